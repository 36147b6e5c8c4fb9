"""Token counts, token files and packing against the tokenizer's library and brute force."""

import random
import zlib
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow.fs
import pytest
import zstandard
from tokenizers import Tokenizer

from tidewright.llm import QUERIES
from tidewright.llm.common import bucket_bounds, bucket_of, shared_path
from tidewright.llm.packing import optimal_boundaries, pack
from tidewright.llm.pretokens import pretokenizer
from tidewright.llm.token_counts import pretoken_table, token_counts
from tidewright.llm.token_files import opened, read_documents, read_token_files, write_token_files

from .cases import AWKWARD, SF, awkward, documents, empty, load

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_pretokens_encode_as_the_library(library):
    own = pretokenizer(PATH)
    random.seed(3)
    alphabet = "ab'sR1٣½ .,\n\t\x1c\x85\xa0 éÉéÅΣσςİıǅß漢👩‍<|>" + "".join(chr(c) for c in range(0x20, 0x250, 7))
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 40))) for _ in range(3000)]
    texts += [chr(c) + "a " + chr(c) for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000]
    texts += [t or "" for _, t in AWKWARD] + documents()["text"].tolist()
    texts += ["it's ''s we'll'd 're don't'", "i'M ‘s 's's", "a1b22 x²½ ab%%% $$a", "Ⱥɏ Ⱦ's ʼn ª"]
    for text, data, n in zip(texts, own.encode(texts), own.lengths(texts), strict=True):
        assert np.frombuffer(data, own.dtype).tolist() == ids_of(library, text), repr(text[:80])
        assert n * own.dtype.itemsize == len(data)
    few = texts[:200]
    assert own.encode(few, most=50) == own.encode(few) and own.lengths(few, most=50) == own.lengths(few)


@pytest.mark.parametrize("hot", [0, 3, 1 << 17])
def test_counts_of_awkward_rows(spark, library, hot):
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts(awkward(spark), PATH, hot=hot).collect()), key=repr)
    want = sorted(((d, len((t or "").encode()), len(ids_of(library, t))) for d, t in AWKWARD), key=repr)
    assert got == want
    assert token_counts(empty(spark), PATH).collect() == []


def test_each_pretoken_is_counted_once(spark):
    rows = pretoken_table(awkward(spark), PATH).collect()
    assert len({r.piece for r in rows}) == len(rows)
    assert next(r.n for r in rows if r.piece == "long") >= 30_000


def test_query_counts(spark, library):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op2_token_counts"](spark, SF).collect()}
    for doc, text in documents()[["doc_id", "text"]].itertuples(index=False):
        n = len(ids_of(library, text))
        assert got[doc] == (len(text.encode()), n, n > 2048)


def brute_files(rows, library):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    out, start = [], 0
    for doc, text in order:
        ids = ids_of(library, text) + [2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


@pytest.mark.parametrize("per_shard", [2, 5, 4096])
def test_files_of_awkward_rows(spark, library, per_shard):
    manifest = write_token_files(awkward(spark), shared_path(spark, "t"), PATH, 2, rows_per_task=per_shard)
    got = sorted(map(tuple, read_token_files(manifest).collect()), key=repr)
    assert got == brute_files(AWKWARD, library)
    wanted = spark.createDataFrame([(7,), (8,), (99,)], "doc_id long")
    found = sorted(((r.doc_id, r.ids) for r in read_documents(manifest, wanted).collect()), key=repr)
    texts = [(d, t) for d, t in AWKWARD if d in (7, 8)]
    assert found == sorted(((d, ids_of(library, t) + [2]) for d, t in texts), key=repr)


def test_files_of_no_rows(spark):
    manifest = write_token_files(empty(spark), shared_path(spark, "t"), PATH, 2)
    assert read_token_files(manifest).collect() == []


def test_query_files(spark, library):
    rows = list(documents()[["doc_id", "text"]].itertuples(index=False, name=None))
    assert sorted(map(tuple, QUERIES["op3_token_files"](spark, SF).collect()), key=repr) == brute_files(rows, library)


def test_frames_are_independent_and_checked(spark):
    manifest = write_token_files(load(spark, "documents"), shared_path(spark, "t"), PATH, 2).first()
    store, inner = pyarrow.fs.FileSystem.from_uri(manifest.path)
    data = store.open_input_file(inner).read()
    whole = b"".join(opened(manifest.path).ids(i).tobytes() for i in range(manifest.n_docs))
    # Any zstandard reader gets the ids: tables are skippable frames.
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain == whole and len(plain) == 2 * manifest.n_ids
    broken = bytearray(data)
    broken[len(broken) - 9 - 12 * 2 + 8] ^= 1  # checksum of the last frame with ids
    with store.open_output_stream(inner + ".bad", compression=None) as out:
        out.write(bytes(broken))
    shard = opened(manifest.path + ".bad")
    with pytest.raises(ValueError, match="checksum"):
        shard.ids(manifest.n_docs - 1)
    # A reader of the first document leaves later frames alone.
    assert shard.ids(0).tobytes() == whole[: 2 * int(shard.starts[1])]


def test_buckets_follow_the_key(spark):
    df = spark.range(1000).selectExpr("id * id AS k").union(spark.createDataFrame([(None,)], "k long"))
    bounds = bucket_bounds(df, "k", 50)
    rows = df.select("k", bucket_of(df.k, bounds).alias("b")).collect()
    for k, b in rows:
        assert b == (0 if k is None else int(np.searchsorted(bounds, k, "right")))


def test_boundaries_are_optimal():
    random.seed(5)
    for _ in range(60):
        lengths = sorted(random.sample(range(1, 30), random.randint(1, 7)))
        counts = [random.randint(1, 9) for _ in lengths]
        k = random.randint(1, 4)

        def padding(edges):
            return sum(c * (min(e for e in edges if e >= n) - n) for n, c in zip(lengths, counts))

        best = min(padding({lengths[-1], *s}) for s in product(lengths, repeat=k - 1)) if k > 1 else padding({lengths[-1]})
        edges = optimal_boundaries(np.array(lengths), np.array(counts), k)
        assert len(edges) <= k and padding(edges) == best


def check_packing(rows, limit, budget, lengths):
    by_doc, batches = {}, {}
    for r in rows:
        assert 1 <= r.length <= r.padded and r.start == r.piece * limit
        by_doc.setdefault(r.doc_id, []).append(r.length)
        batches.setdefault((r.padded, r.batch), []).append(r.slot)
    assert {d: sum(n) for d, n in by_doc.items()} == lengths
    last = {}
    for (padded, batch), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) * padded <= budget
        last[padded] = max(last.get(padded, 0), batch)
    for (padded, batch), slots in batches.items():
        if batch < last[padded]:
            assert len(slots) == budget // padded


@pytest.mark.parametrize("per_slice", [3, 20_000])
def test_packing(spark, per_slice):
    rows = [(i, (i * 37) % 300) for i in range(200)] + [(1000 + i, 17) for i in range(100)] + [(5000, None), (5001, 1000)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long")
    got = pack(df, limit=128, buckets=5, budget=512, rows_per_slice=per_slice).collect()
    check_packing(got, 128, 512, {d: max(1, n or 0) for d, n in rows})
    assert len({r.padded for r in got}) <= 5
    assert pack(df.limit(0)).collect() == []


def test_query_packing(spark, library):
    got = QUERIES["op8_packing_buckets"](spark, SF).collect()
    want = {d: len(ids_of(library, t)) + 1 for d, t in documents()[["doc_id", "text"]].itertuples(index=False)}
    check_packing(got, 2048, 65_536, want)


def test_shards_are_bounded_by_bytes_and_hold_whole_ids(spark, library):
    rows = [(i // 3, f"text number {i} " * (i % 7)) for i in range(60)] + [(None, f"no id {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = write_token_files(df, shared_path(spark, "t"), PATH, 2, rows_per_task=30, shard_bytes=200)
    assert sorted(map(tuple, read_token_files(manifest).collect()), key=repr) == brute_files(rows, library)
    shards = manifest.orderBy("shard").collect()
    assert len(shards) > 8 and max(r.n_ids for r in shards) < 250 and [r.start for r in shards] == sorted(r.start for r in shards)
    wanted = spark.createDataFrame([(d,) for d in range(20)], "doc_id long")
    found = sorted((r.doc_id, tuple(r.ids)) for r in read_documents(manifest, wanted).collect())
    assert found == sorted((d, tuple([*ids_of(library, t), 2])) for d, t in rows if d is not None)
