"""Registered queries of the operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontaminate, divergence, license_scan, line_dedup, packing, quality_gam, simhash, suffix_dedup, token_counts, token_files, toxicity, winnowing
from .common import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def _query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@_query("op1_quality_gam")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    return quality_gam.quality(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


@_query("op2_token_counts")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Token count of every document."""
    found = token_counts.token_counts(_read(spark, folder, "documents"), TOKENIZER)
    return found.selectExpr("doc_id", "n_bytes", "n_tokens", "n_tokens > 2048 AS over_limit")


@_query("op3_token_files")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as read back from token files."""
    documents = _read(spark, folder, "documents")
    manifest = token_files.write_token_files(documents, shared_path(spark, "tokens"), TOKENIZER, END_ID)
    return token_files.read_token_files(manifest)


@_query("op4_winnowing")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return winnowing.fingerprint_edits(_read(spark, folder, "documents"))


#: Exact spread of lines; the first occurrence of a boilerplate line stays.
LINE_SQL = r"""
WITH split AS (
    SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
           trim(unnest(string_split(text, chr(10)))) AS line
    FROM documents
), lines AS (
    SELECT *, len(regexp_extract_all(line, '[^ \t]+')) AS words FROM split
), counted AS (
    SELECT doc_id, pos, line,
           CASE WHEN words > 50 THEN 'doc:' || doc_id ELSE 'site:' || coalesce(source, '') END AS site
    FROM lines WHERE words >= 3
), spread AS (
    SELECT line, min((doc_id, pos)) AS first FROM counted GROUP BY line HAVING count(DISTINCT site) >= 2
), gone AS (
    SELECT doc_id, pos FROM counted JOIN spread USING (line) WHERE (doc_id, pos) <> first
), kept AS (
    SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
           unnest(string_split(text, chr(10))) AS line
    FROM documents
), texts AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text
    FROM kept ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
), counts AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
"""
OP5_SQL = LINE_SQL + """
SELECT d.doc_id,
       CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE len(string_split(d.text, chr(10))) END::BIGINT AS n_lines,
       coalesce(c.n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END AS text
FROM documents d LEFT JOIN texts t USING (doc_id) LEFT JOIN counts c USING (doc_id)
"""


@_query("op5_line_spread", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the boilerplate lines."""
    return line_dedup.dedup_lines(_read(spark, folder, "documents")).select("doc_id", "n_lines", "n_removed", "text")


@_query("op6_toxicity_kn")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


@_query("op7_license_rules")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and labels of every document."""
    return license_scan.license_labels(_read(spark, folder, "documents"))


@_query("op8_packing_buckets")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Bucket and batch of every piece of every document."""
    lengths = packing.token_lengths(_read(spark, folder, "documents"), TOKENIZER)
    return packing.pack(lengths)


@_query("op9_decontamination_fm")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark hits of every document."""
    return decontaminate.contamination(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


@_query("op10_simhash_golay")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.simhash_components(_read(spark, folder, "documents"))


#: Exact with 128-bit whole numbers; the terms of every pair of sources are met one by one.
OP11_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), words AS (
    SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*)::HUGEINT AS c FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 30
), langs AS (
    SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY lang
), counts AS (
    SELECT lang, source, term, count(*)::HUGEINT AS c FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
), totals AS (
    SELECT lang, source, sum(c)::HUGEINT AS n FROM counts GROUP BY lang, source
), groups AS (
    SELECT g.lang, g.source, coalesce(t.n, 0)::HUGEINT AS n, l.v
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN totals t USING (lang, source) LEFT JOIN langs l USING (lang)
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
           1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (g.n + 5 * g.v) AS p,
           1 + (1000000000::HUGEINT * (k.c + 5)) // (l.n + 5 * l.v) AS q
    FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), met AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(m.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN met m ON m.lang = a.lang AND m.source = a.source AND m.item = b.source
), found AS (
    SELECT * FROM pairs
    UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE c > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@_query("op11_level_products", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Divergence of every source from the others of its language, and its telling terms."""
    return divergence.divergence(_read(spark, folder, "documents"))


#: Every n-gram of every piece, joined with its parts and with the phrases that hold it.
OP12_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), places AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM places, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)
), totals AS (
    SELECT lang, count(*) AS n FROM places GROUP BY lang
), known AS (
    SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM known WHERE k >= 2
), cuts AS (
    SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS cut FROM candidates
), rated AS (
    SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
    FROM cuts c
    JOIN known x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
    JOIN known y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')
), best AS (
    SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
    SELECT c.lang, c.a AS longer, array_to_string(c.w[i:i + m - 1], ' ') AS phrase
    FROM candidates c, (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([2, 3]) AS m) WHERE i + m - 1 <= c.k AND m < c.k
), gone AS (
    SELECT DISTINCT i.lang, i.phrase FROM inside i JOIN known x ON x.lang = i.lang AND x.phrase = i.phrase WHERE 100 * i.longer >= 80 * x.f
), ranked AS (
    SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM best b ANTI JOIN gone g ON g.lang = b.lang AND g.phrase = b.phrase
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@_query("op12_collocations", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2,000 collocations of every language."""
    return collocations.collocations(_read(spark, folder, "documents"))


@_query("op13_suffix_dedup")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the passages of 400 bytes that stand anywhere else too."""
    found = suffix_dedup.remove_repeats(_read(spark, folder, "documents").select("doc_id", "text"))
    # What remains of a character that a cut has split is shown as U+FFFD; the digest is of the bytes as they are.
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))
