"""Tables of Kneser-Ney models, built in the tasks and kept in the shared folder.

N-grams are grouped by the last two bytes of their context. All orders from 3 on are settled inside such a group: a
context, its n-grams and the continuation counts below them agree in these bytes. A group has distinct n-grams, not
occurrences, so a frequent word makes none larger. The orders below have at most 65,536 pairs of bytes and are built in one
group per model. Three models are kept: of all learning rows, and of either half of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_path
from .kneser_ney import KneserNey

#: Counts of a word or n-gram: by class in all learning rows, and in one half of them.
COUNTS = ("ordinary", "toxic", "ordinary_a", "toxic_a")

#: The least order that is settled inside the groups.
LEAST = 3

_ROWS = "model int, level int, context boolean, key long, a double, b double"


def _parts(counts: np.ndarray) -> list[np.ndarray]:
    return [counts[:, :2], counts[:, :2] - counts[:, 2:], counts[:, 2:]]


def _level_rows(model: int, built: KneserNey) -> list[pd.DataFrame]:
    """The tables of a model's levels as rows: n-grams with their own shares, contexts with the weights of the rest."""
    out = []
    for level, (grams, own, context, weight) in zip(range(built.order, built.least - 1, -1), built.levels):
        for keys, values, is_context in ((grams, own, False), (context, weight, True)):
            out.append(pd.DataFrame({"model": model, "level": level, "context": is_context, "key": keys, "a": values[:, 0], "b": values[:, 1]}))
    return out


def write_tables(grams: DataFrame, order: int, shared: int) -> str | None:
    """The folder with the tables of the models over a settled table (gram and counts); None without both classes."""
    if not LEAST <= shared < order:
        raise ValueError("shared orders are from 3 on and less than the order")
    total = grams.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS]).first()
    if not (total["ordinary"] and total["toxic"]):
        return None
    # A half that lacks a class gets the model of the whole.
    use = [k if part.all() else 0 for k, part in enumerate(_parts(np.array([list(total)])))]

    def upper(group: pd.DataFrame) -> pd.DataFrame:
        keys, parts = group["gram"].to_numpy(np.int64), _parts(group[list(COUNTS)].to_numpy(np.int64))
        out = []
        for k, chosen in enumerate(use):
            seen = parts[chosen].sum(axis=1) > 0
            if seen.any():
                built = KneserNey(keys[seen], parts[chosen][seen], order, shared, LEAST)
                low, values = built.rest
                # Level 0 are the counts that the orders below are built from.
                below = pd.DataFrame({"model": k, "level": 0, "context": False, "key": low, "a": values[:, 0].astype(float), "b": values[:, 1].astype(float)})
                out += [*_level_rows(k, built), below]
        return pd.concat(out) if out else pd.DataFrame([], columns=[c.split()[0] for c in _ROWS.split(", ")])

    def lower(group: pd.DataFrame) -> pd.DataFrame:
        built = KneserNey(group["key"].to_numpy(np.int64), group[["a", "b"]].to_numpy(np.int64), LEAST - 1, LEAST - 1)
        return pd.concat(_level_rows(int(group["model"].iat[0]), built))

    folder = shared_path(grams.sparkSession, "kneser-ney")
    pair = F.shiftrightunsigned("gram", 8).bitwiseAND(F.lit(0xFFFF)).alias("pair")
    grams.groupBy(pair).applyInPandas(upper, _ROWS).write.partitionBy("model").parquet(folder)
    low = grams.sparkSession.read.schema(_ROWS).parquet(folder).where("level = 0")
    low = low.groupBy("model", "key").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    low.groupBy("model").applyInPandas(lower, _ROWS).write.mode("append").partitionBy("model").parquet(folder)
    return folder


def opened_model(folder: str, model: int, shared: int) -> KneserNey:
    """A model from its tables; only its own part of the folder is read."""
    store, inner = fs.FileSystem.from_uri(folder)
    rows = pq.read_table(f"{inner}/model={model}", filesystem=store, partitioning=None, use_threads=False)
    rows = rows.filter(pc.greater(rows.column("level"), 0))
    level, context, key = (rows.column(c).to_numpy() for c in ("level", "context", "key"))
    values = np.column_stack([rows.column(c).to_numpy() for c in ("a", "b")])
    del rows
    pa.default_memory_pool().release_unused()

    def table(n: int, is_context: bool) -> tuple[np.ndarray, np.ndarray]:
        own = np.flatnonzero((level == n) & (context == is_context))
        own = own[np.argsort(key[own])]
        return key[own], values[own]

    levels = [(*table(n, False), *table(n, True)) for n in range(int(level.max()), 0, -1)]
    del level, context, key, values
    return KneserNey.from_levels(levels, shared)
