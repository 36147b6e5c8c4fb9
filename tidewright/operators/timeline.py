"""Cutting long timelines into slices of rows, so that no task has to hold a whole key.

A window partitioned by key alone puts every row of that key into one task. When a key may hold a large share of all
rows, the table is range-partitioned by key and full order instead, and the partition a row falls into is its slice. A
slice is bounded by rows, not by time: a burst of readings in one second is cut like any other stretch. Each slice gets
the few neighbouring rows that its frames reach into, taken from a summary of the slices' edges. Group size then depends
on the wished slice size alone, and a frame of *n* rows still sees exactly the rows it would see on the uncut timeline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewright.functions.scalars import epoch_seconds
from tidewright.session import settle

SLICE = "_slice"
CARRIED = "_carried"


def slice_of(ts: str, seconds: int) -> Column:
    """Number of the slice that holds a timestamp."""
    return F.floor(epoch_seconds(ts) / F.lit(seconds))


def with_neighbours(
    df: DataFrame,
    by: list[str],
    order: list[str],
    values: list[str],
    slice_rows: int,
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """Add a slice number and copies of the ``before`` / ``after`` rows next to each slice.

    ``order`` must be a total order within ``by``. Copies carry the keys, the order columns and ``values``, and are
    marked in the ``_carried`` column: windows over (``by``, slice) whose row frames stay within these bounds are exact
    on the unmarked rows. Slices have about ``slice_rows`` rows, by Spark's sample of the range bounds, which should be
    many more than the copies.

    The cut table is settled in the shared folder, so that the edges and the rows agree on one set of bounds.
    """
    slices = max(1, -(-df.count() // slice_rows))
    cut = df.repartitionByRange(slices, *by, *order).withColumn(SLICE, F.spark_partition_id())
    sliced = settle(cut, "timeline").withColumn(CARRIED, F.lit(False))
    columns = list(dict.fromkeys([*order, *values]))
    lean = sliced.select(*by, SLICE, *columns)
    copies = []
    if after:
        copies.append(_carry(lean, by, order, columns, after, forward=True))
    if before:
        copies.append(_carry(lean, by, order, columns, before, forward=False))
    for copy in copies:
        sliced = sliced.unionByName(copy, allowMissingColumns=True)
    return sliced


def _carry(lean: DataFrame, by: list[str], order: list[str], columns: list[str], n: int, forward: bool) -> DataFrame:
    # Only the n rows at the near edge of each slice can be wanted by a neighbour. Ranking with a
    # bound lets every task drop the rest before the shuffle.
    towards = [F.col(c).asc() if forward else F.col(c).desc() for c in order]
    rank = F.row_number().over(Window.partitionBy(*by, SLICE).orderBy(*towards))
    edge = lean.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")

    # On the edge rows alone (n per slice) the rows that follow a slice are the next ones in order.
    along = Window.partitionBy(*by).orderBy(*towards)
    row = F.struct(*columns)
    following = F.array(*[F.lead(row, k).over(along) for k in range(1, n + 1)])
    last_of_slice = ~F.lead(SLICE, 1).over(along).eqNullSafe(F.col(SLICE))
    carried = edge.select(*by, SLICE, following.alias("_rows"), last_of_slice.alias("_last")).where("_last")
    return (
        carried.select(*by, SLICE, F.explode("_rows").alias("_row"))
        .where(F.col("_row").isNotNull())
        .select(*by, SLICE, "_row.*", F.lit(True).alias(CARRIED))
    )
