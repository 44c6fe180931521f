"""Time blocks: windows over a series without one task per entity.

A plain ``Window.partitionBy(entity)`` puts all rows of an entity into one task, so one
entity that holds a third of the data is one straggler. Here a series is cut into blocks
of consecutive slots and windows run per (entity, block):

* frames of bounded reach get the rows they look back on copied into the next block
  (``open_blocks`` / ``close_blocks``);
* frames of unbounded reach get a few values per block carried across blocks
  (``carry``): blocks are aggregated to one row each, a window runs over these few rows,
  and its result is joined back on (entity, block).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions.timegrid import floor_div

BLOCK = "_block"
OWN = "_own"


def open_blocks(df: DataFrame, slot: Column, block_slots: int, look_back: int) -> DataFrame:
    """Assign blocks and copy the last ``look_back`` slots of each into the following ones.

    One row per slot and entity is expected, so a reach of n rows is a reach of n slots.
    Copies are marked ``_own = false``.
    """
    home = floor_div(slot, block_slots)
    if look_back <= 0:
        return df.withColumn(BLOCK, home).withColumn(OWN, F.lit(True))
    last = floor_div(slot + F.lit(look_back), block_slots)
    return (
        df.withColumn("_home", home)
        .withColumn(BLOCK, F.explode(F.sequence("_home", last)))
        .withColumn(OWN, F.col(BLOCK) == F.col("_home"))
        .drop("_home")
    )


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """Rows by (keys, block) in as many tasks as shuffles have.

    Rows of a grid, most of them empty, are few bytes when written and many in the sorts of windows: by these bytes the runtime
    would merge far too many into a task. A number of partitions given here it leaves as it is.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def close_blocks(df: DataFrame) -> DataFrame:
    """Drop the copied rows once all windows have run."""
    return df.filter(OWN).drop(BLOCK, OWN)


def carry(
    df: DataFrame,
    keys: Sequence[str],
    block: str,
    summary: dict[str, Column],
    *across: dict[str, Column],
    placed: bool = False,
) -> DataFrame:
    """Add to every row of a block values computed from the summaries of all blocks.

    ``summary`` are aggregates per (keys, block). ``across`` are expressions over these
    summary rows, built on ``before_blocks`` / ``after_blocks``; a later set of them may
    use the columns of an earlier one. The window over blocks
    sees one row per block: its size is the covered span divided by the block length,
    whatever the number of rows. The exchange on (keys, block) serves both the summary
    and the joined rows; ``placed`` says that ``df`` already comes out of one.
    """
    by = [*keys, block]
    spread = df if placed else df.repartition(*by)
    per_block = spread.groupBy(*by).agg(*[c.alias(n) for n, c in summary.items()])
    carried = per_block
    for step in across:
        carried = carried.withColumns(step)
    carried = carried.select(*by, *[name for step in across for name in step])
    return spread.join(carried, by, "left")


def before_blocks(keys: Sequence[str], block: str):
    return Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)


def after_blocks(keys: Sequence[str], block: str):
    """All later blocks, nearest last; reversed order keeps the frame linear."""
    return (
        Window.partitionBy(*keys).orderBy(F.col(block).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def all_blocks(keys: Sequence[str]):
    return Window.partitionBy(*keys)
