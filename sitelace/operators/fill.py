"""Forward fills in row order (WIN-01, WIN-02)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import blanks_to_null


def fill_forward(df: DataFrame, columns: Sequence[str], order: str = "rid", within: Sequence[str] = ()) -> DataFrame:
    """Nulls take the last value before them, within groups.

    The order column numbers the rows.  A fill is done in two steps, within blocks of numbers and from the last value of the
    blocks before in the same group, so no task holds more than a block, however large a group is or if there are none.
    Rows whose group is null are dropped.
    """
    for c in within:
        df = df.where(F.col(c).isNotNull())
    block = "fill_block"
    rows = df.withColumn(block, F.floor(F.col(order) / BLOCK_ROWS))
    own = Window.partitionBy(*within, block).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    held = lambda c: F.when(F.col(c).isNotNull(), F.col(order))
    last = rows.groupBy(*within, block).agg(*(F.max_by(F.col(c), held(c)).alias(f"last_{c}") for c in columns))
    # A row for each block of a group: of all rows, a millionth or the number of groups.
    earlier = Window.partitionBy(*within).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*within, block, *(F.last(f"last_{c}", ignorenulls=True).over(earlier).alias(f"before_{c}") for c in columns))
    filled = rows.select("*", *(F.last(c, ignorenulls=True).over(own).alias(f"own_{c}") for c in columns)).join(carried, [*within, block])
    return filled.select(*(F.coalesce(f"own_{c}", f"before_{c}").alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns))


BLOCK_ROWS = 1_000_000


def clean_workbook(df: DataFrame, group: str, order: str = "rid") -> DataFrame:
    """Merged cells: blanks become null, the group column is filled down, then all others within their group; what is
    still missing becomes a dash (PRJ-01, WIN-01, WIN-02, PRJ-02)."""
    others = [c for c in df.columns if c not in (group, order)]
    rows = fill_forward(blanks_to_null(df), [group], order)
    rows = fill_forward(rows, others, order, within=[group])
    return _dashed(rows, order)


def _dashed(rows: DataFrame, order: str) -> DataFrame:
    """A dash for what is missing, but in the order column."""
    return rows.select(*(F.col(f"`{c}`") if c == order else F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("-")).alias(c) for c in rows.columns))
