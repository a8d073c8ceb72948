"""Colours and widths of map features (PAL-01, PAL-02, NUM-02)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Colours of common levels, the cycle for others, and what stands in where there is no level.
PREFERRED = {
    34: "#00E676", 44: "#00B0FF", 66: "#7C4DFF", 110: "#00E5FF", 115: "#2979FF", 138: "#AA00FF",
    220: "#FF6D00", 230: "#00C853", 345: "#FFD600", 400: "#D50000", 500: "#FF1744", 750: "#FF4081",
}
CYCLE = ("#00BCD4", "#FF5722", "#8BC34A", "#3F51B5", "#FFC107", "#E91E63", "#4CAF50", "#9C27B0", "#FF9800", "#2196F3", "#CDDC39", "#F44336")
NO_STATION, NO_LINE = "#BDBDBD", "#757575"


def palette(levels: DataFrame, kv: str = "kv") -> DataFrame:
    """(kv, colour) of the distinct levels: the preferred colour, or the next of the cycle in order of level."""
    present = levels.where(F.col(kv).isNotNull()).select(F.col(kv).cast("int").alias("kv")).distinct()
    fixed = F.create_map(*(F.lit(x) for pair in PREFERRED.items() for x in pair))[F.col("kv")]
    marked = present.withColumn("fixed", fixed)
    # Distinct levels only: a few dozen rows.
    place = F.row_number().over(Window.partitionBy(F.col("fixed").isNull()).orderBy("kv")) - 1
    cycle = F.get(F.array(*map(F.lit, CYCLE)), F.pmod(place, F.lit(len(CYCLE))))
    return marked.select("kv", F.coalesce("fixed", cycle).alias("colour"))


def coloured(df: DataFrame, colours: DataFrame, default: str, kv: str = "kv") -> DataFrame:
    return df.join(colours.withColumnRenamed("kv", "level"), F.col(kv) == F.col("level"), "left").withColumn("colour", F.coalesce("colour", F.lit(default))).drop("level")


def line_weight(kv: Column) -> Column:
    return F.when(kv.isNull() | (kv < 200), 2.5).when(kv < 400, 3.5).otherwise(4.5)
