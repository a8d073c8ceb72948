"""Tolerant parsing (PARSE-01 to 03, PRJ-01 to 04 and 13, SEM-03)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER = r"[-+]?\d+(?:[.,]\d+)?"
#: From this value on a voltage is in volts.
VOLTS_FROM = 1000


def numeric(c: Column) -> Column:
    return c.try_cast("double")


def lenient_float(c: Column) -> Column:
    """A decimal comma is taken for a point."""
    return F.replace(F.trim(c.cast("string")), F.lit(","), F.lit(".")).try_cast("double")


def robust_float(c: Column) -> Column:
    """A number, or the first number in the text, with degree signs and decimal commas; else null."""
    text = F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", "")
    found = F.regexp_extract(F.translate(text, "º°", ""), NUMBER, 0)
    return F.coalesce(text.try_cast("double"), F.replace(found, F.lit(","), F.lit(".")).try_cast("double"))


def parse_voltage(c: Column) -> Column:
    """The highest level in kV, rounded half to even; null without a number."""
    text = F.replace(c.cast("string"), F.lit(","), F.lit("."))
    numbers = F.transform(F.regexp_extract_all(text, F.lit(r"(\d+(?:\.\d+)?)"), F.lit(0)), lambda x: x.cast("double"))
    levels = F.transform(numbers, lambda v: F.when(v >= VOLTS_FROM, v / 1000).otherwise(v))
    return F.bround(F.array_max(levels)).cast("int")


def max_kv(c: Column) -> Column:
    """Highest of volts joined by semicolons, in kV; 0 if any part is not a number."""
    parts = F.transform(F.split(F.coalesce(c.cast("string"), F.lit("")), ";"), lambda x: F.trim(x).try_cast("double"))
    return F.when(F.exists(parts, lambda x: x.isNull()), F.lit(0.0)).otherwise(F.array_max(parts) / 1000)


def blank_to_null(c: Column) -> Column:
    return F.when(c.rlike(r"(?U)^\s*$"), None).otherwise(c)


def blanks_to_null(df: DataFrame) -> DataFrame:
    return df.select(*(blank_to_null(F.col(f"`{n}`")).alias(n) if t == "string" else F.col(f"`{n}`") for n, t in df.dtypes))


def nulls_to_dash(df: DataFrame) -> DataFrame:
    return df.select(*(F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("-")).alias(n) for n in df.columns))


def has_text(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def sanitize(c: Column) -> Column:
    """Line ends become spaces, ends are trimmed."""
    return F.regexp_replace(F.regexp_replace(c, r"[\r\n]+", " "), r"(?U)^\s+|\s+$", "")


def named_split(df: DataFrame, name: str = "name_clean") -> tuple[DataFrame, DataFrame]:
    """Rows with a name, and all others."""
    named = F.coalesce(F.trim(F.col(name)) != "", F.lit(False))
    return df.where(named), df.where(~named)
