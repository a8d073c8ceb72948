"""Delimited files and workbooks (SRC-09 to 12).  Cells are text; casts are the caller's."""

from __future__ import annotations

import codecs
import csv
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE_BYTES = 65_536
DELIMITERS = ",;\t|"


@dataclass(frozen=True)
class Dialect:
    sep: str = ","
    quote: str = '"'
    newline: str = "\n"
    encoding: str = "utf-8"


def read_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "utf-8") -> DataFrame:
    """All text, line ends allowed within quotes, a byte order mark taken off; short rows are padded with nulls."""
    df = spark.read.csv(path, header=True, sep=sep, encoding=encoding, multiLine=True, quote='"', escape='"', mode="PERMISSIVE")
    return df.toDF(*(c.lstrip("﻿") for c in df.columns))


def head(spark: SparkSession, path: str, size: int = SAMPLE_BYTES) -> bytes:
    """The first bytes of a file, through Spark's own file systems."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).open(hadoop)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(spark._jvm.org.apache.commons.io.input.BoundedInputStream(stream, size)))
    finally:
        stream.close()


def sniff(sample: bytes) -> Dialect:
    """Encoding, line end and delimiter of a sample; a comma where none of the known delimiters shows."""
    for encoding in ("utf-8", "utf-8-sig", "latin-1"):
        try:
            # A sample can end within a character.
            text = codecs.getincrementaldecoder(encoding)().decode(sample)
            break
        except UnicodeDecodeError:
            continue
    newline = "\r\n" if "\r\n" in text else "\r" if "\r" in text and "\n" not in text else "\n"
    try:
        found = csv.Sniffer().sniff(text, delimiters=DELIMITERS)
        return Dialect(found.delimiter, found.quotechar or '"', newline, encoding)
    except csv.Error:
        return Dialect(",", '"', newline, encoding)


def read_sniffed(spark: SparkSession, path: str) -> tuple[DataFrame, Dialect]:
    """The table and the dialect to write it back in.  Rows with too many cells are dropped, short ones padded."""
    dialect = sniff(head(spark, path))
    encoding = {"utf-8-sig": "utf-8", "latin-1": "ISO-8859-1"}.get(dialect.encoding, dialect.encoding)
    names = read_csv(spark, path, dialect.sep, encoding).columns
    bad = "__bad_line"
    schema = ", ".join(f"`{n}` string" for n in [*names, bad])
    df = spark.read.schema(schema).csv(path, header=True, sep=dialect.sep, encoding=encoding, quote=dialect.quote, escape=dialect.quote, multiLine=True, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=bad)
    counted = _cells(F.col(bad), dialect)
    return df.where(F.col(bad).isNull() | (counted <= len(names))).drop(bad), dialect


def _cells(line, dialect: Dialect):
    """How many cells a raw line has: delimiters outside quotes, and one."""
    quoted = F.regexp_replace(line, f"{dialect.quote}[^{dialect.quote}]*{dialect.quote}", "")
    return F.coalesce(F.size(F.split(quoted, "\\" + dialect.sep if dialect.sep == "|" else dialect.sep, -1)), F.lit(0))


def read_workbook(spark: SparkSession, path: str, header_row: int = 1) -> DataFrame:
    """An Excel sheet as text, its header in the second row.  Needs pandas' engine for the file type; sheets fit a driver."""
    import pandas as pd

    sheet = pd.read_excel(path, header=header_row, dtype=str)
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in sheet.itertuples(index=False)]
    schema = ", ".join(f"`{c}` string" for c in [*map(str, sheet.columns), "rid"][:-1])
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{schema}, rid bigint")
    return df
