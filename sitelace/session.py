"""Session settings, tables that cut lineage, and row numbers that survive repartitioning."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PLACE_BITS = 33


def session(name: str = "sitelace", **conf: str) -> SparkSession:
    """Cluster settings come from spark-submit; here only what results depend on, and adaptive execution."""
    builder = SparkSession.builder.appName(name)
    for k, v in ({"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"} | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below `spark.checkpoint.dir`, which driver and executors share.  Where that is unset, a
    local session takes a folder of this machine; a cluster has none that all could read."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "/tmp/checkpoints"
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: the rows as a Parquet table in the shared folder, until `clear_written`."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_written(spark: SparkSession) -> None:
    """Deletes what this application has written there; results that still read it must be saved before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def with_row_id(df: DataFrame, order: Sequence[str | Column], name: str = "rid") -> DataFrame:
    """Dense numbers 0, 1, ... in the given order, by a range exchange and one count for each partition.

    The order must be total for the numbers to be reproducible.  The numbered table is written, so every later use sees
    the same numbers.
    """
    mark = f"{name}_place"
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    laid = written(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(mark, F.monotonically_increasing_id()), "rows")
    part = F.shiftright(mark, PLACE_BITS)
    counts = laid.groupBy(part.alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()  # a row for each partition
    before, at = [], 0
    for r in counts:
        before += [F.lit(r["p"]), F.lit(at)]
        at += r["n"]
    offset = F.create_map(*before)[part] if before else F.lit(0)
    return laid.withColumn(name, (offset + F.col(mark).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))).cast("bigint")).drop(mark)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for a context, so that their Python finds it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_sitelace_shipped", False):
        return
    home = Path(__file__).resolve().parent
    folder = os.path.realpath(tempfile.mkdtemp())
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # executors fetch it from here whenever they start
    target = Path(folder) / "sitelace.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, p.relative_to(home.parent))
    context.addPyFile(str(target))
    context._sitelace_shipped = True
