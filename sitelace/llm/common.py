"""What the corpus operators share: where tables lie, where lineage is cut, how large an Arrow batch may get, and what a
Python worker keeps between tasks."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder, written

__all__ = ["bounded_batches", "fresh", "one_blas_thread", "shared_dir", "table", "text_or_empty", "tokenizer_path", "worker_cache", "written"]
#: Rows of one Arrow batch, and its bytes: a batch ends with the row that reaches either, so only a single text is larger.
ARROW_ROWS, ARROW_BYTES = 512, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches small enough for long texts; smaller settings stay.

    Plans are made when a result is asked for, so the settings hold for the session from here on."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        now = int(spark.conf.get(key, str(most + 1)).removesuffix("b"))
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


_held: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What an operator keeps in this worker from task to task.  What others have kept goes, memory and all, so a worker
    that serves one stage after another holds the caches of one."""
    others = [k for k in _held if k != owner]
    for k in others:
        del _held[k]
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call, it keeps the pages
            ctypes.CDLL(None).malloc_trim(0)
    return _held.setdefault(owner, {})


_limited = False


def one_blas_thread() -> None:
    """A task has one core, but numpy's linear algebra takes as many threads as the executor has cores and lets them spin
    between calls.  Where it is OpenBLAS, this process gets one from here on; elsewhere nothing changes."""
    global _limited
    if _limited:
        return
    _limited = True
    with contextlib.suppress(OSError):
        with open("/proc/self/maps") as f:
            paths = {line.split()[-1] for line in f if "openblas" in line}
        for path in paths:
            library = ctypes.CDLL(path)
            for name in ("openblas_set_num_threads", "openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "scipy_openblas_set_num_threads64_"):
                if set_threads := getattr(library, name, None):
                    set_threads(1)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    return public_tokenizers.path(name)


def fresh(name: str, *taken: str) -> str:
    """The name, with as many underscores behind it as keep it apart from columns that are there (in any case)."""
    held = {t.lower() for t in taken}
    while name.lower() in held:
        name += "_"
    return name


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))
