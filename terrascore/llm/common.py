"""Small helpers shared by the training-data operators.

Every operator copies the columns it needs into names of its own before it
works, so extra columns of the input, whatever they are called, cannot clash.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrascore.session import shared_path, stage_table

#: ASCII white space, as text and as the inside of a regex class.
WS_CHARS = " \t\n\x0b\x0c\r"
WS_CLASS = r"\x20\x09-\x0D"
#: Of rows that are handed to Python at once (a longer row is by itself).
BATCH = "4m"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

__all__ = ["LOWER", "UPPER", "WS_CHARS", "WS_CLASS", "read_table", "row_key", "shared_path",
           "ship_code", "shuffles_removed", "small_batches", "split_words", "stage_table", "trimmed", "word_count"]

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Hand this package's source to the executors' Python workers, once per
    application, so that it need not be installed there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="code-"), f"{os.path.basename(package)}_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, Spark removes the shuffle files of each execution at its end, for
    chains of staged tables: what a later step needs is in the staged one."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, rows go to Python ``BATCH`` at a time, for tasks over texts: Spark's
    own limit is a number of rows, whatever their length, and such a batch is held
    by the JVM, outside its heap and while it grows twice, and by Python."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trimmed(text: Column) -> Column:
    """``text`` (null: empty) without ASCII white space at either end."""
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(WS_CHARS))


def split_words(text: Column, separators: str = WS_CLASS) -> Column:
    """The words between runs of ``separators`` (a regex class body); none for
    null, empty or blank text."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{separators}]+")
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    t = trimmed(text)
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, f"[{WS_CLASS}]+"))).cast("long")


def row_key() -> Column:
    """One number per input row. Only stable once the rows are staged, so it is
    always followed by ``stage_table`` before anything joins on it."""
    return F.monotonically_increasing_id()
