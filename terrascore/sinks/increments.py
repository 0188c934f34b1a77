"""Incremental publish: only what changed is written, a load without change writes nothing.

A published table is a set of folders, one per bucket of its keys, and a manifest
that says which folder holds which bucket. A new snapshot is digested per bucket
(rows and two sums over row hashes, one partial aggregation); buckets whose digest
differs from the published one are written to a folder of the new version, the
others keep theirs. One commit of the new manifest makes the version current:
readers see the old set or the new one, never a mixture, a failed load leaves the
old one, and earlier versions stay readable for as long as their folders are kept.

The manifest has one row per bucket and version, and one that marks the version
(bucket -1: an empty table is a version too); only those rows, as many as there are
buckets, reach the driver.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64
BUCKET = "_bucket"
MARKER = -1
MANIFEST = "version long, bucket int, n_rows long, hash_sum decimal(38,0), hash_xor long, folder string"


@dataclass(frozen=True)
class Publication:
    """What a publish did: its version (the one before, if nothing changed) and
    the buckets that it wrote, kept and dropped."""

    version: int
    written: tuple[int, ...]
    kept: tuple[int, ...]
    dropped: tuple[int, ...]


def bucket_of(keys: tuple[str, ...], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def row_hash(columns: list[str]) -> Column:
    """A hash of a whole row. Hashes skip nulls, so which columns are null is
    hashed too: a value that moves to another column changes the row."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def bucket_digests(df: DataFrame, keys: tuple[str, ...], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n_rows, hash_sum, hash_xor): the same for the same rows in any
    order, repeated rows included."""
    hashed = df.select(bucket_of(keys, buckets).alias("bucket"), row_hash(df.columns).alias("h"))
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("h").cast("decimal(38,0)")).cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor("h").alias("hash_xor"))


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def current_version(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, dict[int, tuple]]:
    """(version, bucket -> manifest row) of the current or the given version;
    (0, none) before the first publish."""
    if not _published(spark, root):
        return 0, {}
    rows = _manifest(spark, root)
    at = F.lit(version) if version is not None else rows.select(F.max("version")).scalar()
    found = rows.where(F.col("version") == at).collect()
    return max((r["version"] for r in found), default=0), {r["bucket"]: r for r in found if r["bucket"] != MARKER}


def _published(spark: SparkSession, root: str) -> bool:
    """Whether the table has a manifest: a read of a folder that is not there is
    refused when the plan is made."""
    from pyspark.errors import AnalysisException
    try:
        _manifest(spark, root).schema
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def publish_changes(df: DataFrame, root: str, keys: tuple[str, ...], buckets: int = BUCKETS) -> Publication:
    """Make ``df`` the current version of the table at ``root``, writing only the
    buckets that differ. ``df`` is read twice (digest, write): stage it first. The
    number of buckets is the table's; another one rewrites all of it."""
    spark, root = df.sparkSession, root.rstrip("/")
    last, before = current_version(spark, root)
    after = {r["bucket"]: r for r in bucket_digests(df, keys, buckets).collect()}

    def same(b: int) -> bool:
        return b in before and all(before[b][f] == after[b][f] for f in ("n_rows", "hash_sum", "hash_xor"))

    kept = tuple(sorted(b for b in after if same(b)))
    written = tuple(sorted(set(after) - set(kept)))
    dropped = tuple(sorted(set(before) - set(after)))
    if last and not written and not dropped:
        return Publication(last, (), kept, ())
    folder = f"{root}/data/{uuid.uuid4().hex[:12]}"
    if written:
        rows = df.withColumn(BUCKET, bucket_of(keys, buckets))
        if kept:
            rows = rows.where(F.col(BUCKET).isin(*written))
        rows.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(folder)
    entries = [(last + 1, b, r["n_rows"], r["hash_sum"], r["hash_xor"],
                before[b]["folder"] if b in kept else f"{folder}/{BUCKET}={b}") for b, r in sorted(after.items())]
    entries.append((last + 1, MARKER, 0, None, None, None))
    spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return Publication(last + 1, written, kept, dropped)


def read_published(spark: SparkSession, root: str, schema: StructType, version: int | None = None) -> DataFrame:
    """The current (or the given) version of the table at ``root``."""
    folders = [r["folder"] for r in current_version(spark, root.rstrip("/"), version)[1].values()]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
