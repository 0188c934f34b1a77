"""Session construction and the shared working folder.

Intermediate tables and lineage cuts go to the folder the cluster names in
``spark.checkpoint.dir`` (shared storage on a real cluster). Only a local
session without one gets a folder of its own; any other is refused.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A stack walk for every column built: about a second of a view's planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "terrascore", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; set one only when unset."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    # Executors of a cluster would each write to a disk of their own.
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    # No cluster setting (local tests): create a private folder for this run.
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="terrascore-ckpt-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stage_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = (),
                path: str | None = None) -> DataFrame:
    """Write ``df`` to Parquet in the shared folder and read it back.

    Cuts lineage (a lost executor re-reads the file instead of recomputing
    the upstream) and lets several consumers share one computation.
    ``partition_by`` folders let later filters on those columns prune files.
    ``path``: a folder of the caller's, replaced on every run, instead of a
    fresh one of the shared folder.
    """
    return stage_table_counted(df, name, partition_by, count=False, path=path)[0]


def stage_table_counted(df: DataFrame, name: str, partition_by: tuple[str, ...] = (),
                        count: bool = True, path: str | None = None) -> tuple[DataFrame, int | None]:
    """``stage_table`` that also returns the row count, observed by the write
    job itself (no second pass)."""
    spark = df.sparkSession
    path = path or shared_path(spark, name)
    obs = Observation(f"stage_{name}") if count else None
    out = df.observe(obs, F.count(F.lit(1)).alias("rows")) if count else df
    if partition_by:  # rows of a folder meet before they are written; large folders are split
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    w = out.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    w.parquet(path)
    # Declared read schema: no inference job; original column order kept
    # (partition columns would otherwise move to the end).
    back = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    return back, (int(obs.get["rows"]) if count else None)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
