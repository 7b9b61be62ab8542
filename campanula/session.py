"""Session construction and cluster-safe lineage cutting."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Defaults sized for a large cluster; tests and the local bench override the
# shuffle partition count through ``shuffle_partitions``.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast by the planner's estimate; at run time a side whose
    # *measured* size is under 64 MB is broadcast, others are shuffled.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "campanula", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the library's defaults.

    ``master`` is only set when given, so on a cluster the submit-time master
    wins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only a local-mode session without one (tests) gets a private
    temporary folder; a cluster session without one is an error, since any
    folder made up here could be local to one machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="campanula-ckpt-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by writing the rows once as a Parquet table in the shared
    checkpoint folder and reading them back (survives executor loss).

    Used where a nondeterministic step (range bounds, partition ids) feeds
    more than one consumer, so every consumer sees the same rows, and where
    one intermediate is read several times.  A single write job: an eager
    ``checkpoint()`` would compute the rows twice (a count, then the
    checkpoint write), and the Parquet copy is read back column-pruned.
    """
    import uuid
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/campanula_materialized/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@contextmanager
def split_methods(spark: SparkSession) -> Iterator[None]:
    """Within it, a job whose rows pass through many expressions (the cleaning of a
    whole table) is compiled as many small methods instead of one for the whole stage:
    the JVM leaves a method of over 8,000 bytes of bytecode uncompiled."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def folder_state(spark: SparkSession, folder: str) -> tuple:
    """Name, time, size and number of files of each entry of a folder (a table
    is one file or a folder of files); empty where there is no such folder."""
    fs, path = _file_system(spark, folder)
    if not fs.exists(path):
        return ()
    out = []
    for s in fs.listStatus(path):
        inside = fs.getContentSummary(s.getPath()) if s.isDirectory() else None
        out.append((s.getPath().getName(), s.getModificationTime(), inside.getLength() if inside else s.getLen(), inside.getFileCount() if inside else 1))
    return tuple(sorted(out))


def remove_intermediates(spark: SparkSession) -> None:
    """Delete the stages and ``materialize`` tables of this application (its
    checkpoint folder has a name of its own, so no other application's)."""
    for name in ("campanula_stages", "campanula_materialized"):
        fs, path = _file_system(spark, f"{checkpoint_dir(spark).rstrip('/')}/{name}")
        fs.delete(path, True)
    spark.catalog.clearCache()


def small(df: DataFrame) -> DataFrame:
    """Keep a small table (bounded by a group or class count) for reuse by
    several scalar subqueries.  A deterministic plan is cached: recomputing
    it after an executor loss gives the same rows.  A nondeterministic one
    (e.g. an input ordered by ``rand``) is checkpointed instead, so every
    consumer sees one fixed result."""
    if df._jdf.queryExecution().analyzed().deterministic():
        return df.cache()
    return materialize(df)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def env_cpus(default: int = 8) -> int:
    try:
        return int(os.environ.get("BENCH_CPUS", default))
    except ValueError:
        return default
