"""SparkSession construction with the settings every plan in this package assumes."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings that change results, not only speed: timestamps are wall-clock
# (TIMESTAMP_NTZ in the inputs) and every comparison with DuckDB is done in UTC.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings for the physical plan. They are sized for a cluster and stay
# correct on local[N]: AQE re-plans joins from runtime sizes (broadcast only
# below the threshold, sort-merge beyond it), splits skewed partitions and
# coalesces small ones, so the initial partition count can be generous.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Item rows meet their order through chains of joins on the same key
    # (items -> orders -> runner rows), which AQE only splits for a hot key if
    # it may add a shuffle after the split; one order may hold a third of the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What a task reads of a shuffle, compressed. Item rows are narrow and
    # compress to a few bytes, and one stage may hold a join, aggregates and
    # another join of them: at 64 MB a task, its sorts and maps took 0.9 to
    # 4 GB of memory. Merged partitions stay below this size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # Broadcast only sides that are small by measurement: 10 MB from plan
    # statistics (Spark's default), 4 MB for AQE's runtime conversion. A
    # broadcast is shipped to every executor, so on a 1000-executor cluster
    # its cost is ~1000x its size; everything larger is a sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(4 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit or " ")


def bound_task_reads(spark: SparkSession) -> None:
    """Lower the size to which a running session merges shuffle partitions to this package's; a smaller one stays."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if _bytes(spark.conf.get(key)) > _bytes(PLAN_SETTINGS[key]):
        spark.conf.set(key, PLAN_SETTINGS[key])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a scratch one only if none is set.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; the
    fallback is for ``local[N]`` only (tests and single-machine runs).
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tillroll", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package settings.

    ``master`` defaults to ``local[$BENCH_CPUS or *]`` when no master is
    configured by the launcher; on a cluster pass nothing and let
    spark-submit decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and not os.environ.get("SPARK_MASTER"):
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    if master:
        builder = builder.master(master)
    for key, value in {**RESULT_SETTINGS, **PLAN_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
