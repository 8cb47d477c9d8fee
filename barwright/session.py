"""Session helpers: the settings every job relies on."""

from __future__ import annotations

import tempfile
from functools import lru_cache

from pyspark.sql import SparkSession

# Settings the library depends on for correct results (UTC calendar) and for
# a sane physical plan (AQE coalescing and skew handling).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Classes that Spark generates and keeps compiled. A full feature build needs about 800; with the default of 100
# every task would compile them again. It is fixed when a session's JVM starts, so clusters set it themselves.
CODEGEN_CACHE = ("spark.sql.codegen.cache.maxEntries", "5000")


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "barwright") -> SparkSession:
    """Local session for tests and benches; on a cluster use the provided session."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config(*CODEGEN_CACHE)
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Apply the required session settings to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


@lru_cache(maxsize=1)
def _scratch_dir() -> str:
    return tempfile.mkdtemp(prefix="barwright-ckpt-")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (spark.checkpoint.dir).

    Only where it is unset and the master is local (tests) do we pick a scratch
    folder ourselves; on a cluster executors do not share such a folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = _scratch_dir()
    spark.sparkContext.setCheckpointDir(d)
    return d
