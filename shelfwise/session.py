"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Adaptive execution re-plans joins from measured sizes and splits skewed
# join partitions even where that costs one more shuffle.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the plans in this package rely on."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, app: str = "shelfwise", memory: str = "12g") -> SparkSession:
    """Session for tests and the bench on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see, from ``spark.checkpoint.dir``.

    A cluster must set it.  A one-machine session without the setting (tests,
    the bench) gets one folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
    if context.applicationId not in _OWN_DIRS:
        _OWN_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="shelfwise-")
    return _OWN_DIRS[context.applicationId]
