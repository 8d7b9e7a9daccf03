"""Session settings that the library is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution splits skewed join partitions and merges small ones. The
# force flag lets it split a hot join key even if that costs one more shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Without it every column expression records where it was written, which costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def tune(spark: SparkSession) -> None:
    """Turns adaptive execution and its skew handling on in a session that was built elsewhere."""
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql.adaptive."):
            spark.conf.set(key, value)


def build_session(app: str = "tallyframe", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the recommended settings; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
