"""Session defaults that suit both a laptop and a cluster."""

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS; `conf` keys use __ for dots."""
    b = SparkSession.builder.appName("palimpsest")
    if master:
        b = b.master(master)
    for k, v in (DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def stored(df: DataFrame) -> DataFrame:
    """df, written once if the session has a checkpoint folder: what is costly and used twice is not computed twice."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df
