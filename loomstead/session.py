"""Sessions for tests and local runs; a cluster brings its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, name: str = "loomstead", **conf: str) -> SparkSession:
    """A local session with UTC time and adaptive execution."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.driver.host": "127.0.0.1",
    } | conf
    spark = SparkSession.builder.master(f"local[{cores}]").appName(name).config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
