"""Session factory with the settings the library is tuned for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(app: str = "folioflow", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    settings = {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.driver.host": "127.0.0.1",
    } | conf
    builder = SparkSession.builder.master(f"local[{n}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
