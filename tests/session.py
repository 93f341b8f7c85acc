"""The local session of the tests and checks."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .appName("derrick")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
