"""One local session for tests and checks."""

import os
import tempfile

from pyspark.sql import SparkSession


def make_session(cpus=None, partitions=8):
    builder = (
        SparkSession.builder.master(f"local[{cpus or os.environ.get('BENCH_CPUS', '8')}]")
        .appName("answerloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
