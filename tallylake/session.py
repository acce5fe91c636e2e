"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library counts on.  Days and 30-minute buckets are cut in UTC.  A sum that
# does not fit its column raises, which is ANSI behaviour.  Timestamps are written as INT64
# because INT96 carries no row-group statistics, without which a time range prunes nothing
# inside a month.
SQL_SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session created elsewhere."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallylake")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder every executor can reach.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``.  Only a
    local session without that setting gets a temporary folder of the machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _machine_folder()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@functools.cache
def _machine_folder() -> str:
    return tempfile.mkdtemp(prefix="tallylake-")
