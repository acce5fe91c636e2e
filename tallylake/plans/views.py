"""Ad-hoc SQL over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallylake.plans import rollups
from tallylake.sources import tables


def register_views(spark: SparkSession, root: str) -> None:
    """Temporary views transactions, agg_username_30min and agg_site_daily.

    A view shows the commits of the time it was registered; ``adhoc_sql`` does it anew.
    """
    tables.read_table(spark, tables.transactions(root)).createOrReplaceTempView("transactions")
    rollups.read_user_30min(spark, root).createOrReplaceTempView("agg_username_30min")
    rollups.read_site_daily(spark, root).createOrReplaceTempView("agg_site_daily")


def adhoc_sql(spark: SparkSession, root: str, query: str) -> DataFrame:
    """A query over the views as the tables are now, after all loads, runs and compactions."""
    register_views(spark, root)
    return spark.sql(query)
