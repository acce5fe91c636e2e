"""The test tables, seen as transactions and as input files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.schema import AMOUNT, CELLS
from tallylake.sources.paths import delete_folder, glob_paths, literal_path, rename


def event_transactions(spark: SparkSession, sf_dir: str, raw_users: bool = False) -> DataFrame:
    """``events`` as transactions: times within the day, small groups.

    ``raw_users`` keeps each user apart; otherwise users fold into three names, so that
    30-minute groups hold more than one row.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("bigint")
    user = F.col("user_id") if raw_users else F.col("user_id") % 3
    return events.select(
        F.col("event_id").cast("decimal(20,0)").alias("transaction_id"),
        F.col("event_id").cast("decimal(20,0)").alias("bill_id"),
        (k % 2).alias("site_id"),
        F.concat(F.lit("u"), user.cast("string")).alias("username"),
        k.alias("item_id"),
        F.col("event_type").alias("currency_code"),
        F.col("value").cast(AMOUNT).alias("transfer_amount"),
        F.col("ts").alias("transaction_time"),
    )


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with its customer as transactions: volume, many months, duplicates."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name")
    # The names go to the orders first, so that the many lines are shuffled and sorted once.
    named = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    joined = lineitem.join(named, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("decimal(20,0)").alias("transaction_id"),
        F.col("l_orderkey").cast("decimal(20,0)").alias("bill_id"),
        F.col("l_suppkey").alias("site_id"),
        F.col("c_name").alias("username"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_returnflag").alias("currency_code"),
        F.col("l_extendedprice").cast(AMOUNT).alias("transfer_amount"),
        F.col("l_shipdate").alias("transaction_time"),
    )


def lineitem_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites and times of ``lineitem_transactions`` without its joins, to find bounds by."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_suppkey").alias("site_id"),
        F.col("l_returnflag").alias("currency_code"),
        F.col("l_shipdate").alias("transaction_time"),
    )


# The two arrivals of the incremental queries, over event_transactions.
FIRST_ARRIVAL = (
    "transaction_time < timestamp_ntz '2024-01-16 10:40:00'"
    " AND transaction_id % 10 <> 0"
    " AND NOT (site_id = 1 AND transaction_time >= timestamp_ntz '2024-01-16 00:00:00')"
)


def arrivals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    df = event_transactions(spark, sf_dir)
    return df.where(FIRST_ARRIVAL), df.where(f"NOT ({FIRST_ARRIVAL})")


def json_text(value: Column) -> Column:
    """A string as a quoted JSON string."""
    listed = F.to_json(F.array(value))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def json_row(df: DataFrame) -> Column:
    """A transaction as the text of a JSON array; times in epoch milliseconds."""
    cells = {c: F.col(c).cast("string") for c in CELLS}
    for name in ("username", "currency_code"):
        cells[name] = json_text(F.col(name))
    cells["transaction_time"] = F.unix_millis(F.col("transaction_time").cast("timestamp")).cast("string")
    return F.concat(F.lit("["), F.concat_ws(",", *[cells[c] for c in CELLS]), F.lit("]"))


def write_json_documents(rows: DataFrame, folder: str) -> None:
    """Write one column of JSON texts as files that each hold one JSON array.

    A task writes one document and streams its rows; ``rebalance`` makes as many tasks as
    the data needs.  Spark names text files ``.txt``, so the committed files are renamed.
    """
    name = rows.columns[0]

    def as_array(batches):
        first = True
        for batch in batches:
            if len(batch):
                texts = "," + batch[name]
                if first:
                    texts.iloc[0] = "[" + texts.iloc[0][1:]
                    first = False
                yield pd.DataFrame({name: texts})
        yield pd.DataFrame({name: ["[]" if first else "]"]})

    spread = rows.hint("rebalance")
    spread.mapInPandas(as_array, f"{name} string").write.mode("append").text(folder)
    spark = rows.sparkSession
    for path in glob_paths(spark, f"{literal_path(folder)}/part-*.txt"):
        rename(spark, path, path.removesuffix(".txt") + ".json")


def write_unfinished_documents(rows: DataFrame, folder: str) -> None:
    """Write one column of JSON texts as files cut off before their end."""
    name = rows.columns[0]
    begun = rows.select(F.concat(F.lit("[["), F.col(name), F.lit("]")).alias(name))
    begun.hint("rebalance").write.text(folder, lineSep=",")


def move_files(spark: SparkSession, source: str, folder: str, prefix: str) -> None:
    """Move the files of a folder into another as <prefix>0.json, ..., replacing those there."""
    for number, path in enumerate(sorted(glob_paths(spark, f"{literal_path(source)}/part-*"))):
        target = f"{folder}/{prefix}{number}.json"
        delete_folder(spark, target)
        rename(spark, path, target)
