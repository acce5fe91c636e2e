"""Registered queries and the SQL each of them must agree with."""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallylake import fixtures
from tallylake.functions.cells import type_cells
from tallylake.functions.timeparts import day_range
from tallylake.operators import aggregates, dedup
from tallylake.operators.ordering import place_rows
from tallylake.plans import reports, rollup_reports, rollups, sketches
from tallylake.plans.compaction import compact_transactions
from tallylake.plans.views import adhoc_sql, register_views
from tallylake.schema import CELLS
from tallylake.session import configure, scratch_dir
from tallylake.sources import spans, tables
from tallylake.sources.json_documents import read_json_rows
from tallylake.sources.paths import create_empty
from tallylake.streaming.ingest import ingest_new
from tallylake.streaming.rollup_stream import stream_user_30min

Query = Callable[[SparkSession, str], DataFrame]

# Days inside the range the test tables cover.
EVENT_DAYS = ("2024-01-05", "2024-01-20")
SHIP_DAYS = ("1996-01-15", "1998-03-14")
RSD = 0.02


def entry(spark: SparkSession) -> DataFrame:
    """Transactions per day on the smallest test tables."""
    configure(spark)
    return _daily_count(spark, "/root/testdata/sf0.001")


# --- reports --------------------------------------------------------------------------


def _daily_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_count(fixtures.lineitem_transactions(spark, sf_dir))


def _daily_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_amount(fixtures.lineitem_transactions(spark, sf_dir))


def _daily_currency_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_currency_count(fixtures.lineitem_transactions(spark, sf_dir))


def _daily_count_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.lineitem_transactions(spark, sf_dir)
    return place_rows(reports.daily_count(df), [F.desc("total_count"), "day"])


def _daily_currency_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.lineitem_transactions(spark, sf_dir)
    order = [F.desc("currency_code"), F.desc("total_count"), "day"]
    return place_rows(reports.daily_currency_count(df), order)


def _daily_unique_users_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.lineitem_transactions(spark, sf_dir)
    users = reports.daily_unique_users(df, *SHIP_DAYS, by_site=True)
    return place_rows(users, ["day", "site_id"])


def _top_users_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_users(fixtures.lineitem_transactions(spark, sf_dir), *SHIP_DAYS)


def _top_users_by_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_users(
        fixtures.lineitem_transactions(spark, sf_dir),
        *SHIP_DAYS,
        sort_by="total_amount",
        descending=True,
    )


def _daily_unique_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = fixtures.event_transactions(spark, sf_dir, raw_users=True)
    return reports.daily_unique_users(users, *EVENT_DAYS)


def _daily_unique_users_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = fixtures.event_transactions(spark, sf_dir, raw_users=True)
    return reports.daily_unique_users(users, *EVENT_DAYS, by_site=True)


def _daily_unique_users_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = fixtures.event_transactions(spark, sf_dir, raw_users=True)
    exact = reports.daily_unique_users(users, *EVENT_DAYS)
    approx = reports.daily_unique_users(users, *EVENT_DAYS, approx=True, rsd=RSD)
    error = F.abs(F.col("total_count") - F.col("estimate"))
    return exact.join(approx.withColumnRenamed("total_count", "estimate"), "day").select(
        "day", (error <= F.ceil(3 * RSD * F.col("total_count"))).alias("within_bound")
    )


# --- rollups --------------------------------------------------------------------------


def _boundary(df: DataFrame) -> DataFrame:
    """Times without a zone, as the test tables have them."""
    for field in df.schema.fields:
        if field.dataType.typeName() == "timestamp":
            df = df.withColumn(field.name, F.col(field.name).cast("timestamp_ntz"))
    return df


def _rollup_user_30min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boundary(aggregates.user_30min(fixtures.event_transactions(spark, sf_dir)))


def _rollup_site_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.site_daily(fixtures.event_transactions(spark, sf_dir))


def _two_arrivals(
    spark: SparkSession, sf_dir: str, refresh: Callable[[SparkSession, str], object]
) -> str:
    """Load the first arrival, refresh, load the second, refresh; returns the lake."""
    root = scratch_dir(spark, "lake")
    for batch, rows in enumerate(fixtures.arrivals(spark, sf_dir)):
        tables.write_transactions(rows, root, batch)
        refresh(spark, root)
    return root


def _rollup_user_30min_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _two_arrivals(spark, sf_dir, rollups.refresh_user_30min)
    return _boundary(rollups.read_user_30min(spark, root))


def _rollup_user_30min_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _two_arrivals(spark, sf_dir, rollups.refresh_user_30min)
    rollups.compact_user_30min(spark, root)
    return _boundary(rollups.read_user_30min(spark, root))


def _rollup_user_30min_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _two_arrivals(spark, sf_dir, stream_user_30min)
    return _boundary(rollups.read_user_30min_stream(spark, root))


def _rollup_site_daily_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _two_arrivals(spark, sf_dir, rollups.refresh_site_daily)
    return rollups.read_site_daily(spark, root)


def _rollup_site_daily_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _two_arrivals(
        spark, sf_dir, lambda s, r: rollups.refresh_site_daily(s, r, mode="refresh")
    )
    return rollups.read_site_daily(spark, root)


def _rollup_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _two_arrivals(spark, sf_dir, rollups.refresh_user_30min)
    audit = tables.rollup_audit(tables.user_30min(root))
    return tables.read_table(spark, audit).select("run_id", "late_rows")


def _rollup_user_30min_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _two_arrivals(spark, sf_dir, rollups.refresh_user_30min)
    return _boundary(rollups.read_user_30min(spark, root, repaired=True))


def _rollup_site_daily_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _two_arrivals(spark, sf_dir, rollups.refresh_site_daily)
    return rollups.read_site_daily(spark, root, repaired=True)


def _part_unseen(
    spark: SparkSession, sf_dir: str, refresh: Callable[[SparkSession, str], object]
) -> str:
    """Two arrivals, the second in two loads of which the refresh has seen the first only."""
    root = scratch_dir(spark, "lake")
    first, second = fixtures.arrivals(spark, sf_dir)
    for batch, rows in enumerate((first, second.where("transaction_id % 2 = 0"))):
        tables.write_transactions(rows, root, batch)
        refresh(spark, root)
    tables.write_transactions(second.where("transaction_id % 2 = 1"), root, 2)
    return root


def _daily_count_from_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _part_unseen(spark, sf_dir, rollups.refresh_site_daily)
    return rollup_reports.daily_count(spark, root)


def _daily_amount_from_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _part_unseen(spark, sf_dir, rollups.refresh_site_daily)
    return rollup_reports.daily_amount(spark, root, EVENT_DAYS)


def _top_users_from_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _part_unseen(spark, sf_dir, rollups.refresh_user_30min)
    return rollup_reports.top_users(spark, root, *EVENT_DAYS, "total_amount", descending=True)


def _daily_unique_users_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of two loads, merged, against the exact numbers."""
    root = scratch_dir(spark, "lake")
    users = fixtures.event_transactions(spark, sf_dir, raw_users=True)
    for batch in (0, 1):
        tables.write_transactions(users.where(f"transaction_id % 2 = {batch}"), root, batch)
        sketches.refresh_user_sketches(spark, root)
    exact = reports.daily_unique_users(users, *EVENT_DAYS)
    found = sketches.daily_unique_users_sketch(spark, root, *EVENT_DAYS)
    error = F.abs(F.col("total_count") - F.col("estimate"))
    bound = F.ceil(3 * sketches.RELATIVE_ERROR * F.col("total_count"))
    return exact.join(found.withColumnRenamed("total_count", "estimate"), "day").select(
        "day", (error <= bound).alias("within_bound")
    )


def _adhoc_sql_after_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same SQL before and after a second load: it sees what was loaded in between."""
    root = scratch_dir(spark, "lake")
    counts = []
    for batch, rows in enumerate(fixtures.arrivals(spark, sf_dir)):
        tables.write_transactions(rows, root, batch)
        found = adhoc_sql(
            spark,
            root,
            """
            SELECT site_id, count(*) AS txn_count,
                   CAST(sum(transfer_amount) AS DECIMAL(38,2)) AS total_amount
            FROM transactions GROUP BY site_id
            """,
        )
        counts.append(found.withColumn("loads", F.lit(batch + 1)))
    return counts[0].unionByName(counts[1])


def _adhoc_rollup_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _two_arrivals(spark, sf_dir, rollups.refresh_all)
    register_views(spark, root)
    return spark.sql(
        """
        SELECT u.day, u.site_id, u.user_txns, s.txn_count AS site_txns, t.stored_txns
        FROM (SELECT to_date(window_start) AS day, site_id, sum(txn_count) AS user_txns
              FROM agg_username_30min GROUP BY 1, 2) u
        JOIN agg_site_daily s ON s.day = u.day AND s.site_id = u.site_id
        JOIN (SELECT to_date(transaction_time) AS day, site_id, count(*) AS stored_txns
              FROM transactions GROUP BY 1, 2) t ON t.day = u.day AND t.site_id = u.site_id
        """
    )


# --- ingestion ------------------------------------------------------------------------


def _input_files(spark: SparkSession, *loads: DataFrame) -> str:
    folder = scratch_dir(spark, "json")
    for rows in loads:
        fixtures.write_json_documents(_as_json(rows), folder)
    return folder


def _as_json(rows: DataFrame) -> DataFrame:
    return rows.select(fixtures.json_row(rows).alias("value"))


def _typed(rows: DataFrame) -> DataFrame:
    return _boundary(type_cells(rows.withColumn("raw", F.lit(""))).select(*CELLS))


def _ingest_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _input_files(spark, fixtures.lineitem_transactions(spark, sf_dir))
    return _typed(read_json_rows(spark, folder))


def _ingest_json_brackets(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.concat(F.col("username"), F.lit('],[ "q" \\ ]'), F.col("currency_code"))
    rows = fixtures.event_transactions(spark, sf_dir).withColumn("username", odd)
    return _typed(read_json_rows(spark, _input_files(spark, rows)))


def _faulty_files(spark: SparkSession, sf_dir: str) -> str:
    """Input files in which three of four rows are bad in one of six ways."""
    df = fixtures.event_transactions(spark, sf_dir)
    quoted = fixtures.json_text(F.col("username"))
    number = F.col("transaction_id").cast("string")

    def row(site="0", user=quoted, item="1", last=',"5"'):
        cells = [number, number, F.lit(site), user, F.lit(item), F.lit('"USD"'), F.lit("1.5")]
        return F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit(last), F.lit("]"))

    fault = F.col("transaction_id") % 8
    text = (
        F.when(fault == 0, row(last=""))
        .when(fault == 1, row(site='"x"'))
        .when(fault == 2, row(user=F.lit("null")))
        .when(fault == 3, row(site="4294967296"))
        .when(fault == 4, F.concat(F.lit('{"id":'), number, F.lit("}")))
        .when(fault == 5, row(item="4.9"))
        .otherwise(row())
    )
    folder = scratch_dir(spark, "json")
    fixtures.write_json_documents(df.select(text.alias("value")), folder)
    return folder


def _ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "lake")
    ingest_new(spark, _faulty_files(spark, sf_dir), root)
    found = tables.rejected(spark, root)
    number = F.regexp_extract("raw", "[0-9]+", 0).cast("bigint")
    return found.select(number.alias("event_id"), "reason")


def _ingest_object_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of objects: each a reject, at its own place in its file."""
    df = fixtures.event_transactions(spark, sf_dir)
    number = F.col("transaction_id").cast("string")
    text = F.concat(F.lit('{"id":'), number, F.lit(',"note":"a, b"}'))
    folder, root = scratch_dir(spark, "json"), scratch_dir(spark, "lake")
    fixtures.write_json_documents(df.select(text.alias("value")), folder)
    ingest_new(spark, folder, root)
    place = F.row_number().over(Window.partitionBy("file").orderBy("pos")) - 1
    return tables.rejected(spark, root).select(
        F.get_json_object("raw", "$.id").cast("bigint").alias("event_id"),
        "reason",
        (F.col("pos") == place).alias("placed"),
    )


def _ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "lake")
    ingest_new(spark, _faulty_files(spark, sf_dir), root)
    return (
        tables.audited_files(spark, root)
        .groupBy("status")
        .agg(F.sum("rows_ok").alias("rows_ok"), F.sum("rows_rejected").alias("rows_rejected"))
    )


def _ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "lake")
    first, second = fixtures.arrivals(spark, sf_dir)
    folder = _input_files(spark, first)
    ingest_new(spark, folder, root)
    fixtures.write_json_documents(_as_json(second), folder)
    ingest_new(spark, folder, root)
    ingest_new(spark, folder, root)
    return _boundary(tables.read_table(spark, tables.transactions(root)).select(*CELLS))


def _put_files(
    spark: SparkSession,
    rows: DataFrame,
    folder: str,
    prefix: str,
    write: Callable[[DataFrame, str], None] = fixtures.write_json_documents,
) -> None:
    made = scratch_dir(spark, "made")
    write(_as_json(rows), made)
    fixtures.move_files(spark, made, folder, prefix)


def _ingest_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files first loaded when unfinished, then mended: their rows arrive, and only once."""
    root = scratch_dir(spark, "lake")
    first, second = fixtures.arrivals(spark, sf_dir)
    folder = _input_files(spark, first)
    _put_files(spark, second, folder, "late", fixtures.write_unfinished_documents)
    ingest_new(spark, folder, root)
    _put_files(spark, second, folder, "late")
    ingest_new(spark, folder, root)
    ingest_new(spark, folder, root)
    return _boundary(tables.read_table(spark, tables.transactions(root)).select(*CELLS))


def _ingest_skipped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty file, filled later, and files Spark passes over, as the audit shows them."""
    root = scratch_dir(spark, "lake")
    first, second = fixtures.arrivals(spark, sf_dir)
    folder = _input_files(spark, first)
    create_empty(spark, f"{folder}/late0.json")
    _put_files(spark, second, folder, "_hidden")
    ingest_new(spark, folder, root)
    _put_files(spark, second, folder, "late")
    ingest_new(spark, folder, root)
    ingest_new(spark, folder, root)
    files = tables.audited_files(spark, root)
    return files.groupBy("status").agg(F.sum("rows_ok").alias("rows_ok"))


# --- stored transactions --------------------------------------------------------------

SHIPMENT_ORDER = ("transaction_time", "item_id", "site_id", "transfer_amount")
STORED_KEY_ORDER = ("transaction_id", "item_id", "currency_code", "transfer_amount")


def _replace_latest_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.lineitem_transactions(spark, sf_dir)
    return dedup.replace_latest(df, dedup.BY_TRANSACTION_ID, SHIPMENT_ORDER)


def _replace_latest_stored_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.lineitem_transactions(spark, sf_dir).withColumn("_version", F.lit(1))
    return dedup.replace_latest(df, dedup.BY_STORED_KEY, STORED_KEY_ORDER).drop("_version")


def _replace_latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that share ids with other amounts: the later version of each id stays."""
    root = scratch_dir(spark, "lake")
    first = fixtures.event_transactions(spark, sf_dir)
    second = first.where("transaction_id % 3 = 0").withColumn(
        "transfer_amount", F.expr("cast(transfer_amount + 1 as decimal(18,2))")
    )
    # The later version is loaded first: its stamp decides, not the order of the loads.
    for batch, (rows, version) in enumerate([(second, 2), (first, 1)]):
        tables.write_transactions(rows.withColumn("_version", F.lit(version)), root, batch)
    stored = tables.read_table(spark, tables.transactions(root))
    latest = dedup.replace_latest(stored, dedup.BY_TRANSACTION_ID, dedup.LATEST)
    return _boundary(latest.select(*CELLS, F.col("_version").alias("version")))


def _compact_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that repeat half of each other, folded into one row per transaction."""
    root = scratch_dir(spark, "lake")
    df = fixtures.lineitem_transactions(spark, sf_dir)
    like = fixtures.lineitem_places(spark, sf_dir)
    shipped = "currency_code <> 'N'"
    tables.write_transactions(df, root, 0, like)
    tables.write_transactions(df.where(shipped), root, 1, like.where(shipped))
    compact_transactions(spark, root, dedup.BY_TRANSACTION_ID, SHIPMENT_ORDER)
    return _boundary(tables.read_table(spark, tables.transactions(root)).select(*CELLS))


def _month_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "lake")
    tables.write_transactions(fixtures.lineitem_transactions(spark, sf_dir), root, 0)
    stored = tables.read_table(spark, tables.transactions(root))
    return (
        day_range(stored, *SHIP_DAYS)
        .groupBy("yyyymm", "site_id")
        .agg(
            F.count("*").alias("txn_count"),
            F.sum("transfer_amount").cast("decimal(38,2)").alias("total_amount"),
        )
    )


def _day_span_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One site's days: a compacted base and a later load, of which only some files are opened."""
    root = scratch_dir(spark, "lake")
    df = fixtures.lineitem_transactions(spark, sf_dir)
    tables.write_transactions(df.where("currency_code <> 'N'"), root, 0)
    tables.compact(spark, tables.transactions(root), tables.with_month_layout)
    spans.refresh_spans(spark, root)
    tables.write_transactions(df.where("currency_code = 'N'"), root, 1)
    spans.refresh_spans(spark, root)
    found = aggregates.daily_count(spans.read_days(spark, root, *SHIP_DAYS, site_id=1))
    return found.select("day", "total_count")


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {
        "daily_count": _daily_count,
        "daily_amount": _daily_amount,
        "daily_currency_count": _daily_currency_count,
        "top_users_by_name": _top_users_by_name,
        "top_users_by_amount": _top_users_by_amount,
        "daily_unique_users": _daily_unique_users,
        "daily_unique_users_by_site": _daily_unique_users_by_site,
        "daily_unique_users_approx": _daily_unique_users_approx,
        "rollup_user_30min": _rollup_user_30min,
        "rollup_site_daily": _rollup_site_daily,
        "rollup_user_30min_incremental": _rollup_user_30min_incremental,
        "rollup_user_30min_compacted": _rollup_user_30min_compacted,
        "rollup_user_30min_stream": _rollup_user_30min_stream,
        "rollup_site_daily_incremental": _rollup_site_daily_incremental,
        "rollup_site_daily_refresh": _rollup_site_daily_refresh,
        "rollup_late_rows": _rollup_late_rows,
        "rollup_user_30min_repaired": _rollup_user_30min_repaired,
        "rollup_site_daily_repaired": _rollup_site_daily_repaired,
        "daily_count_from_rollup": _daily_count_from_rollup,
        "daily_amount_from_rollup": _daily_amount_from_rollup,
        "top_users_from_rollup": _top_users_from_rollup,
        "daily_unique_users_sketch": _daily_unique_users_sketch,
        "adhoc_rollup_sql": _adhoc_rollup_sql,
        "adhoc_sql_after_load": _adhoc_sql_after_load,
        "daily_count_placed": _daily_count_placed,
        "daily_currency_placed": _daily_currency_placed,
        "daily_unique_users_placed": _daily_unique_users_placed,
        "replace_latest_versions": _replace_latest_versions,
        "ingest_json_rows": _ingest_json_rows,
        "ingest_json_brackets": _ingest_json_brackets,
        "ingest_rejects": _ingest_rejects,
        "ingest_object_rows": _ingest_object_rows,
        "ingest_audit": _ingest_audit,
        "ingest_incremental": _ingest_incremental,
        "ingest_reload": _ingest_reload,
        "ingest_skipped_files": _ingest_skipped_files,
        "replace_latest_transactions": _replace_latest_transactions,
        "replace_latest_stored_key": _replace_latest_stored_key,
        "compact_transactions": _compact_transactions,
        "month_partition_scan": _month_partition_scan,
        "day_span_scan": _day_span_scan,
    }
    if _has_llm():
        registered |= importlib.import_module("tallylake.llm.queries").queries()
        registered["pipeline"] = importlib.import_module("corpus_pipeline").run
    return {name: _configured(query) for name, query in registered.items()}


def _has_llm() -> bool:
    """The corpus operators and their pipeline may be left out of an installation."""
    return all(
        importlib.util.find_spec(name) is not None
        for name in ("tallylake.llm", "tallylake.llm.queries", "corpus_pipeline")
    )


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run


# --- the same in SQL ------------------------------------------------------------------

_EVENTS = """
    SELECT event_id AS transaction_id, event_id AS bill_id, k % 2 AS site_id,
           {user} AS username, k AS item_id, event_type AS currency_code,
           CAST(value AS DECIMAL(18,2)) AS transfer_amount, ts AS transaction_time
    FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events)
"""
_FOLDED = _EVENTS.format(user="concat('u', user_id % 3)")
_USERS = _EVENTS.format(user="concat('u', user_id)")

_SHIPMENTS = """
    SELECT l_orderkey * 10 + l_linenumber AS transaction_id, l_orderkey AS bill_id,
           l_suppkey AS site_id, c_name AS username, l_partkey AS item_id,
           l_returnflag AS currency_code,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS transfer_amount,
           l_shipdate AS transaction_time
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
"""

# Ids are DECIMAL(20,0) on the Spark side.
_CELLS = """
    CAST(transaction_id AS DECIMAL(20,0)) AS transaction_id,
    CAST(bill_id AS DECIMAL(20,0)) AS bill_id, site_id, {user} AS username, item_id,
    currency_code, transfer_amount, {time} AS transaction_time
"""
_ALL_CELLS = _CELLS.format(user="username", time="transaction_time")
_MILLIS = "date_trunc('milliseconds', transaction_time)"
_LOADED_EVENTS = f"SELECT {_CELLS.format(user='username', time=_MILLIS)} FROM ({_FOLDED})"

_MEASURES = """
    count(*) AS txn_count, CAST(sum(transfer_amount) AS DECIMAL(18,2)) AS total_amount
"""
_WINDOW = "time_bucket(INTERVAL 30 MINUTE, transaction_time)"
_DAY = "CAST(transaction_time AS DATE)"


def _between(days: tuple[str, str]) -> str:
    start, end = days
    return (
        f"transaction_time >= TIMESTAMP '{start} 00:00:00'"
        f" AND transaction_time < TIMESTAMP '{end} 00:00:00' + INTERVAL 1 DAY"
    )


# t: all rows with their arrival; m: the newest stored window and day.
_ARRIVALS = f"""
    WITH t AS (
        SELECT *, {_WINDOW} AS window_start, {_DAY} AS day,
               transaction_time < TIMESTAMP '2024-01-16 10:40:00'
               AND transaction_id % 10 <> 0
               AND NOT (site_id = 1 AND transaction_time >= TIMESTAMP '2024-01-16 00:00:00')
               AS is_first
        FROM ({_FOLDED})
    ), m AS (
        SELECT max(window_start) AS hw, max(day) AS md FROM t WHERE is_first
    )
"""
_TWO_WINDOWS = f"""
    {_ARRIVALS}
    SELECT window_start, site_id, username, {_MEASURES}
    FROM t, m WHERE is_first OR window_start >= hw
    GROUP BY window_start, site_id, username
"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "daily_count": f"SELECT {_DAY} AS day, count(*) AS total_count FROM ({_SHIPMENTS}) GROUP BY 1",
        "daily_amount": f"""
            SELECT {_DAY} AS day, CAST(sum(transfer_amount) AS DECIMAL(38,2)) AS total_amount
            FROM ({_SHIPMENTS}) GROUP BY 1""",
        "daily_currency_count": f"""
            SELECT {_DAY} AS day, currency_code, count(*) AS total_count
            FROM ({_SHIPMENTS}) GROUP BY 1, 2""",
        "top_users_by_name": f"""
            SELECT username, CAST(sum(transfer_amount) AS DECIMAL(38,2)) AS total_amount
            FROM ({_SHIPMENTS}) WHERE {_between(SHIP_DAYS)}
            GROUP BY username ORDER BY username LIMIT 20""",
        "top_users_by_amount": f"""
            SELECT username, CAST(sum(transfer_amount) AS DECIMAL(38,2)) AS total_amount
            FROM ({_SHIPMENTS}) WHERE {_between(SHIP_DAYS)}
            GROUP BY username ORDER BY total_amount DESC, username LIMIT 20""",
        "daily_unique_users": f"""
            SELECT {_DAY} AS day, count(DISTINCT username) AS total_count
            FROM ({_USERS}) WHERE {_between(EVENT_DAYS)} GROUP BY 1""",
        "daily_unique_users_by_site": f"""
            SELECT {_DAY} AS day, site_id, count(DISTINCT username) AS total_count
            FROM ({_USERS}) WHERE {_between(EVENT_DAYS)} GROUP BY 1, 2""",
        "daily_unique_users_approx": f"""
            SELECT DISTINCT {_DAY} AS day, TRUE AS within_bound
            FROM ({_USERS}) WHERE {_between(EVENT_DAYS)}""",
        "rollup_user_30min": f"""
            SELECT {_WINDOW} AS window_start, site_id, username, {_MEASURES}
            FROM ({_FOLDED}) GROUP BY 1, 2, 3""",
        "rollup_site_daily": f"""
            SELECT {_DAY} AS day, site_id, {_MEASURES} FROM ({_FOLDED}) GROUP BY 1, 2""",
        "rollup_user_30min_incremental": _TWO_WINDOWS,
        "rollup_user_30min_compacted": _TWO_WINDOWS,
        "rollup_user_30min_stream": _TWO_WINDOWS,
        "rollup_site_daily_incremental": f"""
            {_ARRIVALS}, stored AS (SELECT DISTINCT day, site_id FROM t WHERE is_first)
            SELECT day, site_id, {_MEASURES}
            FROM t, m
            WHERE is_first
               OR (day >= md AND NOT EXISTS (
                    SELECT 1 FROM stored s WHERE s.day = t.day AND s.site_id = t.site_id))
            GROUP BY day, site_id""",
        "rollup_site_daily_refresh": f"""
            {_ARRIVALS}
            SELECT day, site_id, {_MEASURES} FROM t, m WHERE is_first OR day >= md
            GROUP BY day, site_id""",
        "rollup_late_rows": f"""
            {_ARRIVALS}
            SELECT CAST(0 AS BIGINT) AS run_id, CAST(0 AS BIGINT) AS late_rows
            UNION ALL
            SELECT CAST(1 AS BIGINT), count(*) FROM t, m
            WHERE NOT is_first AND window_start < hw""",
        "rollup_user_30min_repaired": f"""
            SELECT {_WINDOW} AS window_start, site_id, username, {_MEASURES}
            FROM ({_FOLDED}) GROUP BY 1, 2, 3""",
        "rollup_site_daily_repaired": f"""
            SELECT {_DAY} AS day, site_id, {_MEASURES} FROM ({_FOLDED}) GROUP BY 1, 2""",
        "daily_count_from_rollup": f"""
            SELECT {_DAY} AS day, count(*) AS total_count FROM ({_FOLDED}) GROUP BY 1""",
        "daily_amount_from_rollup": f"""
            SELECT {_DAY} AS day, CAST(sum(transfer_amount) AS DECIMAL(38,2)) AS total_amount
            FROM ({_FOLDED}) WHERE {_between(EVENT_DAYS)} GROUP BY 1""",
        "top_users_from_rollup": f"""
            SELECT username, CAST(sum(transfer_amount) AS DECIMAL(38,2)) AS total_amount
            FROM ({_FOLDED}) WHERE {_between(EVENT_DAYS)}
            GROUP BY username ORDER BY total_amount DESC, username LIMIT 20""",
        "daily_unique_users_sketch": f"""
            SELECT DISTINCT {_DAY} AS day, TRUE AS within_bound
            FROM ({_USERS}) WHERE {_between(EVENT_DAYS)}""",
        "adhoc_rollup_sql": f"""
            {_ARRIVALS}, stored AS (SELECT DISTINCT day, site_id FROM t WHERE is_first),
            u AS (
                SELECT day, site_id, count(*) AS user_txns
                FROM t, m WHERE is_first OR window_start >= hw GROUP BY day, site_id
            ), s AS (
                SELECT day, site_id, count(*) AS site_txns
                FROM t, m
                WHERE is_first
                   OR (day >= md AND NOT EXISTS (
                        SELECT 1 FROM stored s WHERE s.day = t.day AND s.site_id = t.site_id))
                GROUP BY day, site_id
            )
            SELECT u.day, u.site_id, CAST(user_txns AS BIGINT) AS user_txns, site_txns,
                   (SELECT count(*) FROM t WHERE t.day = u.day AND t.site_id = u.site_id)
                   AS stored_txns
            FROM u JOIN s ON s.day = u.day AND s.site_id = u.site_id""",
        "ingest_json_rows": f"SELECT {_ALL_CELLS} FROM ({_SHIPMENTS})",
        "ingest_json_brackets": "SELECT "
        + _CELLS.format(
            user="""concat(username, '],[ "q" \\ ]', currency_code)""", time=_MILLIS
        )
        + f" FROM ({_FOLDED})",
        "ingest_rejects": """
            SELECT event_id, CASE event_id % 8
                WHEN 0 THEN 'BAD_SHAPE' WHEN 1 THEN 'BAD_CELL:site_id'
                WHEN 2 THEN 'BAD_CELL:username' WHEN 3 THEN 'OUT_OF_RANGE'
                WHEN 4 THEN 'BAD_SHAPE' WHEN 5 THEN 'BAD_CELL:item_id' END AS reason
            FROM events WHERE event_id % 8 < 6""",
        "ingest_object_rows":
            "SELECT event_id, 'BAD_SHAPE' AS reason, TRUE AS placed FROM events",
        "ingest_audit": """
            SELECT 'LOADED' AS status,
                   count(*) FILTER (event_id % 8 >= 6) AS rows_ok,
                   count(*) FILTER (event_id % 8 < 6) AS rows_rejected
            FROM events""",
        "ingest_incremental": _LOADED_EVENTS,
        "ingest_reload": _LOADED_EVENTS,
        "ingest_skipped_files": """
            SELECT 'LOADED' AS status, count(*) AS rows_ok FROM events
            UNION ALL SELECT 'EMPTY_FILE', 0 UNION ALL SELECT 'HIDDEN_NAME', 0""",
        "adhoc_sql_after_load": f"""
            {_ARRIVALS}
            SELECT site_id, count(*) AS txn_count,
                   CAST(sum(transfer_amount) AS DECIMAL(38,2)) AS total_amount, loads
            FROM t, (VALUES (1), (2)) AS l(loads) WHERE is_first OR loads = 2
            GROUP BY site_id, loads""",
        "daily_count_placed": f"""
            SELECT *, row_number() OVER (ORDER BY total_count DESC, day) AS place
            FROM (SELECT {_DAY} AS day, count(*) AS total_count FROM ({_SHIPMENTS}) GROUP BY 1)""",
        "daily_currency_placed": f"""
            SELECT *, row_number() OVER (ORDER BY currency_code DESC, total_count DESC, day) AS place
            FROM (SELECT {_DAY} AS day, currency_code, count(*) AS total_count
                  FROM ({_SHIPMENTS}) GROUP BY 1, 2)""",
        "daily_unique_users_placed": f"""
            SELECT *, row_number() OVER (ORDER BY day, site_id) AS place
            FROM (SELECT {_DAY} AS day, site_id, count(DISTINCT username) AS total_count
                  FROM ({_SHIPMENTS}) WHERE {_between(SHIP_DAYS)} GROUP BY 1, 2)""",
        "replace_latest_versions": "SELECT "
        + _CELLS.format(user="username", time="transaction_time").replace(
            "transfer_amount,",
            "CAST(transfer_amount + CASE WHEN transaction_id % 3 = 0 THEN 1 ELSE 0 END"
            " AS DECIMAL(18,2)) AS transfer_amount,",
        )
        + f", CASE WHEN transaction_id % 3 = 0 THEN 2 ELSE 1 END AS version FROM ({_FOLDED})",
        "replace_latest_transactions": _latest("transaction_id", SHIPMENT_ORDER),
        "replace_latest_stored_key": _latest(
            "site_id, username, transaction_time", STORED_KEY_ORDER
        ),
        "compact_transactions": _latest("transaction_id", SHIPMENT_ORDER),
        "month_partition_scan": f"""
            SELECT CAST(year(transaction_time) * 100 + month(transaction_time) AS INTEGER)
                   AS yyyymm, site_id, count(*) AS txn_count,
                   CAST(sum(transfer_amount) AS DECIMAL(38,2)) AS total_amount
            FROM ({_SHIPMENTS}) WHERE {_between(SHIP_DAYS)} GROUP BY 1, 2""",
        "day_span_scan": f"""
            SELECT {_DAY} AS day, count(*) AS total_count
            FROM ({_SHIPMENTS}) WHERE {_between(SHIP_DAYS)} AND site_id = 1 GROUP BY 1""",
    }
    if _has_llm():
        sql |= importlib.import_module("tallylake.llm.sql").oracle_sql()
    return sql


def _latest(keys: str, order: tuple[str, ...]) -> str:
    ranked = ", ".join(f"{c} DESC" for c in order)
    return f"""
        SELECT {_ALL_CELLS} FROM (
            SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {ranked}) AS rn
            FROM ({_SHIPMENTS})) WHERE rn = 1"""
