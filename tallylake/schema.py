"""Declared schemas.  Nothing in the library is inferred from data."""

from pyspark.sql import types as T

# One input row is a JSON array; the position is the schema.
CELLS = (
    "transaction_id",
    "bill_id",
    "site_id",
    "username",
    "item_id",
    "currency_code",
    "transfer_amount",
    "transaction_time",
)

UINT64_MAX = 2**64 - 1
UINT32_MAX = 2**32 - 1

ID64 = T.DecimalType(20, 0)
AMOUNT = T.DecimalType(18, 2)
AMOUNT_SUM = T.DecimalType(38, 2)

TRANSACTION = T.StructType(
    [
        T.StructField("transaction_id", ID64),
        T.StructField("bill_id", ID64),
        T.StructField("site_id", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("currency_code", T.StringType()),
        T.StructField("transfer_amount", AMOUNT),
        T.StructField("transaction_time", T.TimestampType()),
        T.StructField("_version", T.LongType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("source_pos", T.LongType()),
    ]
)

USER_30MIN = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("site_id", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("txn_count", T.LongType()),
        T.StructField("total_amount", AMOUNT),
    ]
)

SITE_DAILY = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("site_id", T.LongType()),
        T.StructField("txn_count", T.LongType()),
        T.StructField("total_amount", AMOUNT),
    ]
)

# A mergeable sketch of the users of a day and site.
USER_SKETCH = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("site_id", T.LongType()),
        T.StructField("users", T.BinaryType()),
    ]
)

REJECT = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("raw", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_ok", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        # As they were when the file was read; a file that differs has been mended.
        T.StructField("file_size", T.LongType()),
        T.StructField("modified_ms", T.LongType()),
    ]
)

ROLLUP_AUDIT = T.StructType(
    [
        T.StructField("through_batch", T.LongType()),
        T.StructField("late_rows", T.LongType()),
    ]
)
