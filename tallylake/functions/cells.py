"""Typing of the eight cells of one input row."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.functions.timeparts import INTEGER_TEXT, epoch_millis
from tallylake.schema import AMOUNT, CELLS, UINT32_MAX, UINT64_MAX

# Column -> (largest value, stored type)
UNSIGNED = {
    "transaction_id": (UINT64_MAX, "decimal(20,0)"),
    "bill_id": (UINT64_MAX, "decimal(20,0)"),
    "site_id": (UINT32_MAX, "bigint"),
    "item_id": (UINT32_MAX, "bigint"),
}


def type_cells(rows: DataFrame, null_as_text: bool = False) -> DataFrame:
    """Replace ``cells`` by the eight typed columns and a reject ``reason``.

    ``reason`` is NULL for a good row, else ``BAD_SHAPE``, ``BAD_CELL:<column>`` (the
    first cell that does not convert) or ``OUT_OF_RANGE``.  ``raw``, the text of the
    row, is kept for rejected rows only.  ``null_as_text`` turns a null username or
    currency into the text ``None`` instead of rejecting the row.
    """
    kept = [c for c in rows.columns if c not in ("cells", "raw")]
    wide = rows.select(
        *kept,
        "raw",
        F.coalesce(F.size("cells") == len(CELLS), F.lit(False)).alias("_shape"),
        *[_parsed(name, F.get("cells", F.lit(i)), null_as_text) for i, name in enumerate(CELLS)],
    )
    unusable = [F.when(F.col(n).isNull(), F.lit(f"BAD_CELL:{n}")) for n in CELLS]
    outside = [
        F.when(~F.col(n).between(0, F.lit(Decimal(top))), F.lit("OUT_OF_RANGE"))
        for n, (top, _) in UNSIGNED.items()
    ]
    judged = wide.withColumn(
        "reason",
        F.coalesce(F.when(~F.col("_shape"), F.lit("BAD_SHAPE")), *unusable, *outside),
    )
    good = F.col("reason").isNull()
    return judged.select(
        *kept,
        "reason",
        F.when(~good, F.col("raw")).alias("raw"),
        *[F.when(good, F.col(n)).alias(n) if n in UNSIGNED else F.col(n) for n in CELLS],
    )


def _parsed(name: str, text: Column, null_as_text: bool) -> Column:
    if name in UNSIGNED:
        # An integer too long for its type becomes -1: out of range like any negative.
        stored = UNSIGNED[name][1]
        value = F.when(
            text.rlike(INTEGER_TEXT), F.coalesce(text.try_cast(stored), F.lit(-1).cast(stored))
        )
    elif name == "transfer_amount":
        value = text.try_cast(AMOUNT)
    elif name == "transaction_time":
        value = epoch_millis(text)
    else:
        value = F.coalesce(text, F.lit("None")) if null_as_text else text
    return value.alias(name)

