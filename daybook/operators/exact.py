"""Sums of doubles that do not depend on the order of addition (A4).

A double is split without error into three whole numbers relative to a power of two that its size
chooses: with the bucket b = floor(log2 |v| / 32), x = v / 2^(32 b) lies between 1
and 2^32 and is a multiple of 2^-53, so

    x = 2^4 h + 2^-24 m + 2^-53 l,   |h|, |m|, |l| < 2^29.

Whole numbers are summed as longs, exactly and in any order, for each bucket (a
group has one or two as a rule, 66 at most); 2^34 values fit, beyond that the
sum raises.  At the end a group's buckets make one whole number, which is rounded to a
double once.  So the total is the correctly rounded sum of the products,
with the same bits for any partitioning, retry or split into batches.

Infinite and undefined values have sums of their own, in which order does not matter either.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import day_key
from daybook.operators.convert import attach_prices

LIMBS = ("_h", "_m", "_l")
LOWEST, HIGHEST = -34, 32          # buckets of all doubles, with room for the rounding of a logarithm
LIMB_BITS = (57, 29, 0)            # units of h, m and l, over 2^-53
EXACT_PARTIAL_COLUMNS = ("Date", "ProjectId", "bucket", "NumberOfTransactions", *LIMBS, "_special")


def with_limbs(rows: DataFrame, value: str) -> DataFrame:
    """``rows`` with ``bucket``, the limbs of the double ``value``, and ``_special`` where it is not finite."""
    finite = f"abs({value}) < double('inf')"
    # 2^(-16 b), applied twice: 2^(-32 b) itself may be beyond a double.
    powers = "array(" + ", ".join(f"double('{2.0 ** (-16 * b)!r}')" for b in range(LOWEST, HIGHEST + 1)) + ")"
    bucket = f"CASE WHEN {finite} THEN coalesce(CAST(floor(log2(abs({value})) / 32) AS int), 0) ELSE 0 END"
    out = rows.withColumn("bucket", F.expr(bucket))
    out = out.withColumn("_p", F.expr(f"element_at({powers}, bucket - {LOWEST} + 1)"))
    out = out.withColumn("_x", F.expr(f"CASE WHEN {finite} THEN {value} * _p * _p ELSE 0D END"))
    out = out.withColumn("_h", F.expr("CAST(_x / 16D AS bigint)")).withColumn("_r", F.expr("_x - _h * 16D"))
    out = out.withColumn("_m", F.expr("CAST(_r * 16777216D AS bigint)"))
    out = out.withColumn("_l", F.expr("CAST((_r - _m / 16777216D) * 9007199254740992D AS bigint)"))
    return out.withColumn("_special", F.expr(f"CASE WHEN NOT ({finite}) THEN {value} END")).drop("_p", "_x", "_r")


def exact_partials(priced: DataFrame) -> DataFrame:
    """Priced clean rows (ts, project_id, usd) → one row per (day, project, bucket) with the count and the summed limbs."""
    rows = with_limbs(priced.select(F.to_date("ts").alias("_day"), F.col("project_id").alias("ProjectId"), "usd"), "usd")
    sums = rows.groupBy("_day", "ProjectId", "bucket").agg(
        F.count(F.lit(1)).alias("NumberOfTransactions"), *[F.sum(c).alias(c) for c in (*LIMBS, "_special")])
    return sums.select(day_key("_day").alias("Date"), *EXACT_PARTIAL_COLUMNS[1:])


def merge_exact_partials(partials: DataFrame) -> DataFrame:
    """Combine exact partials (any number of rows per key) into one row per key."""
    return partials.groupBy("Date", "ProjectId", "bucket").agg(
        *[F.sum(c).alias(c) for c in ("NumberOfTransactions", *LIMBS, "_special")])


def rounded_total(parts: list[dict], special: float | None) -> float:
    """The sum of buckets ({bucket, limbs}) as the nearest double."""
    if special is not None:
        return special
    low = min(p["bucket"] for p in parts)
    whole = sum(sum(p[c] << bits for c, bits in zip(LIMBS, LIMB_BITS, strict=True)) << 32 * (p["bucket"] - low) for p in parts)
    shift = 32 * low - 53
    try:
        return float(whole << shift) if shift >= 0 else whole / (1 << -shift)
    except OverflowError:
        return float("inf") if whole > 0 else float("-inf")


def exact_totals(partials: DataFrame) -> DataFrame:
    """Exact partials → Date, ProjectId, NumberOfTransactions, TotalVolumeUsd; one rounding for each group."""

    @F.arrow_udf("double")
    def rounded(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for parts, special in batches:
            yield pa.array([rounded_total(p, s) for p, s in zip(parts.to_pylist(), special.to_pylist(), strict=True)], pa.float64())

    groups = merge_exact_partials(partials).groupBy("Date", "ProjectId").agg(
        F.sum("NumberOfTransactions").alias("NumberOfTransactions"),
        F.collect_list(F.struct("bucket", *LIMBS)).alias("_parts"),      # at most one entry a bucket
        F.sum("_special").alias("_special"))
    return groups.select("Date", "ProjectId", "NumberOfTransactions", rounded("_parts", "_special").alias("TotalVolumeUsd"))


def exact_daily_volume(clean: DataFrame, lookup: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """:func:`~daybook.operators.aggregate.daily_volume` with order-independent sums of price x volume.

    Every row is priced, as its product is rounded before it is added; a
    lookup too large to broadcast is joined by a shuffle on the symbol, whose hot keys AQE splits.
    """
    return exact_totals(exact_partials(attach_prices(clean, lookup, broadcast)))
