"""Hot keys: one (day, project, symbol) holding a third of all rows."""

from __future__ import annotations

from transaction_rows import raw_df, tx
from pyspark.sql import functions as F

from daybook.operators.aggregate import daily_volume, daily_volume_with_unknown
from daybook.operators.clean import clean
from daybook.operators.prices import inline_prices
from daybook.operators.replicate import replicate
from daybook.sources.balance import spread

PRICES = {"USD": 1.0, "EUR": 2.0}


def _skewed(spark, hot_copies=3000):
    cold = [tx(ts=f"2023-10-{1 + i % 28:02d} 12:00:00", project=f"P{i % 50}", symbol="EUR", volume="1.5")
            for i in range(2 * hot_copies)]
    hot = replicate(raw_df(spark, [tx(ts="2023-10-01 00:00:00", project="HOT", symbol="USD", volume="2.0")]),
                    hot_copies)
    return raw_df(spark, cold).unionByName(hot), hot_copies


def test_hot_key_totals_are_exact(spark):
    raw, hot = _skewed(spark)
    for broadcast in (True, False):
        agg = {(r.Date, r.ProjectId): (r.NumberOfTransactions, r.TotalVolumeUsd)
               for r in daily_volume(clean(raw), inline_prices(spark, PRICES), broadcast=broadcast).collect()}
        assert agg[("2023-10-01", "HOT")] == (hot, 2.0 * hot)
        assert sum(n for n, _ in agg.values()) == 3 * hot
    agg, unknown = daily_volume_with_unknown(clean(raw), inline_prices(spark, {"EUR": 2.0}), broadcast=False)
    assert unknown.count() == hot
    assert sum(r.NumberOfTransactions for r in agg.collect()) == 2 * hot


def test_spread_balances_identical_rows(spark):
    same = replicate(raw_df(spark, [tx()]), 8000).coalesce(1)
    spread_df = spread(same, 8)
    sizes = [r["count"] for r in spread_df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and sum(sizes) == 8000
    assert max(sizes) < 1.2 * min(sizes)


def test_spread_leaves_wide_scans_alone(spark):
    wide = raw_df(spark, [tx()] * 64).repartition(16)
    assert spread(wide, 8) is wide


def test_many_copies_use_all_tasks(spark):
    sample = raw_df(spark, [tx(project=f"P{i}") for i in range(60)]).coalesce(1)
    copies = replicate(sample, 10_000, copy_col="copy")
    sizes = [r["count"] for r in copies.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 600_000 and len(sizes) == spark.sparkContext.defaultParallelism
    assert max(sizes) < 1.5 * sum(sizes) / len(sizes)
    assert copies.groupBy("project_id").agg(F.countDistinct("copy").alias("n")).where("n <> 10000").count() == 0


def test_spread_keeps_scans_of_a_quarter_of_the_cores(spark):
    some = raw_df(spark, [tx()] * 64).repartition(4)
    assert spread(some, 16) is some
    assert spread(some, 17) is not some
