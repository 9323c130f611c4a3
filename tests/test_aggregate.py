"""Pricing and daily aggregation: totals, merge, strict lookup, plans."""

from __future__ import annotations

import datetime as dt

import pytest
from transaction_rows import raw_df, tx
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from daybook.operators.aggregate import daily_totals, daily_volume, merge_partials
from daybook.operators.clean import clean
from daybook.operators.convert import attach_prices, fits_broadcast, lookup_size, split_unknown
from daybook.operators.prices import inline_prices, latest_prices
from daybook.operators.replicate import replicate

CLEAN_SCHEMA = "ts timestamp_ntz, project_id string, currency_symbol string, volume double"
AGG_ROWS = [
    (dt.datetime(2022, 3, 5, 8, 30), "north", "USD", 12.5),
    (dt.datetime(2022, 3, 5, 23, 59, 59), "north", "EUR", 30.0),
    (dt.datetime(2022, 3, 5, 0, 0), "south", "BTC", 0.25),
    (dt.datetime(2022, 3, 6, 0, 0), "north", "USD", 7.0),
    (dt.datetime(2022, 3, 6, 17, 1), "south", "EUR", 10.0),
    (dt.datetime(2022, 3, 6, 17, 2), "south", "EUR", 5.0),
]
PRICES = {"USD": 1.0, "EUR": 1.5, "BTC": 4096.0}
EXPECTED = {
    ("2022-03-05", "north"): (2, 57.5),
    ("2022-03-05", "south"): (1, 1024.0),
    ("2022-03-06", "north"): (1, 7.0),
    ("2022-03-06", "south"): (2, 22.5),
}


def _as_dict(df):
    return {(r.Date, r.ProjectId): (r.NumberOfTransactions, r.TotalVolumeUsd) for r in df.collect()}


@pytest.mark.parametrize("broadcast", [True, False])
def test_aggregate_fixture(spark, broadcast):
    cl = spark.createDataFrame(AGG_ROWS, CLEAN_SCHEMA)
    got = _as_dict(daily_volume(cl, inline_prices(spark, PRICES), broadcast=broadcast))
    assert got == EXPECTED
    assert daily_volume(cl, inline_prices(spark, PRICES), broadcast=broadcast).columns == [
        "Date", "ProjectId", "NumberOfTransactions", "TotalVolumeUsd"]


def test_size_check(spark):
    lookup = inline_prices(spark, PRICES)
    assert lookup_size(lookup) == (3, 3 * (3 + 32))
    assert fits_broadcast(lookup, 105)
    assert not fits_broadcast(lookup, 104)


def test_unknown_currency_aborts(spark):
    cl = spark.createDataFrame(AGG_ROWS + [(dt.datetime(2023, 10, 1), "P", "XRP", 1.0)], CLEAN_SCHEMA)
    for broadcast in (True, False):
        with pytest.raises((PySparkException, Py4JJavaError), match="currency symbol not supported: XRP"):
            daily_volume(cl, inline_prices(spark, PRICES), broadcast=broadcast).collect()
        # also where the consumer reads no price
        for consume in (lambda df: df.count(), lambda df: df.groupBy("project_id").count().collect()):
            with pytest.raises((PySparkException, Py4JJavaError), match="currency symbol not supported: XRP"):
                consume(attach_prices(cl, inline_prices(spark, PRICES), broadcast=broadcast))


def test_lookup_is_case_sensitive_on_the_transaction_side(spark):
    lookup = latest_prices(spark.createDataFrame([("btc", 1.0, 1)], "Symbol string, `Price (USD)` double, o int"),
                           order="o")
    assert [tuple(r) for r in lookup.collect()] == [("BTC", 1.0)]
    cl = spark.createDataFrame([(dt.datetime(2023, 1, 1), "P", "btc", 1.0)], CLEAN_SCHEMA)
    priced, unknown = split_unknown(cl, lookup, broadcast=True)
    assert priced.count() == 0 and unknown.first().Reason == "currency symbol not supported: btc"


def test_dead_letter_mode(spark):
    cl = spark.createDataFrame(AGG_ROWS + [(dt.datetime(2023, 10, 1), "P", "XRP", 1.0)], CLEAN_SCHEMA)
    priced, unknown = split_unknown(cl, inline_prices(spark, PRICES), broadcast=True)
    assert _as_dict(daily_totals(priced)) == EXPECTED
    assert [r.reason_code for r in unknown.collect()] == ["currency symbol not supported"]


def test_last_price_wins_and_empty_price_matches(spark):
    rows = [("a", "btc", 1.0, 1), ("b", "BTC", 2.0, 2), ("c", "eth", None, 3), ("d", "Btc", 3.0, 0)]
    df = spark.createDataFrame(rows, "ID string, Symbol string, `Price (USD)` double, o int")
    got = {r.symbol: r.price for r in latest_prices(df, order="o").collect()}
    assert got == {"BTC": 2.0, "ETH": 0.0}
    cl = spark.createDataFrame([(dt.datetime(2023, 1, 1), "P", "ETH", 5.0)], CLEAN_SCHEMA)
    assert attach_prices(cl, latest_prices(df, order="o"), broadcast=True).first().usd == 0.0


def test_partials_merge_to_one_shot(spark):
    raw = raw_df(spark, [tx(ts=f"2023-10-0{d} 1{h}:00:00", project=f"P{p}", symbol=s, volume=str(v))
                         for d in (1, 2) for h in range(4) for p in range(3)
                         for s, v in (("USD", 1.25), ("EUR", 2.5))])
    cl = clean(raw)
    lookup = inline_prices(spark, PRICES)
    one_shot = _as_dict(daily_volume(cl, lookup, broadcast=True))
    for parts in (1, 3, 7):
        partials = [daily_volume(piece, lookup, broadcast=True) for piece in cl.randomSplit([1.0] * parts, seed=7)]
        union = partials[0]
        for p in partials[1:]:
            union = union.unionByName(p)
        merged = _as_dict(merge_partials(union))
        assert merged.keys() == one_shot.keys()
        for k, (n, v) in one_shot.items():
            assert merged[k][0] == n and merged[k][1] == pytest.approx(v, rel=1e-12)


def test_replicate_multiplies_counts(spark):
    raw = raw_df(spark, [tx(project="A"), tx(project="B", volume="2.0")])
    base = _as_dict(daily_volume(clean(raw), inline_prices(spark, PRICES), broadcast=True))
    tripled = _as_dict(daily_volume(clean(replicate(raw, 3)), inline_prices(spark, PRICES), broadcast=True))
    assert {k: (n * 3, v * 3) for k, (n, v) in base.items()} == tripled
    assert replicate(raw, 2, copy_col="copy").select("copy").distinct().count() == 2


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_plan_shuffles_partials_only(spark):
    raw = raw_df(spark, [tx()])
    df = daily_volume(clean(raw), inline_prices(spark, PRICES), broadcast=True)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in plan
    # one shuffle, on (day, project), above a map-side aggregate
    assert plan.count("Exchange hashpartitioning") == 1
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "partial_count" in below and "partial_sum" in below


def test_clean_filter_runs_inside_generated_code(spark):
    """The filter on the reason and the projections over it read plain columns, without lambdas."""
    df = clean(raw_df(spark, [tx()]).repartition(1))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    top = [line for line in plan.splitlines() if "Project [" in line or "Filter " in line][:2]
    assert len(top) == 2 and all(line.lstrip(" :+-").startswith("*(") for line in top), top
    assert all("lambda" not in line for line in top)


def test_large_lookup_plan_aggregates_before_joining(spark):
    raw = raw_df(spark, [tx()])
    df = daily_volume(clean(raw), inline_prices(spark, PRICES), broadcast=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the first aggregate (per day, project, symbol) sits below the join
    join_at = plan.index("Join LeftOuter")
    assert "Aggregate" in plan[join_at:]


@pytest.mark.parametrize("broadcast", [True, False])
def test_dead_letter_mode_aggregate_both_paths(spark, broadcast):
    from daybook.operators.aggregate import daily_volume_with_unknown

    cl = spark.createDataFrame(AGG_ROWS + [(dt.datetime(2023, 10, 1), "P", "XRP", 1.0)] * 3, CLEAN_SCHEMA)
    agg, unknown = daily_volume_with_unknown(cl, inline_prices(spark, PRICES), broadcast=broadcast)
    assert _as_dict(agg) == EXPECTED
    assert [r.Reason for r in unknown.collect()] == ["currency symbol not supported: XRP"] * 3
