"""Cleaning and dead letters: outcomes and the trap cases."""

from __future__ import annotations

import datetime as dt

import pytest
from transaction_rows import raw_df, tx

from daybook.functions import json_string_field, strict_double, strict_timestamp
from daybook.operators.clean import classify, clean, dead_letters, reject_counts

CLEANUP_ROWS = [
    ("2022-03-05 08:30:00", "north", "A", '{"currencySymbol": "USD"}', '{"currencyValueDecimal": "12.5"}'),
    ("2022-03-05 09:30:00", "south", "B", '{"currencySymbol": "EUR"}', '{"currencyValueDecimal": "0"}'),
    ("05.03.2022", "no-day", "C", '{"currencySymbol": "USD"}', '{"currencyValueDecimal": "1"}'),
    ("2022-03-05 10:30:00", "no-json", "D", '{"currencySymbol": "USD"}', "amount 3"),
    ("2022-03-05 11:30:00", "negative", "E", '{"currencySymbol": "EUR"}', '{"currencyValueDecimal": "-0.01"}'),
    ("2022-03-05 12:30:00", "huge", "F", '{"currencySymbol": "BTC"}', '{"currencyValueDecimal": "2e16"}'),
    ("2022-03-05 13:30:00", "east", "G", '{"currencySymbol": "BTC"}', '{"currencyValueDecimal": "1e3"}'),
]


def test_outcomes(spark):
    df = raw_df(spark, CLEANUP_ROWS).coalesce(1)
    got = [tuple(r) for r in clean(df).collect()]
    assert got == [
        (dt.datetime(2022, 3, 5, 8, 30), "north", "USD", 12.5),
        (dt.datetime(2022, 3, 5, 9, 30), "south", "EUR", 0.0),
        (dt.datetime(2022, 3, 5, 13, 30), "east", "BTC", 1000.0),
    ]
    reasons = {r.project_id: r.Reason for r in dead_letters(df).collect()}
    assert set(reasons) == {"no-day", "no-json", "negative", "huge"}
    assert reasons["no-day"].startswith("invalid timestamp format")
    assert reasons["no-json"].startswith("invalid JSON format in Nums field")
    assert reasons["negative"] == "volume over threshold: -0.010000"
    assert reasons["huge"] == "volume over threshold: 20000000000000000.000000"


def test_clean_plus_rejected_is_read(spark):
    df = raw_df(spark, CLEANUP_ROWS * 3)
    assert clean(df).count() + dead_letters(df).count() == df.count()
    counts = {r.outcome: r.n_rows for r in reject_counts(df).collect()}
    assert counts == {"clean": 9, "invalid timestamp format": 3, "invalid JSON format in Nums field": 3,
                      "volume over threshold": 6}


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr.alias("r")).first().r


@pytest.mark.parametrize("text,expected", [
    ("2024-04-15 02:15:07", dt.datetime(2024, 4, 15, 2, 15, 7)),
    ("2024-04-15 02:15:07.167", dt.datetime(2024, 4, 15, 2, 15, 7, 167000)),
    ("2024-04-15 02:15:07,167", dt.datetime(2024, 4, 15, 2, 15, 7, 167000)),
    ("2024-04-15 2:15:07", dt.datetime(2024, 4, 15, 2, 15, 7)),
    ("2024-04-15  02:15:07", dt.datetime(2024, 4, 15, 2, 15, 7)),
    ("2024-04-15 02:15:07.1234567891", dt.datetime(2024, 4, 15, 2, 15, 7, 123456)),
    ("2024-02-29 00:00:00", dt.datetime(2024, 2, 29)),
    ("2024-04-15", None),
    ("2024-04-15T02:15:07", None),
    ("2024-04-15 02:15:07Z", None),
    (" 2024-04-15 02:15:07", None),
    ("2024-4-15 02:15:07", None),
    ("2023-02-29 00:00:00", None),
    ("2024-04-15 24:00:00", None),
    ("2024-04-15 23:59:60", None),
    ("2024-04-15 02:15:07\n", None),
    ("2024-04-15 02:15", None),
    ("", None),
])
def test_strict_timestamp(spark, text, expected):
    assert _one(spark, strict_timestamp("x"), text) == expected


@pytest.mark.parametrize("text,ok,value", [
    ('{"currencyValueDecimal": "1.5"}', True, "1.5"),
    ('{"currencyValueDecimal":"1.5"}', True, "1.5"),
    (' \t{ "currencyValueDecimal" :\n"1.5" }\r\n', True, "1.5"),
    ('{"currencyValueDecimal": "1.5", "other": [1, {"a": null}]}', True, "1.5"),
    ('{"CURRENCYVALUEDECIMAL": "7"}', True, "7"),
    ('{"currencyValueDecimal": "1", "currencyValueDecimal": "2"}', True, "2"),
    ('{"currencyValueDecimal": "1", "CURRENCYVALUEDECIMAL": "2"}', True, "2"),
    ('{"currencyValueDecimal": "1", "currencyValueDecimal": null}', True, "1"),
    ('{"currencyValueDecimal": "1", "CurrencyValueDecimal": 5}', False, None),
    ('{"currencyValueDecimal": 5, "currencyValueDecimal": "2"}', False, None),
    ('{"currencyValue\\u0044ecimal": "3"}', True, "3"),
    ('{"a": {"currencyValueDecimal": 5}, "currencyValueDecimal": "4"}', True, "4"),
    ('{"a": "currencyValueDecimal"}', True, ""),
    ('{"currencyValueDecimal": "\\u0031\\u0032"}', True, "12"),
    ('{"currencyValueDecimal": null}', True, ""),
    ('{"other": "x"}', True, ""),
    ("{}", True, ""),
    ("null", True, ""),
    ('{"currencyValueDecimal": 5}', False, None),
    ('{"currencyValueDecimal": true}', False, None),
    ('{"currencyValueDecimal": ["1"]}', False, None),
    ('{"currencyValueDecimal": "1"} x', False, None),
    ('{"currencyValueDecimal": "1"}]', False, None),
    ('{"currencyValueDecimal": "1"}}', False, None),
    ("{},{}", False, None),
    ("{}{}", False, None),
    ("{'currencyValueDecimal': '1'}", False, None),
    ('{"a": NaN}', False, None),
    ('{"a": 1,}', False, None),
    ('{"a": 01}', False, None),
    ('{"a": 1} /* c */', False, None),
    ('{"currencyValueDecimal": "a\tb"}', False, None),
    ('[{"currencyValueDecimal": "1"}]', False, None),
    ('"text"', False, None),
    ("5", False, None),
    ("", False, None),
    ("   ", False, None),
    ("invalid-json", False, None),
])
def test_json_string_field(spark, text, ok, value):
    r = _one(spark, json_string_field("x", "currencyValueDecimal"), text)
    assert (r.ok, r.value) == (ok, value)


@pytest.mark.parametrize("text,expected", [
    ("1", 1.0), ("+5", 5.0), (".5", 0.5), ("5.", 5.0), ("-0", -0.0), ("0", 0.0), ("1e15", 1e15),
    ("1E-3", 0.001), ("0001.50", 1.5), ("1e-400", 0.0),
    ("inf", float("inf")), ("-Infinity", float("-inf")), ("+INF", float("inf")),
    ("1d", None), ("1f", None), (" 1", None), ("1 ", None), ("1e400", None), ("1_0", 10.0), ("1_000.5_0e1_0", 1000.5e10), ("1__0", None), ("_1", None), ("1_", None), ("1_.5", None), (".", None),
    ("1e", None), ("1\n", None), ("0x1p-2", None), ("", None), ("abc", None), ("infin", None), ("+nan", None),
])
def test_strict_double(spark, text, expected):
    assert _one(spark, strict_double("x"), text) == expected


def test_nan_is_rejected_as_over_threshold(spark):
    df = raw_df(spark, [tx(volume="NaN")])
    assert dead_letters(df).first().Reason == "volume over threshold: NaN"
    df = raw_df(spark, [tx(volume="inf"), tx(volume="1e15"), tx(volume="0")])
    assert [r.Reason for r in dead_letters(df).collect()] == ["volume over threshold: +Inf"]


def test_first_failure_wins(spark):
    rows = [
        ("bad", "P", "", "invalid-json", "invalid-json"),
        ("2023-10-01 12:00:00", "P", "", "invalid-json", "invalid-json"),
        ("2023-10-01 12:00:00", "P", "", "invalid-json", '{"currencyValueDecimal": "x"}'),
        ("2023-10-01 12:00:00", "P", "", '{"currencySymbol": "USD"}', '{"currencyValueDecimal": "x"}'),
    ]
    got = [r.reason_code for r in dead_letters(raw_df(spark, rows).coalesce(1)).collect()]
    assert got == ["invalid timestamp format", "invalid JSON format in Nums field",
                   "invalid JSON format in Props field", "invalid volume format"]


def test_missing_or_null_fields(spark):
    rows = [
        ("2023-10-01 12:00:00", "P", "", '{"currencySymbol": "USD"}', '{"other": 1}'),
        ("2023-10-01 12:00:00", "P", "", '{"currencySymbol": "USD"}', "null"),
        ("2023-10-01 12:00:00", "P", "", "null", '{"currencyValueDecimal": "1"}'),
    ]
    df = raw_df(spark, rows).coalesce(1)
    assert [r.reason_code for r in dead_letters(df).collect()] == ["invalid volume format"] * 2
    assert [tuple(r)[1:] for r in clean(df).collect()] == [("P", "", 1.0)]


def test_empty_project_is_a_group_value(spark):
    assert clean(raw_df(spark, [tx(project="")])).first().project_id == ""


def test_each_field_is_parsed_once(spark):
    """The parse expressions appear once in the plan even with a filter on the reason."""
    plan = clean(raw_df(spark, CLEANUP_ROWS))._jdf.queryExecution().executedPlan().toString()
    # two wraps per JSON field, each parsed exactly once
    assert plan.count("parseJson(concat([") == 2
    assert plan.count('parseJson(concat({"v":') == 2


def test_classify_keeps_input_columns(spark):
    df = raw_df(spark, CLEANUP_ROWS)
    assert set(df.columns) <= set(classify(df).columns)


def test_non_canonical_payloads_match_canonical_ones(spark):
    """Extra keys, other spacing and key order take the general path with the same result."""
    rows = [
        ("2023-10-01 12:00:00", "P", "", '{"src": "web", "currencySymbol": "USD"}',
         '{"k": [1, {"x": null}], "currencyValueDecimal": "12.5"}'),
        ("2023-10-01 12:00:00", "P", "", '{ "currencySymbol" :"USD" }', '{\n"currencyValueDecimal":"12.5"\n}'),
        ("2023-10-01 12:00:00", "P", "", '{"CurrencySymbol": "USD", "a": 1}', '{"CURRENCYVALUEDECIMAL": "12.5", "b": 2}'),
        ("2023-10-01 12:00:00", "P", "", '{"currencySymbol": "USD"}', '{"currencyValueDecimal": "12.5"}'),
    ]
    got = [tuple(r)[1:] for r in clean(raw_df(spark, rows)).collect()]
    assert got == [("P", "USD", 12.5)] * 4
    bad = [
        ("2023-10-01 12:00:00", "P", "", '{"currencySymbol": "USD", "a": 1}', '{"currencyValueDecimal": 12.5, "b": 2}'),
        ("2023-10-01 12:00:00", "P", "", '{"currencySymbol": 7, "a": 1}', '{"currencyValueDecimal": "1", "b": 2}'),
        ("2023-10-01 12:00:00", "P", "", '{"a": 1}', '[{"currencyValueDecimal": "1"}, 2]'),
    ]
    codes = sorted(r.reason_code for r in dead_letters(raw_df(spark, bad)).collect())
    assert codes == ["invalid JSON format in Nums field", "invalid JSON format in Nums field",
                     "invalid JSON format in Props field"]
