"""The strict parsers against plain-Python implementations of the same rules, over generated inputs."""

from __future__ import annotations

import datetime as dt
import itertools
import json
import math
import re

from daybook.functions import json_string_field, strict_double, strict_timestamp

FIELD = "currencyValueDecimal"


# ---- plain-Python statements of the rules -------------------------------------------------

def _no_constants(name):
    raise ValueError(name)


def ref_field(text: str, field: str = FIELD):
    """Entries in document order, duplicates included: every one that matches must be text or null, the last text wins."""
    depth = []

    def pairs(items):
        depth.append(items)
        return dict(items)

    try:
        doc = json.loads(text, parse_constant=_no_constants, object_pairs_hook=pairs)
    except (ValueError, RecursionError):
        return (False, None)
    if doc is None:
        return (True, "")
    if not isinstance(doc, dict):
        return (False, None)
    values = [v for k, v in depth[-1] if k.lower() == field.lower()]     # the outermost object is closed last
    if any(not (v is None or isinstance(v, str)) for v in values):
        return (False, None)
    strings = [v for v in values if v is not None]
    return (True, strings[-1] if strings else "")


_DECIMAL = re.compile(r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?")


def ref_double(text: str):
    if re.fullmatch(r"[^_].*[^_]", text) and re.search(r"_", text) and not re.search(r"(?<![0-9])_|_(?![0-9])", text):
        text = text.replace("_", "")
    if _DECIMAL.fullmatch(text):
        value = float(text)
        return None if math.isinf(value) else value
    if re.fullmatch(r"(?i)[+-]?inf(inity)?", text):
        return float("-inf") if text.startswith("-") else float("inf")
    if re.fullmatch(r"(?i)nan", text):
        return "nan"
    return None


def ref_timestamp(text: str):
    m = re.fullmatch(r"([0-9]{4})-([0-9]{2})-([0-9]{2}) +([0-9]{1,2}):([0-9]{2}):([0-9]{2})([.,][0-9]+)?", text)
    if not m:
        return None
    y, mo, d, h, mi, s, frac = m.groups()
    micros = int((frac[1:] + "000000")[:6]) if frac else 0
    try:
        return dt.datetime(int(y), int(mo), int(d), int(h), int(mi), int(s), micros)
    except ValueError:
        return None


# ---- generated inputs -------------------------------------------------------------------

def json_cases():
    keys = ['"currencyValueDecimal"', '"CURRENCYVALUEDECIMAL"', '"currencyvaluedecimal"', '"other"']
    values = ['"1.5"', '""', "null", "5", "-0", "1e400", "true", "[1]", "{}", '"a\\"b"', '"\\u0031\\u0032"',
              '"x\\ty"', "01", "NaN", "'q'"]
    extras = ["", ', "o": 1', ', "o": [1, {"a": null}]', ', "o": "x"']
    spaces = [("", ""), (" ", " "), ("\n", "\t")]
    out = set()
    for key, value, extra, (a, b) in itertools.product(keys, values, extras, spaces):
        out.add(f"{a}{{{a}{key}{a}:{b}{value}{extra}}}{b}")
    for base in ['{"currencyValueDecimal": "2"}', "null", "[]", '"s"', "7", "{}"]:
        for junk in ["", " ", "x", "}", "]", ",{}", "{}", " // c", "\n"]:
            out.add(base + junk)
            out.add(junk + base)
    for first, second in itertools.product(keys, keys):
        for one, two in itertools.product(values[:7], values[:7]):
            out.add(f"{{{first}: {one}, {second}: {two}}}")
    out.update(["", " ", "{", "}", "[", '{"currencyValueDecimal": "1", "currencyValueDecimal": "2"}',
                '{"currencyValueDecimal": "1",}', '{"currencyValueDecimal": "1" "o": 2}'])
    return sorted(out)


def number_cases():
    parts = ["", "+", "-", "0", "1", "12", ".", "5", "e", "E", "e5", "e-3", "x", " ", "_", "d"]
    out = {a + b + c for a, b, c in itertools.product(parts, repeat=3)}
    out.update(["inf", "-Infinity", "+INF", "nan", "NaN", "+nan", "infin", "1e400", "-1e400", "1e-400",
                "0x1p3", "1_000", "1_0.0_1e1_0", "1_.0", "1._0", "1e_1", "-1_0", "1.5e+10", "\t1", "1\n"])
    return sorted(out)


def timestamp_cases():
    dates = ["2024-02-29", "2023-02-29", "2024-12-31", "2024-13-01", "2024-00-10", "2024-4-05", "0001-01-01"]
    times = ["00:00:00", "23:59:59", "24:00:00", "7:05:09", "12:60:00", "12:00:60", "12:00", "12:00:00.5",
             "12:00:00,123456789", "12:00:00.", "12:00:00Z"]
    seps = [" ", "  ", "T", ""]
    out = {d + s + t for d, s, t in itertools.product(dates, seps, times)}
    out.update(["", "2024-01-01", " 2024-01-01 00:00:00", "2024-01-01 00:00:00 ", "2024-01-01 00:00:00\n"])
    return sorted(out)


def _evaluate(spark, cases, expr):
    df = spark.createDataFrame([(c,) for c in cases], "x string").select("x", expr.alias("r"))
    return {row.x: row.r for row in df.collect()}


def test_json_field_against_python(spark):
    cases = json_cases()
    got = _evaluate(spark, cases, json_string_field("x", FIELD))
    wrong = [(c, (got[c].ok, got[c].value), ref_field(c)) for c in cases
             if (got[c].ok, got[c].value) != ref_field(c)]
    assert not wrong, wrong[:10]
    assert len(cases) > 700


def test_strict_double_against_python(spark):
    cases = number_cases()
    got = _evaluate(spark, cases, strict_double("x"))
    norm = {c: ("nan" if isinstance(v, float) and math.isnan(v) else v) for c, v in got.items()}
    wrong = [(c, norm[c], ref_double(c)) for c in cases if norm[c] != ref_double(c)]
    assert not wrong, wrong[:10]


def test_strict_timestamp_against_python(spark):
    cases = timestamp_cases()
    got = _evaluate(spark, cases, strict_timestamp("x"))
    wrong = [(c, got[c], ref_timestamp(c)) for c in cases if got[c] != ref_timestamp(c)]
    assert not wrong, wrong[:10]


def ref_reason(ts: str, props: str, nums: str):
    if ref_timestamp(ts) is None:
        return "invalid timestamp format"
    nums_ok, amount_text = ref_field(nums)
    if not nums_ok:
        return "invalid JSON format in Nums field"
    props_ok, _ = ref_field(props, "currencySymbol")
    if not props_ok:
        return "invalid JSON format in Props field"
    amount = ref_double(amount_text)
    if amount is None:
        return "invalid volume format"
    if amount == "nan" or amount < 0 or amount > 1e15:
        return "volume over threshold"
    return None


def test_classify_against_python(spark):
    from daybook.operators.clean import classify

    stamps = ["2024-01-01 00:00:00", "2024-1-01 00:00:00", "2023-02-29 10:00:00", "2024-01-01  7:00:00,5"]
    amounts = ["1.5", "-1", "0", "1e15", "1e16", "abc", "", "inf", "NaN", "1e400", " 2"]
    nums_forms = ['{"currencyValueDecimal": "%s"}', '{"o": 1, "CurrencyValueDecimal": "%s"}',
                  '{"currencyValueDecimal": "%s"} x', '["%s"]']
    props = ['{"currencySymbol": "USD"}', '{"currencysymbol": "USD", "x": [1]}', '{"currencySymbol": 1}',
             "null", "{bad"]
    rows = [(ts, "P", "", p, form % a) for ts in stamps for a in amounts for form in nums_forms for p in props]
    df = spark.createDataFrame(rows, "ts string, project_id string, event string, props string, nums string")
    got = {(r.ts, r.props, r.nums): r.reason_code for r in classify(df).collect()}
    wrong = [(k, got[k], ref_reason(*k)) for k in got if got[k] != ref_reason(*k)]
    assert not wrong, wrong[:10]
    assert len(got) == len(rows)
