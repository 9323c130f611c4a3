"""File sources: transaction CSV, price CSV, price pages, path mapping."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from daybook.sources.files import read_price_pages, read_prices, read_transactions, resolve_path

# The header of the transaction export and its payload keys.  The rows are this test's own.
HEADER = ("app", "ts", "event", "project_id", "source", "ident", "user_id", "session_id", "country", "device_type",
          "device_os", "device_os_ver", "device_browser", "device_browser_ver", "props", "nums")
GOOD = {"app": "till", "ts": "2022-07-03 09:08:07.5", "event": "SALE", "project_id": "p-12", "ident": "x1", "country": "NZ",
        "props": '{"currencySymbol":"ABC"}', "nums": '{"currencyValueDecimal":"3.25"}'}


def wide(*rows, order=HEADER):
    """A wide export: rows of dicts, or of ready lines."""
    def quoted(values):
        return ",".join('"' + v.replace('"', '""') + '"' for v in values)

    return "\n".join([quoted(order), *[r if isinstance(r, str) else quoted(r.get(c, "") for c in order) for r in rows]]) + "\n"


FIXTURE_CSV = wide(GOOD, GOOD | {"project_id": "0", "ts": "2022-07-03 10:00:00"})
LOST = ",".join(['"a"'] * 4)
GAINED = ",".join(['"a"'] * 18)


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_transaction_csv_fixture(spark, workdir):
    path = _write(workdir, "tx.csv", FIXTURE_CSV)
    rows = [tuple(r) for r in read_transactions(spark, path).collect()]
    assert rows == [
        ("2022-07-03 09:08:07.5", "p-12", "SALE", '{"currencySymbol":"ABC"}', '{"currencyValueDecimal":"3.25"}'),
        ("2022-07-03 10:00:00", "0", "SALE", '{"currencySymbol":"ABC"}', '{"currencyValueDecimal":"3.25"}'),
    ]


def test_lines_are_split_once_and_in_generated_code(spark, workdir):
    """One scan of whole lines; one parse of each, below the filters on its result."""
    path = _write(workdir, "tx.csv", FIXTURE_CSV)
    rows, _ = read_transactions(spark, path, on_malformed="dead_letter")
    plan = rows.where("project_id <> ''")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv(") == 1 and plan.count("FileScan csv") == 1 and "Python" not in plan


@pytest.mark.parametrize("damaged", [LOST, GAINED])
def test_damaged_rows_of_a_wide_file_are_noticed(spark, workdir, damaged):
    path = _write(workdir, "tx.csv", wide(GOOD, damaged))
    for consume in (lambda df: df.collect(), lambda df: df.count(), lambda df: df.select("ts").collect()):
        with pytest.raises((PySparkException, Py4JJavaError), match="malformed CSV row"):
            consume(read_transactions(spark, path))
    rows, bad = read_transactions(spark, path, on_malformed="dead_letter")
    assert [r.project_id for r in rows.collect()] == ["p-12"]
    assert [r.Reason for r in bad.collect()] == [f"malformed CSV row: {damaged}"]
    assert (rows.count(), bad.count()) == (1, 1)


def test_files_with_another_column_order(spark, workdir):
    _write(workdir, "a.csv", wide(GOOD))
    _write(workdir, "b.csv", wide(GOOD | {"project_id": "second"}, order=HEADER[::-1]))
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_transactions(spark, workdir).collect()     # never bound by position
    rows = read_transactions(spark, workdir, mixed_headers=True).collect()
    assert sorted((r.project_id, r.ts, r.nums) for r in rows) == [
        ("p-12", GOOD["ts"], GOOD["nums"]), ("second", GOOD["ts"], GOOD["nums"])]


def test_line_breaks_in_quoted_fields(spark, workdir):
    path = _write(workdir, "tx.csv", wide(GOOD | {"event": "two\nlines"}, GOOD))
    for multi_line in (None, True):
        assert sorted(r.event for r in read_transactions(spark, path, multi_line=multi_line).collect()) == ["SALE", "two\nlines"]
    with pytest.raises((PySparkException, Py4JJavaError), match="malformed CSV row"):
        read_transactions(spark, path, multi_line=False).collect()      # told that there are none


def test_line_breaks_in_price_names(spark, workdir):
    _write(workdir, "p.csv", 'ID,Symbol,Name,Price (USD)\r\nu,usd,"Dol\r\nlar",1\r\ne,usd,"E ""x""",2\r\n')
    assert [(r.symbol, r.price) for r in read_prices(spark, workdir).collect()] == [("USD", 2.0)]


@pytest.mark.parametrize("price", ["NaN", "inf", "-Infinity"])
def test_prices_that_would_poison_sums_fail(spark, workdir, price):
    _write(workdir, "p.csv", f"ID,Symbol,Name,Price (USD)\nu,usd,Dollar,{price}\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="price is not a number"):
        read_prices(spark, workdir).collect()


def test_file_without_a_line(spark, workdir):
    path = _write(workdir, "tx.csv", "")
    with pytest.raises(ValueError, match="no header"):
        read_transactions(spark, path)


@pytest.mark.parametrize("row", ["e,eur", "e,eur,Euro,1.1,x,y"])
def test_damaged_price_rows_fail(spark, workdir, row):
    _write(workdir, "p.csv", f"ID,Symbol,Name,Price (USD)\nu,usd,Dollar,1\n{row}\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="malformed CSV row"):
        read_prices(spark, workdir).collect()


def test_empty_fields_order_and_blank_lines(spark, workdir):
    text = 'nums,props,ts,extra,project_id\n"",,2024-01-01 00:00:00,x,""\n\n1,2,3,4,5\n'
    path = _write(workdir, "tx.csv", text)
    rows = [tuple(r) for r in read_transactions(spark, path).collect()]
    # event is missing entirely → ""; empty and quoted-empty fields → ""
    assert rows == [("2024-01-01 00:00:00", "", "", "", ""), ("3", "5", "", "2", "1")]


def test_malformed_rows_fail_or_dead_letter(spark, workdir):
    text = 'ts,project_id,event,props,nums\na,b,c,d,e\nshort,row\nf,g,h,i,j,k\n'
    path = _write(workdir, "tx.csv", text)
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_transactions(spark, path).collect()
    rows, bad = read_transactions(spark, path, on_malformed="dead_letter")
    assert [tuple(r) for r in rows.collect()] == [("a", "b", "c", "d", "e")]
    reasons = sorted(r.Reason for r in bad.collect())
    assert reasons == ["malformed CSV row: f,g,h,i,j,k", "malformed CSV row: short,row"]


def test_header_only_input(spark, workdir):
    path = _write(workdir, "tx.csv", "ts,project_id,event,props,nums\n")
    assert read_transactions(spark, path).count() == 0


def test_price_csv_last_row_wins_across_files(spark, workdir):
    _write(workdir, "a.csv", "ID,Symbol,Name,Price (USD)\nbitcoin,btc,Bitcoin,1\nether,eth,Ether,\n")
    _write(workdir, "b.csv", "ID,Symbol,Name,Price (USD)\nbitcoin,BTC,Bitcoin,2\nx,Btc,X,3\n")
    got = {r.symbol: r.price for r in read_prices(spark, workdir).collect()}
    assert got == {"BTC": 3.0, "ETH": 0.0}


def test_price_csv_bad_price_fails(spark, workdir):
    _write(workdir, "a.csv", "ID,Symbol,Name,Price (USD)\nbitcoin,btc,Bitcoin,1x\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="price is not a number"):
        read_prices(spark, workdir).collect()


def test_price_pages(spark, workdir):
    _write(workdir, "p1.json", '[{"id": "bitcoin", "symbol": "btc", "name": "Bitcoin", "current_price": 60000.5},'
                               ' {"id": "x", "symbol": "x", "name": "X", "current_price": null}]\n'
                               '[{"id": "ether", "symbol": "eth", "name": "Ether", "current_price": 3000}]\n')
    rows = sorted(tuple(r) for r in read_price_pages(spark, workdir, page_size=1).collect())
    assert rows == [("bitcoin", "btc", "Bitcoin", 60000.5), ("ether", "eth", "Ether", 3000.0), ("x", "x", "X", 0.0)]


def test_price_pages_multiline(spark, workdir):
    _write(workdir, "p1.json", '[\n  {"id": "a", "symbol": "a", "name": "A", "current_price": 1}\n]\n')
    assert read_price_pages(spark, workdir, multi_line=True).count() == 1


def test_resolve_path():
    assert resolve_path("s3://bucket/key") == "s3a://bucket/key"
    assert resolve_path("gs://bucket/key") == "gs://bucket/key"
    assert resolve_path("/data/x.csv") == "/data/x.csv"
    assert resolve_path("abfss://box@host/x") == "abfss://box@host/x"
