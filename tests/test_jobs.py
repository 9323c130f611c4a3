"""End-to-end jobs: E1 with its invariants, E2 price snapshot."""

from __future__ import annotations

import os

import pytest

from daybook.plans.jobs import daily_volume_job, price_snapshot
from daybook.sinks.files import read_aggregates_csv, read_dead_letters_csv
from daybook.sources.files import read_prices

HEADER = "ts,project_id,event,props,nums\n"


def _csv_row(ts, project, symbol, volume):
    props = '"{""currencySymbol"": ""%s""}"' % symbol
    nums = '"{""currencyValueDecimal"": ""%s""}"' % volume
    return f"{ts},{project},BUY,{props},{nums}\n"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


@pytest.fixture()
def inputs(workdir):
    tx = os.path.join(workdir, "tx", "a.csv")
    rows = [
        _csv_row("2023-10-01 12:00:00", "ProjectA", "USD", "100.0"),
        _csv_row("2023-10-01 13:00:00", "ProjectA", "EUR", "50.0"),
        _csv_row("2023-10-01 14:00:00", "ProjectB", "BTC", "0.001"),
        _csv_row("2023-10-02 12:00:00", "ProjectA", "USD", "200.0"),
        _csv_row("2023-10-02 13:00:00", "ProjectB", "EUR", "80.0"),
        _csv_row("bad-ts", "ProjectC", "USD", "1"),
        _csv_row("2023-10-02 13:00:00", "ProjectD", "USD", "-1"),
    ]
    _write(tx, HEADER + "".join(rows))
    prices = os.path.join(workdir, "prices", "p.csv")
    _write(prices, "ID,Symbol,Name,Price (USD)\nusd,usd,Dollar,1.0\neur,eur,Euro,1.2\nbtc,btc,Bitcoin,60000\n")
    return workdir, os.path.dirname(tx), prices


def test_daily_volume_job(spark, inputs):
    workdir, tx, prices = inputs
    out, err = os.path.join(workdir, "out"), os.path.join(workdir, "err")
    report = daily_volume_job(spark, tx, prices, out, err)
    got = {(r.Date, r.ProjectId): (r.NumberOfTransactions, r.TotalVolumeUsd)
           for r in read_aggregates_csv(spark, out).collect()}
    assert got == {("2023-10-01", "ProjectA"): (2, 160.0), ("2023-10-01", "ProjectB"): (1, 60.0),
                   ("2023-10-02", "ProjectA"): (1, 200.0), ("2023-10-02", "ProjectB"): (1, 96.0)}
    dead = read_dead_letters_csv(spark, err).collect()
    assert sorted(r.project_id for r in dead) == ["ProjectC", "ProjectD"]
    assert report.rows_read == 7 and report.clean_rows == 5 and report.rejected_rows == 2
    assert report.prices_read == 3 and report.aggregates_written == 4
    assert report.clean_rows + report.rejected_rows == report.rows_read
    assert sum(v[0] for v in got.values()) == report.clean_rows


def test_job_unknown_currency(spark, inputs, workdir):
    _, tx, prices = inputs
    with open(os.path.join(tx, "b.csv"), "w") as fh:
        fh.write(HEADER + _csv_row("2023-10-03 00:00:00", "ProjectE", "XRP", "1"))
    out, err = os.path.join(workdir, "out2"), os.path.join(workdir, "err2")
    with pytest.raises(Exception, match="currency symbol not supported: XRP"):
        daily_volume_job(spark, tx, prices, out, err)
    assert not os.path.exists(os.path.join(out, "_SUCCESS"))
    report = daily_volume_job(spark, tx, prices, out, err, on_unknown="dead_letter")
    reasons = sorted(r.Reason for r in read_dead_letters_csv(spark, err).collect())
    assert "currency symbol not supported: XRP" in reasons
    assert report.aggregates_written == 4
    assert (report.rows_read, report.clean_rows, report.rejected_rows) == (8, 5, 3)


def test_job_counts_rows_of_a_table_sink_once(spark, inputs, workdir):
    _, tx, prices = inputs
    name = "table://spark_catalog/default/job_sink_test"
    for runs in (1, 2):      # append is the default
        report = daily_volume_job(spark, tx, prices, name, os.path.join(workdir, f"e{runs}"))
        assert report.aggregates_written == 4
        assert spark.table("spark_catalog.default.job_sink_test").count() == 4 * runs
    spark.sql("DROP TABLE spark_catalog.default.job_sink_test")


@pytest.mark.parametrize("on_unknown", ["fail", "dead_letter"])
@pytest.mark.parametrize("on_malformed", ["fail", "dead_letter"])
def test_job_reads_its_source_once(spark, inputs, workdir, on_unknown, on_malformed, monkeypatch):
    """One scan of the transaction files in all modes, nothing sorted by outcome, and no scratch left."""
    from daybook.plans import jobs
    from daybook.session import shared_dir

    plans, left = [], []
    real = jobs.land
    monkeypatch.setattr(jobs, "land", lambda rows, path: (plans.append(rows._jdf.queryExecution().executedPlan().toString()),
                                                          left.append(path), real(rows, path))[-1])
    _, tx, prices = inputs
    daily_volume_job(spark, tx, prices, os.path.join(workdir, "o"), os.path.join(workdir, "e"),
                     on_unknown=on_unknown, on_malformed=on_malformed)
    assert len(plans) == 1 and plans[0].count("FileScan csv") == 1 and "Sort" not in plans[0].replace("SortMergeJoin", "")
    assert left[0].startswith(shared_dir(spark)) and not os.path.exists(left[0])


def test_job_line_breaks_in_fields(spark, workdir):
    tx = os.path.join(workdir, "tx", "a.csv")
    row = _csv_row("2023-10-01 12:00:00", '"Pro\nject"', "USD", "1")
    _write(tx, HEADER + row + _csv_row("2023-10-01 12:00:00", "Q", "USD", "1"))
    prices = os.path.join(workdir, "prices", "p.csv")
    _write(prices, "ID,Symbol,Name,Price (USD)\nusd,usd,Dollar,1.0\n")
    out = os.path.join(workdir, "out")
    report = daily_volume_job(spark, os.path.dirname(tx), prices, out, os.path.join(workdir, "err"), multi_line=True)
    assert (report.rows_read, report.clean_rows) == (2, 2)
    assert {r.ProjectId for r in read_aggregates_csv(spark, out).collect()} == {"Pro\nject", "Q"}


def test_prices_are_counted_whole(spark, inputs, workdir):
    _, tx, prices = inputs
    report = daily_volume_job(spark, tx, prices, os.path.join(workdir, "o"), os.path.join(workdir, "e"), max_broadcast_bytes=1)
    assert (report.prices_read, report.aggregates_written) == (3, 4)


def test_job_malformed_rows_dead_lettered(spark, inputs, workdir):
    _, tx, prices = inputs
    with open(os.path.join(tx, "c.csv"), "w") as fh:
        fh.write(HEADER + "only,three,fields\n")
    out, err = os.path.join(workdir, "out3"), os.path.join(workdir, "err3")
    report = daily_volume_job(spark, tx, prices, out, err, on_malformed="dead_letter")
    assert report.rows_read == 8 and report.rejected_rows == 3
    assert any(r.Reason.startswith("malformed CSV row") for r in read_dead_letters_csv(spark, err).collect())


def test_job_header_only(spark, workdir):
    tx = os.path.join(workdir, "tx", "a.csv")
    _write(tx, HEADER)
    prices = os.path.join(workdir, "prices", "p.csv")
    _write(prices, "ID,Symbol,Name,Price (USD)\nusd,usd,Dollar,1.0\n")
    out, err = os.path.join(workdir, "out"), os.path.join(workdir, "err")
    report = daily_volume_job(spark, os.path.dirname(tx), prices, out, err)
    assert report.rows_read == 0 and report.aggregates_written == 0
    assert read_aggregates_csv(spark, out).count() == 0


def test_price_snapshot(spark, workdir):
    pages = os.path.join(workdir, "pages", "p.json")
    _write(pages, '[{"id": "bitcoin", "symbol": "btc", "name": "Bitcoin", "current_price": 2.5}]\n'
                  '[{"id": "b2", "symbol": "BTC", "name": "B2", "current_price": 3.5}]\n')
    out = os.path.join(workdir, "prices")
    assert price_snapshot(spark, os.path.dirname(pages), out, page_size=1) == 2
    with open(sorted(p for p in os.listdir(out) if p.startswith("part-"))[0] and
              os.path.join(out, sorted(p for p in os.listdir(out) if p.startswith("part-"))[0])) as fh:
        assert fh.readline().strip() == "ID,Symbol,Name,Price (USD)"
    assert {r.symbol for r in read_prices(spark, out).collect()} == {"BTC"}


def test_command_line(spark, inputs, workdir):
    from daybook.cli import main

    _, tx, prices = inputs
    out, err = os.path.join(workdir, "cli-out"), os.path.join(workdir, "cli-err")
    report = main(["agg", "-c", prices, "-t", tx, "-o", out, "-e", err])
    assert report["aggregates_written"] == 4 and report["rows_read"] == 7
    out2, err2 = os.path.join(workdir, "cli-out2"), os.path.join(workdir, "cli-err2")
    run = main(["agg", "-c", prices, "-t", tx, "-o", out2, "-e", err2, "--stream", "--files-per-batch", "1",
                "--compact", "--work-dir", os.path.join(workdir, "work")])
    assert run["rows_read"] == 7 and run["clean_rows"] == 5
    assert read_aggregates_csv(spark, out2).count() == 4
    assert read_dead_letters_csv(spark, err2).count() == 2


def test_command_line_snapshot(spark, workdir):
    from daybook.cli import main

    pages = os.path.join(workdir, "pages", "p.json")
    _write(pages, '[{"id": "bitcoin", "symbol": "btc", "name": "Bitcoin", "current_price": 2.5}]\n')
    out = os.path.join(workdir, "snap")
    assert main(["snapshot", "--pages", os.path.dirname(pages), "-o", out]) == {"prices_written": 1}
    assert [tuple(r) for r in read_prices(spark, out).collect()] == [("BTC", 2.5)]
