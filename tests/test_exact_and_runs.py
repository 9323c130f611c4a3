"""Order-independent sums, the table by run id, the running reduce, row-count batches, price versions, pages, clean-up."""

from __future__ import annotations

import math
import os
import random
from fractions import Fraction

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from transaction_rows import raw_df, tx

from daybook.operators import exact
from daybook.operators.aggregate import daily_volume
from daybook.operators.clean import clean
from daybook.operators.prices import inline_prices
from daybook.plans.queries import STAGED_FILES, rows_a_file
from daybook.session import scratch_path, shared_dir
from daybook.sinks.runs import read_runs, run_log, unread_versions, write_run
from daybook.sources.files import read_price_pages, read_transactions
from daybook.streaming.microbatch import (
    PriceVersions,
    daily_volume_batches,
    merged_daily_volume,
    run_daily_volume_stream,
    stream_dead_letters,
    transaction_stream,
)
from daybook.streaming.rowbatches import RowBatches
from daybook.streaming.running import (
    running_counters,
    running_daily_volume,
    running_dead_letters,
    run_running_daily_volume,
)

PRICES = {"USD": 1.0, "EUR": 1.2}
HEAD = "ts,project_id,event,props,nums\n"


def csv_row(ts="2023-10-01 10:00:00", project="P", event="E", symbol="USD", volume="1"):
    return f'{ts},{project},{event},"{{""currencySymbol"": ""{symbol}""}}","{{""currencyValueDecimal"": ""{volume}""}}"\n'


def write(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(HEAD + "".join(rows))


# --- exact sums ------------------------------------------------------------------------------------


def doubles(rng, n):
    kinds = (lambda: rng.uniform(0, 1e15), lambda: rng.uniform(-1, 1), lambda: rng.choice([1e15, 1e-300, 5e-324, -1e300, 2.0**31, 2.0**32, 0.0]),
             lambda: math.ldexp(rng.uniform(0.5, 1), rng.randint(-1073, 1000)) * rng.choice([1, -1]),
             lambda: math.nextafter(2.0 ** (32 * rng.randint(-33, 31)), rng.choice([0.0, math.inf])))
    return [rng.choice(kinds)() for _ in range(n)]


def nearest(values):
    total = sum(map(Fraction, values), Fraction(0))
    return total.numerator / total.denominator


@pytest.mark.parametrize("parts", [1, 7])
def test_exact_sums_are_the_rounded_sums(spark, parts):
    rng = random.Random(parts)
    groups = {f"p{k}": doubles(rng, n) for k, n in enumerate((1, 2, 50, 400, 3))}
    groups["cancel"] = [1e300, 1.0, -1e300, 1e-300]
    groups["tie"] = [2.0**53, 1.0, 2.0**-60]
    groups["cents"] = [0.1] * 1000
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "project_id string, usd double").repartition(parts).withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    got = {r.ProjectId: r for r in exact.exact_totals(exact.exact_partials(df)).collect()}
    for name, values in groups.items():
        assert got[name].TotalVolumeUsd == nearest(values), name
        assert got[name].NumberOfTransactions == len(values)


def test_exact_sums_of_partials_in_any_split(spark):
    rng = random.Random(3)
    values = doubles(rng, 300)
    df = spark.createDataFrame([("p", v, k) for k, v in enumerate(values)], "project_id string, usd double, k int").withColumn(
        "ts", F.lit("2024-01-01").cast("timestamp"))
    for n in (2, 9):
        partials = None
        for k in range(n):
            part = exact.exact_partials(df.where(F.col("k") % n == k))
            partials = part if partials is None else partials.unionByName(part)
        assert exact.exact_totals(partials).first().TotalVolumeUsd == nearest(values)


def test_exact_sums_with_special_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("i", inf), ("i", 1.0), ("m", -inf), ("b", inf), ("b", -inf), ("n", nan), ("n", 2.0), ("o", 1.7e308), ("o", 1.7e308)]
    df = spark.createDataFrame(rows, "project_id string, usd double").withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    got = {r.ProjectId: r.TotalVolumeUsd for r in exact.exact_totals(exact.exact_partials(df)).collect()}
    assert got["i"] == inf and got["m"] == -inf and math.isnan(got["b"]) and math.isnan(got["n"]) and got["o"] == inf


def test_exact_daily_volume_is_the_same_for_any_lookup_size(spark):
    rng = random.Random(5)
    rows = [tx(project=f"P{i % 3}", symbol=rng.choice(["USD", "EUR"]), volume=repr(rng.uniform(0, 1e6))) for i in range(500)]
    raw, lookup = raw_df(spark, rows), inline_prices(spark, {"USD": 0.1, "EUR": 1.3})
    seen = {frozenset(map(tuple, exact.exact_daily_volume(clean(raw.repartition(n)), lookup, b).collect())) for n in (1, 5) for b in (True, False)}
    assert len(seen) == 1


def test_one_shuffle_with_a_broadcast_lookup(spark):
    """Rows are priced where they are read; partials of (day, project) are the only rows that move."""
    raw = raw_df(spark, [tx()])
    plan = daily_volume(clean(raw), inline_prices(spark, PRICES), broadcast=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
    plan = daily_volume(clean(raw), inline_prices(spark, PRICES), broadcast=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Join") < plan.index("partial_count(1)")      # the lookup meets partials, not rows


# --- table by run id -------------------------------------------------------------------------------


def agg(spark, *rows):
    return spark.createDataFrame(list(rows), "Date string, ProjectId string, NumberOfTransactions bigint, TotalVolumeUsd double")


def runs(spark, base):
    return sorted((str(r.Date), r.ProjectId, r.NumberOfTransactions, r.run_id) for r in read_runs(spark, base).collect())


def test_a_rerun_replaces_its_own_rows(spark, workdir):
    base = os.path.join(workdir, "table")
    assert runs(spark, base) == []
    write_run(agg(spark, ("2024-01-01", "p", 1, 1.0), ("2024-01-02", "p", 2, 2.0)), base, "A")
    write_run(agg(spark, ("2024-01-02", "p", 5, 5.0), ("2024-01-03", "q", 6, 6.0)), base, "B")
    both = [("2024-01-01", "p", 1, "A"), ("2024-01-02", "p", 2, "A"), ("2024-01-02", "p", 5, "B"), ("2024-01-03", "q", 6, "B")]
    assert runs(spark, base) == both
    write_run(agg(spark, ("2024-01-01", "p", 1, 1.0), ("2024-01-02", "p", 2, 2.0)), base, "A")
    assert runs(spark, base) == both
    # Now A has a row on another Date and none on the others: its old rows go, B's stay.
    write_run(agg(spark, ("2024-01-03", "q", 9, 9.0)), base, "A")
    assert runs(spark, base) == [("2024-01-02", "p", 5, "B"), ("2024-01-03", "q", 6, "B"), ("2024-01-03", "q", 9, "A")]
    write_run(agg(spark), base, "B")
    assert runs(spark, base) == [("2024-01-03", "q", 9, "A")]
    assert run_log(spark, base).count() == 5 and unread_versions(spark, base).count() == 3


def test_a_failed_write_changes_nothing(spark, workdir):
    base = os.path.join(workdir, "table")
    write_run(agg(spark, ("2024-01-01", "p", 1, 1.0)), base, "A")
    bad = agg(spark, ("2024-01-01", "p", 7, 7.0), ("2024-01-02", None, 1, 1.0))
    with pytest.raises((PySparkException, Py4JJavaError), match="must not be NULL"):
        write_run(bad, base, "A")
    # A version that was written whole, but not noted.
    agg(spark).sparkSession.createDataFrame([("x", 1, 1.0, "A")], "ProjectId string, NumberOfTransactions bigint, TotalVolumeUsd double, run_id string") \
        .withColumn("Date", F.lit("2024-01-01").cast("date")).write.partitionBy("Date").parquet(f"{base}/data/version=lost")
    assert runs(spark, base) == [("2024-01-01", "p", 1, "A")]


# --- running reduce --------------------------------------------------------------------------------


def random_rows(seed, n):
    rng = random.Random(seed)
    return [csv_row(ts=rng.choice(["2023-10-01 10:00:00", "2023-10-02 10:00:00", "x"]), project=rng.choice("PQ"),
                    symbol=rng.choice(["USD", "EUR"]), volume=repr(rng.uniform(0, 10.0 ** rng.randint(-6, 15)))) for _ in range(n)]


def test_running_reduce_equals_one_batch_after_restarts(spark, workdir):
    totals = []
    for files_per_batch, cuts in ((1, (2, 3, 6)), (4, (6,))):
        src, work = os.path.join(workdir, f"src{files_per_batch}"), os.path.join(workdir, f"work{files_per_batch}")
        done = 0
        for cut in cuts:
            for k in range(done, cut):
                write(src, f"f{k}.csv", random_rows(k, 30))
            done = cut
            run = run_running_daily_volume(spark, transaction_stream(spark, src, max_files_per_trigger=files_per_batch),
                                           inline_prices(spark, PRICES), work_dir=work)
        totals.append(sorted(map(tuple, running_daily_volume(spark, run).collect())))
        read, kept = running_counters(spark, run)
        assert read == 180 and running_dead_letters(spark, run).count() == read - kept
    assert totals[0] == totals[1]
    whole = exact.exact_daily_volume(clean(read_transactions(spark, src)), inline_prices(spark, PRICES), True)
    assert totals[0] == sorted(map(tuple, whole.collect()))


# --- row-count batches -----------------------------------------------------------------------------


def test_batches_of_ten_rows_across_files(spark, workdir):
    src, work = os.path.join(workdir, "src"), os.path.join(workdir, "work")
    sizes, k = (3, 0, 12, 1, 9), 0
    for f, n in enumerate(sizes):
        write(src, f"f{f}.csv", [csv_row(event=f'"{k + i}\n"') if (k + i) % 4 == 0 else csv_row(event=str(k + i)) for i in range(n)])
        k += n
        os.utime(os.path.join(src, f"f{f}.csv"), (1_700_000_000 + f, 1_700_000_000 + f))
    seen: dict[int, list] = {}

    def note(batch, batch_id):
        seen[batch_id] = sorted(int(r.event) for r in batch.collect())

    assert RowBatches(spark, src, work, 10).run(note) == 3
    assert [len(seen[b]) for b in range(3)] == [10, 10, 5]
    assert [v for b in range(3) for v in seen[b]] == list(range(25))
    assert RowBatches(spark, src, work, 10).run(note) == 0
    # More rows: they come after the flushed batch; a batch that fails is worked on again, with its rows.
    write(src, "g.csv", [csv_row(event=str(25 + i)) for i in range(13)])

    def fail(batch, batch_id):
        if batch_id == 4:
            raise RuntimeError("stopped")
        note(batch, batch_id)

    with pytest.raises(RuntimeError, match="stopped"):
        RowBatches(spark, src, work, 10).run(fail)
    write(src, "h.csv", [csv_row(event=str(38 + i)) for i in range(4)])
    assert RowBatches(spark, src, work, 10).run(note) == 2
    assert [seen[b] for b in (3, 4, 5)] == [list(range(25, 35)), list(range(35, 38)), list(range(38, 42))]


def test_row_batches_within_splits(spark, workdir):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    src = os.path.join(workdir, "src")
    write(src, "a.csv", [csv_row(event=str(i)) for i in range(60)])
    got = []
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        RowBatches(spark, src, os.path.join(workdir, "w"), 7).run(lambda df, k: got.append(sorted(int(r.event) for r in df.collect())))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == [list(range(a, min(a + 7, 60))) for a in range(0, 60, 7)]


def test_many_batches_in_a_round(spark, workdir):
    """One call of the function for many batches; a round that failed comes again with its rows and ids, alone."""
    src, work = os.path.join(workdir, "src"), os.path.join(workdir, "work")
    k = 0
    for f, n in enumerate((7, 1, 0, 30, 12)):
        write(src, f"f{f}.csv", [csv_row(event=str(k + i)) for i in range(n)])
        k += n
        os.utime(os.path.join(src, f"f{f}.csv"), (1_700_000_000 - f, 1_700_000_000 - f))      # their names, not these, give the order
    calls: list[tuple[int, dict[int, list[int]]]] = []

    def note(batches, first_id):
        rows: dict[int, list[int]] = {}
        for r in batches.collect():
            rows.setdefault(r.batch_id, []).append(int(r.event))
        calls.append((first_id, {b: sorted(v) for b, v in rows.items()}))

    def fail(batches, first_id):
        if first_id == 10:
            raise RuntimeError("stopped")
        note(batches, first_id)

    whole = {b: list(range(4 * b, min(4 * b + 4, 50))) for b in range(13)}
    with pytest.raises(RuntimeError, match="stopped"):
        RowBatches(spark, src, work, 4, by_name=True).run(fail, at_once=10)
    assert calls == [(0, {b: whole[b] for b in range(10)})]
    write(src, "g.csv", [csv_row(event=str(50 + i)) for i in range(9)])
    assert RowBatches(spark, src, work, 4, by_name=True).run(note, at_once=10) == 6
    # The flushed batch of two rows stays as it was noted; the new rows make batches behind it.
    assert calls[1:] == [(10, {b: whole[b] for b in range(10, 13)}), (13, {13: [50, 51, 52, 53], 14: [54, 55, 56, 57], 15: [58]})]
    assert RowBatches(spark, src, work, 4, by_name=True).run(note, at_once=10) == 0


def test_larger_exports_make_no_more_files(spark, workdir):
    """Micro-batches of a fixed number of files do not grow in number with the table."""
    small, large = os.path.join(workdir, "small"), os.path.join(workdir, "large")
    for path, n in ((small, 100), (large, 2_000_000)):
        spark.range(n).withColumnRenamed("id", "event_id").write.parquet(f"{path}/events.parquet")
    assert rows_a_file(spark, small, 2_500) == 2_500
    assert -(-2_000_000 // rows_a_file(spark, large, 2_500)) <= STAGED_FILES


def test_staged_exports_hold_all_rows_in_few_files(spark, workdir, monkeypatch):
    """Both exports that streams read: larger files instead of more of them, and not a row less."""
    from daybook.plans import queries

    monkeypatch.setattr(queries, "STAGED_ROWS", 20)
    monkeypatch.setattr(queries, "STAGED_FILES", 4)
    sf_dir, cores = os.path.join(workdir, "sf"), spark.sparkContext.defaultParallelism
    spark.range(4000).select(F.col("id").alias("event_id"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts"), (F.col("id") % 7).alias("user_id"),
                             F.lit("view").alias("event_type"), F.lit(1.5).alias("value")).coalesce(1).write.parquet(f"{sf_dir}/events.parquet")
    land = queries.stage_events_in_turns(spark, sf_dir)
    for path, turns in ((queries.stage_events_csv(spark, sf_dir), 1), ((land(0), land(1))[1], 2)):
        files = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".csv")]
        assert len(files) <= turns * (4 + cores)
        assert sorted(int(r.ident) for r in spark.read.option("header", True).csv(path).collect()) == list(range(4000))


# --- price versions --------------------------------------------------------------------------------


def test_a_later_run_takes_the_new_list_and_a_replay_keeps_its_own(spark, workdir):
    src, work = os.path.join(workdir, "src"), os.path.join(workdir, "work")
    write(src, "a.csv", [csv_row(volume="1")])
    stream = lambda: transaction_stream(spark, src, max_files_per_trigger=1)
    run = run_daily_volume_stream(spark, stream(), inline_prices(spark, {"USD": 1.0}), work_dir=work)
    assert run.price_version == 0
    write(src, "b.csv", [csv_row(symbol="EUR", volume="1")])
    with pytest.raises(Exception, match="currency symbol not supported: EUR"):
        run_daily_volume_stream(spark, stream(), inline_prices(spark, {"USD": 1.0}), work_dir=work)
    run = run_daily_volume_stream(spark, stream(), inline_prices(spark, {"USD": 5.0, "EUR": 2.0}), work_dir=work)
    assert run.price_version == 1
    assert merged_daily_volume(spark, run).first().TotalVolumeUsd == 3.0        # 1 x 1.0 + 1 x 2.0
    # The same list in another order is no new version.
    run = run_daily_volume_stream(spark, stream(), inline_prices(spark, {"EUR": 2.0, "USD": 5.0}), work_dir=work)
    assert run.price_version == 1
    # Both batches are replayed under another list, each at its own prices; a batch that never ended takes the new one.
    prices = PriceVersions(spark, work)
    assert prices.take(inline_prices(spark, {"USD": 9.0, "EUR": 9.0})) == 2
    fn = daily_volume_batches(prices, run.partials, run.dead_letters)
    for batch_id, name in enumerate(("a.csv", "b.csv")):
        fn(read_transactions(spark, os.path.join(src, name)), batch_id)
    assert merged_daily_volume(spark, run).first().TotalVolumeUsd == 3.0
    fn(read_transactions(spark, os.path.join(src, "a.csv")), 2)
    assert merged_daily_volume(spark, run).first().TotalVolumeUsd == 12.0


def test_a_half_written_price_list_is_not_read(spark, workdir):
    src, work = os.path.join(workdir, "src"), os.path.join(workdir, "work")
    write(src, "a.csv", [csv_row(volume="1")])
    os.makedirs(os.path.join(work, "prices", "crashed", "_temporary"))
    run = run_daily_volume_stream(spark, transaction_stream(spark, src), inline_prices(spark, {"USD": 4.0}), work_dir=work)
    assert merged_daily_volume(spark, run).first().TotalVolumeUsd == 4.0


def scratch(spark):
    base = os.path.join(shared_dir(spark).removeprefix("file:"), "daybook")
    return {d for d in os.listdir(base) if d.startswith(("outcomes", "lookup", "batch"))} if os.path.isdir(base) else set()


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_a_failed_job_or_stream_leaves_no_scratch(spark, workdir, limit):
    from daybook.plans.jobs import daily_volume_job

    src, prices = os.path.join(workdir, "src"), os.path.join(workdir, "p.csv")
    write(src, "a.csv", [csv_row(symbol="XRP")])
    with open(prices, "w") as fh:
        fh.write("ID,Symbol,Name,Price (USD)\nu,usd,Dollar,1\n")
    scratch_path(spark, "any")
    before = scratch(spark)
    with pytest.raises(Exception, match="currency symbol not supported: XRP"):
        daily_volume_job(spark, src, prices, os.path.join(workdir, "o"), os.path.join(workdir, "e"), max_broadcast_bytes=limit)
    with pytest.raises(Exception, match="currency symbol not supported: XRP"):
        run_daily_volume_stream(spark, transaction_stream(spark, src), inline_prices(spark, PRICES), work_dir=os.path.join(workdir, "w"),
                                max_broadcast_bytes=limit)
    assert scratch(spark) == before


def test_unknown_symbols_with_a_large_lookup(spark, workdir):
    """Raw rows never meet the lookup; the outcome is the same as with a broadcast."""
    from daybook.plans.jobs import daily_volume_job, landing
    from daybook.sinks.files import read_aggregates_csv, read_dead_letters_csv

    src, prices = os.path.join(workdir, "src"), os.path.join(workdir, "p.csv")
    write(src, "a.csv", [csv_row(symbol=s, ts=t) for s in ("USD", "XRP", "XRP", "ADA", "EUR") for t in ("2023-10-01 10:00:00", "bad")])
    with open(prices, "w") as fh:
        fh.write("ID,Symbol,Name,Price (USD)\nu,usd,Dollar,1\ne,eur,Euro,2\n")
    seen = []
    for limit in (1 << 20, 0):
        out, err = os.path.join(workdir, f"o{limit}"), os.path.join(workdir, f"e{limit}")
        report = daily_volume_job(spark, src, prices, out, err, on_unknown="dead_letter", max_broadcast_bytes=limit)
        seen.append((report, sorted(map(tuple, read_aggregates_csv(spark, out).collect())), sorted(map(tuple, read_dead_letters_csv(spark, err).collect()))))
        run = run_daily_volume_stream(spark, transaction_stream(spark, src), inline_prices(spark, PRICES), on_unknown="dead_letter",
                                      work_dir=os.path.join(workdir, f"w{limit}"), max_broadcast_bytes=limit)
        assert (run.rows_read, run.clean_rows, stream_dead_letters(spark, run).count()) == (10, 2, 8)
    assert seen[0] == seen[1] and seen[0][0].clean_rows == 2
    raw = raw_df(spark, [tx(symbol="XRP")])
    with landing(spark, raw, inline_prices(spark, PRICES), False, "dead_letter", 1e15, "outcomes") as landed:
        assert [r.kind for r in landed.rows.collect()] == ["unknown"]


def test_counters_leave_other_queries_out(spark, workdir):
    """A second query that runs at the same time, on another source, does not count."""
    src, other = os.path.join(workdir, "src"), os.path.join(workdir, "other")
    for k in range(3):
        write(src, f"a{k}.csv", [csv_row()] * 2)
    write(other, "b.csv", [csv_row()] * 50)
    busy = (transaction_stream(spark, other).writeStream.queryName("busy").foreachBatch(lambda df, k: df.count())
            .option("checkpointLocation", os.path.join(workdir, "c")).start())
    try:
        busy.processAllAvailable()
        run = run_daily_volume_stream(spark, transaction_stream(spark, src, max_files_per_trigger=1), inline_prices(spark, PRICES),
                                      work_dir=os.path.join(workdir, "w"), on_batch=lambda df, k: df.count())
    finally:
        busy.stop()
    assert (run.batches, run.rows_read) == (3, 6)


# --- price pages -----------------------------------------------------------------------------------


def pages(folder, *texts):
    os.makedirs(folder, exist_ok=True)
    for k, text in enumerate(texts):
        with open(os.path.join(folder, f"p{k}.json"), "w") as fh:
            fh.write(text)
    return folder


def coin(k):
    return f'{{"id": "c{k}", "symbol": "s{k}", "name": "N {k}", "current_price": {k}.5, "more": [1, {{}}]}}'


def test_pages_after_the_first_short_one_do_not_count(spark, workdir):
    def page(*ks):
        return "[" + ", ".join(map(coin, ks)) + "]\n"

    folder = pages(os.path.join(workdir, "p"), page(1, 2) + page(3, 4), page(5) + page(6, 7), page(8, 9))
    ids = lambda **kw: sorted(r.ID for r in read_price_pages(spark, folder, **kw).collect())
    assert ids(page_size=2) == ["c1", "c2", "c3", "c4", "c5"]
    assert ids(page_size=None) == [f"c{k}" for k in range(1, 10)] and ids(page_size=1) == ids(page_size=None)
    assert ids() == ["c1", "c2"]
    folder = pages(os.path.join(workdir, "q"), page(1, 2), "[]", page(3, 4))
    assert sorted(r.ID for r in read_price_pages(spark, folder, page_size=2, multi_line=True).collect()) == ["c1", "c2"]


@pytest.mark.parametrize("text,fault", [
    ('[{"id": 5, "symbol": "a"}]', "another type"), ('[{"id": "a", "current_price": "1"}]', "another type"), ('["a"]', "another type"),
    ('{"id": "a"}', "not a JSON array"), ('[{"id": "a"}] x', "not a JSON array"), ("[{]", "not a JSON array"), ("[true]", "another type")])
def test_pages_of_another_shape_fail(spark, workdir, text, fault):
    folder = pages(os.path.join(workdir, "p"), text)
    for consume in (lambda df: df.count(), lambda df: df.select("Name").collect()):
        with pytest.raises((PySparkException, Py4JJavaError), match=fault):
            consume(read_price_pages(spark, folder))


def test_nulls_in_pages(spark, workdir):
    folder = pages(os.path.join(workdir, "p"), '[null, {"id": null, "current_price": null}, {"current_price": 1e3}, {"id": "\\u0041]"}]')
    assert [tuple(r) for r in read_price_pages(spark, folder).collect()] == [("", "", "", 0.0), ("", "", "", 0.0), ("", "", "", 1000.0), ("A]", "", "", 0.0)]
