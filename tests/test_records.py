"""CSV records put together from splits: against a reader that goes through the file from its start."""

from __future__ import annotations

import os
import random

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from daybook.sources import records as R
from daybook.sources.files import read_transactions

HEAD = "ts,project_id,event,props,nums"


def strict(text: str) -> bool:
    """The quoting rule, character by character."""
    state = "start"
    for c in text:
        if state == "start":
            state = {'"': "quoted", ",": "start"}.get(c, "plain")
        elif state == "plain":
            if c == '"':
                return False
            state = "start" if c == "," else "plain"
        elif state == "quoted":
            state = "closed" if c == '"' else "quoted"
        elif c == '"':
            state = "quoted"
        elif c == ",":
            state = "start"
        else:
            return False
    return state != "quoted"


def open_end(text: str) -> bool:
    """The text follows the rule as far as it goes and ends inside a quoted field."""
    return not strict(text) and strict(text + '"')


def sequential(text: str) -> list[str]:
    """Records of a file read from its start."""
    out, held = [], []
    for line in text.split("\n"):
        line = line.removesuffix("\r")
        held.append(line)
        if open_end("\n".join(held)):
            continue
        out.append("\n".join(held))
        held = []
    if held:
        out.append("\n".join(held))
    return [r for r in out if r.strip()]


def field(rng: random.Random) -> str:
    kind = rng.random()
    word = "".join(rng.choices("ab é,", k=rng.randint(0, 6)))
    if kind < 0.35:
        return word.replace(",", "")
    inner = word + rng.choice(["", "\n", "\r\n", '""', '"",""', '\n"",""x""\n\n', ",\n,", '""\n']) + word
    if kind < 0.94:
        return f'"{inner}"'
    return rng.choice(['x"y', '"a"b', '"open', 'a"', '""x', '"\n"z'])


def random_file(rng: random.Random, rows: int) -> str:
    lines = [",".join(field(rng) for _ in range(rng.choice([5, 5, 5, 4, 6]))) for _ in range(rows)]
    return HEAD + "\n" + "\n".join(lines) + rng.choice(["", "\n", "\n\n"])


@pytest.fixture()
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def write(folder: str, name: str, text: str) -> str:
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as fh:
        fh.write(text)
    return path


@pytest.mark.parametrize("limit", [R.MAX_BROADCAST_BYTES, 0])
def test_records_of_splits_are_those_of_the_whole_file(spark, workdir, small_splits, limit):
    rng = random.Random(8)
    texts = [random_file(rng, n) for n in (40, 25, 1, 60)] + [HEAD + "\n", HEAD]
    for k, text in enumerate(texts):
        write(workdir, f"f{k}.csv", text)
    lines = R.text_lines(spark, workdir)
    assert lines.rdd.getNumPartitions() > 20      # several tasks a file
    got = R.assembled_records(lines, HEAD, limit).collect()
    for k, text in enumerate(texts):
        mine = sorted((r.block, r.n, r.record) for r in got if r.file.endswith(f"f{k}.csv"))
        assert [r[2] for r in mine] == sequential(text)[1:], k


def test_records_across_arrow_batches(spark, workdir):
    rng = random.Random(9)
    text = random_file(rng, 300)
    write(workdir, "f.csv", text)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for rows in ("1", "3", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
            got = R.assembled_records(R.text_lines(spark, workdir), HEAD).collect()
            assert [r.record for r in sorted(got, key=lambda r: (r.block, r.n))] == sequential(text)[1:]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_states_of_lines():
    rng = random.Random(10)
    for _ in range(3000):
        line = "".join(rng.choices('",ab', k=rng.randint(0, 9)))
        quotes = line.count('"')
        _, end = R.continued(pa.array([line]), 0)
        assert end == int(open_end(line)), line
        _, end = R.continued(pa.array([line]), 1)
        assert end == int(open_end('"' + line)), line
        if quotes % 2:
            assert R.opens(line) == open_end(line)


def test_strict_rule_in_sql(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choices('",a\n', k=rng.randint(0, 10))) for _ in range(3000)] + ['"' + '""' * 200_000 + '"', '"' + '""' * 200_000]
    rows = spark.createDataFrame([(t,) for t in texts], "record string").select("record", R.strict_record("record").alias("ok")).collect()
    assert all(r.ok == strict(r.record) for r in rows)


@pytest.mark.parametrize("row", ['x"y,1,2,3,4', '"a"b,1,2,3,4', '1,2,3,4,"x'])
def test_misplaced_quotes_are_malformed(spark, workdir, row):
    path = write(workdir, "tx.csv", f"{HEAD}\na,b,c,d,e\n{row}\nf,g,h,i,j\n\"f\",g,h,i,j\n")
    for multi_line in (None, False, True):
        with pytest.raises((PySparkException, Py4JJavaError), match="malformed CSV row"):
            read_transactions(spark, path, multi_line=multi_line).count()
        rows, bad = read_transactions(spark, path, on_malformed="dead_letter", multi_line=multi_line)
        reasons = [r.Reason for r in bad.collect()]
        assert len(reasons) == 1 and reasons[0].startswith(f"malformed CSV row: {row}")
        # A stray quote that opens a field takes the lines up to the next quote with it, no more.
        assert rows.count() == (3 if multi_line is False or row[-1] != "x" else 1)


def test_header_of_another_file_fails(spark, workdir):
    write(workdir, "a.csv", f'{HEAD}\n"a\nb",b,c,d,e\n')
    write(workdir, "b.csv", "nums,props,event,project_id,ts\na,b,c,d,e\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="header"):
        read_transactions(spark, workdir).collect()


def test_rows_come_from_several_tasks(spark, workdir, small_splits):
    rows = "".join(f'2024-01-01 00:00:00,"P\n{i}",e,p,n\n' for i in range(200))
    path = write(workdir, "one.csv", f"{HEAD}\n{rows}")
    df = read_transactions(spark, path)
    assert sorted(r.project_id for r in df.collect()) == sorted(f"P\n{i}" for i in range(200))
    assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 10
