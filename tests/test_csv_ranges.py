"""CSV files read by byte ranges against Spark's own multi-line reader."""

import random

import pytest

from modsieve.sources import csv_ranges, tables
from modsieve.spec import TableSpec


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1k"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def field(rng):
    pieces = ["a", "b ", "é", "日", "x,", "\n", "\r\n", '""', ' "" ', "z" * rng.randrange(30)]
    text = "".join(rng.choices(pieces, k=rng.randrange(12)))
    plain = text if rng.randrange(5) else '""'
    return f'"{text}"' if any(c in text for c in ',\n"\r') else plain


def write(path, rng, end, rows=600):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write('id,"a ""b"", c",d.e' + end)
        for i in range(rows):
            f.write(f"{i},{field(rng)},{field(rng)}{end}" + (end if i % 50 == 0 else ""))
        f.write(f'{rows},"{"long " * 3000}\n{end}","last')
        f.write('"')  # no line break at the end


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_as_one_task(spark, tmp_path, small_ranges, end):
    for name in ("x", "y"):
        write(tmp_path / f"{name}.csv", random.Random(name), end)
    path = str(tmp_path)
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    lines = csv_ranges._lines(spark, path)
    assert lines.rdd.getNumPartitions() > 10
    assert csv_ranges._ranges(lines).where("inside = 1").count() > 5
    got = csv_ranges.read_ranges(spark, path, whole.columns, "file")
    assert got.columns == [*whole.columns, "file"]
    assert sorted(map(str, got.drop("file").collect())) == sorted(map(str, whole.collect()))
    assert {r.file for r in got.select("file").distinct().collect()} == {"x.csv", "y.csv"}
    narrow = got.select("id")  # the parser may leave columns out
    assert narrow.count() == whole.count() and narrow.distinct().count() == 601


@pytest.mark.parametrize("text, message", [('a,b\n1,"open\n2,x\n', "not closed"), ('a,b\n1,5" x 3"\n', "unquoted field")])
def test_broken_quotes_are_an_error(spark, tmp_path, text, message):
    path = tmp_path / "x.csv"
    path.write_text(text)
    with pytest.raises(Exception, match=message):
        csv_ranges.read_ranges(spark, str(path), ["a", "b"]).collect()
    plain = tables.read_csv(spark, str(path), ranges=False)
    assert plain.count() == 1


def test_short_long_and_empty_rows(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b,c\n1\n\n2,"",\n3,4,5,6\n,,\n')
    want = tables.read_csv(spark, str(path), ranges=False).collect()
    assert sorted(map(str, tables.read_csv(spark, str(path)).collect())) == sorted(map(str, want))
    empty = tmp_path / "e.csv"
    empty.write_text("a,b\n")
    assert tables.read_csv(spark, str(empty)).collect() == []


def test_typed_columns_and_file(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('n,t\n1,"x\ny"\n2,\n')
    spec = TableSpec(columns={"t": "str", "n": "int64"}, features=("t",))
    read = tables.read_sources(spark, {"x": str(path)}, {"x": spec}, with_file=True)["x"]
    assert read.dtypes == [("n", "bigint"), ("t", "string"), ("file", "string")]
    assert sorted(map(tuple, read.collect())) == [(1, "x\ny", "x.csv"), (2, None, "x.csv")]


def test_small_ranges_share_tasks(spark, tmp_path, small_ranges):
    write(tmp_path / "x.csv", random.Random(1), "\n", 4000)
    most = 2 * spark.sparkContext.defaultParallelism
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 2 * most
    lines = csv_ranges._lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() <= most
    assert lines.select("range").distinct().count() > 2 * most  # the ranges stay as they are
    whole = tables.read_csv(spark, str(tmp_path), ranges=False)
    assert sorted(map(str, tables.read_csv(spark, str(tmp_path)).collect())) == sorted(map(str, whole.collect()))
