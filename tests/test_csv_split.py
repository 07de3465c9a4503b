"""A large quoted CSV file read by many tasks equals the ``multiLine`` read."""

import csv
import random

import pytest

from trilake.sources.csv_split import read_csv_split, split_parities, split_records, _lines
from trilake.sources.raw_csv import CSV_OPTIONS, land_raw, read_raw_by_header

VALUES = ["", "plain", 'say "hi"', "two\nlines", '"', '""', "\n", "\n\n\n", ",", "a,b\n\"c\"\n", "é ü\nß", "x" * 300, "y\n" * 60, " ", "tab\t", "end\r\nof"]


@pytest.fixture()
def tiny_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in names}
    yield lambda n: [spark.conf.set(k, str(n)) for k in names]
    for k, v in old.items():
        spark.conf.set(k, v)


def _file(path, rows, columns, **how):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, **{"lineterminator": "\n"} | how)
        w.writerow(columns)
        w.writerows(rows)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("size", [40, 200, 5000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equal_to_the_multi_line_read(spark, tmp_dir, tiny_splits, size, end):
    rng = random.Random(size)
    values = [v for v in VALUES if "\r" not in v] if end == "\n" else [v.replace("\r\n", "\n") for v in VALUES if "\n" not in v.replace("\r\n", "")]
    for i in range(3):
        _file(f"{tmp_dir}/{i}.csv", [[j, rng.choice(values), rng.choice(values)] for j in range(80)], ["id", "a b", 'c,"d"'], lineterminator=end)
    want = _rows(spark.read.options(**CSV_OPTIONS).csv(tmp_dir))
    tiny_splits(size)
    got = read_csv_split(spark, tmp_dir, ["id", "a b", 'c,"d"'], CSV_OPTIONS)
    assert got.columns == ["id", "a b", 'c,"d"'] and _rows(got) == want and len(want) == 240


def test_many_tasks_read_one_file(spark, tmp_dir, tiny_splits):
    rng = random.Random(1)
    _file(f"{tmp_dir}/big.csv", [[i, rng.choice(VALUES[:11])] for i in range(20_000)], ["id", "t"])
    want = spark.read.options(**CSV_OPTIONS).csv(tmp_dir)
    want = (want.count(), _rows(want.selectExpr("bit_xor(xxhash64(id, t))")))
    tiny_splits(16_384)
    got = read_csv_split(spark, tmp_dir, ["id", "t"], CSV_OPTIONS)
    assert (got.count(), _rows(got.selectExpr("bit_xor(xxhash64(id, t))"))) == want
    parities = split_parities(_lines(spark, tmp_dir)).collect()
    assert len(parities) > 8 and len({r.odd for r in parities}) == 2  # splits begin inside and outside of fields


def test_more_splits_than_are_broadcast(spark, tmp_dir, tiny_splits):
    rng = random.Random(2)
    _file(f"{tmp_dir}/a.csv", [[i, rng.choice(VALUES[:11])] for i in range(500)], ["id", "t"])
    tiny_splits(300)
    records = lambda n: _rows(split_records(spark, tmp_dir, ["id", "t"], max_splits=n).select("text"))
    assert records(1 << 20) == records(0) and len(records(0)) == 500


def test_headers_and_odd_files(spark, tmp_dir, tiny_splits):
    with open(f"{tmp_dir}/a.csv", "w", newline="") as f:
        f.write('\n\nid,"t"\n1,x\n\n\n2,"y\nz"')  # blank lines, no line break at the end
    assert _rows(read_csv_split(spark, tmp_dir, ["id", "t"], CSV_OPTIONS)) == [("1", "x"), ("2", "y\nz")]
    tiny_splits(4)
    assert _rows(read_csv_split(spark, tmp_dir, ["id", "t"], CSV_OPTIONS)) == [("1", "x"), ("2", "y\nz")]
    with open(f"{tmp_dir}/b.csv", "w") as f:
        f.write("")
    with open(f"{tmp_dir}/c.csv", "w") as f:
        f.write("id,t\n")
    assert read_csv_split(spark, tmp_dir, ["id", "t"], CSV_OPTIONS).count() == 2
    with open(f"{tmp_dir}/d.csv", "w") as f:
        f.write("t,id\nq,3\n")
    tiny_splits(1000)
    with pytest.raises(Exception, match="does not conform"):
        read_csv_split(spark, tmp_dir, ["id", "t"], CSV_OPTIONS).collect()


def test_raw_runs_with_large_files_are_split(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    land_raw(spark.createDataFrame([(str(i), "a\nb" * (i % 3)) for i in range(50)], "id string, t string").coalesce(1), raw, "t", run_ts="1")
    land_raw(spark.createDataFrame([("x\ny", "99", "e")], "t string, id string, extra string"), raw, "t", run_ts="2")
    whole, split = read_raw_by_header(spark, f"{raw}/t"), read_raw_by_header(spark, f"{raw}/t", split_large=0)
    assert sorted(whole.columns) == sorted(split.columns) and _rows(split.select(whole.columns)) == _rows(whole)
    assert {r.run_ts for r in split.collect()} == {1, 2}
    large = read_raw_by_header(spark, f"{raw}/t", split_large=200)  # one of the two only
    assert _rows(large.select(whole.columns)) == _rows(whole)
