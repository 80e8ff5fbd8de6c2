"""CSV files read in splits, against Spark's reader of one task per file."""

import csv
import random

import pytest

from gridloom.sources import files
from gridloom.sources.records import after_line

VALUES = ["", "a", "two words", "x,y", 'say "hi"', "line\nbreak", "a\r\nb", '"', '""', "\n", "é🙂", "tail\\", ' "q', "1", "long " * 30]


def whole(spark, path, escape):
    return spark.read.options(header="true", multiLine="true", escape=escape).csv(path)


def bag(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def small_splits(spark):
    for setting in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.set(setting, "64")
    yield
    for setting in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(setting)


@pytest.mark.parametrize(("seed", "quoting", "ends"), [(1, csv.QUOTE_MINIMAL, "\n"), (2, csv.QUOTE_ALL, "\n"), (3, csv.QUOTE_MINIMAL, "\r\n")])
def test_splits_cut_the_same_records(spark, tmp_path, small_splits, seed, quoting, ends):
    r = random.Random(seed)
    values = [v for v in VALUES if not v.startswith(" ")] if ends == "\n" else ["a", "x,y", 'say "hi"', "line\nbreak", "b"]
    for name in ("one", "two"):
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, quoting=quoting, lineterminator=ends)
            out.writerow(["id", "a col", "b.c"])
            for i in range(60):
                out.writerow([f"{name}{i}", r.choice(values), r.choice(values)])
    found = files.csv_scan(spark, str(tmp_path), escape='"')
    text = spark.read.text(str(tmp_path))
    assert text.rdd.getNumPartitions() > 20
    assert found.columns == ["id", "a col", "b.c"]
    assert found.count() == 120
    assert bag(found) == bag(whole(spark, str(tmp_path), '"'))


def test_records_over_many_splits_and_escapes(spark, tmp_path, small_splits):
    lines = ["head,\"with\nbreak\"", "1," + '"' + "\n".join(f"row {i}" for i in range(90)) + '"', "", "2,plain", "3,\"a \\\" b\n\\\\\"", "4,5\" pipe", "5,\"open\nuntil the end"]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    found = files.csv_scan(spark, str(tmp_path))
    assert found.columns == ["head", "with\nbreak"]
    assert bag(found) == bag(whole(spark, str(tmp_path), "\\"))


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("k,v\n" + "".join(f'{i},"x\n{i}"\n' for i in range(200)))
    found = files.csv_scan(spark, str(tmp_path), escape='"')
    assert found.rdd.getNumPartitions() > 20
    assert sorted(int(r.k) for r in found.collect()) == list(range(200))


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert files.csv_scan(spark, str(tmp_path)).count() == 0
    (tmp_path / "b.csv").write_text("k,v\n")
    assert files.csv_scan(spark, str(tmp_path / "b.csv")).count() == 0


def test_lines():
    assert [after_line(t, False, escape='"') for t in ("a,b", '"a', '"a","b', '"a ""b"', '5" x,"', 'a,"b"c', ',,"')] == [False, True, True, False, True, False, True]
    assert [after_line(t, True, escape='"') for t in ("a,b", 'a"', 'a","b', 'a""', '",x', '","y"')] == [True, False, True, True, False, False]
