"""Files, payloads, workbooks, archives, pages."""

import io
import os
import random
import zipfile

import models
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom import sinks
from gridloom.functions import text
from gridloom.operators import delimited, html_tables as ht, links
from gridloom.plans import flat_files
from gridloom.queries.decoders import _encode_workbook
from gridloom.sources import archive, files, html, payload, workbook


def test_line_numbers_over_splits(spark, tmp_path):
    """A file read in many splits is numbered as a whole."""
    for k in range(3):
        (tmp_path / f"f{k}.txt").write_text("".join(f"{k} {i}\n" for i in range(500 * (k + 1))))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        lines = files.text_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 10
        assert lines.count() == 3000
        assert lines.filter(F.col("line_no") != F.split("value", " ")[1].cast("long")).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_blank_lines_keep_their_number(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\n\n  \ny\n")
    got = lambda blank: [r["line_no"] for r in files.text_lines(spark, str(tmp_path), blank).orderBy("line_no").collect()]
    assert (got("empty"), got("space"), got("keep")) == ([0, 2, 3], [0, 3], [0, 1, 2, 3])


def test_inventory(spark, tmp_path):
    for name in ("a.xls", "sub/b.xlsx", "sub/c.TXT", "d.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    names = lambda suffixes: sorted(r[0] for r in files.file_inventory(spark, str(tmp_path), suffixes).select(text.base_name(F.col("path"))).collect())
    assert names(files.WORKBOOK_SUFFIXES) == ["a.xls", "b.xlsx"]
    assert names(files.TEXT_SUFFIXES) == ["c.TXT", "d.txt"]
    assert names([]) == ["a.xls", "b.xlsx", "c.TXT", "d.txt"]


def test_workbook(spark, tmp_path):
    pdf = pd.DataFrame(
        [("w", "S 1", 0, ["a", None, "3"]), ("w", "S 1", 2, [None, "b & <c>", None]), ("w", "T", 0, ["x", None, None])],
        columns=["file", "sheet", "at", "vals"],
    )
    (tmp_path / "my book.xlsx").write_bytes(_encode_workbook(pdf)["content"][0])
    (tmp_path / "broken.xlsx").write_bytes(b"no zip")
    rows = workbook.workbook_rows(spark, str(tmp_path))
    got = [(r["sheet"], r["row_idx"], r["vals"]) for r in rows.filter("error is null").orderBy("sheet", "row_idx").collect()]
    assert got == [
        ("S 1", 0, ["a", None, "3"]),
        ("S 1", 1, [None, None, None]),
        ("S 1", 2, [None, "b & <c>", None]),
        ("T", 0, ["x"]),
    ]
    paths = {r["table_path"].split("/", 3)[-1].rsplit("/", 2)[-2:][0] for r in workbook.sheet_path(rows.filter("error is null")).collect()}
    assert paths == {"my_book"}
    assert rows.filter("error is not null").select("source").collect()[0][0].endswith("broken.xlsx")


def test_archive(spark, tmp_path):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name in ("top.txt", "a/one.txt", "a/b/two.txt", "pack/own.txt"):
            z.writestr(name, name)
    (tmp_path / "pack.ZIP").write_bytes(out.getvalue())
    (tmp_path / "bad.zip").write_bytes(b"x")
    got = archive.archive_expand(spark, str(tmp_path))
    paths = sorted(r["path"].split("/pack/", 1)[1] for r in got.filter("error is null").collect())
    assert paths == ["a/one.txt", "b/two.txt", "own.txt", "top.txt"]
    assert got.filter("error is not null").count() == 1


def test_payloads(spark):
    df = spark.createDataFrame(
        [("a", '{"BEAAPI":{"Data":[{"x":"1"}]}}'), ("b", '{"BEAAPI":{"Results":{"Data":[{"y":2},{"x":"3"}]}}}'), ("c", "no json")],
        "source string, payload string",
    )
    got = payload.json_envelope(df).orderBy("source", "record_idx")
    assert got.columns == ["source", "record_idx", "x", "y"]
    assert [tuple(r) for r in got.collect()] == [("a", 0, "1", None), ("b", 0, None, "2"), ("b", 1, "3", None)]
    tables = flat_files.combined_payloads(df, ["a", "b"])
    assert tables["a"].columns == ["source", "record_idx", "x"] and tables["b"].count() == 2


PAGE = """<html><body><h1>Counts</h1><div class="view-header">by day</div>
<table><caption>Table 1.1A – Use</caption><thead><tr><th rowspan=2>Kind</th><th colspan=2>Year</th></tr><tr><th>a</th><th>b</th></tr></thead>
<tbody><tr><th class="sub0">All</th><td>9</td><td></td></tr><tr><th class="sub2">x</th><td>1</td><td>2</td></tr>
<tr><th class="sub2">y</th><td rowspan=2>3</td><td>4</td></tr><tr><th class="sub0">z</th><td>6</td></tr></tbody>
<tfoot><tr><td>Source: us</td></tr></tfoot></table><div class="view-footer">end</div></body></html>"""


def test_page_tables(spark):
    from gridloom.plans.pages import page_tables

    found = page_tables(spark.createDataFrame([("https://x/1", PAGE)], "url string, html string"))
    table = found.table("https://x/1", "0")
    assert table.columns == ["row_idx", "Kind", "Year_a", "Year_b", "Header", "Footer"]
    got = [tuple(r)[1:4] for r in table.orderBy("row_idx").collect()]
    # Labels stand under the one they are indented below; the span leaves an empty cell.
    assert got == [("All", "9", None), ("All x", "1", "2"), ("All y", "3", "4"), ("z", None, "6")]
    notes = table.select("Header", "Footer").first()
    assert tuple(notes) == ("Table 1.1A – Use", "Source: us")


def test_simple_table(spark):
    page = '<h1> A </h1><div class="view-footer"> f </div><table><tr><td>1</td><th>n</th></tr><tr><td>2</td><td>3</td></tr></table>'
    pages = spark.createDataFrame([("u", page)], "url string, html string")
    rows = html.simple_table_rows(html.html_table_cells(pages)).orderBy("row_idx").collect()
    assert [r["vals"] for r in rows] == [["n", "1"], ["2", "3"]]
    assert tuple(html.page_notes(pages).first()) == ("u", "A", "f")


@pytest.mark.parametrize("seed", [1, 2])
def test_span_model(spark, seed):
    rng = random.Random(seed)
    tables = {
        t: [[(f"{i}.{j}", rng.choice([1, 1, 1, 2, 3])) for j in range(rng.randrange(1, 5))] for i in range(rng.randrange(1, 8))]
        for t in range(30)
    }
    cells = [
        ("u", t, "tbody", i, j, "td", text_, span, 1, "")
        for t, rows in tables.items()
        for i, row in enumerate(rows)
        for j, (text_, span) in enumerate(row)
    ]
    df = spark.createDataFrame(cells, "url string, " + html.CELL_SCHEMA)
    got = {}
    for r in sorted(ht.span_expand(df).collect(), key=lambda r: (r["table_idx"], r["row_idx"])):
        got.setdefault(r["table_idx"], []).append(r["vals"])
    for t, rows in tables.items():
        assert got[t] == models.spans(rows)


def test_span_sample(spark):
    cells = [("u", 0, "tbody", 0, 0, "td", "x", 2, 1, ""), ("u", 0, "tbody", 0, 1, "td", "y", 1, 1, ""), ("u", 0, "tbody", 1, 0, "td", "z", 1, 1, "")]
    got = ht.span_expand(spark.createDataFrame(cells, "url string, " + html.CELL_SCHEMA)).orderBy("row_idx")
    assert [r["vals"] for r in got.collect()] == [["x", "y"], ["", "z"]]


def _lines(spark, sheets):
    data = [("f", s, i, line) for s, lines in sheets.items() for i, line in enumerate(lines)]
    return spark.createDataFrame(data, "source string, sheet string, row_idx long, value string")


def test_sniffing(spark):
    sheets = {
        "ruler": ["code  name", "----", "1  x"],
        "trim": ["a\tb", "1\t2\t", "3\t4\t"],
        "unnamed": ["a\tb", "1\t\t2", "3\tx\t4"],
        "only": ["a\tb"],
        "plain": ["a\tb", "1\t2"],
        "bad": ["a", "1\t2\t3", "4\t5"],
    }
    sniffed = delimited.sniff_table(delimited.delimited_layout(_lines(spark, sheets)))
    got = {}
    for r in sorted(sniffed.collect(), key=lambda r: (r["sheet"], r["row_idx"])):
        assert r["mode"] == r["sheet"].replace("only", "header_only")
        if r["position"] > r["header_end"]:
            got.setdefault(r["sheet"], (r["header"], []))[1].append(r["vals"])
    assert got["ruler"] == (["code", "name"], [["1", "x"]])
    assert got["trim"] == (["a", "b"], [["1", "2"], ["3", "4"]])
    assert got["unnamed"] == (["a", "b"], [["1", "2"], ["3", "4"]])
    assert got["plain"] == (["a", "b"], [["1", "2"]])


def test_retry(spark):
    sheets = {
        "fit": ["a\tb", "1\t2", "\t3\t4"],
        "trim": ["a\tb", "1\t2\t", "3\t4\t"],
        "pad": ["a", "1\t2", "3\t4"],
    }
    out = delimited.retry_parse(delimited.tab_fields(_lines(spark, sheets)))
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r["sheet"], r["row_idx"])):
        got.setdefault((r["sheet"], r["route"], tuple(r["names"])), []).append(r["vals"])
    assert got == {
        ("fit", "fit", ("a", "b")): [["1", "2"], ["3", "4"]],
        ("trim", "trim", ("a", "b")): [["1", "2"], ["3", "4"]],
        ("pad", "pad", ("col_1", "col_2")): [["a", " "], ["1", "2"], ["3", "4"]],
    }


def test_chunks(spark):
    lines = _lines(spark, {"m": ["\t".join(["n1", "", "n2", "n3", "n4", "n5", "1", "2", "3", "4", "5", "left"]), "other"]})
    got = delimited.chunk_reshape(delimited.tab_fields(lines)).orderBy("row_idx", "col_idx").collect()
    assert [r["value"] for r in got] == ["n1", "n2", "n3", "n4", "n5", "1", "2", "3", "4", "5"]
    assert [r["name"] for r in got[5:]] == ["n1", "n2", "n3", "n4", "n5"]


def test_text_tables(spark, tmp_path):
    (tmp_path / "good.data").write_text("id\tvalue\n1\t2\n\n3\t4\n")
    (tmp_path / "numbers.data").write_text("id\t2010\n1\t2\n")
    (tmp_path / "wide.data").write_text("a\n1\t2\t3\n4\t5\n")
    (tmp_path / "notes.txt").write_text("skip me\n")
    (tmp_path / "again.data").write_text("a\n1\t2\n")
    (tmp_path / "x.MapErrors").write_text("n1\t\tn2\tn3\tn4\tn5\t1\t2\t3\t4\t5\tleft\n")
    names, rows, errors = flat_files.text_tables(spark, str(tmp_path))
    stem = lambda s: s.rsplit("/", 1)[1]
    named = {stem(r["source"]): r["names"] for r in names.collect()}
    assert named["good.data"] == ["id", "value"] and named["numbers.data"] == ["col_1", "col_2"]
    got = sorted((stem(r["source"]), r["vals"]) for r in rows.collect())
    assert got == [
        ("again.data", ["1", "2"]), ("again.data", ["a", " "]), ("good.data", ["1", "2"]), ("good.data", ["3", "4"]), ("numbers.data", ["1", "2"]), ("numbers.data", ["id", "2010"]),
        ("x.MapErrors", ["1", "2", "3", "4", "5"]), ("x.MapErrors", ["n1", "n2", "n3", "n4", "n5"]),
    ]
    assert named["x.MapErrors"] == ["n1", "n2", "n3", "n4", "n5"] and named["again.data"] == ["col_1", "col_2"]
    assert {(stem(r["source"]), r["reason"]) for r in errors.collect()} == {
        ("notes.txt", "excluded by name"),
        ("wide.data", "no width fits"),
    }


def test_closure_ends_on_cycles(spark):
    edges = [("/", "d1/", True), ("/", "f0", False), ("d1/", "f1", False), ("d1/", "/", True), ("x/", "f9", False)]
    got = links.directory_closure(
        spark.createDataFrame(edges, "parent string, child string, is_folder boolean"), spark.createDataFrame([("/",)], "folder string")
    )
    assert sorted(tuple(r) for r in got.collect()) == sorted(edges[:4])


def test_closure_of_a_long_chain_takes_two_jobs_a_round(spark):
    """A chain of folders with a way back; rounds deal out only what they find."""
    depth = 500 if os.environ.get("LONG_TESTS") else 40
    edges = [(f"d{i}/", f"d{i + 1}/", True) for i in range(depth)] + [(f"d{i}/", f"f{i}", False) for i in range(depth + 1)]
    edges += [(f"d{depth}/", "d3/", True), (None, "d0/", True), ("d5/", None, True), ("elsewhere/", "d0/", True)]
    table = spark.createDataFrame(edges, "parent string, child string, is_folder boolean")
    jobs = lambda: max(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    got = links.directory_closure(table, spark.createDataFrame([("d0/",), (None,)], "folder string"))
    # beside the rounds: the edges, the seeds, and a last round that finds nothing
    assert jobs() - before <= 2 * depth + 8
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(e) for e in edges if e[0] and e[0] != "elsewhere/")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan


def test_quoting(spark):
    df = spark.createDataFrame([("/a b~*é,+:x",)], "u string")
    assert df.select(text.url_quote(F.col("u"))).first()[0] == "/a%20b~%2A%C3%A9%2C%2B:x"
    path = spark.createDataFrame([("https://a.b/api/data/?&UserID=S&method=GetData&DataSetName=ITA&I=1",)], "u string")
    assert path.select(text.url_to_path(F.col("u"))).first()[0] == "a.b/api/ITA/-&UserID=S&method=GetData&DataSetName=ITA&I=1"


def test_good_and_bad_rows_in_one_pass(spark, tmp_path):
    """The event of reading a row is counted: every row of the source is worked out once."""
    from gridloom.operators.quarantine import check, tee

    read = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def touched(n):
        read.add(1)
        return n

    rows = spark.range(100).select(F.lit("s").alias("source"), touched("id").alias("n"))
    outcome = tee(check(rows, {"too large": F.col("n") < 70}), "size")
    assert (outcome.n_good, outcome.n_bad, read.value) == (70, 30, 100)
    assert sorted(r.n for r in outcome.good.collect()) == list(range(70))
    assert {tuple(r) for r in outcome.errors.collect()} == {("s", "size", "too large")} and outcome.errors.count() == 30
    assert read.value == 100
    assert sinks.write_outcomes(check(rows, {"all": F.col("n") >= 0}), "x", str(tmp_path / "g"), str(tmp_path / "log")) == (100, 0)
    assert not (tmp_path / "log").exists() and read.value == 200
    none = tee(check(rows.limit(0), {"all": F.lit(False)}), "x")
    assert (none.n_good, none.n_bad, none.good.count(), none.errors.count()) == (0, 0, 0, 0)


def test_error_log_of_one(spark, tmp_path):
    one = spark.createDataFrame([("f", "s", "r")], "source string, stage string, reason string")
    assert sinks.error_log(one, str(tmp_path / "log"))
    assert not sinks.error_log(one.limit(0), str(tmp_path / "none"))
    assert files.csv_scan(spark, str(tmp_path / "log")).count() == 1


def test_fixed_width_views(spark):
    lines = spark.createDataFrame([("d/Fin_PID.txt", 0, "01A0042"), ("d/x.txt", 0, "02B")], "source string, line_no long, value string")
    layout = spark.createDataFrame([("State", "1-2", "2", ""), ("Kind of", "3", "1", ""), ("State", "1-2", "2", "")], "Description string, Positions string, Length string, Value string")
    codes = spark.createDataFrame([(0, "A", "county", "Kind_of"), (1, "01", "north", "State")], "row_idx int, Code string, Desription string, Name string")
    first, second = flat_files.fixed_width_views(lines, layout, codes)
    assert first.columns == ["source", "line_no", "State_code", "Type_code", "State", "Kind_of"]
    got = {r["source"]: tuple(r)[2:] for r in second.collect()}
    assert got == {"d/Fin_PID.txt": ("01", "A", "north", "county"), "d/x.txt": (None, None, "02", "B")}


def test_nested_tables_and_odd_spans(spark):
    from gridloom.sources.html import html_table_cells

    html = """<TABLE><tr><td>a<table><tr><td colspan="²">in</td></tr></table>b</td><td colspan="5 x">c</td></tr>
      <tr><td rowspan=99999999999>d</td><td colspan=-3>e</td><td colspan="100000">f</td></tr></TABLE><table><tr><td>last</td></tr></table>"""
    pages = spark.createDataFrame([("u", html), ("v", None), ("w", "<table>")], "url string, html string")
    found = sorted((c.table_idx, c.row_idx, c.cell_idx, c.text, c.rowspan, c.colspan) for c in html_table_cells(pages).collect())
    assert found == [
        (0, 0, 0, "ab", 1, 1), (0, 0, 1, "c", 1, 5), (0, 1, 0, "d", 65534, 1), (0, 1, 1, "e", 1, 1), (0, 1, 2, "f", 1, 1000),
        (1, 0, 0, "in", 1, 1), (2, 0, 0, "last", 1, 1),
    ]


def test_grid_of_wide_and_high_tables(spark):
    """Thousands of slices in a row and row numbers above a million stay apart."""
    from gridloom.operators.html_tables import page_grid

    cell = lambda part, row, i, text: ("u", 0, part, row, i, "td", text, 1, 1, "")
    cells = [cell("thead", 0, 0, "h"), cell("caption", 0, 0, "c"), cell("tfoot", 0, 0, "f")]
    cells += [cell("tbody", row, i, str(i)) for row, width in ((1, 1), (2, 1200), (3, 1100), (2_000_000, 2)) for i in range(width)]
    schema = "url string, table_idx int, part string, row_idx int, cell_idx int, tag string, text string, rowspan int, colspan int, row_class string"
    rows = page_grid(spark.createDataFrame(cells, schema)).collect()
    at = sorted(r.row_idx for r in rows)
    assert at == list(range(len(rows))) and len(rows) == 1 + 1 + 1 + 1199 + 1099 + 1 + 1
    by = {r.row_idx: r.vals for r in rows}
    assert by[0] == ["c"] and by[1] == ["h"] and by[len(rows) - 1] == ["f"] and by[3] == ["0"] and len(by[1201]) == 1199


def test_broken_payloads(spark):
    from gridloom.operators.quarantine import good, quarantine
    from gridloom.sources.payload import checked_payloads

    texts = ["", None, "{", '{"BEAAPI":{}}', '{"BEAAPI":{"Data":3}}', '{"BEAAPI":{"Data":[{"a":"1"}]}}', '{"BEAAPI":{"Results":{"Data":[]}}}']
    checked = checked_payloads(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "source string, payload string"))
    errors = {r.source: r.reason for r in quarantine(checked, "payload").collect()}
    assert errors == {"0": "not JSON", "1": "not JSON", "2": "not JSON", "3": "no data envelope", "4": "records are no list of objects"}
    assert {r.source for r in good(checked).collect()} == {"5", "6"}
