"""Families of sheets, end to end, on small sheets worked out by hand."""

from pyspark.sql import functions as F

from gridloom.operators import combine
from gridloom.plans import workbook as w


def _table(tables, sheet, source="f"):
    df = tables.table(source, sheet)
    rows = [tuple(r)[1:] for r in df.orderBy("row_idx").collect()]
    return df.columns[1:], rows


def test_gov(rows):
    sheets = {
        "s": [
            ["Table of money", None, None, None],
            ["by year", None, None, None],
            ["Description", None, "2010", "2011"],
            [None, None, None, None],
            ["Revenue1", None, "1", "2"],
            ["Taxes:", None, None, None],
            ["  Income", None, "3", "4"],
            ["Notes below", None, None, None],
        ],
        "plain": [["a", "b"], ["c", None]],
    }
    tables = w.sheet_tables(rows(sheets), w.GOV)
    columns, got = _table(tables, "s")
    assert columns == ["Description", "2010", "2011", "Header", "Footer"]
    # A heading lends its text and goes; the four headings carry no prefix and clear the path.
    notes = (" Table of money.  by year", " Notes below")
    assert got == [("Revenue1", " 1", " 2", *notes), ("Revenue1 Taxes: Income", " 3", " 4", *notes)]
    assert _table(tables, "plain") == (["col_0", "col_1"], [("a", "b"), ("c", None)])


def test_uspto(rows):
    sheets = {
        "s": [
            ["Patents", None, None],
            ["by state", None, None],
            ["State", "Count", None],
            ["", "2010", "2011"],
            ["West", None, None],
            ["Ohio", "1", "2"],
            ["  Akron", "3", "4"],
            [None, None, None],
            ["Iowa", "5", "6"],
            ["1 a note", None, None],
        ],
        "first": [["a", "b.0"], ["1", "2"]],
    }
    tables = w.sheet_tables(rows(sheets), w.USPTO)
    columns, got = _table(tables, "s")
    assert columns[-2:] == ["Header", "Footer"]
    assert {r[0] for r in got} >= {"West Ohio", "Iowa"}
    assert {r[-2:] for r in got} == {("Patents. by state", "1 a note")}
    assert _table(tables, "first") == (["a", "b"], [("1", "2")])


def test_dl(rows):
    sheets = {
        "s": [
            ["Workforce", None, None],
            ["Area", "Men", "Women"],
            ["North", "1", "2"],
            ["South", "3", "4"],
            ["Source: survey", None, None],
        ]
    }
    columns, got = _table(w.dl_tables(rows(sheets)), "s")
    assert columns == ["Area", "Men", "Women", "Header", "Footer"]
    assert got == [("North", "1", "2", "Workforce", "Source: survey"), ("South", "3", "4", "Workforce", "Source: survey")]


def test_soi(rows):
    head = [["Table 1. Returns", None, None], [None, "All", None], [None, "Number", "Amount"], [None, "(1)", "(2)"]]
    body = [[f"  row {i}", str(i), str(i * 10)] for i in range(8)]
    sheets = {"s": [*head, ["Total", "9", "90"], *body, ["* Estimate.", None, None]]}
    tables = w.soi_tables(rows(sheets))
    columns, got = _table(tables, "s|0|0")
    # The column numbers go; the nameless first column is named after the second.
    assert columns == ["All_Number", "All_Number_2", "All_Amount", "Header", "Footer"]
    assert [r[:3] for r in got] == [("Total", "9", "90")] + [(f"Total row {i}", str(i), str(i * 10)) for i in range(8)]
    assert {r[-2:] for r in got} == {("Table 1. Returns", "* Estimate.")}


def test_soi_heading_of_one_row(rows):
    """The row below a heading of one row is taken for part of it and goes."""
    head = [[None, "All", None], [None, "Number", "Amount"]]
    body = [[f"row {i}", str(i), str(i * 10)] for i in range(8)]
    columns, got = _table(w.soi_tables(rows({"s": [*head, *body]})), "s|0|0")
    assert columns == ["col_0", "All", "col_2"]
    assert len(got) == 8


def test_soi_sideways_and_down(rows):
    """Two tables side by side, the left one above another."""
    def block(title, n):
        return [[title, None], [None, "Count"], [None, "of all"], [None, "(1)"]] + [[f"r{i}", str(i)] for i in range(n)]

    left = block("Table A", 12) + block("Table B", 12)
    right = block("Table C", 12)
    right += [[None, None]] * (len(left) - len(right))
    sheet = [a + [None] + b for a, b in zip(left, right)]
    tables = w.soi_tables(rows({"s": sheet}))
    found = {r["sheet"]: r["n"] for r in tables.rows.groupBy("sheet").count().withColumnRenamed("count", "n").collect()}
    assert found == {"s|0|0": 12, "s|0|1": 12, "s|1|0": 12}
    titles = {r["sheet"]: r["header"] for r in tables.notes.collect()}
    assert titles == {"s|0|0": "Table A", "s|0|1": "Table B", "s|1|0": "Table C"}


def test_write_groups_tables_by_schema(rows, spark, tmp_path):
    sheets = {f"s{i}": [["a", "b"], [str(i), "x"]] for i in range(3)} | {"t": [["c", "d"], ["1", "2"]]}
    tables = w.sheet_tables(rows(sheets), w.USPTO)
    tables.write(str(tmp_path))
    assert len(list(tmp_path.glob("schema=*"))) == 2
    found = [spark.read.parquet(str(p)) for p in tmp_path.glob("schema=*")]
    assert sorted(df.count() for df in found) == [1, 3]
    assert [tuple(r) for r in w.stored_table(spark, str(tmp_path), "f", "s2").select("a", "b").collect()] == [("2", "x")]


def test_one_write_for_all_schemas(rows, spark, tmp_path):
    """Twelve schemas take as many jobs as one; every table reads as it was."""
    jobs = lambda: max(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    taken = []
    for name, kinds in (("one", 1), ("many", 12)):
        sheets = {f"{i:03}": [[f"k{i % kinds}", f"v{i % kinds}", *[f"w{j}" for j in range(i % kinds)]], [f"{i}", "x", *["y"] * (i % kinds)]] for i in range(24)}
        tables = w.sheet_tables(rows(sheets), w.USPTO)
        before = jobs()
        tables.write(str(tmp_path / name))
        taken.append(jobs() - before)
        for sheet in ("001", "023"):
            stored = w.stored_table(spark, str(tmp_path / name), "f", sheet)
            assert (stored.columns, stored.collect()) == (tables.table("f", sheet).columns, tables.table("f", sheet).collect())
    assert taken[1] <= taken[0] + 2


def test_five_hundred_tables_make_a_shallow_plan(spark):
    tables = [spark.range(0, 1, 1, 1).select(F.col("id").alias("Key" if i % 2 else "key"), F.lit(i).alias(f"c{i % 7}")) for i in range(500)]
    out = combine.union_by_name_merge(tables)
    lines = out._jdf.queryExecution().analyzed().toString().splitlines()
    assert max((len(line) - len(line.lstrip(" :|+-"))) // 3 for line in lines) < 20
    assert out.columns == ["key", *[f"c{i}" for i in range(7)]]
    assert out.selectExpr("count(*)", "sum(c0)", "sum(c6)").first() == (500, sum(range(0, 500, 7)), sum(range(6, 500, 7)))
