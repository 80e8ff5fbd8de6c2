"""Ordered rules against row-by-row models, and the hand-made samples."""

import models
import pytest
from conftest import collect
from pyspark.sql import functions as F

from gridloom.operators import grid, naming, structure as st, splits
from gridloom.operators.fixed_width import codebook_decode, fixed_width_slice, layout_for_file, layout_range


def test_indent_path(rows):
    sheets = models.random_sheets(1, 40)
    got = collect(st.indent_path(rows(sheets)), "vals")
    for s, sheet in sheets.items():
        assert [r[0] for r in got[str(s)]] == models.indent_paths(sheet)


def test_indent_sample(rows):
    got = collect(st.indent_path(rows({"s": [["A"], ["  B"], ["    C"], ["  D"], ["E"]]})), "vals")
    assert [r[0][0] for r in got["s"]] == ["A", "A B", "A B C", "A D", "E"]


@pytest.mark.parametrize("seed", [2, 5])
def test_split_tables_down(rows, seed):
    sheets = models.random_sheets(seed, 25, width=9, longest=120, indent=False)
    got = collect(splits.split_tables_down(rows(sheets)), "row_idx", "table_id")
    several = 0
    for s, sheet in sheets.items():
        want = models.tables_down(sheet)
        several += len({t for _, t in want}) > 1
        assert got.get(str(s), []) == want
    assert several > 5


def test_split_tables_down_in_one_block(rows, spark):
    sheets = models.random_sheets(9, 10, width=9, longest=80, indent=False)
    spark.conf.set("spark.gridloom.blockRows", "100000")
    try:
        got = collect(splits.split_tables_down(rows(sheets)), "row_idx", "table_id")
    finally:
        spark.conf.set("spark.gridloom.blockRows", "4")
    for s, sheet in sheets.items():
        assert got.get(str(s), []) == models.tables_down(sheet)


def test_uspto_roles_and_labels(rows):
    sheets = models.random_sheets(4, 40, width=4)
    roles = st.classify_rows_uspto(rows(sheets))
    got = collect(roles, "role")
    carried = collect(st.carry_label_uspto(roles), "row_idx", "vals")
    for s, sheet in sheets.items():
        assert [r[0] for r in got[str(s)]] == models.uspto_roles(sheet)
        assert carried.get(str(s), []) == [(i, r) for i, r in models.uspto_carried(sheet)]


def test_uspto_special(rows):
    sheets = models.random_sheets(6, 40, width=3)
    for i, sheet in sheets.items():  # the moving label, in some sheets
        if i % 2 and len(sheet) > 6:
            sheet[5] = ["Patent Matters"] + [None] * (len(sheet[5]) - 1)
    # A chain needs a label to continue: the model and the operator agree where there is one.
    got = collect(st.keep_label_uspto_special(st.classify_rows_uspto(rows(sheets))), "row_idx", "vals")
    for s, sheet in sheets.items():
        want = models.special_kept(sheet)
        have = [(i, list(r)) for i, r in got.get(str(s), [])]
        assert [i for i, _ in have] == [i for i, _ in want]
        for (_, a), (_, b) in zip(have, want):
            assert a[0].strip() == b[0].strip() and a[1:] == b[1:]


def test_soi_labels(rows):
    sheets = {s: [r for r in sheet if models.cells_of(r)] for s, sheet in models.random_sheets(7, 40, width=4).items()}
    sheets = {s: sheet for s, sheet in sheets.items() if sheet}
    got = collect(st.carry_label_soi(rows(sheets)), "row_idx", "vals", "prefix")
    for s, sheet in sheets.items():
        assert got.get(str(s), []) == [tuple(x) for x in models.soi_carried(sheet)]


def test_html_roles(rows):
    sheets = models.random_sheets(8, 40, width=3)
    got = collect(st.classify_rows_html(rows(sheets)), "role")
    for s, sheet in sheets.items():
        assert [r[0] for r in got[str(s)]] == models.html_roles(sheet)


def test_html_roles_sample(rows):
    got = collect(st.classify_rows_html(rows({"s": [["T", None], ["x", "1"], ["n1", None], ["n2", None]]})), "role")
    assert [r[0] for r in got["s"]] == ["title", "body", "other", "footer"]


def test_gov_prefix_keeps_headings_on_top(rows):
    sheet = [["Debt outstanding", "1"], ["Long", "2"], ["Revenue1", "3"]]
    prefixed = st.gov_prefix(rows({"s": sheet}))
    got = collect(st.indent_path(prefixed), "vals")
    assert [r[0][0] for r in got["s"]] == ["Debt outstanding", "Debt outstanding Long", "Revenue1"]


def test_header_sample(rows):
    grid_rows = rows({"s": [[None, "2020", None], ["Area", "Total", "Share"], ["x", "1", "2"]]}).withColumn(
        "position", F.col("row_idx")
    )
    depth = grid_rows.groupBy("source", "sheet").agg(F.lit(2).alias("depth"))
    names, body = st.split_header(grid_rows.join(depth, ["source", "sheet"]), F.col("depth"))
    named = {r["col_idx"]: r["raw"].strip() for r in names.collect()}
    assert named == {0: "Area", 1: "2020 Total", 2: "2020 Share"}
    assert [r["vals"] for r in body.collect()] == [["x", "1", "2"]]


def test_header_depth_one_and_none(rows):
    sheets = {"one": [["a", None], ["b", "c"], ["d", "e"]], "none": [["a", "b"], ["c", "d"]]}
    placed = rows(sheets).withColumn("position", F.col("row_idx"))
    depth = F.when(F.col("sheet") == "one", 1).otherwise(0)
    names, body = st.split_header(placed.withColumn("d", depth), F.col("d"))
    got = {(r["sheet"], r["col_idx"]): r["raw"] for r in names.collect()}
    # A single value in the first of two rows spreads over all columns but the first.
    assert got == {("one", 0): "  b", ("one", 1): "a c", ("none", 0): "a", ("none", 1): "b"}
    assert collect(body, "vals") == {"one": [(["d", "e"],)], "none": [(["c", "d"],)]}


def test_dedupe_names(spark):
    def dedupe(names):
        df = spark.createDataFrame([("f", "s", i, n) for i, n in enumerate(names)], "source string, sheet string, col_idx int, name string")
        return [r["name"] for r in sorted(naming.dedupe_names(df).collect(), key=lambda r: r["col_idx"])]

    assert dedupe(["a", "a", "a_2"]) == ["a", "a_2", "a_2_2"]
    long = dedupe(["a", "a", "a_2", "a_2_2", "a_2_2_2", "a_2_2_2_2", "A"])
    assert len({n.lower() for n in long}) == len(long)


def test_name_samples(spark):
    from gridloom.functions import text

    df = spark.createDataFrame([("Rate (%)", 0), ("2010.0", 1), (None, 2)], "raw string, col_idx int")
    got = [r[0] for r in df.select(text.clean_name_excel(F.col("raw"), F.col("col_idx"))).collect()]
    assert got == ["Rate____", "2010", "col_2"]
    got = [r[0] for r in spark.createDataFrame([("series id",), ("M--1",), ("",)], "raw string").select(text.clean_name_text(F.col("raw"))).collect()]
    assert got == ["series_id", "M_1", None]
    caption = spark.createDataFrame([("Table 1.1A – Use",), (" – x",), ("",)], "c string")
    assert [r[0] for r in caption.select(text.caption_key(F.col("c"))).collect()] == ["Table_1_1", "", ""]


def test_codebook_sample(spark):
    df = spark.createDataFrame([(str(i),) for i in range(1, 5)], "c string")
    codes = spark.createDataFrame(
        [(0, "1", "a", "c"), (1, "1", "b", "c"), (2, "2", None, "c"), (3, "4", "d", "c")],
        "row_idx int, Code string, Desription string, Name string",
    )
    assert [r["c"] for r in codebook_decode(df, codes, ["c"]).collect()] == ["b", None, "3", "d"]


def test_slice_sample(spark):
    lines = spark.createDataFrame([("01A0042",), ("01A",)], "value string")
    got = fixed_width_slice(lines, [(4, 4, "Amt"), (1, 2, "State"), (3, 1, "Type"), (1, 2, "State")])
    assert got.columns == ["State", "Type", "Amt"]
    assert [tuple(r) for r in got.collect()] == [("01", "A", "0042"), ("01", "A", "")]


def test_layout_samples(spark):
    got = layout_range(spark.createDataFrame([("10-12",), ("14",), ("x",)], "Location string"))
    assert [(r["start"], r["length"]) for r in got.collect()] == [(10, 3), (14, 1)]
    files = spark.createDataFrame([("d/e8090abc.txt",), ("d/other.txt",)], "source string")
    listed = spark.createDataFrame([("E8090ABC.TXT", "1980", 0), ("E8090ABC.TXT", "1990", 1)], "`File Name` string, use_layout_decade string, row_idx int")
    layout = spark.createDataFrame([("1980", "1-2"), ("1980", "1-2"), ("1990", "3-4")], "decade string, Location string")
    assert [(r["source"], r["Location"]) for r in layout_for_file(files, listed, layout).collect()] == [("d/e8090abc.txt", "1-2")]


def test_footer_sample(spark):
    tables = spark.createDataFrame(
        [("f", "s", 0, None), ("f", "s", 1, "f1"), ("f", "s", 2, "Footnotes at end of table"), ("f", "s", 3, "f2")],
        "source string, sheet string, table_id long, footer string",
    )
    got = sorted((r["place"], r["table_id"], r["footer"]) for r in st.footer_propagate(tables).collect())
    assert got == [(0, 1, "f1"), (1, 3, "f2"), (2, 0, "f2"), (3, 2, "f2")]


def test_sections(spark):
    lines = ["Level Code Description", "1 State", "2 Local", "State Name Abbreviation State Code", "New York NY 36", "Notes here", "skipped 1", "Flags Description", "I imputed value"]
    df = spark.createDataFrame([("d", i, v) for i, v in enumerate(lines)], "source string, line_no long, value string")
    got = [(r["Name"], r["Code"], r["Desription"]) for r in splits.section_extract(df).orderBy("line_no").collect()]
    assert got == [
        ("Level_of_estimate_code", "1", "State"),
        ("Level_of_estimate_code", "2", "Local"),
        ("State_code", "36", "New York"),
        ("Imputation_type/item_data_flag", "I", "imputed value"),
    ]
    closed = splits.section_extract(df, flush_last=False)
    assert closed.count() == 3


@pytest.mark.parametrize("n", [1, 10, 11, 37, 100])
def test_shards(spark, n):
    df = spark.range(n)
    got = [r["shard"] for r in splits.equal_frequency_shard(df, "id", 10).orderBy("id").collect()]
    assert got == [max(0, -(-10 * i // max(n - 1, 1)) - 1) for i in range(n)]
    chunks = [r["chunk"] for r in splits.even_split(df, "id", 3).orderBy("id").collect()]
    sizes = [chunks.count(c) for c in (1, 2, 3)]
    assert chunks == sorted(chunks) and sizes == [n // 3 + (i < n % 3) for i in range(3)]


def test_leading_gap_and_columns(rows):
    sheets = {"gap": [[None, "a"], ["x", "b"]], "full": [["a", "b"]]}
    got = collect(grid.drop_leading_gap_column(rows(sheets)), "vals")
    assert got == {"gap": [(["a"],), (["b"],)], "full": [(["a", "b"],)]}


def test_empty_input(rows, spark):
    from conftest import ROWS

    empty = spark.createDataFrame([], ROWS)
    assert st.classify_rows_gov(empty).count() == 0
    assert st.indent_path(empty).count() == 0
    assert splits.split_tables_down(empty).count() == 0


def test_strip_is_the_unicode_one(spark):
    from gridloom.functions import text

    assert sorted(text.WHITE_SPACE) == [chr(i) for i in range(0x10000) if chr(i).isspace()]
    values = ["  a b ", " x　", "\t\n", "", "a", " \x1cé\x85"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [tuple(r) for r in df.select(text.strip(F.col("v")), text.strip_left(F.col("v"))).collect()]
    assert got == [(v.strip(), v.lstrip()) for v in values]


def test_dedupe_names_on_adversarial_headings(spark):
    """One rule until all are unique, against a walk from left to right."""
    import random

    r = random.Random(7)
    tables = [["a", "a", "a__1", "a_2", "a_2_2", "a_2_2_2", "a_2_2_2_2", "A"], ["a_2", "a", "a", "a_3"], ["x"] * 40, [None, "n", None, "N"]]
    tables += [[r.choice(["a", "A", "a_2", "a_3", "a_2_2", "b"]) for _ in range(12)] for _ in range(30)]
    rows = [("f", str(t), i, n) for t, names in enumerate(tables) for i, n in enumerate(names)]
    found = {}
    for x in naming.dedupe_names(spark.createDataFrame(rows, "source string, sheet string, col_idx int, name string")).collect():
        found.setdefault(int(x.sheet), {})[x.col_idx] = x.name
    for t, names in enumerate(tables):
        taken, expected = set(), []
        for i, n in enumerate(names):
            use = 1 + sum(m is not None and n is not None and m.lower() == n.lower() for m in names[:i])
            k, name = max(use, 2), n
            while name is not None and name.lower() in taken:
                name, k = f"{n}_{k}", k + 1
            taken.add(name and name.lower())
            expected.append(name)
        assert [found[t][i] for i in range(len(names))] == expected
        known = [n.lower() for n in expected if n]
        assert len(set(known)) == len(known)


def test_a_long_run_of_labels_is_linear(spark):
    n = 100_000
    held = spark.conf.get("spark.gridloom.blockRows")
    spark.conf.set("spark.gridloom.blockRows", "65536")
    try:
        rows = spark.range(n + 1).selectExpr(
            "'f' source", "'s' sheet", "id row_idx",
            f"if(id < {n}, array('label', null), array('x', 'y')) vals", f"if(id < {n}, 'label', 'body') role",
        )
        out = st.carry_label_uspto(rows).collect()
    finally:
        spark.conf.set("spark.gridloom.blockRows", held)
    assert len(out) == 1 and out[0].vals[0] == " ".join(["label"] * n + ["x"])
