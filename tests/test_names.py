"""Cleaned names against their definition, a pattern; sheets of one block and of several."""

import re

import pytest
from pyspark.sql import functions as F

from gridloom.functions import blockwise, text
from gridloom.operators import structure as st
from gridloom.plans import workbook

RAW = ["a b.0c", "x_%#y", "\0nul\t", "Größe – Σ Ж", "漢 字1", "😀 z", "e\u0301", "", "_", "~!@\x7f\x80", None]


def _plans(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("cleaner", "kept"), [(text.clean_name_excel, ""), (text.clean_name_html, ""), (text.clean_name_dl, "%#")])
def test_names_are_cleaned_as_by_the_pattern(spark, cleaner, kept):
    df = spark.createDataFrame([(r,) for r in RAW], "raw string")
    for raw, name in df.select("raw", cleaner(F.col("raw"), F.lit(3))).collect():
        want = None if raw is None else re.sub(f"[^a-zA-Z0-9{kept}]", "_", raw.strip(text.WHITE_SPACE).replace(".0", ""))
        if cleaner is text.clean_name_html and want is not None:
            want = re.sub("^_+|_+$", "", want)
        if cleaner is text.clean_name_dl and (raw is None or len(raw.strip(text.WHITE_SPACE)) <= 1):
            want = None
        assert name == ("col_3" if want is None else want)


def test_only_long_sheets_are_summarised(spark, rows, tmp_path, monkeypatch):
    """Blocks of four rows: of a sheet of four and one of nine, only the second has summaries; both come out right."""
    seen = []
    settle = blockwise.settle
    monkeypatch.setattr(blockwise, "settle", lambda df, *more: seen.append(settle(df, *more)) or seen[-1])
    paths = st.indent_path(rows({"one": [["a"], [" b"], ["  c"], ["d"]], "long": [["a"], *[[f" {i}"] for i in range(8)]]}))
    got = {(r["sheet"], r["row_idx"]): r["vals"][0] for r in paths.collect()}
    assert [got["one", i] for i in range(4)] == ["a", "a b", "a b c", "d"]
    assert [got["long", i] for i in range(9)] == ["a", *[f"a {i}" for i in range(8)]]
    assert [r["sheet"] for r in seen[-1].collect()] == ["long"]


def test_kind_of_a_sheet_takes_no_sort(rows):
    """The first row's test is aggregated, not its cells, which would make Spark sort them."""
    sheets = rows({"p": [["a", "b"], [None, "c"]], "q": [[None, "b"], ["a", "c"]]})
    facts = workbook._first_facts(sheets, workbook._no_gap)
    assert "SortAggregate" not in _plans(facts)
    assert {r["sheet"]: r["is_plain"] for r in facts.collect()} == {"p": True, "q": False}
