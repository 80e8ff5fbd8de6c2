"""Every registered query against its SQL, in blocks of four rows."""

import sys
from pathlib import Path

import oracle
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from gridloom.queries.registry import load  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = load()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


# Decoders, and rules with a state of their own; all other queries stay in the JVM.
PYTHON = {
    "workbook_cells", "workbook_values", "sheet_path", "archive_expand", "html_table_cells", "html_simple_table", "class_indent",
    "span_expand", "html_page_grid", "captions", "split_tables_down", "page_tables", "page_unions", "sheet_tables_soi",
    "carry_label_uspto", "keep_label_uspto_special", "carry_label_soi", "indent_path",
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    """Same rows as the SQL where there is one; no Python in the plan but for the decoders."""
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    if name not in PYTHON:
        assert not any(w in plan for w in ("EvalPython", "InPandas", "PythonUDF"))
    if name in SQL:
        assert oracle.compare_df(df, duck, SQL[name]) in ("", "EMPTY")
    else:
        df.write.format("noop").mode("overwrite").save()


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["source", "line_no", "status", "priority", "customer", "cents", "tail"]
