"""The pipeline, stage by stage, against brute force on the same input; and the registered queries."""

import re
import sys
from collections import defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import corpus_pipeline  # noqa: E402
import oracle  # noqa: E402
from test_text_operators import PLAIN, brute_print, brute_spans, library  # noqa: E402

from gridloom.llm import decontam, quality, queries  # noqa: E402
from gridloom.session import settle  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage and the last result, as rows."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = settle(stage(spark, docs, SF_DIR))
    return [*out, docs]


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns_of_documents(stages):
    assert all(df.columns == stages[0].columns for df in stages[:5])
    assert [dict(df.dtypes) for df in stages[1:5]] == [dict(stages[0].dtypes)] * 4


def test_rejected_texts_go(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = {r.doc_id: r.score for r in quality.score_documents(stages[0], labels).collect()}
    before, after = texts(stages[0]), texts(stages[1])
    assert after == {i: t for i, t in before.items() if scored[i] >= 0.3}
    marks = {r.doc_id: r.quality for r in labels.collect()}
    assert sum(marks[i] for i in after if i in marks) >= 0.97 * sum(marks.values())


def test_one_of_each_group_stays(stages):
    before, after = texts(stages[1]), texts(stages[2])
    prints = {i: brute_print(t) for i, t in before.items()}
    group = {i: i for i in prints}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(prints)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                group[b] = a
    assert after == {i: before[i] for i in ids if find(i) == i}


def test_texts_with_benchmark_items_go(spark, stages):
    before, after = texts(stages[2]), texts(stages[3])
    plain = lambda t: b" " + b" ".join(decontam.words(t)) + b" "
    items = [plain(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert after == {i: t for i, t in before.items() if not any(item in plain(t) for item in items)}


def test_identifiers_are_taken_out(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    for i, text in before.items():
        spans = sorted(brute_spans(text), key=lambda s: (s[1], s[2]))
        merged = []
        for kind, start, end in spans:
            if merged and merged[-1][2] > start:
                merged[-1][2] = max(merged[-1][2], end)
            else:
                merged.append([kind, start, end])
        for kind, start, end in reversed(merged):
            text = f"{text[:start]}[{kind.upper()}]{text[end:]}"
        assert re.sub(r"\[TERM\]", "", after[i]) == text or "[TERM]" in after[i]
        assert not any(kind in PLAIN for kind, _, _ in brute_spans(after[i]))
    assert {r.doc_id: r.n_chars for r in stages[4].collect()} == {i: len(t) for i, t in after.items()}


def test_sequences_hold_all_tokens(stages):
    given, bins, tokens = texts(stages[4]), defaultdict(list), defaultdict(int)
    for r in stages[5].collect():
        bins[r.sequence_id].append((r.offset, r.length))
        tokens[r.doc_id] += r.length
    assert tokens == {i: len(library(t)) + 1 for i, t in given.items()}
    for content in bins.values():
        place = 0
        for offset, length in sorted(content):
            assert offset == place
            place += length
        assert place <= 4096
    assert len(bins) <= -(-sum(tokens.values()) // 4096) + 1  # fewer than the tokens allow there cannot be


NATIVE = ("op2_disclosure_spans", "op5_robust_outliers", "op9_shard_tree")


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_registered(spark, name):
    """Same rows as the SQL where there is some; no Python in the plans that are to be native."""
    df = queries.QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in NATIVE:
        assert not any(w in plan for w in ("EvalPython", "InPandas", "InArrow", "PythonUDF"))
    if name in queries.SQL:
        assert oracle.compare_df(df, oracle.connect(SF_DIR), queries.SQL[name]) == ""
    else:
        assert df.count() > 0
