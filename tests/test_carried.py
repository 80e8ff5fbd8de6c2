"""Rules with a state: however a sheet is cut into blocks, the results are those of one block; long sheets and many depths."""

import json
import random

import models
import numpy as np
import pytest

from conftest import collect
from gridloom.functions.blockwise import Machine
from gridloom.operators import splits
from gridloom.operators import structure as st
from gridloom.operators.carried import Indentation, KeptLabels, LoneRuns, RunningLabel


def drive(rule, columns, cuts):
    """Results of a rule over blocks cut at ``cuts``, as (row, value, ...)."""
    n = len(next(iter(columns.values())))
    edges = [0, *cuts, n]
    blocks = [{k: v[a:b] for k, v in columns.items()} for a, b in zip(edges, edges[1:], strict=False)]
    plain = lambda state: json.loads(json.dumps(state))
    starts = rule.chain([plain(rule.summarise(b)) for b in blocks])
    out = []
    for block, start, edge in zip(blocks, starts, edges, strict=False):
        at, found = rule.run(block, plain(start))
        out += zip((at + edge).tolist(), *[list(v) for v in found.values()], strict=True)
    return out


def sheet_columns(r, n):
    """Rows of a narrow alphabet, so that chains, blanks and moves are frequent."""
    kinds = r.choices(["blank", "full", "label", "lone"], [1, r.choice([1, 4]), r.choice([2, 8]), 1], k=n)
    texts = ["a", " b", "c:", " d:", "Patent", " Patent", "Matters", "Patent Matters", "x "]
    first = [r.choice(texts) if k in ("label", "lone") else None for k in kinds]
    return {
        "n": np.array([{"blank": 0, "full": 3}.get(k, 1) for k in kinds]),
        "role": np.array([{"full": 1, "label": 2, "lone": r.choice([0, 1])}.get(k, 0) for k in kinds]),
        "first": np.array([*first, ""], object)[:-1],
    }


@pytest.mark.parametrize("seed", range(40))
def test_cuts_change_nothing(seed):
    r = random.Random(seed)
    n = r.randint(1, 60)
    cuts = sorted(r.sample(range(1, n), r.randint(0, min(n - 1, 12)))) if n > 1 else []
    columns = sheet_columns(r, n)
    for rule in (RunningLabel(), KeptLabels("Patent Matters")):
        assert drive(rule, columns, cuts) == drive(rule, columns, [])
    lone = np.array([r.random() < 0.6 for _ in range(n)])
    runs = {"lone": lone, "first": np.array([*[f"v{i}" if x else None for i, x in enumerate(lone)], ""], object)[:-1]}
    assert drive(LoneRuns(), runs, cuts) == drive(LoneRuns(), runs, [])
    labels = [r.choice([None, "", "p", "q", "r"]) for _ in range(n)]
    depths = {"level": np.array([r.randint(0, 5) for _ in range(n)]), "label": np.array([*labels, ""], object)[:-1]}
    assert drive(Indentation(), depths, cuts) == drive(Indentation(), depths, [])
    flags = {"flags": np.array([r.choice([1, 1 | 64, 8 | 16, 8, 32 | 4, 32, 8 | 16 | 4, 2 | 8]) for _ in range(n)])}
    assert drive(splits.Down(), flags, cuts) == drive(splits.Down(), flags, [])


@pytest.mark.parametrize("n", [0, 1, 2, 3, 15, 16, 17, 400])
def test_lanes_are_the_rows_one_after_the_other(n):
    r = random.Random(n)
    states, codes = 5, 4
    following = [[r.randrange(states) for _ in range(states)] for _ in range(codes)]
    marked = [[r.random() < 0.5 for _ in range(states)] for _ in range(codes)]
    machine, given = Machine(following, marked), np.array([r.randrange(codes) for _ in range(n)], np.int64)
    ends, counts = machine.ends(given)
    for start in range(states):
        state, marks = start, []
        for code in given.tolist():
            marks.append(marked[code][state])
            state = following[code][state]
        assert (ends[start], counts[start]) == (state, sum(marks))
        assert machine.marks(given, start).tolist() == marks


def test_one_sheet_over_many_blocks(rows):
    sheet = models.random_sheet(random.Random(8), 7, 1_500, indent=False)
    got = collect(splits.split_tables_down(rows({"s": sheet})), "row_idx", "table_id")["s"]
    assert got == models.tables_down(sheet)
    assert got[-1][1] > 10


def test_two_hundred_depths(rows):
    r = random.Random(6)
    sheet = [[" " * (i % 200) + f"l{i}"] for i in range(400)] + [[" " * r.randrange(200) + f"m{i}"] for i in range(200)]
    out = st.indent_path(rows({"s": sheet}))
    assert out._jdf.queryExecution().analyzed().toString().count("Window") == 0
    assert [v[0][0] for v in collect(out, "vals")["s"]] == [v[0] for v in models.indent_paths(sheet)]


def labels_then_a_row(spark, n, text):
    return spark.range(n + 1).selectExpr(
        "'f' source", "'s' sheet", "id row_idx", f"if(id < {n}, array('{text}', null), array('x', 'y')) vals",
        f"if(id < {n}, 'label', 'body') role",
    )


def test_long_runs_of_lone_rows(spark):
    """100,000 rows of one cell: no step may take the square of their number."""
    n, held = 100_000, spark.conf.get("spark.gridloom.blockRows")
    spark.conf.set("spark.gridloom.blockRows", "65536")
    try:
        kept = st.keep_label_uspto_special(labels_then_a_row(spark, n, "label")).collect()
        runs = st.carry_label_soi(labels_then_a_row(spark, n, "label").drop("role").unionAll(
            spark.range(2).selectExpr("'f'", "'s'", f"id + {n + 1}", "array('p', 'q')")
        )).collect()
    finally:
        spark.conf.set("spark.gridloom.blockRows", held)
    assert [r.vals for r in kept] == [["x", "y"]]
    assert {r.prefix for r in runs} == {" ".join(["label"] * n)} and len(runs) == 3
