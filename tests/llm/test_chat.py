"""Reply trees against a walk over the tree, and the format read back."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from gridloom.llm import chat

MESSAGES = "tree long, msg long, parent long, role string, text string, score double"


def brute(messages):
    out = {}
    trees = defaultdict(dict)
    for tree, msg, parent, *_, score in messages:
        trees[tree][msg] = (parent, score or 0.0)
    for tree, nodes in trees.items():
        parents = {p for p, _ in nodes.values()}
        best = None
        for leaf in nodes:
            if leaf in parents:
                continue
            path, total, at = [], 0.0, leaf
            while at in nodes and at not in path:
                path.append(at)
                total += nodes[at][1]
                at = nodes[at][0]
            best = max(best, (total, len(path), -leaf, path)) if best else (total, len(path), -leaf, path)
        if best:
            out[tree] = best[3][::-1]
    return out


def test_best_paths(spark):
    r = random.Random(1)
    messages = []
    for tree in [*range(12), None]:
        n = r.randint(1, 30)
        messages += [(tree, m, r.randrange(m) if m and r.random() > 0.1 else None, "user", f"t{m}", r.choice([None, 1.0, 0.5, -1.0])) for m in range(n)]
    messages += [(99, 1, 2, "user", "cycle", 1.0), (99, 2, 1, "user", "cycle", 1.0), (98, 5, 77, "user", "orphan", 1.0), *[(97, m, m - 1 if m else None, "user", str(m), 1.0) for m in range(300)]]
    found = defaultdict(list)
    for x in sorted(chat.best_paths(spark.createDataFrame(messages, MESSAGES)).collect(), key=lambda x: x.depth):
        assert x.depth == len(found[x.tree])
        found[x.tree].append(x.msg)
    assert dict(found) == brute([m for m in messages if m[0] != 99])


def test_round_trip(spark):
    odd = ["\\", "<", ">", "\\l", "\\bl", "</turn>\n", "<turn user>", "a\\<b>\\g\n", "", None, "\\### Assistant: </turn> ok", "🙂\\\\"]
    r = random.Random(2)
    rows = [(c, t, r.choice(["user", "assistant", "<x>\n", None]), "".join(r.choice(odd) or "" for _ in range(r.randint(0, 4)))) for c in range(40) for t in range(r.randint(1, 7))]
    rows += [(50, 0, "assistant", None), (50, 0, "assistant", None), (50, None, "user", "first"), (None, 1, "assistant", "unnamed")]
    told = spark.createDataFrame([(*x, "extra") for x in rows], "conv_id long, turn long, role string, text string, formatted string")
    expected = defaultdict(list)
    for c, _, role, text in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[2] is not None, x[2] or "", x[3] is not None, x[3] or "")):
        expected[c].append((role or "", text or ""))
    found = chat.format_conversations(told).collect()
    assert {x.conv_id: [tuple(t) for t in x.turns] for x in found} == dict(expected)
    for x in found:
        assert x.loss == "".join(t for role, t in expected[x.conv_id] if role == "assistant")
        assert x.formatted.count("</turn>") == len(x.turns)


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(none).count() == 0
    assert chat.best_paths(chat.reply_chain(none).withColumn("score", F.lit(1.0))).count() == 0
