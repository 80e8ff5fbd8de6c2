"""The manifest against a tree built by the standard library, with nulls, copies, repeated ids and odd columns."""

import hashlib
import zlib

import numpy as np
import pytest

from gridloom.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos int, digest string"
ROWS = [
    (3, "a", "en", "s", 1), (3, "a", "en", "s", 1), (3, "b", "en", None, None), (None, "x", "en", "s", 5), (0, "", "en", "s", 0),
    (8, "Ünï 🙂", "de", "s", 7), (12, None, "de", "s", None), (5, "t", None, "s", 1), (6, "t", None, None, 1), (7, None, "", None, 2),
    *[(i, f"text {i} " * (i % 7), "fr", "s1", i) for i in range(20, 57)], (100, "y" * 300_000, "zz", "s", 300_000),
]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    fields = (doc_id, source, lang, None if n_chars is None else n_chars + more, text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def tree(leaves, arity):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def by_the_book(rows, arity):
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    for own in langs.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {k: tree([leaf(r) for r in own], arity) for k, own in langs.items()}
    order = sorted(langs, key=lambda k: (k is not None, (k or "").encode()))
    top = tree([trees[k][-1][0] for k in order], arity)
    out = []
    for place, k in enumerate(order):
        for at, r in enumerate(langs[k]):
            touched = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            now, proof = leaf(r, int(touched)), []
            for levels, i in ((trees[k], at), (top, place)):
                for level in levels[:-1]:
                    run = level[i // arity * arity :][:arity]
                    proof += run[: i % arity] + run[i % arity + 1 :]
                    run[i % arity] = now
                    now, i = digest(*run), i // arity
            out.append((r[0], leaf(r), trees[k][-1][0], top[-1][0], digest(*proof), now, now == top[-1][0]))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize(("arity", "block"), [(2, 4096), (2, 8), (3, 9)])
def test_manifest(spark, monkeypatch, arity, block):
    """Blocks of 8 and 9 leaves make several tiers."""
    monkeypatch.setattr(merkle, "BLOCK", block)
    docs = spark.createDataFrame([(*r, "clash", 1, "clash") for r in ROWS], SCHEMA).repartition(3)
    found = in_order(merkle.prove(docs, arity).collect())
    assert found == in_order(by_the_book(ROWS, arity))
    assert any(not r[6] for r in found) and any(r[6] for r in found)


def test_no_rows_and_one_row(spark):
    assert merkle.prove(spark.createDataFrame([], SCHEMA)).collect() == []
    one = [(0, "text", "en", "s", 4)]
    found = merkle.prove(spark.createDataFrame([(*one[0], "x", 1, "x")], SCHEMA)).collect()
    assert in_order(found) == in_order(by_the_book(one, 2))
    assert found[0]["proof_sha256"] == hashlib.sha256(b"").hexdigest()


def test_copied_states_resume():
    """A state kept before a slot goes on as the library's own copy does."""
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(5)]
    nodes = merkle._words(b"".join(digests))
    parents, kept = merkle.raise_level(nodes, 3)
    library = hashlib.sha256()
    for slot in range(3):
        before = library.copy()
        before.update(b"".join(d.hex().encode() for d in digests[slot:3]))
        right = [(np.array([0]), merkle.as_text(nodes[i : i + 1])) for i in range(slot + 1, 3)]
        found = merkle.resume(nodes[slot : slot + 1], kept[0, slot][None], right, np.array([3]))
        assert merkle._column(found)[0] == before.digest() == merkle._column(parents)[0]
        library.update(digests[slot].hex().encode())
