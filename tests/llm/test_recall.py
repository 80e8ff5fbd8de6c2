"""Benchmark items in texts: large benchmarks, copies in part, items of repeated words."""

import random

import numpy as np
import pytest

from gridloom.llm import decontam


@pytest.fixture(scope="module")
def sources():
    r = random.Random(21)
    words = ["".join(r.choice("abcdefghilmnorstu") for _ in range(r.randint(2, 9))) for _ in range(20_000)]
    weights = [1 / (i + 5) for i in range(len(words))]
    return [" ".join(r.choices(words, weights, k=r.randint(100, 400))) for _ in range(1_000)]


@pytest.mark.parametrize("size", [200, 1_000, 4_000])
def test_copies_of_a_large_benchmark_are_found(spark, sources, size):
    r = random.Random(22)
    items = []
    for _ in range(size):
        words, n = r.choice(sources).split(), r.randint(16, 59)
        at = r.randint(0, len(words) - n)
        items.append(" ".join(words[at : at + n]))
    docs = spark.createDataFrame(list(enumerate(sources)), "doc_id long, text string")
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    block = decontam.prepare(docs, next(decontam.read_blocks(table)))
    tried = range(0, size, size // 100)
    found = sum(any(h[0] == k for h in decontam.search(f"{sources[k % 7][: 40 + k % 90]} {items[k]} {sources[k % 5][:200]}", block)) for k in tried)
    assert found >= 0.97 * len(tried)


def test_the_first_part_of_an_item_is_a_leak(spark, sources):
    """Without a given answer the words in order decide; with one, half of it must be there."""
    items = [" ".join(sources[i].split()[:n]) + "." for i, n in enumerate((40, 60, 80, 100))]
    heads = [" ".join(x.split()[: int(0.7 * len(x.split()))]) for x in items]
    docs = spark.createDataFrame([(i, f"{sources[50 + i]} {t} {sources[60 + i]}") for i, t in enumerate([*items, *heads])], "doc_id long, text string")
    rows = [(i, x, " ".join(x.split()[-8:])) for i, x in enumerate(items)]
    for columns, truth in (("item_id long, text string", range(8)), ("item_id long, text string, answer string", range(4))):
        table = spark.createDataFrame([r[: columns.count(",") + 1] for r in rows], columns)
        found = {(x["doc_id"], x["item_id"]) for x in decontam.contaminated(spark, docs, table).collect()}
        assert found == {(i, i % 4) for i in truth}


def test_items_whose_words_all_repeat():
    """An exact copy of an item without a word that occurs once is found whole."""
    for n in (1, 3, 10):
        ids = np.array([*range(1, n + 1)] * 3, np.int32)
        text = np.concatenate([np.zeros(37, np.int32), ids, np.zeros(50, np.int32)])
        item = decontam.Item(0, ids, np.arange(len(ids)))
        assert decontam.verify(text, 32, item) == (1.0, 1.0)
        assert decontam.verify(np.zeros(90, np.int32), 32, item) == (0.0, 0.0)


def test_latent_space_of_all_passages(spark, sources, monkeypatch):
    """Words, pairs and the space are those of every document's passages, counted one by one; tasks that hold few pairs at a time."""
    monkeypatch.setattr(decontam, "CELLS", 2_000)
    r = random.Random(23)
    texts = [" ".join(r.choice(sources).split()[:n]) for n in (r.randint(0, 70) for _ in range(4_000))] + [None, "", " ".join(sources[:400])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(i, " ".join(s.split()[:30])) for i, s in enumerate(sources[:8])], "item_id long, text string")
    block = next(decontam.read_blocks(items))
    size = len(block.vocabulary) + 1
    pairs, seen, own = np.zeros((size, size)), np.zeros(size), np.zeros((size, size))
    for t in texts:
        ids = decontam._ids(t or "", block.vocabulary)
        seen[np.unique(ids[ids > 0])] += 1
        for at in range(0, len(ids), 2 * decontam.HALF):
            w = np.unique(ids[at : at + 2 * decontam.HALF])
            pairs[np.ix_(w[w > 0], w[w > 0])] += 1
    found, total, written = decontam.word_pairs(docs, block.vocabulary)
    assert total == len(texts) and found[1:].tolist() == seen[1:].tolist()
    got = np.zeros((size, size))
    for x in written.collect():
        keys = np.frombuffer(x["keys"], np.int64)
        assert not got[keys // size, keys % size].any()
        got[keys // size, keys % size] = np.frombuffer(x["counts"], np.int64)
    assert (got == pairs).all()

    block = decontam.prepare(docs, block)
    for w in block.passages:
        own[np.ix_(w, w)] += 1
    squares = np.outer(block.weight, block.weight).astype(np.float64)
    whole = squares * (own + pairs * ((squares * own).trace() / (squares * pairs).trace()))
    values = np.linalg.eigvalsh(whole)[::-1]
    rank = block.basis.shape[1]
    assert np.trace(block.basis.T @ whole @ block.basis) >= 0.995 * values[:rank].sum()
