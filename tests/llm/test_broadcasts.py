"""Tables that grow with the documents are merged with others, however small Spark takes them to be."""

import re

from pyspark.sql import functions as F

from gridloom.llm import graph, packing, pii, quality, simhash
from gridloom.session import settle


def joins(df, key=""):
    return re.findall(rf"(\w+Join) \[{key}", df._jdf.queryExecution().executedPlan().toString())


def test_entries_of_the_index_are_merged(spark):
    """An exploded print is 70 entries, but counts as one."""
    prints = spark.createDataFrame([(0,), (1,), (1 << 40,)], "fingerprint long")
    found = simhash.links(prints)
    assert joins(found) == ["SortMergeJoin"]
    assert sorted(map(tuple, found.collect())) == [(0, 1), (0, 1 << 40), (1, 1 << 40)]


def test_facts_in_salted_copies_are_merged(spark):
    rows = settle(spark.createDataFrame([(k % 3, k) for k in range(50)], "a long, b long"))
    found = graph.beside(rows, rows.groupBy("a").agg(F.min("b").alias("m")), "a", "b")
    assert joins(found) == ["SortMergeJoin"]
    assert sorted(map(tuple, found.collect())) == sorted((k % 3, k, k % 3) for k in range(50))


def test_components_are_merged_with_their_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "A b c d e f"), (3, "x y z"), (None, None)], "doc_id long, text string")
    found = simhash.near_copies(docs)
    assert joins(found) == ["SortMergeJoin"]
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {1: 1, 2: 1, 3: 3, None: None}


TEXTS = ["the report of Quorvin went to qq@x.org in the end", *["the report of the day went to the end in time"] * 4_000]


def test_pairs_of_an_entity_and_a_word_are_merged(spark):
    docs = settle(spark.createDataFrame([(t,) for t in TEXTS], "text string"))
    found = settle(docs.select(pii.identifiers(F.col("text")).alias("spans")).where("size(spans) > 0"))
    terms = pii.disclosing_terms(docs, found)
    assert joins(terms, "term") == joins(terms, "entity") == ["SortMergeJoin"]
    assert [r["term"] for r in terms.collect()] == ["quorvin"]


def test_long_lists_of_words_are_merged_with_their_texts(spark, monkeypatch):
    docs = settle(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"))
    short = pii.find(docs)
    assert joins(short, "_gl_key") == ["BroadcastHashJoin"]
    monkeypatch.setattr(pii, "LISTED", 0)
    long = pii.find(docs)
    assert joins(long, "_gl_key") == ["SortMergeJoin"]
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, short.collect()))


def test_counts_of_lengths_are_merged_with_the_pieces(spark):
    cut = spark.createDataFrame([(i, i % 7 + 1) for i in range(40)], "doc_id long, length long")
    placed = packing.pack(cut, 8)
    assert joins(placed) == ["SortMergeJoin"]
    assert sorted(r["doc_id"] for r in placed.collect()) == list(range(40))


def test_labels_are_merged_with_their_documents(spark):
    stats = settle(spark.createDataFrame([(i, (float(i),)) for i in range(9)], "doc_id long, _gl_stats struct<x: double>"))
    labels = settle(spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 3, 50)], "doc_id long, quality int"))
    known = quality.labelled(stats, labels, F.lit(True))
    assert joins(known) == ["SortMergeJoin"]
    assert sorted((r["_gl_stats"]["x"], r["label"]) for r in known.collect()) == [(1.0, 1.0), (2.0, 0.0), (3.0, 1.0)]
