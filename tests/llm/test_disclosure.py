"""Words that stand by one identifier only."""

from gridloom.llm import pii


def test_a_name_by_one_address_is_protected(spark):
    """In a large corpus one place is enough for a word found nowhere else; common words stay."""
    texts = ["the report of Quorvin went to qq@x.org in the end", *["the report of the day went to the end in time"] * 4_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.find(docs).where("size(spans) > 0").collect()
    assert [(r.doc_id, [(s.kind, s.value) for s in r.spans]) for r in found] == [(0, [("email", "qq@x.org"), ("term", "Quorvin")])]


def test_one_place_in_a_small_corpus_is_not_enough(spark):
    texts = ["the report of Quorvin went to qq@x.org in the end", *["the report of the day went to the end in time"] * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [[s.kind for s in r.spans] for r in pii.find(docs).where("size(spans) > 0").collect()] == [["email"]]
