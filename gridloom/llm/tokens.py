"""Token counts by a two-tier lookup.

First tier: the lengths of frequent pre-tokens, counted on the map side of a few tasks over a sample of whole texts,
encoded once on the driver and broadcast. The table holds ``table_size`` pre-tokens of at most 64 characters at most,
so its size is bounded whatever the corpus. Second tier: a cache in each Python worker, filled by the library. No
pre-token is ever shuffled. The sample decides what is fast, never what is counted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm import encode
from gridloom.llm.common import text_of
from gridloom.session import ship_package

#: Pre-tokens in the broadcast table, texts they are counted in, and tasks that count.
TABLE_SIZE, SAMPLE_ROWS, SAMPLE_TASKS = 65_536, 8_192, 4


def frequent(docs: DataFrame, text: str = "text", size: int = TABLE_SIZE, rows: int = SAMPLE_ROWS) -> list[str]:
    """Frequent pre-tokens of a sample of about ``rows`` texts; each task sends ``size`` of them at most."""

    def tops(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for t in batch["t"]:
                seen.update(p for p in encode.pre_tokens(t) if len(p) <= encode.CACHED_CHARS)
            if len(seen) > 8 * size:
                seen = Counter(dict(seen.most_common(4 * size)))
        if seen:  # a frame without rows has no text column
            top = seen.most_common(size)
            yield pd.DataFrame({"piece": [p for p, _ in top], "n": [n for _, n in top]})

    total = docs.count()
    if not total:
        return []
    sample = docs.select(text_of(text).alias("t")).sample(fraction=min(1.0, rows / total), seed=42).coalesce(SAMPLE_TASKS)
    seen: Counter[str] = Counter()
    for r in sample.mapInPandas(tops, "piece string, n long").collect():
        seen[r["piece"]] += r["n"]
    return [p for p, _ in seen.most_common(size)]


def token_counter(docs: DataFrame, path: str, text: str = "text", size: int = TABLE_SIZE) -> Column:
    """Column with the number of tokens of each whole text (null: empty text, 0 tokens)."""
    spark = docs.sparkSession
    ship_package(spark)
    known = encode.Encoder(path, len, sum)
    table = spark.sparkContext.broadcast({p: known.pre_token(p) for p in frequent(docs, text, size)})

    @F.pandas_udf("long")
    def n_tokens(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lengths = encode.Encoder(path, len, sum, table.value)
        for texts in parts:
            yield pd.Series([lengths(t) for t in texts], dtype="int64")

    return n_tokens(text_of(text))


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, size: int = TABLE_SIZE) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row.

    Null and empty texts have no bytes and no tokens; rows with equal or null ids each keep a row; an empty table
    gives none; other columns are not read.
    """
    counted = docs.select("doc_id", F.octet_length(text_of()).cast("long").alias("n_bytes"), token_counter(docs, path, size=size).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
