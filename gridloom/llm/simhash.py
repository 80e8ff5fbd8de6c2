"""Near copies by SimHash fingerprints.

Fingerprints of 64 bits are eight positional bytes. Two that differ in ``distance`` <= 4 bits share at least
8 - distance bytes in place: the guaranteed minimum. A plain list per (position, byte) holds a 256th of all rows, so
the inverted index is kept over all groups of that many positions: 70 groups of four, lists of 32 bits. A pair that
shares n bytes meets in as many lists as n has groups, so it has reached the minimum if it meets in any list, and the
number of lists tells its tally: what the count filter drops never forms a pair. Each pair is taken once, from the
first group it shares, and verified bit by bit. Equal fingerprints are one entry, so exact copies never form pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import text_of
from gridloom.llm.graph import beside, components
from gridloom.session import settle, ship_package

BYTES = 8


def position_groups(shared: int) -> list[tuple[int, ...]]:
    """All groups of ``shared`` positions: two fingerprints share that many bytes if and only if they agree in a group."""
    if shared < 4:
        raise ValueError("distances above 4 bits share too few bytes")
    return list(combinations(range(BYTES), shared))


def fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text") -> DataFrame:
    """All columns but the text plus ``fingerprint`` (signed 64 bits), which replaces a column of that name.

    Null texts are empty, with fingerprint 0.
    """
    ship_package(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (text, "fingerprint")]
    frame = docs.select(*kept, text_of(text).alias("_gl_text"))
    schema = frame.drop("_gl_text").schema.add("fingerprint", "long")

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("_gl_text"))
            found = pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, found], names=[*batch.schema.names[:-1], "fingerprint"])

    return frame.mapInArrow(prints, schema)


def fingerprint(text: str, shingle: int) -> int:
    """Bit i is set if it is set in over half the hashes of the text's word shingles."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    ones = np.zeros(64, np.int64)
    step = 1 << 18
    for i in range(0, n, step):
        spans = zip(starts[i : min(n, i + step)].tolist(), last[i : i + step].tolist(), strict=True)
        hashes = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def links(prints: DataFrame, distance: int = 4, column: str = "fingerprint") -> DataFrame:
    """Pairs ``a < b`` of different fingerprints that differ in at most ``distance`` bits, each once."""
    groups = position_groups(BYTES - distance)
    distinct = settle(prints.select(F.col(column).alias("print")).where("print is not null").distinct())

    def mask(group: tuple[int, ...]) -> int:
        m = sum(255 << (8 * p) for p in group)
        return m - (1 << 64) if m >= 1 << 63 else m

    entries = F.array(*[F.struct(F.lit(i).cast("byte").alias("list"), F.col("print").bitwiseAND(F.lit(mask(g))).alias("bytes")) for i, g in enumerate(groups)])
    index = distinct.select("print", F.explode(entries).alias("e")).select("print", "e.list", "e.bytes")
    a, b = index.alias("a"), index.alias("b")
    xor = F.col("a.print").bitwiseXOR(F.col("b.print"))
    first = reduce(lambda f, i: F.when(xor.bitwiseAND(F.lit(mask(groups[i]))) == 0, i).otherwise(f), reversed(range(len(groups))), F.lit(len(groups)))
    near = (
        (F.col("a.list") == F.col("b.list"))
        & (F.col("a.bytes") == F.col("b.bytes"))
        & (F.col("a.print") < F.col("b.print"))
        & (F.bit_count(xor) <= distance)
        & (first == F.col("a.list"))
    )
    # Spark takes an exploded table to be as small as what it was made of, and would broadcast all entries of a million prints.
    return a.join(b.hint("merge"), near).select(F.col("a.print").alias("a"), F.col("b.print").alias("b"))


def near_copies(docs: DataFrame, shingle: int = 4, distance: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All columns but the text, plus ``fingerprint``, ``component`` (its smallest fingerprint) and ``component_id``.

    The latter is the smallest ``key`` reachable over links. Columns of these names are replaced. Texts without a word have fingerprint 0 and are linked like any other. Rows with equal ids each keep a row; a
    component of rows without an id has a null ``component_id``. An empty table gives none.
    """
    replaced = [c for c in ("component", "component_id") if c not in (key, text)]
    prints = settle(fingerprints(docs.drop(*replaced), shingle, text))
    found = settle(links(prints, distance))
    least = prints.groupBy("fingerprint").agg(F.min(key).alias("_least"))
    roots = components(found).withColumnsRenamed({"node": "fingerprint", "root": "component"})
    linked = settle(least.join(roots, "fingerprint"))
    smallest = linked.groupBy("component").agg(F.min("_least").alias("component_id"))
    named = beside(linked, smallest, "component", "fingerprint").select("fingerprint", "component", "component_id")
    alone = F.col("component").isNull()
    ids = least.join(named, "fingerprint", "left").select(
        "fingerprint",
        F.coalesce("component", "fingerprint").alias("component"),
        F.when(alone, F.col("_least")).otherwise(F.col("component_id")).alias("component_id"),
    )
    # As long as the table, however small its files are.
    return prints.join(settle(ids).hint("merge"), "fingerprint").select(*prints.columns, "component", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """Columns of ``docs``, one row of each component: the smallest id (rows without an id come last)."""
    named = settle(docs.withColumn("_gl_row", F.monotonically_increasing_id()))
    found = near_copies(named.select("_gl_row", "doc_id", "text"), shingle, distance)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "fingerprint", "_gl_row")
    best = found.groupBy("component").agg(F.min(order)["_gl_row"].alias("_gl_row"))
    return named.join(best.select("_gl_row"), "_gl_row", "left_semi").drop("_gl_row")
