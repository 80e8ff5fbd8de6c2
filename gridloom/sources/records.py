"""Records of CSV files whose quoted values hold line breaks, read in splits.

Where a record ends depends on the quotes since the start of the file, so Spark reads such files in one task each. Here
they are read by lines, in splits, as text files are:

1. each split tells where it would end, inside quotes or outside, for either start;
2. over one row per split, these give the start of every split;
3. each split cuts its own records from its start; a record over several splits is put together from its parts.

Lines end in ``\\n`` or ``\\r\\n``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.session import settle, ship_package

_SPLIT = ["source", "start"]


@cache
def _patterns(separator: str, quote: str, escape: str) -> tuple[re.Pattern, re.Pattern]:
    """A line from outside quotes, and the rest of a quoted value."""
    s, q, e = re.escape(separator), re.escape(quote), re.escape(escape)
    held = f"{q}{q}" if escape == quote else f"{e}."
    plain = f"[^{q}]" if escape == quote else f"[^{q}{e}]"
    body = f"{plain}*+(?:{held}{plain}*+)*+"
    outside = re.compile(f"(?:(?:{q}{body}{q}[^{s}]*+|[^{q}{s}][^{s}]*+|){s})*+(?:(?P<last>{q}{body})(?P<closed>{q})?)?", re.S)
    return outside, re.compile(f"{body}(?P<closed>{q})?[^{s}]*+{s}?", re.S)


def after_line(line: str, inside: bool, separator: str = ",", quote: str = '"', escape: str = "\\") -> bool:
    """Whether a line ends inside quotes."""
    outside, rest = _patterns(separator, quote, escape)
    at = 0
    if inside:
        found = rest.match(line)
        if found["closed"] is None:
            return True
        at = found.end()
    found = outside.match(line, at)
    return found["last"] is not None and found["closed"] is None


def _segments(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple[tuple, pa.Array]]:
    """Lines of one split after the other, in the order they are read; a split may come in several pieces."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = [batch.column(name) for name in names]
        changes = np.zeros(n, bool)
        changes[0] = True
        for column in keys[:2]:
            changes[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(changes).tolist()
        for begin, end in zip(begins, [*begins[1:], n], strict=True):
            yield tuple(k[begin].as_py() for k in keys), batch.column("value")[begin:end]


def csv_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    header: bool = False,
    separator: str = ",",
    quote: str = '"',
    escape: str = "\\",
) -> DataFrame:
    """``records(source, value)``: one row per record that is not empty, with the line breaks inside quotes.

    With ``header`` the first record of every file goes.
    """
    ship_package(spark)
    raw = spark.read.option("lineSep", "\n").text(list(paths) if not isinstance(paths, str) else paths).select(
        F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("start"), "value"
    )

    def turn(line: str, inside: bool) -> bool:
        return after_line(line, inside, separator, quote, escape)

    def quoted(values: pa.Array) -> np.ndarray:
        return np.flatnonzero(pc.match_substring(values, quote).to_numpy(zero_copy_only=False))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[tuple, list[bool]] = {}
        for key, values in _segments(batches, _SPLIT):
            state = ends.setdefault(key, [False, True, False])
            for line in values.take(pa.array(quoted(values))).to_pylist():
                state[0], state[1] = turn(line, state[0]), turn(line, state[1])
            state[2] = state[2] or bool(pc.any(pc.not_equal(pc.utf8_rtrim(values, "\r"), "")).as_py())
        if ends:
            columns = [[k[0] for k in ends], [k[1] for k in ends], *[[v[i] for v in ends.values()] for i in range(3)]]
            types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*_SPLIT, "out", "in", "filled"])

    told = raw.mapInArrow(tell, "source string, start long, out boolean, in boolean, filled boolean")
    # A split either ends the same way from both starts, or turns the state, or leaves it.
    above = Window.partitionBy("source").orderBy("start")
    past = above.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.sum((F.col("out") & ~F.col("in")).cast("int")).over(above)
    known = F.when(F.col("out") == F.col("in"), F.struct(F.col("out").cast("int").alias("state"), F.col("turns")))
    last = F.last(known, ignorenulls=True).over(past)
    so_far = F.coalesce(F.lag("turns").over(above), F.lit(0))
    inside = (F.coalesce(last["state"], F.lit(0)) + so_far - F.coalesce(last["turns"], F.lit(0))) % 2 == 1
    first = F.min(F.when(F.col("filled"), F.col("start"))).over(Window.partitionBy("source")) == F.col("start")
    starts = settle(
        told.withColumn("turns", turns)
        .select("*", inside.alias("inside"), F.coalesce(first, F.lit(False)).alias("first"))
        .select(*_SPLIT, "inside", "first", F.when(F.col("inside"), F.col("in")).otherwise(F.col("out")).alias("ends_inside"))
    )

    def cut(batches: Iterator[pa.RecordBatch], parts: bool) -> Iterator[pa.RecordBatch]:
        """Whole records of each split, or else the parts of records that go on beyond it."""
        last: tuple | None = None
        state, held, begun, heading = False, [], False, False
        out: list[tuple] = []

        def close(whole: bool) -> None:
            """The record in hand ends, or its split does."""
            nonlocal heading, begun
            text = "\n".join(held)
            held.clear()
            named = heading and text.rstrip("\r") != ""
            if (begun and whole) == (not parts) and not (named and not parts):
                out.append((last[0], text, last[1], not begun, named))
            if named:
                heading = False
            begun = True

        names = [*_SPLIT, "inside", "first"]

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            types = [pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["source", "value", "start", "goes_on", "heading"]
            )
            out.clear()
            return batch

        for key, values in _segments(batches, names):
            if key != last:
                if held:
                    close(False)
                last, state, begun = key, key[2], not key[2]
                heading = header and key[3]
            lines, at = values.to_pylist(), 0
            for spot in [*quoted(values).tolist(), len(lines)]:
                plain = lines[at:spot]
                if state:
                    held.extend(plain)
                else:
                    for line in plain:
                        held.append(line)
                        close(True)
                if spot < len(lines):
                    held.append(lines[spot])
                    state = turn(lines[spot], state)
                    if not state:
                        close(True)
                at = spot + 1
            if len(out) >= 10_000:
                yield flush()
        if held:
            close(False)
        if out:
            yield flush()

    schema = "source string, value string, start long, goes_on boolean, heading boolean"
    # The order of a split's lines is that of its task; a shuffled join would lose it.
    placed = raw.withColumn("at", F.monotonically_increasing_id()).join(starts, _SPLIT)
    ordered = placed.sortWithinPartitions(*_SPLIT, "at").drop("at")
    records = ordered.drop("ends_inside").mapInArrow(lambda b: cut(b, False), schema).select("source", "value")
    if not starts.filter("inside or ends_inside").isEmpty():
        open_splits = ordered.filter(F.col("inside") | F.col("ends_inside")).drop("ends_inside")
        parts = open_splits.mapInArrow(lambda b: cut(b, True), schema)
        # A part that does not go on from the split before opens the record.
        opens = (~F.col("goes_on")).cast("int")
        in_order = Window.partitionBy("source").orderBy("start", F.desc("goes_on"))
        numbered = parts.withColumn("record", F.sum(opens).over(in_order))
        pieces = F.array_sort(F.collect_list(F.struct("start", (~F.col("goes_on")).alias("opens"), "value")))
        joined = numbered.groupBy("source", "record").agg(
            F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("value"), F.max("heading").alias("heading")
        )
        records = records.unionAll(settle(joined.filter("not heading").select("source", "value")))
    bare = F.when(F.col("value").endswith("\r"), F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value"))
    return records.select("source", bare.alias("value")).filter("value != ''")
