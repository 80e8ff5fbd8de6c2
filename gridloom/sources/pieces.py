"""Bytes of large files, read in splits by many tasks.

``binaryFile`` makes one cell of a file, of 2 GB at most. Here a file is read as lines, whatever its bytes mean: the line
breaks are put back and the lines of a split joined to pieces of about a megabyte, each with its place in the file.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.session import settle

#: Bytes of a piece, about; a longer run without a line break stays one.
PIECE = 1 << 20


def _join_lines(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Pieces of each split, with their place in it; lines come in the order of the file."""
    names = ["source", "size", "start", "inside", "n", "bytes"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.large_binary()]
    last, held, n, inside = None, [], 0, 0

    def piece() -> pa.RecordBatch:
        content = b"".join(held)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([*last, inside, len(content), content], types, strict=True)], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i) for i in range(3)]
        changes = np.ones(batch.num_rows, bool)
        changes[1:] = False
        for column in (keys[0], keys[2]):
            changes[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(changes).tolist()
        for begin, end in zip(begins, [*begins[1:], batch.num_rows], strict=True):
            key = tuple(k[begin].as_py() for k in keys)
            if key != last:
                if held:
                    yield piece()
                last, held, n, inside = key, [], 0, 0
            for line in batch.column("line")[begin:end]:
                content = line.as_py()
                held += (content, b"\n")
                n += len(content) + 1
                if n >= size:
                    yield piece()
                    held, n, inside = [], 0, inside + n
    if held:
        yield piece()


def file_pieces(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, size: int = PIECE) -> DataFrame:
    """``pieces(source, size, at, bytes)`` of files: ``size`` is the file's, ``at`` the place of the piece's first byte."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    # The path as other sources give it, not as an address.
    address = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    raw = reader.text(list(paths) if not isinstance(paths, str) else paths).select(
        F.regexp_replace(address, "^file:/+", "file:/").alias("source"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"),
    )
    schema = "source string, size long, start long, inside long, n long, bytes binary"
    # Written once: the places of the splits are told from it, and any piece is read again without its whole file.
    pieces = settle(raw.mapInArrow(lambda batches: _plain(_join_lines(batches, size)), schema))
    totals = pieces.groupBy("source", "start").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("source").orderBy("start")
    shifts = totals.select("source", "start", (F.sum("n").over(before) - F.col("n")).alias("shift"))
    placed = pieces.join(shifts, ["source", "start"]).withColumn("at", F.col("shift") + F.col("inside"))
    # A file need not end in a line break.
    there = F.least(F.col("n"), F.col("size") - F.col("at")).cast("int")
    return placed.select("source", "size", "at", F.substring("bytes", F.lit(1), there).alias("bytes")).filter("length(bytes) > 0")


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.set_column(5, "bytes", batch.column(5).cast(pa.binary()))


def cell_pieces(files: DataFrame, size: int = PIECE) -> DataFrame:
    """The same of contents at hand, ``files(path, content)``."""
    n = F.octet_length("content").cast("long")
    places = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(n - 1, F.lit(0)), F.lit(size).cast("long")))
    cut = files.select(F.col("path").alias("source"), n.alias("size"), "content", places.alias("at"))
    return cut.select("source", "size", "at", F.substring("content", (F.col("at") + 1).cast("int"), F.lit(size)).alias("bytes"))


def ranges(pieces: DataFrame, wanted: DataFrame, keys: Sequence[str], size: int = PIECE) -> DataFrame:
    """``wanted(keys..., source, begin, end)`` beside each piece that has a byte of the range, columns ``at`` and ``bytes``.

    Pieces and ranges meet in blocks of the file; a piece that fills several comes once.
    """
    blocks = lambda begin, end: F.explode(F.sequence(F.floor(begin / size), F.floor((end - 1) / size)))
    n = F.octet_length("bytes")
    mine = wanted.filter("end > begin").withColumn("block", blocks(F.col("begin"), F.col("end")))
    theirs = pieces.withColumn("first", F.floor(F.col("at") / size)).withColumn("block", blocks(F.col("at"), F.col("at") + n))
    met = mine.join(theirs.drop("size"), ["source", "block"])
    meets = (F.col("at") < F.col("end")) & (F.col("at") + n > F.col("begin"))
    once = F.col("block") == F.greatest(F.col("first"), F.floor(F.col("begin") / size))
    return met.filter(meets & once).select("source", *keys, "begin", "end", "at", "bytes")
