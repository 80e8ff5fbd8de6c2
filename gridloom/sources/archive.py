"""Members of zip archives, of any size.

Two steps over the pieces of an archive (``sources.pieces``): its directory, which stands at the end, becomes rows; then the members
are read by their places, neighbours together, in tasks of their own. No task sees a whole archive.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import settle
from gridloom.sources.pieces import cell_pieces, file_pieces, ranges

ARCHIVE_SUFFIXES = [".zip", ".ZIP"]
SCHEMA = "archive string, member string, content binary, error string"
#: Bytes of neighbouring members that one task reads at a time; a larger member is read alone.
UNIT = 8 << 20
#: Marks and lengths of the records at the end, with the longest comment.
END, END_64, LOCATOR = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
TAIL = 22 + 65_535 + 20 + 56
LOCAL_HEADER = 30

_MEMBER = "member string, begin long, end long, method int, packed long, crc long, locked boolean"


def _bytes(rows: pd.DataFrame, begin: int, end: int) -> bytes:
    """The bytes of a range, from the pieces that have them."""
    out = bytearray(max(0, end - begin))
    for at, part in zip(rows["at"], rows["bytes"], strict=True):
        low, high = max(begin, at), min(end, at + len(part))
        if high > low:
            out[low - begin : high - begin] = part[low - at : high - at]
    return bytes(out)


def _directory_place(tail: bytes, size: int) -> tuple[int, int, int]:
    """Begin and end of the directory in the file, and the bytes before the archive, from the file's last bytes."""
    at = tail.rfind(END)
    if at < 0 or len(tail) < at + 22:
        raise zipfile.BadZipFile("File is not a zip file")
    length, place = struct.unpack_from("<2L", tail, at + 12)
    ends = size - len(tail) + at
    if 0xFFFFFFFF in (length, place) and tail[at - 20 : at - 16] == LOCATOR:
        large = tail.rfind(END_64, 0, at - 20)
        length, place = struct.unpack_from("<2Q", tail, large + 40)
        ends = size - len(tail) + large
    if length > ends:
        raise zipfile.BadZipFile("Bad directory length")
    return ends - length, ends, ends - length - place


def _members(directory: bytes, begin: int, shift: int) -> list[tuple]:
    """Rows of the directory: each member's name, its bytes in the file with its header, and how they are packed."""
    # The library reads a directory that stands alone as that of an archive without members' bytes.
    end = struct.pack("<4s4H2LH", END, 0, 0, min(0xFFFF, directory.count(b"PK\x01\x02")), min(0xFFFF, directory.count(b"PK\x01\x02")), len(directory), 0, 0)
    with zipfile.ZipFile(io.BytesIO(directory + end)) as book:
        infos = book.infolist()
    offsets = sorted({i.header_offset for i in infos})
    after = dict(zip(offsets, [*offsets[1:], begin - shift], strict=True))
    return [
        (i.filename, i.header_offset + shift, after[i.header_offset] + shift, i.compress_type, i.compress_size, i.CRC, bool(i.flag_bits & 1))
        for i in infos
        if not i.is_dir()
    ]


def _content(held: bytes, method: int, packed: int, crc: int, locked: bool) -> bytes:
    """A member's content from its bytes in the file."""
    if held[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("Bad magic number for file header")
    if locked:
        raise RuntimeError("member is encrypted")
    name, extra = struct.unpack_from("<2H", held, 26)
    body = held[LOCAL_HEADER + name + extra : LOCAL_HEADER + name + extra + packed]
    if method == zipfile.ZIP_DEFLATED:
        body = zlib.decompress(body, -15)
    elif method != zipfile.ZIP_STORED:
        body = zipfile._get_decompressor(method).decompress(body)  # the other methods of the library
    if zlib.crc32(body) != crc:
        raise zipfile.BadZipFile("Bad CRC-32 for member")
    return body


def directory(pieces: DataFrame) -> DataFrame:
    """``source, member, begin, end, method, packed, crc, locked, error`` per member; a broken archive has one row with its error.

    The pieces at the end of an archive tell where its directory is, and mostly hold it: the others are then read by their place.
    """
    tails = pieces.filter(F.col("at") + F.octet_length("bytes") > F.col("size") - TAIL)

    def places(rows: pd.DataFrame) -> pd.DataFrame:
        source, size, held = rows["source"].iloc[0], int(rows["size"].iloc[0]), None
        try:
            begin, end, shift = _directory_place(_bytes(rows, max(0, size - TAIL), size), size)
            if begin >= int(rows["at"].min()):
                names = [c.split()[0] for c in _MEMBER.split(", ")]
                held = [dict(zip(names, m, strict=True)) for m in _members(_bytes(rows, begin, end), begin, shift)]
            found = (begin, end, shift, None)
        except Exception as e:  # noqa: BLE001 - a broken archive becomes an error row, the others go on
            found = (0, 0, 0, f"{type(e).__name__}: {e}")
        return pd.DataFrame([(source, *found, held)], columns=["source", "begin", "end", "shift", "error", "members"])

    facts = _MEMBER.replace(" ", ": ").replace(",: ", ", ")
    ends = settle(tails.groupBy("source").applyInPandas(places, f"source string, begin long, end long, shift long, error string, members array<struct<{facts}>>"))

    def members(rows: pd.DataFrame) -> pd.DataFrame:
        source, begin, end, shift = (rows[c].iloc[0] for c in ("source", "begin", "end", "shift"))
        try:
            found = [(source, *m, None) for m in _members(_bytes(rows, begin, end), begin, shift)]
        except Exception as e:  # noqa: BLE001
            found = [(source, *[None] * 7, f"{type(e).__name__}: {e}")]
        return pd.DataFrame(found, columns=["source", "member", "begin", "end", "method", "packed", "crc", "locked", "error"], dtype=object)

    told = ranges(pieces, ends.filter("error is null and members is null").drop("error", "members"), ["shift"])
    listed = told.groupBy("source").applyInPandas(members, f"source string, {_MEMBER}, error string")
    broken = ends.filter("error is not null").select("source", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in _MEMBER.split(", ")], "error")
    at_hand = ends.filter("error is null").select("source", F.explode("members").alias("m")).select("source", "m.*", F.lit(None).cast("string").alias("error"))
    return listed.unionAll(at_hand).unionAll(broken)


def expand_pieces(pieces: DataFrame, wanted: Column | None = None) -> DataFrame:
    """``(archive, member, content, error)`` of the members of archives given in pieces, or of those ``wanted`` by name."""
    listed = settle(directory(pieces))
    own = listed.filter("error is null") if wanted is None else listed.filter(F.col("error").isNull() & wanted)
    # Neighbours whose headers lie in one stretch of the file are read together.
    facts = F.struct("member", "begin", "end", "method", "packed", "crc", "locked")
    units = own.withColumn("unit", F.floor(F.col("begin") / UNIT)).groupBy("source", "unit").agg(
        F.min("begin").alias("low"), F.max("end").alias("high"), F.collect_list(facts).alias("members")
    )
    spans = units.select("source", "unit", F.col("low").alias("begin"), F.col("high").alias("end"))

    def read(rows: pd.DataFrame, unit: pd.DataFrame) -> pd.DataFrame:
        out = []
        for m in unit["members"].iloc[0] if len(unit) else []:
            source = unit["source"].iloc[0]
            try:
                held = _bytes(rows, m["begin"], m["end"])
                out.append((source, m["member"], _content(held, m["method"], m["packed"], m["crc"], m["locked"]), None))
            except Exception as e:  # noqa: BLE001 - a broken member becomes an error row
                out.append((source, m["member"], None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(out, columns=["archive", "member", "content", "error"])

    met = ranges(pieces, spans, ["unit"]).select(F.col("source").alias("archive"), F.col("unit").alias("part"), "at", "bytes")
    found = met.groupBy("archive", "part").cogroup(units.groupBy("source", "unit")).applyInPandas(read, SCHEMA)
    broken = listed.filter("error is not null").select(
        F.col("source").alias("archive"), F.lit(None).cast("string").alias("member"), F.lit(None).cast("binary").alias("content"), "error"
    )
    return found.unionAll(broken)


def member_path(archive: Column, member: Column) -> Column:
    """Archive path without extension, the last inner folder, the file name."""
    stem = F.regexp_replace(archive, r"\.[^./]*$", "")
    folder = F.regexp_extract(member, r"([^/]+)/[^/]+$", 1)
    name = F.regexp_extract(member, r"([^/]+)$", 1)
    own = F.element_at(F.split(stem, "/"), -1)
    return F.when((folder == "") | (folder == own), F.concat_ws("/", stem, name)).otherwise(
        F.concat_ws("/", stem, folder, name)
    )


def _with_path(members: DataFrame) -> DataFrame:
    return members.withColumn("path", member_path(F.col("archive"), F.col("member")))


def expand_archives(files: DataFrame) -> DataFrame:
    """``files(path, content)`` → ``(archive, member, content, error, path)``."""
    return _with_path(expand_pieces(settle(cell_pieces(files))))


def archive_expand(spark: SparkSession, root: str) -> DataFrame:
    """All archives below a folder, read in splits."""
    return _with_path(expand_pieces(file_pieces(spark, root, "*{" + ",".join(ARCHIVE_SUFFIXES) + "}")))
