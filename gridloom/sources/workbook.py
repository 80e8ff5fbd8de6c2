"""Workbook files (``.xlsx``) as grid rows.

The file format is a zip of XML parts, read as ``sources.archive`` reads members. The small parts of a workbook tell its sheets and
styles; every sheet is then parsed once, in a task of its own, and emits its rows batch by batch. Cells that refer to the
workbook's list of texts meet it in a join, so no task holds that list. The width of a sheet is an aggregate over its rows.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from datetime import datetime, timedelta
from functools import cache
from xml.etree import ElementTree

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.ordered import join_facts, no_blocks, with_blocks
from gridloom.session import settle
from gridloom.sources.archive import expand_pieces
from gridloom.sources.files import with_suffix
from gridloom.sources.pieces import cell_pieces, file_pieces

SCHEMA = "source string, sheet string, row_idx long, vals array<string>, n_sheets int, error string"
BATCH_ROWS = 4096
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``source, at, text`` of the lists of texts."""
    for batch in batches:
        for source, content in zip(batch["source"], batch["content"], strict=True):
            held = []
            for at, text in enumerate(_string_items(content)):
                held.append((source, at, text))
                if len(held) == BATCH_ROWS:
                    yield pd.DataFrame(held, columns=["source", "at", "text"])
                    held = []
            if held:
                yield pd.DataFrame(held, columns=["source", "at", "text"])


def _string_items(content: bytes) -> Iterator[str]:
    for _, node in ElementTree.iterparse(io.BytesIO(content)):
        if node.tag == _MAIN + "si":
            yield "".join(t.text or "" for t in node.iter(_MAIN + "t"))
            node.clear()


def _sheets(workbook: bytes, relations: bytes) -> list[tuple[str, str]]:
    targets = {n.get("Id"): n.get("Target", "") for n in ElementTree.fromstring(relations)}
    names = ElementTree.fromstring(workbook).iter(_MAIN + "sheet")
    path = lambda t: t.lstrip("/") if t.startswith("/") else "xl/" + t
    return [(n.get("name", ""), path(targets[n.get(_RELATION)])) for n in names]


@cache
def _column_number(letters: str) -> int:
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - 64
    return number - 1


def _column(reference: str) -> int:
    letters = reference.rstrip("0123456789")
    return _column_number(letters if len(letters) == 1 and "A" <= letters <= "Z" else re.match(r"[A-Z]*", reference).group())


# Texts that stand for no value, number formats that show a date or a time, and day zero of both calendars.
MISSING = {
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
    "None", "n/a", "nan", "null",
}
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
DAY_ZERO, DAY_ZERO_1904 = datetime(1899, 12, 30), datetime(1904, 1, 1)
# What a custom format shows literally, and its colours, conditions and elapsed times.
_LITERAL = re.compile(r'"[^"]*"|\\.|_.|\*.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', re.IGNORECASE)


def _date_styles(styles: bytes | None) -> list[bool]:
    if styles is None:
        return []
    root = ElementTree.fromstring(styles)
    custom = {int(n.get("numFmtId", 0)): n.get("formatCode", "") for n in root.iter(_MAIN + "numFmt")}
    formats = root.find(_MAIN + "cellXfs")
    ids = [int(x.get("numFmtId", 0)) for x in formats] if formats is not None else []
    shows = lambda code: bool(re.search("[dmyhs]", _LITERAL.sub("", code), re.IGNORECASE)) and code.lower() != "general"
    return [shows(custom[i]) if i in custom else i in DATE_FORMATS for i in ids]


def _number(value: str, is_date: bool, zero: datetime) -> str:
    """A number as its shortest text; a date with its time of day, a time alone below one day."""
    if is_date:
        moment = zero + timedelta(seconds=round(float(value) * 86_400))
        return str(moment.time() if 0 <= float(value) < 1 else moment)
    return str(float(value)) if "." in value or "e" in value or "E" in value else str(int(value))


def _text(cell, dates: list[bool], zero: datetime) -> tuple[str | None, int | None]:
    """The text of a cell, or its place in the list of texts."""
    kind = cell.get("t")
    if kind == "inlineStr":
        value = "".join(t.text or "" for t in cell.iter(_MAIN + "t"))
        return None if value in MISSING else value, None
    value = cell.findtext(_MAIN + "v")
    if value is None or kind == "e":
        return None, None
    if kind == "s":
        return None, int(value)
    if kind == "b":
        return "True" if value == "1" else "False", None
    if kind in (None, "n"):
        style = int(cell.get("s", 0))
        return _number(value, style < len(dates) and dates[style], zero), None
    if kind == "d":
        return str(datetime.fromisoformat(value.replace("Z", ""))), None
    return None if value in MISSING else value, None


def _rows(content: bytes, dates: list[bool], zero: datetime) -> Iterator[tuple[int, list, list]]:
    """Rows of a sheet, gaps between them filled: place, cells ``(column, text)``, cells ``(column, place in the list)``."""
    at, expected = -1, 0
    for _, node in ElementTree.iterparse(io.BytesIO(content)):
        if node.tag != _MAIN + "row":
            continue
        at = int(node.get("r", at + 2)) - 1
        for gap in range(expected, at):
            yield gap, [], []
        expected = at + 1
        texts, shared, column = {}, {}, -1
        for c in node.iter(_MAIN + "c"):
            column = _column(c.get("r")) if c.get("r") else column + 1
            text, place = _text(c, dates, zero)
            if text is not None:
                texts[column] = text
            elif place is not None:
                shared[column] = place
        node.clear()
        yield at, list(texts.items()), list(shared.items())


# The parts that tell a workbook's sheets and styles, its list of texts, and the sheets.
_FACTS = ["xl/workbook.xml", "xl/_rels/workbook.xml.rels", "xl/styles.xml"]
_STRINGS = "xl/sharedStrings.xml"


def _facts(parts: pd.DataFrame) -> pd.DataFrame:
    source, found = parts["source"].iloc[0], dict(zip(parts["member"], parts["content"], strict=True))
    names = ["source", "sheets", "dates", "late", "error"]
    try:
        for part in _FACTS[:2]:
            if part not in found:
                raise KeyError(f"There is no item named '{part}' in the archive")
        properties = ElementTree.fromstring(found[_FACTS[0]]).find(_MAIN + "workbookPr")
        late = properties is not None and properties.get("date1904") in ("1", "true")
        sheets = [{"place": i, "sheet": n, "member": p} for i, (n, p) in enumerate(_sheets(found[_FACTS[0]], found[_FACTS[1]]))]
        told = (source, sheets, _date_styles(found.get(_FACTS[2])), late, None)
    except Exception as e:  # noqa: BLE001 - a broken file becomes an error row, the others go on
        told = (source, [], [], False, f"{type(e).__name__}: {e}")
    return pd.DataFrame([told], columns=names)


_CELL = "array<struct<col: int, text: string>>"
_PARSED = f"source string, sheet string, place int, n_sheets int, row_idx long, cells {_CELL}, shared array<struct<col: int, at: int>>, error string"


_CELL_TYPE, _SHARED_TYPE = (pa.list_(pa.struct([("col", pa.int32()), (name, kind)])) for name, kind in (("text", pa.string()), ("at", pa.int32())))
_PARSED_TYPES = pa.schema(
    [
        ("source", pa.string()), ("sheet", pa.string()), ("place", pa.int32()), ("n_sheets", pa.int32()), ("row_idx", pa.int64()),
        ("cells", _CELL_TYPE), ("shared", _SHARED_TYPE), ("error", pa.string()),
    ]
)


def _pairs(rows: list[list[tuple]], kind: pa.ListType) -> pa.ListArray:
    """Lists of pairs, from flat columns."""
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = [pair for row in rows for pair in row]
    columns = [pa.array([pair[i] for pair in flat], kind.value_type.field(i).type) for i in range(2)]
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, fields=list(kind.value_type)), type=kind)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(sheet: dict, rows: list[tuple]) -> pa.RecordBatch:
        facts = [pa.array([sheet[name]] * len(rows), _PARSED_TYPES.field(name).type) for name in ("source", "sheet", "place", "n_sheets")]
        at, cells, shared = zip(*rows, strict=True)
        lists = [pa.array(at, pa.int64()), _pairs(cells, _CELL_TYPE), _pairs(shared, _SHARED_TYPE)]
        return pa.RecordBatch.from_arrays([*facts, *lists, pa.nulls(len(rows), pa.string())], schema=_PARSED_TYPES)

    for batch in batches:
        for i in range(batch.num_rows):
            sheet = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            pending = []
            try:
                if sheet["content"] is None:
                    raise KeyError(f"There is no item named '{sheet['member']}' in the archive")
                for row in _rows(sheet["content"], sheet["dates"], DAY_ZERO_1904 if sheet["late"] else DAY_ZERO):
                    pending.append(row)
                    if len(pending) == BATCH_ROWS:
                        full, pending = pending, []
                        yield batch_of(sheet, full)
                if pending:
                    full, pending = pending, []
                    yield batch_of(sheet, full)
            except Exception as e:  # noqa: BLE001 - a broken sheet becomes an error row, the others go on
                if pending:
                    yield batch_of(sheet, pending)
                told = {"source": sheet["source"], "place": sheet["place"], "error": f"{type(e).__name__}: {e}"}
                yield pa.RecordBatch.from_pylist([told], schema=_PARSED_TYPES)


def workbook_parts(pieces: DataFrame) -> DataFrame:
    """Rows of every sheet of workbooks given in pieces (``sources.pieces``), and error rows (``error`` not NULL)."""
    wanted = F.col("member").isin(*_FACTS, _STRINGS) | F.col("member").like("xl/%.xml")
    parts = settle(expand_pieces(pieces, wanted).withColumnRenamed("archive", "source"))
    readable = parts.filter("error is null")
    small = readable.filter(F.col("member").isin(_FACTS)).groupBy("source").applyInPandas(
        _facts, "source string, sheets array<struct<place: int, sheet: string, member: string>>, dates array<boolean>, late boolean, error string"
    )
    # An archive without any such part is no workbook.
    every = pieces.select("source").distinct()
    told = settle(every.join(small, "source", "left"))
    listed = told.filter("error is null and sheets is not null").select(
        "source", "dates", "late", F.size("sheets").alias("n_sheets"), F.explode("sheets").alias("s")
    ).select("source", "s.*", "dates", "late", "n_sheets")
    content = readable.select("source", "member", "content")
    # A sheet is dealt out by its name: each to a task.
    sheets = listed.join(content, ["source", "member"], "left").repartition("source", "sheet", "place")
    parsed = settle(sheets.select("source", "sheet", "place", "member", "content", "dates", "late", "n_sheets").mapInArrow(_parse, _PARSED))
    strings = content.filter(F.col("member") == _STRINGS).mapInPandas(_strings, "source string, at int, text string")

    key = ["source", "place", "row_idx"]
    asked = parsed.filter("size(shared) > 0").select(*key, F.explode("shared").alias("c")).select(*key, "c.col", "c.at")
    said = asked.join(strings, ["source", "at"]).filter(~F.col("text").isin(*MISSING))
    found = said.groupBy(*key).agg(F.collect_list(F.struct("col", "text")).alias("texts"))
    rows = parsed.filter("error is null").drop("error", "shared").join(found, key, "left")
    cells = F.array_sort(F.concat("cells", F.coalesce("texts", F.array().cast(_CELL))))
    grid = settle(with_blocks(rows.select(*key, "sheet", "n_sheets", cells.alias("cells")), "row_idx"))
    widths = grid.groupBy("source", "place").agg(F.max(F.try_element_at("cells", F.lit(-1))["col"] + 1).alias("width")).filter("width > 0")
    placed = no_blocks(join_facts(grid, widths, ["source", "place"]))
    # Each cell with the gap before it, then the gap up to the width.
    gap = lambda n: F.array_repeat(F.lit(None).cast("string"), n)
    before = lambda c, i: F.when(i > 0, F.get("cells", i - 1)["col"]).otherwise(-1)
    filled = F.flatten(F.transform("cells", lambda c, i: F.concat(gap(c["col"] - before(c, i) - 1), F.array(c["text"]))))
    last = F.coalesce(F.try_element_at("cells", F.lit(-1))["col"], F.lit(-1))
    vals = F.concat(filled, gap(F.col("width") - last - 1))
    good = placed.select("source", "sheet", "row_idx", vals.alias("vals"), "n_sheets", F.lit(None).cast("string").alias("error"))

    none = [F.lit(None).cast(t).alias(c) for c, t in (("sheet", "string"), ("row_idx", "long"), ("vals", "array<string>"), ("n_sheets", "int"))]
    missing = told.filter("sheets is null").select("source", *none, F.lit(f"KeyError: There is no item named '{_FACTS[0]}' in the archive").alias("error"))
    no_zip = parts.filter("error is not null").select("source", "error")
    unread = told.filter("error is not null").select("source", "error").unionAll(parsed.filter("error is not null").select("source", "error")).unionAll(no_zip)
    # What is wrong with the archive tells more than what it therefore lacks.
    lacking = missing.join(no_zip.select("source").distinct(), "source", "left_anti").select(*good.columns)
    return good.unionAll(unread.select("source", *none, "error")).unionAll(lacking)


def decode_workbooks(files: DataFrame) -> DataFrame:
    """``files(path, content)`` → rows of every sheet, padded to its width, and error rows (``error`` not NULL)."""
    return workbook_parts(settle(cell_pieces(files)))


def workbook_rows(spark: SparkSession, root: str, suffixes: tuple[str, ...] = (".xlsx",)) -> DataFrame:
    """All workbooks below a folder, read in splits."""
    return workbook_parts(with_suffix(file_pieces(spark, root, "*{" + ",".join(suffixes) + "}"), list(suffixes), "source"))


def sheet_path(rows: DataFrame, always: bool = False) -> DataFrame:
    """``table_path``: the file without extension, and the sheet if there are several."""
    stem = F.regexp_replace("source", r"\.[^./]*$", "")
    named = F.concat_ws("/", stem, "sheet")
    path = named if always else F.when(F.col("n_sheets") > 1, named).otherwise(stem)
    return rows.withColumn("table_path", F.replace(path, F.lit(" "), F.lit("_")))
