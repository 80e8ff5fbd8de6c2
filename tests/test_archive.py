"""Archives read in splits: members against the library's, whatever the cuts."""

import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from gridloom.sources import archive, workbook
from gridloom.sources.pieces import cell_pieces, file_pieces


@pytest.fixture
def small_splits(spark):
    for setting in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.set(setting, "2000")
    # Spark would put so little data into one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for setting in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(setting)


def packed(seed, n, method=zipfile.ZIP_DEFLATED, comment=b"", before=b""):
    r, out = random.Random(seed), io.BytesIO()
    out.write(before)
    with zipfile.ZipFile(out, "a" if before else "w", method) as book:
        for i in range(n):
            book.writestr(f"folder{i % 3}/m{i}.bin", r.randbytes(r.choice([0, 1, 50, 700, 5_000])) + b"\n" * (i % 4))
        book.writestr("a folder/", b"")
        book.comment = comment
    return out.getvalue()


FILES = {
    "plain.zip": packed(1, 60),
    "stored.ZIP": packed(2, 9, zipfile.ZIP_STORED, b"a comment\n" * 40),
    "bzip.zip": packed(3, 3, zipfile.ZIP_BZIP2),
    "after.zip": packed(4, 5, before=b"some program\n" * 30),
    "none.zip": packed(5, 0),
}


def members(name):
    with zipfile.ZipFile(io.BytesIO(FILES[name])) as book:
        return [(name, i.filename, book.read(i)) for i in book.infolist() if not i.is_dir()]


@pytest.fixture
def folder(tmp_path):
    for name, content in FILES.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "broken.zip").write_bytes(FILES["plain.zip"][:-30])
    (tmp_path / "other.txt").write_text("no archive")
    return str(tmp_path)


def test_pieces_are_the_file(spark, folder, small_splits):
    found = {}
    pieces = file_pieces(spark, folder, size=300)
    for r in sorted(pieces.collect(), key=lambda r: r["at"]):
        name = r["source"].rsplit("/", 1)[1]
        assert len(found.setdefault(name, b"")) == r["at"]
        found[name] += r["bytes"]
    assert found["plain.zip"] == FILES["plain.zip"] and found["other.txt"] == b"no archive"
    assert pieces.filter(F.col("source").endswith("plain.zip")).count() > 20


def test_members_by_their_places(spark, folder, small_splits, monkeypatch):
    monkeypatch.setattr(archive, "UNIT", 4_000)
    found = archive.archive_expand(spark, folder)
    rows = found.filter("error is null").withColumn("task", F.spark_partition_id()).collect()
    got = sorted((r["archive"].rsplit("/", 1)[1], r["member"], bytes(r["content"])) for r in rows)
    assert got == sorted(m for name in FILES for m in members(name))
    assert [r["archive"].rsplit("/", 1)[1] for r in found.filter("error is not null").collect()] == ["broken.zip"]
    assert len({r["task"] for r in rows if r["archive"].endswith("plain.zip")}) > 1


def test_a_broken_member_spoils_no_other(spark):
    content = bytearray(FILES["stored.ZIP"])
    first = members("stored.ZIP")[3]
    at = content.find(first[2][:40]) if first[2] else 100
    content[at] ^= 1
    files = spark.createDataFrame([("x/s.zip", bytes(content)), ("x/empty.zip", b"")], "path string, content binary")
    found = archive.expand_archives(files).collect()
    bad = [r for r in found if r["error"]]
    assert {r["archive"] for r in bad} == {"x/s.zip", "x/empty.zip"} and len(bad) == 2
    assert len(found) == len(members("stored.ZIP")) + 1


def test_pieces_of_cells(spark):
    content = bytes(range(256)) * 5
    files = spark.createDataFrame([("a", content)], "path string, content binary")
    parts = sorted((r["at"], bytes(r["bytes"])) for r in cell_pieces(files, 100).collect())
    assert b"".join(p for _, p in parts) == content and [a for a, _ in parts] == list(range(0, len(content), 100))


NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def book(sheets, shared, broken=()):
    """A workbook of sheets ``{row: {column: text or place in the list of texts}}``."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as target:
        for i, rows in enumerate(sheets):
            lines = []
            for at, cells in rows.items():
                said = [
                    f'<c r="{chr(65 + c)}{at + 1}" t="s"><v>{v}</v></c>' if isinstance(v, int) else f'<c r="{chr(65 + c)}{at + 1}" t="str"><v>{v}</v></c>'
                    for c, v in cells.items()
                ]
                lines.append(f'<row r="{at + 1}">{"".join(said)}</row>')
            end = "" if i in broken else "</sheetData></worksheet>"
            target.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{NS}"><sheetData>{"".join(lines)}{end}')
        names = "".join(f'<sheet name="S{i}" sheetId="{i + 1}" r:id="r{i}"/>' for i in range(len(sheets)))
        target.writestr("xl/workbook.xml", f'<workbook xmlns="{NS}" xmlns:r="{REL}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(len(sheets)))
        target.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        target.writestr("xl/sharedStrings.xml", f'<sst xmlns="{NS}">{"".join(f"<si><t>{t}</t></si>" for t in shared)}</sst>')
    return out.getvalue()


def test_sheets_of_a_workbook_meet_their_texts(spark):
    r, shared = random.Random(7), [f"text {i}" for i in range(40)] + ["NA", ""]
    sheets = []
    for _ in range(12):
        rows = {at: {c: r.choice([r.randrange(42), "own", "NaN"]) for c in r.sample(range(7), r.randrange(0, 5))} for at in sorted(r.sample(range(30), 9))}
        sheets.append(rows)
    said = lambda v: None if v is None or (t := shared[v] if isinstance(v, int) else v) in ("", "NA", "NaN") else t
    want = []
    for i, rows in enumerate(sheets):
        width = max((c + 1 for cells in rows.values() for c, v in cells.items() if said(v) is not None), default=0)
        if width:
            want += [("b", f"S{i}", at, [said(rows.get(at, {}).get(c)) for c in range(width)], 12) for at in range(max(rows) + 1)]
    data = [("b", book(sheets, shared)), ("c", book(sheets[:2], shared, broken=[1])), ("d", packed(1, 3)), ("e", b"no zip")]
    found = workbook.decode_workbooks(spark.createDataFrame(data, "path string, content binary").repartition(3)).collect()
    got = [(x["source"], x["sheet"], x["row_idx"], x["vals"], x["n_sheets"]) for x in found if x["error"] is None]
    assert sorted(g for g in got if g[0] == "b") == sorted(want)
    assert {g[:2] for g in got if g[0] != "b"} == {("c", "S0"), ("c", "S1")}
    errors = {x["source"]: x["error"].split(":")[0] for x in found if x["error"]}
    assert errors == {"c": "ParseError", "d": "KeyError", "e": "BadZipFile"} and sum(bool(x["error"]) for x in found) == 3
