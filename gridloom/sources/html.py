"""Tables of stored HTML pages as cells.

Only the tags are read in Python, one page at a time with the standard
library; spans, names and row roles are relational (``operators.html_tables``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL_COLUMNS = [
    "table_idx", "part", "row_idx", "cell_idx", "tag", "text", "rowspan", "colspan", "row_class",
]
CELL_SCHEMA = (
    "table_idx int, part string, row_idx int, cell_idx int, tag string, text string, "
    "rowspan int, colspan int, row_class string"
)


# The widest and highest cell markup allows; more counts as this much.
MAX_COLSPAN, MAX_ROWSPAN = 1_000, 65_534
#: Cells handed on at a time.
BATCH_CELLS = 20_000


def _span(value: str | None, most: int) -> int:
    """A span as browsers read it: the digits at its beginning, at least 1."""
    digits = re.match(r"\s*([0-9]{1,9})", value or "")
    return min(max(int(digits.group(1)), 1), most) if digits else 1


class _Tables(HTMLParser):
    """Collects ``CELL_COLUMNS`` tuples; captions and table feet are cells of their own part.

    A table inside a cell is a table of its own, numbered as it begins; its end leads back to the cell around it.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.cells: list[list] = []
        self.table = -1
        self.open = False
        self.part = "tbody"
        self.row = -1
        self.place = 0
        self.row_cells: list[list] = []
        self.row_class: str | None = None
        self.current: list | None = None
        self.around: list[tuple] = []
        self.tables = 0

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag == "table":
            if self.open:
                self.around.append((self.table, self.part, self.row, self.place, self.row_cells, self.row_class, self.current))
            self.table, self.tables = self.tables, self.tables + 1
            self.open, self.part, self.row, self.current = True, "tbody", -1, None
            self.place, self.row_cells, self.row_class = 0, [], None
        elif not self.open:
            return
        elif tag in ("thead", "tbody", "tfoot"):
            self.part = tag
            if tag == "tfoot":
                self._start(tag, 0, "tfoot", {})
        elif tag == "caption":
            self._start(tag, 0, "caption", {})
        elif self.part == "tfoot":
            return
        elif tag == "tr":
            self.row, self.place, self.row_cells, self.current = self.row + 1, 0, [], None
            self.row_class = None
        elif tag in ("td", "th"):
            self._start(tag, self.place, self.part, attrs)
            self.place += 1
            self.row_cells.append(self.current)
            if tag == "th" and self.row_class is None:
                # The first heading cell speaks for the whole row.
                self.row_class = next(iter((attrs.get("class") or "").split()), "")
                for cell in self.row_cells:
                    cell[8] = self.row_class

    def _start(self, tag, place, part, attrs):
        row = self.row if part in ("thead", "tbody") else 0
        self.current = [
            self.table, part, row, place, tag, "", _span(attrs.get("rowspan"), MAX_ROWSPAN), _span(attrs.get("colspan"), MAX_COLSPAN),
            self.row_class if part in ("thead", "tbody") else None,
        ]
        self.cells.append(self.current)

    def handle_data(self, data):
        if self.current is not None:
            self.current[5] += data if self.current[1] in ("caption", "tfoot") else data.strip()

    def handle_endtag(self, tag):
        if tag == "table":
            self.open, self.current = bool(self.around), None
            if self.around:
                self.table, self.part, self.row, self.place, self.row_cells, self.row_class, self.current = self.around.pop()
        elif tag in ("td", "th", "caption", "tfoot") and self.current is not None:
            if self.part != "tfoot" or tag == "tfoot":
                self.current = None
            if tag == "tfoot":
                self.part = "tbody"


def page_cells(html: str) -> list[list]:
    parser = _Tables()
    parser.feed(html)
    parser.close()
    return parser.cells


def html_table_cells(pages: DataFrame, keys: Sequence[str] = ("url",), html: str = "html") -> DataFrame:
    """Cells of every table of every page, with part, spans and the class of the row's first ``th``."""
    keys = list(keys)
    types = dict(pages.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", " + CELL_SCHEMA

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[list] = []
        for batch in batches:
            for *key, text in batch[[*keys, html]].itertuples(index=False, name=None):
                found += [[*key, *c] for c in page_cells(text or "")]
                if len(found) >= BATCH_CELLS:
                    yield pd.DataFrame(found, columns=[*keys, *CELL_COLUMNS])
                    found = []
        if found:
            yield pd.DataFrame(found, columns=[*keys, *CELL_COLUMNS])

    # Pages without a table are left out before any of them goes to Python.
    with_table = pages.filter(F.col(html).rlike("(?i)<table"))
    return with_table.select(*keys, html).mapInPandas(parse, schema)


def simple_table_rows(cells: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    """Rows of the first table of a page: all ``th`` texts, then all ``td`` texts."""
    ordered = F.array_sort(F.collect_list(F.struct((F.col("tag") == "td").alias("td"), "cell_idx", "text")))
    first = cells.filter((F.col("table_idx") == 0) & F.col("tag").isin("th", "td"))
    return first.groupBy(*keys, "row_idx").agg(F.transform(ordered, lambda c: c["text"]).alias("vals"))


def page_notes(pages: DataFrame, keys: Sequence[str] = ("url",), html: str = "html") -> DataFrame:
    """``header`` (first ``h1`` and the view header) and ``footer`` (view footer) of a page."""
    plain = lambda c: F.trim(F.regexp_replace(c, r"(?s)\s*<[^>]*>\s*", ""))
    block = lambda name: F.regexp_extract(html, rf'(?is)<div[^>]*class="(?:[^"]*\s)?{name}(?:\s[^"]*)?"[^>]*>(.*?)</div>', 1)
    has = lambda name: F.col(html).rlike(rf'(?is)<div[^>]*class="(?:[^"]*\s)?{name}(?:\s[^"]*)?"')
    title = plain(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1))
    header = F.when(has("view-header"), F.concat_ws(". ", title, plain(block("view-header")))).otherwise(title)
    return pages.select(*keys, header.alias("header"), plain(block("view-footer")).alias("footer"))
