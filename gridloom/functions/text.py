"""Scalar column expressions: cleaning, naming, paths and URLs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters replaced by "_" in column names, per family of files.
CSV_NAME_CHARACTERS = " .()"
LAYOUT_NAME_CHARACTERS = " ,;{}()\n\t="
MAX_NAME_LENGTH = 255

# Code points that names are cleaned of without a pattern, ASCII to Cyrillic and general punctuation.
COMMON_CHARACTERS = [*range(0x530), *range(0x2000, 0x2070)]

# Fixed value: white space in the Unicode sense, control separators included.
WHITE_SPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def quote_regex(literal: str) -> str:
    """The literal as a pattern that matches only itself."""
    return "".join(c if c.isalnum() or c in "_/ " else "\\" + c for c in literal)


def any_of(patterns: Sequence[str]) -> str:
    """One pattern that matches where any of ``patterns`` does."""
    return "|".join(f"(?:{p})" for p in patterns)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def strip_left(c: Column) -> Column:
    return F.ltrim(c, F.lit(WHITE_SPACE))


def null_normalise(c: Column) -> Column:
    """Blank text and the text ``nan`` become NULL."""
    return F.when(~strip(c).isin("", "nan"), c)


def is_alpha(c: Column) -> Column:
    return c.rlike(r"^\p{L}+$")


def is_digits(c: Column) -> Column:
    return c.rlike(r"^\d+$")


def starts_with_letter(c: Column) -> Column:
    return c.rlike(r"^\p{L}")


def indent_level(c: Column) -> Column:
    """Number of leading white space characters."""
    return (F.length(c) - F.length(strip_left(c))).cast("int")


# ---- column names -------------------------------------------------------


def _underscored(c: Column, kept: str = "") -> Column:
    """Every character but ASCII letters, digits and those in ``kept`` as ``_``.

    A pattern takes some ten times as long as ``translate``; it is left for texts with still other characters, which then
    have more bytes than characters.
    """
    others = "".join(chr(i) for i in COMMON_CHARACTERS if not (i < 128 and chr(i).isalnum()) and chr(i) not in kept)
    plain = F.translate(c, others, "_" * len(others))
    rare = F.octet_length(plain) > F.length(plain)
    return F.when(rare, F.regexp_replace(plain, f"[^a-zA-Z0-9_{kept}]", "_")).otherwise(plain)


def clean_name_excel(c: Column, position: Column) -> Column:
    name = _underscored(F.replace(strip(c), F.lit(".0"), F.lit("")))
    return F.coalesce(name, F.concat(F.lit("col_"), position.cast("string")))


def clean_name_html(c: Column, position: Column) -> Column:
    name = _underscored(F.replace(strip(c), F.lit(".0"), F.lit("")))
    return F.coalesce(F.regexp_replace(name, "^_+|_+$", ""), F.concat(F.lit("col_"), position.cast("string")))


def clean_name_dl(c: Column, position: Column) -> Column:
    name = _underscored(F.replace(strip(c), F.lit(".0"), F.lit("")), "%#")
    return F.when(F.length(strip(c)) > 1, name).otherwise(F.concat(F.lit("col_"), position.cast("string")))


def clean_name_text(c: Column) -> Column:
    """NULL for an empty name: such a field gets no column."""
    return F.when(c != "", F.regexp_replace(strip(c), "[^A-Za-z0-9]+", "_"))


def clean_name_csv(c: Column) -> Column:
    return F.translate(c, CSV_NAME_CHARACTERS, "_" * len(CSV_NAME_CHARACTERS))


def clean_name_layout(c: Column) -> Column:
    return F.translate(c, LAYOUT_NAME_CHARACTERS, "_" * len(LAYOUT_NAME_CHARACTERS))


def truncate_name(c: Column, length: int = MAX_NAME_LENGTH) -> Column:
    return F.substring(c, 1, length)


def caption_key(c: Column) -> Column:
    """Table key of a caption: the part before the dash without its last character."""
    head = strip(F.substring_index(strip(c), "–", 1))
    return F.translate(_drop_last(head), " .", "__")


def _drop_last(c: Column) -> Column:
    return F.substring(c, F.lit(1), F.greatest(F.length(c) - 1, F.lit(0)))


# ---- paths and URLs -----------------------------------------------------


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_folder(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*/)[^/]*$", 1)


def path_segment(path: Column, position: int) -> Column:
    """0-based segment of a path, NULL where there is none."""
    return F.try_element_at(F.split(path, "/"), F.lit(position + 1))


def matches_any(c: Column, patterns: Sequence[str]) -> Column:
    return c.rlike(any_of(patterns)) if patterns else F.lit(True)


def contains_any(c: Column, literals: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(x) for x in literals]) if literals else F.lit(False)


def ends_with_any(c: Column, suffixes: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.endswith(x) for x in suffixes]) if suffixes else F.lit(False)


def dedupe_path_segments(path: Column) -> Column:
    return F.array_join(F.array_distinct(F.split(path, "/")), "/")


def url_quote(c: Column) -> Column:
    """Percent quoting that leaves ``:`` and ``/`` alone."""
    # What form encoding and plain percent quoting spell differently.
    out = F.url_encode(c)
    for encoded, plain in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/"), ("%3A", ":")):
        out = F.replace(out, F.lit(encoded), F.lit(plain))
    return out


# Named character references of markup; the ampersand comes last, so that none is read twice.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&"))


def unescape(c: Column) -> Column:
    """Character references as the characters they stand for: basic names, decimal and hexadecimal numbers."""

    def character(number: Column) -> Column:
        code = F.when(F.lower(F.left(number, F.lit(1))) == "x", F.conv(F.substr(number, F.lit(2)), 16, 10)).otherwise(number)
        return F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")

    numbers = F.array_distinct(F.regexp_extract_all(c, F.lit("&#([xX][0-9A-Fa-f]{1,5}|[0-9]{1,6});"), F.lit(1)))
    replaced = F.aggregate(numbers, c, lambda out, n: F.replace(out, F.concat(F.lit("&#"), n, F.lit(";")), character(n)))
    out = F.when(F.contains(c, F.lit("&#")), replaced).otherwise(c)
    for name, plain in REFERENCES:
        out = F.replace(out, F.lit(name), F.lit(plain))
    return out


def site_root(url: Column) -> Column:
    """Scheme and host of a URL."""
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def output_path(path: Column, prefix: str = "") -> Column:
    """Prefix and extension removed, spaces as ``_``."""
    relative = F.regexp_replace(path, "^" + quote_regex(prefix), "") if prefix else path
    return F.replace(F.regexp_replace(relative, r"\.[^.]*$", ""), F.lit(" "), F.lit("_"))


def page_output_path(url: Column) -> Column:
    """URL without scheme; ``/main`` added unless its last part is a number."""
    bare = F.replace(url, F.lit("https://"), F.lit(""))
    return F.when(is_digits(base_name(url)), bare).otherwise(F.concat(bare, F.lit("/main")))


def url_to_path(url: Column) -> Column:
    """Storage path of a request URL: ``data`` becomes the data set name, ``?`` a dash."""
    dataset = F.element_at(F.split(F.element_at(F.split(url, "DataSetName="), -1), "&"), 1)
    bare = F.replace(F.replace(url, F.lit("data"), dataset), F.lit("https://"), F.lit(""))
    return F.replace(bare, F.lit("?"), F.lit("-"))
