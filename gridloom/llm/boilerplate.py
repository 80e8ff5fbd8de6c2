"""Main text of web pages: suffix arrays over the pages of a host find what repeats, marks of the page say what is declared.

Every page is decided by its host: the token streams of the host's pages are put in a row, and substrings of at least ``RUN``
tokens that stand on several distinct pages, and on a share of the host's, are its frame. Blocks that the frame covers go, the
unique runs between stay. What the page declares says how much the host must show: a page that declares nothing loses what
stands on a tenth of the pages (streams of words and tags, without declared articles). A declared article (``article``, ``main`` or
their roles) loses parts that are named as menus, adverts, forms, comments and the like, and blocks that stand in at least
``ARTICLES`` of the host's articles and in half of them (streams of their words); an article of which the frame covers half is a
copy of others and stays whole, as do passages that fewer pages share.

A host may hold a third of all pages, so its stream is cut into chunks of bounded length, page by page, inside the tasks that read them. A task
builds the suffix array of each chunk, with the longest common prefixes of neighbours: suffixes that share ``RUN`` tokens stand together, which gives every window of that
length with its number of pages. Windows are then added up over all chunks, by host and hash: a token is covered by a
repeated substring of at least ``RUN`` tokens exactly if such a window covers it, so chunks lose nothing. A window in half of a host's
articles is in half of those of some chunk: only such windows leave a chunk, and are then counted in every article of the host.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import settle, ship_package

#: Tokens of the shortest run that counts, and the share of a host's pages it stands on, at least.
RUN, SHARE = 10, 0.1
#: Tokens of a host in one suffix array, and of all hosts a task holds at once (a longer page is a chunk of its own).
CHUNK, HELD = 1 << 17, 1 << 20
#: Share of a block's tokens that a frame covers, and of its characters inside links, from which on it goes.
COVERED, LINKED = 0.8, 0.6
#: Articles of a host that a run stands in, and their share, for it to be frame; the share of an article's tokens that make it a copy.
ARTICLES, ARTICLE_SHARE, COPIED = 3, 0.5, 0.5

# Elements and names of parts as HTML and common practice have them.
RAW = "script style title textarea xmp iframe noembed noframes"
SKIPPED = "nav footer aside form noscript template button select svg canvas object dialog menu audio video head"
BLOCKS = (
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody "
    "tfoot thead tr ul"
)
SPACED = "br td th wbr"
VOID = "area base br col embed hr img input link meta param source track wbr"
ROLES = "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar"
NAMED = (
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices newsletter subscribe subscription signup popup modal overlay sidebar sidebars menu menus nav navbar navigation breadcrumb "
    "breadcrumbs pagination pager footer masthead topbar toolbar comment comments disqus replies respond share sharing social related "
    "recommended recommendations trending widget widgets login search copyright form forms"
)
COMMENTS = "comment comments disqus replies respond reply"
NOT_NAMED = "has with no without"
BODIES = "articlebody article-body article-content entry-content post-content post-body story-body main-content page-content"

_RAW, _SKIPPED, _BLOCKS, _SPACED, _VOID = (frozenset(s.split()) for s in (RAW, SKIPPED, BLOCKS, SPACED, VOID))
_ROLES, _NAMED, _COMMENTS, _NOT_NAMED, _BODIES = (frozenset(s.split()) for s in (ROLES, NAMED, COMMENTS, NOT_NAMED, BODIES))
#: Elements that are kept track of; the others neither open nor close a part of the page.
_PARTS = (_BLOCKS | _SKIPPED | {"td", "th", "span"}) - {"p", "hr", "html"}

_ATTRIBUTES = r"""(?:[^>=]|=(?!\s*["'])|=\s*"[^"]*"|=\s*'[^']*'|=)*+"""
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{"|".join(RAW.split())})(?=[\s/>]){_ATTRIBUTES}(?:>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>?|\Z)|\Z)"""
    rf"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<more>{_ATTRIBUTES})(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_HOST = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)")


def host_of(url: str | None) -> str:
    """The host of an address in lower case, without user and port; empty where there is none."""
    found = _HOST.match((url or "").strip())
    return found[1].rpartition("@")[2].partition(":")[0].lower() if found else ""


@dataclass
class Block:
    """Text of a block as it goes on, and where it stands."""

    place: str  # "skipped", "article", "main" or "open"
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    first: int = 0  # its tokens in the stream
    last: int = 0
    text: str = ""


@dataclass
class Page:
    blocks: list[Block]
    tokens: list[str]  # the stream: tags and words; articles leave an empty token

    def declared(self) -> list[Block]:
        """The blocks of the declared article, none if there is none."""
        for place in ("article", "main"):
            own = [b for b in self.blocks if b.place == place]
            if own:
                return own
        return []


def _place(tag: str, more: str, outer: str) -> str:
    """The place of an element's text, from its name and attributes and the place around it."""
    if outer == "skipped" or tag in _SKIPPED:
        return "skipped"
    if tag == "header" and outer == "open":
        return "skipped"
    if more.strip(" /"):
        given = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(more)}
        role = given.get("role", "").lower()
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "").lower()
        if role in _ROLES or hidden:
            return "skipped"
        if tag != "body":
            title = f"{given.get('class', '')} {given.get('id', '')}"
            for name in title.split():
                parts = [p.lower() for p in _NAME.findall(name)]
                odd = _COMMENTS if tag in ("article", "main") else _NAMED
                if any(p in odd and not (i and parts[i - 1] in _NOT_NAMED) for i, p in enumerate(parts)):
                    return "skipped"
                if outer == "open" and parts == ["header"]:
                    return "skipped"
            if outer != "article" and (given.get("itemprop", "").lower() == "articlebody" or any(n.lower() in _BODIES for n in title.split())):
                return "main"
            if outer == "open" and role in ("main", "article"):
                return role
    if tag == "article" or outer == "article":
        return "article"
    return "main" if tag == "main" or outer == "main" else "open"


def read_page(source: str) -> Page:
    """Blocks and token stream of a page. Open elements end with the elements around them, whatever is missing."""
    blocks: list[Block] = []
    tokens: list[str] = []
    stack: list[tuple[str, str]] = []
    open_tags: dict[str, int] = {}
    place, links, at = "open", 0, 0
    block = Block(place)

    def say(text: str) -> None:
        block.pieces.append(text)
        if links:
            block.linked += len(text)

    def flush() -> None:
        nonlocal block
        if block.pieces:
            words = html.unescape("".join(block.pieces)).split()
            if words:
                block.text, block.first = " ".join(words), len(tokens)
                if block.place == "article":
                    if tokens and tokens[-1]:
                        tokens.append("")
                    block.first = len(tokens)
                else:
                    tokens.extend(words)
                block.last = len(tokens)
                blocks.append(block)
        block = Block(place)

    for found in _TOKEN.finditer(source):
        begin = found.start()
        if begin > at:
            say(source[at:begin])
        at = found.end()
        tag = found["tag"]
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(found["end"])
        if tag in _SPACED:
            say(" ")
        elif tag in _BLOCKS or tag in _SKIPPED:
            flush()
            if place != "article":
                tokens.append(f"</{tag}" if closing else f"<{tag}")
        elif tag == "a":
            links = 0 if closing else 1
        if tag == "p" and not closing:  # ends with the next block, however it is closed
            block.place = _place(tag, found["more"], place)
        if tag not in _PARTS:
            continue
        if not closing:
            if tag in _VOID:
                continue
            inner = _place(tag, found["more"], place)
            stack.append((tag, place))
            open_tags[tag] = open_tags.get(tag, 0) + 1
            if inner != place:
                flush()
                place = inner
                block.place = place
        elif open_tags.get(tag):
            while stack:
                name, outer = stack.pop()
                open_tags[name] -= 1
                if outer != place:
                    flush()
                    place = outer
                    block.place = place
                if name == tag:
                    break
            if tag not in ("span", "td", "th"):
                links = 0
    if at < len(source):
        say(source[at:])
    flush()
    return Page(blocks, tokens)


# ---- suffix arrays --------------------------------------------------------------------------------------------------


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the common prefix of each with the one before (first: 0); ``ids`` ends with a number of its own.

    Suffixes are ranked by 1, 2, 4, ... tokens, until no two are equal; the ranks of each round then add up to the
    common prefixes, from the longest round down.
    """
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    rounds = [rank]
    order = np.argsort(rank)
    while rank.max() < n - 1:
        step = 1 << (len(rounds) - 1)
        second = np.zeros(n, np.int64)
        second[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key)
        ranked = np.zeros(n, np.int64)
        ranked[1:] = np.cumsum(np.diff(key[order]) != 0)
        rank = np.empty(n, np.int64)
        rank[order] = ranked
        rounds.append(rank)
    common = np.zeros(n, np.int64)
    left, right, length = order[:-1], order[1:], np.zeros(n - 1, np.int64)
    for level in range(len(rounds) - 1, -1, -1):
        own = rounds[level]
        a, b = left + length, right + length
        inside = (a < n) & (b < n)
        same = np.zeros(n - 1, bool)
        same[inside] = own[a[inside]] == own[b[inside]]
        length[same] += 1 << level
    common[1:] = length
    return order, common


_FACTOR = 0x9E3779B97F4A7C15


def window_keys(tokens: np.ndarray, run: int) -> np.ndarray:
    """A 64-bit hash of the ``run`` tokens from each place on (fewer at the end)."""
    out = np.zeros(len(tokens), np.uint64)
    for i in range(min(run, len(tokens))):
        out[: len(tokens) - i] += tokens[i:] * np.uint64(pow(_FACTOR, i, 1 << 64))
    # Sums of products keep low bits apart badly; stir them.
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def windows(pages: list[np.ndarray], run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows of ``run`` tokens in the streams (token hashes, 0 where nothing may pass), and how many pages have each."""
    every = np.concatenate([part for p in pages for part in (p, np.zeros(1, np.uint64))])
    owner = np.repeat(np.arange(len(pages)), [len(p) + 1 for p in pages])
    ids = np.unique(every, return_inverse=True)[1].astype(np.int64)
    stops = np.flatnonzero(every == 0)
    ids[stops] = len(every) + np.arange(len(stops))  # each stop is like no other
    order, common = suffix_array(ids)
    until = np.append(stops, len(every))[np.searchsorted(stops, np.arange(len(every)))]
    whole = (until - np.arange(len(every)) >= run)[order]
    group = np.cumsum(common < run)
    order, group = order[whole], group[whole]
    if not len(order):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    names, firsts, inverse = np.unique(group, return_index=True, return_inverse=True)
    pairs = np.unique(inverse.astype(np.int64) * len(pages) + owner[order])
    return window_keys(every, run)[order[firsts]], np.bincount(pairs // len(pages), minlength=len(names))


def covered(tokens: int, places: np.ndarray, run: int = RUN) -> np.ndarray:
    """Which tokens the windows at these places cover."""
    change = np.zeros(tokens + 1, np.int64)
    np.add.at(change, places, 1)
    np.add.at(change, np.minimum(places + run, tokens), -1)
    return np.cumsum(change[:-1]) > 0


# ---- over all pages -------------------------------------------------------------------------------------------------

_BLOCK = "struct<text: string, first: int, last: int, linked: double>"
_READ = (
    "row long, host string, page_id {page_id}, url string, declared boolean, "
    f"blocks array<{_BLOCK}>, n_tokens int, keys array<long>, window_keys array<long>, window_pages array<int>, pages long, "
    "run_keys array<long>, articles long"
)


class Hashes:
    """Token hashes; 0 is the empty token, where nothing may pass."""

    def __init__(self) -> None:
        self.names: dict[str, int] = {"": 0}

    def of(self, tokens: list[str]) -> np.ndarray:
        names = self.names
        if len(names) > 1 << 18:
            names.clear()
            names[""] = 0
        for t in tokens:
            if t not in names:
                names[t] = xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), 42) or 1
        return np.fromiter(map(names.__getitem__, tokens), np.uint64, len(tokens))


def read_pages(pages: DataFrame) -> DataFrame:
    """A written table with a row per page (``row`` is set) and a row per chunk of a host's streams (``pages`` or, of articles, ``articles`` is set)."""
    ship_package(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()
    columns = ["row", "host", "page_id", "url", "declared", "blocks", "n_tokens", "keys", "window_keys", "window_pages", "pages", "run_keys", "articles"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        streams: dict[tuple[str, bool], list[np.ndarray]] = {}  # by host, and whether of articles
        lengths: dict[tuple[str, bool], int] = {}
        number = TaskContext.get().partitionId() << 40
        hashes = Hashes()

        def frame(rows: list[dict]) -> pd.DataFrame:
            # objects, so that whole numbers beside nulls stay whole
            return pd.DataFrame([[r.get(c) for c in columns] for r in rows], columns=columns, dtype=object)

        def close(of: tuple[str, bool]) -> dict:
            own = streams.pop(of)
            lengths.pop(of)
            keys, counts = windows(own)
            if of[1]:
                return {"host": of[0], "run_keys": keys[counts >= ARTICLE_SHARE * len(own)].view(np.int64).tolist(), "articles": len(own)}
            return {"host": of[0], "window_keys": keys.view(np.int64).tolist(), "window_pages": counts.tolist(), "pages": len(own)}

        for batch in batches:
            out: list[dict] = []
            for page_id, url, source in zip(batch["page_id"], batch["url"], batch["html"], strict=True):
                page, host = read_page(source or ""), host_of(url)
                article, given = page.declared(), [((host, False), hashes.of(page.tokens))]
                done = {"row": number, "host": host, "page_id": page_id, "url": url, "declared": bool(article)}
                number += 1
                if article:
                    told = [b.text.split() for b in article]
                    ends = np.cumsum([len(t) for t in told]).tolist()
                    done["blocks"] = [{"text": b.text, "first": e - len(t), "last": e, "linked": 0.0} for b, t, e in zip(article, told, ends, strict=True)]
                    done["n_tokens"] = ends[-1]
                    given.append(((host, True), hashes.of([w for t in told for w in t])))
                else:
                    done["blocks"] = [
                        {"text": b.text, "first": b.first, "last": b.last, "linked": min(1.0, b.linked / max(1, sum(map(len, b.pieces))))}
                        for b in page.blocks
                        if b.place == "open"
                    ]
                    tokens = given[0][1]
                    done["n_tokens"], done["keys"] = len(tokens), window_keys(tokens, RUN).view(np.int64).tolist()
                out.append(done)
                for of, tokens in given:
                    streams.setdefault(of, []).append(tokens)
                    lengths[of] = lengths.get(of, 0) + len(tokens) + 1
                    if lengths[of] >= CHUNK:
                        out.append(close(of))
            if sum(lengths.values()) >= HELD:
                out.extend([close(of) for of in list(streams)])
            if out:
                yield frame(out)
        if streams:
            yield frame([close(of) for of in list(streams)])

    return settle(pages.select("page_id", "url", "html").mapInPandas(read, _READ.format(page_id=kind)))


#: Parts a host's number of pages is spread over, to meet its windows.
_PLACES = 64


def frames(read: DataFrame) -> DataFrame:
    """``host, key`` of the windows on enough distinct pages of a host."""
    chunks = read.where("pages is not null")
    totals = chunks.groupBy("host").agg(F.sum("pages").alias("all_pages"))
    pairs = chunks.select("host", F.explode(F.arrays_zip("window_keys", "window_pages")).alias("w"))
    counted = pairs.select("host", F.col("w.window_keys").alias("key"), F.col("w.window_pages").alias("n")).groupBy("host", "key").agg(F.sum("n").alias("n"))
    place = F.pmod(F.col("key"), F.lit(_PLACES)).cast("int")
    spread = totals.select("host", "all_pages", F.explode(F.sequence(F.lit(0), F.lit(_PLACES - 1))).alias("place"))
    several = counted.where("n >= 2").withColumn("place", place)
    return several.join(spread, ["host", "place"]).where(F.col("n") >= SHARE * F.col("all_pages")).select("host", "key")


def article_places(read: DataFrame) -> DataFrame:
    """``row, at`` of the windows of declared articles that enough articles of their host hold."""
    chunks = read.where("articles is not null")
    runs = settle(chunks.select("host", F.explode("run_keys").alias("key")).groupBy("host").agg(F.collect_set("key").alias("runs")))
    told = read.where("declared").select("row", "host", F.transform("blocks", lambda b: b["text"]).alias("texts"))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for batch in batches:
            out = []
            for row, host, texts, own in zip(batch["row"], batch["host"], batch["texts"], batch["runs"], strict=True):
                tokens = hashes.of([w for t in texts for w in t.split()])
                keys = window_keys(tokens, RUN)[: max(0, len(tokens) - RUN + 1)].view(np.int64)
                at = np.flatnonzero(np.isin(keys, own))
                if len(at):
                    out.append((row, host, at.tolist(), keys[at].tolist()))
            yield pd.DataFrame(out, columns=["row", "host", "places", "keys"])

    met = settle(told.join(runs, "host").mapInPandas(meet, "row long, host string, places array<int>, keys array<long>"))
    totals = chunks.groupBy("host").agg(F.sum("articles").alias("articles"))
    counted = met.select("host", F.explode(F.array_distinct("keys")).alias("key")).groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"))
    frame = counted.join(totals, "host").where((F.col("n") >= ARTICLES) & (F.col("n") >= ARTICLE_SHARE * F.col("articles"))).select("host", "key")
    pairs = met.select("row", "host", F.explode(F.arrays_zip("places", "keys")).alias("w")).select("row", "host", F.col("w.places").alias("at"), F.col("w.keys").alias("key"))
    return pairs.join(settle(frame), ["host", "key"]).select("row", "at")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per page.

    Null and empty pages have an empty text, as have pages that hold nothing but frame, menus and the like; a page without an
    address belongs to the host with the empty name. A page that declares no article and whose every block is covered by the
    frame is a copy of others and keeps its blocks, as does a declared article that the frame covers by half. White space is that of Unicode, no-break spaces included. Pages with equal or null ids
    each have a row; an empty table gives none; other columns are not read.
    """
    read = read_pages(pages)
    told = read.where("row is not null")
    # A page meets the frame of its host.
    places = told.where("not declared").select("row", "host", F.posexplode("keys").alias("at", "key"))
    every = places.join(frames(read), ["host", "key"]).select("row", "at").unionAll(article_places(read))
    found = settle(every.groupBy("row").agg(F.collect_list("at").alias("places")))
    meeting = told.select("row", "page_id", "url", "declared", "blocks", "n_tokens").join(found, "row", "left")
    kind = pages.schema["page_id"].dataType.simpleString()

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for declared, blocks, n, at in zip(batch["declared"], batch["blocks"], batch["n_tokens"], batch["places"], strict=True):
                hidden = np.concatenate([[0], np.cumsum(covered(int(n), np.asarray(at, np.int64)))])
                own = [b for b in blocks if b["linked"] < LINKED]
                free = [b["text"] for b in own if hidden[b["last"]] - hidden[b["first"]] < COVERED * (b["last"] - b["first"])]
                copy = declared and hidden[-1] >= COPIED * n
                texts.append("\n".join(free if free and not copy else [b["text"] for b in own]))
            if texts:
                yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts})

    left = meeting.where("places is not null").drop("row").mapInPandas(keep, f"page_id {kind}, url string, text string")
    # Without any frame on it a page keeps its blocks.
    text = F.array_join(F.transform(F.filter("blocks", lambda b: b["linked"] < LINKED), lambda b: b["text"]), "\n")
    free = meeting.where("places is null").select("page_id", "url", text.alias("text"))
    return free.unionAll(left).withColumn("n_chars", F.length("text").cast("long"))
