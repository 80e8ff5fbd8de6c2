"""Main text: pages with a declared article, the frame of a host by suffix arrays against windows counted one by one."""

import random
from collections import defaultdict

import numpy as np
import pytest

from gridloom.llm import boilerplate

SCHEMA = "page_id long, url string, html string, text string, row int, host string"


def words(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n))


def extract(spark, pages):
    table = spark.createDataFrame([(i, u, h, "x", 1, "y") for i, u, h in pages], SCHEMA).repartition(3)
    return sorted(((r["page_id"], r["text"], r["n_chars"]) for r in boilerplate.extract(table).collect()), key=str)


def test_suffix_array():
    r = random.Random(1)
    for n in (1, 2, 9, 60, 300):
        ids = np.array([r.randint(0, 3) for _ in range(n)] + [99])
        order, common = boilerplate.suffix_array(ids)
        suffixes = [ids[i:].tolist() for i in range(len(ids))]
        assert order.tolist() == sorted(range(len(ids)), key=lambda i: suffixes[i])
        for k in range(1, len(ids)):
            a, b = suffixes[order[k - 1]], suffixes[order[k]]
            same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert common[k] == same


def test_windows_are_counted_by_distinct_pages():
    r = random.Random(2)
    pages = [np.array([r.choice([0, 11, 12, 13]) for _ in range(r.randint(0, 60))], np.uint64) for _ in range(12)]
    seen = defaultdict(set)
    for i, p in enumerate(pages):
        keys = boilerplate.window_keys(p, 3)
        for at in range(len(p) - 2):
            if p[at : at + 3].all():
                seen[int(keys[at])].add(i)
    keys, counts = boilerplate.windows(pages, 3)
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == {k: len(v) for k, v in seen.items()}


def test_declared_articles(spark):
    frame = "<nav><a href=/>Home</a></nav><div class='ad'>Buy now</div>"
    page = (
        f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p><article>no';</script></head><body class='has-sidebar'>{frame}"
        "<header>Site</header><article><h1>A &amp;&#32;B</h1><p>one\n  <b>two</b>&nbsp;three<br>four<p>f<i>iv</i>e &lt;p&gt;<div class=comments><p>nice!</div>"
        "<form><label>Mail</label></form><p class='cookie-notice'>We use cookies</p><section><p>last</p></section><div id=related><p>more</div></article>"
        "<aside><p>side</p></aside><article class=comment>hm</article><footer>f</footer>"
    )
    own = "A & B\none two three four\nfive <p>\nlast"
    assert extract(spark, [(1, "http://h/1", page), (1, "http://h/1", page), (None, None, page)]) == sorted([(1, own, len(own))] * 2 + [(None, own, len(own))], key=str)


@pytest.mark.parametrize("source", [None, "", " \n", "<", "<article", "<!-- <article>x", "<script>x", "<nav>only a menu", "</p></div>", "<a b='"])
def test_nothing_to_keep(spark, source):
    assert [t for _, t, _ in extract(spark, [(1, "http://h/", source)])] in ([""], ["<"])


def test_copies_of_an_article_stay(spark):
    r = random.Random(3)
    text = words(r, 80)
    pages = [(i, f"http://h.example/{i}", f"<body><nav>{words(r, 5)}</nav><article><p>{text}</p></article>") for i in range(30)]
    assert [t for _, t, _ in extract(spark, pages)] == [text] * 30


def test_frame_of_a_host_without_declared_articles(spark, monkeypatch):
    """No element tells the frame: only that it repeats does. The parts of one host lie in many chunks."""
    r = random.Random(4)
    top, bottom, other = words(r, 14), words(r, 20), words(r, 14)
    monkeypatch.setattr(boilerplate, "CHUNK", 200)
    own, pages = {}, []
    for i in range(40):
        own[i] = [words(r, r.randint(12, 40)) for _ in range(3)]
        parts = "".join(f"<div><p>{p}</p></div>" for p in own[i])
        pages.append((i, f"http://a.example/{i}", f"<body><div>{top}</div>{parts}<div>{bottom}</div>"))
    for i in range(40, 50):  # on another host the same words are no frame
        own[i] = [words(r, 30)] + ([top] if i == 40 else [])
        pages.append((i, f"http://B.example:80/{i}", f"<body><div>{other}</div>" + "".join(f"<p>{p}</p>" for p in own[i])))
    quote = words(r, 30)  # shared by two of forty pages: text
    for i in (3, 5):
        own[i].append(quote)
        pages[i] = (i, pages[i][1], pages[i][2] + f"<p>{quote}</p>")
    found = {i: t for i, t, _ in extract(spark, pages)}
    assert found == {i: "\n".join(p) for i, p in own.items()}


def test_coverage_of_repeats():
    marks = boilerplate.covered(12, np.array([1, 2, 9]), 3)
    assert marks.astype(int).tolist() == [0, 1, 1, 1, 1, 0, 0, 0, 0, 1, 1, 1]


def test_frame_inside_declared_articles(spark, monkeypatch):
    """A notice that no name tells stands in most articles of a host and goes; a shared passage and near copies stay. Small chunks."""
    r = random.Random(5)
    monkeypatch.setattr(boilerplate, "CHUNK", 300)
    notice, passage, copied = words(r, 25), words(r, 25), [words(r, 30) for _ in range(3)]
    own, pages = {}, []
    for i in range(40):
        own[i] = [words(r, r.randint(12, 40)) for _ in range(3)] + [passage] * (i % 3 == 0)
        shown = [own[i][0], *([notice] if i % 5 else []), *own[i][1:]]
        tag = "article" if i % 2 else "main"
        pages.append((i, f"http://a.example/{i}", f"<body><{tag}>" + "".join(f"<p>{p}</p>" for p in shown) + f"</{tag}>"))
    for i in range(40, 60):  # near copies are most of another host
        own[i] = [*copied, words(r, 15)] if i < 55 else [words(r, 60)]
        pages.append((i, f"http://b.example/{i}", "<article>" + "".join(f"<p>{p}</p>" for p in own[i]) + "</article>"))
    for i in range(60, 62):  # two articles tell nothing
        own[i] = [words(r, 60), passage]
        pages.append((i, "http://c.example/", "<article>" + "".join(f"<p>{p}</p>" for p in own[i]) + "</article>"))
    found = {i: t for i, t, _ in extract(spark, pages)}
    assert found == {i: "\n".join(p) for i, p in own.items()}
