"""Exact token ids of texts, by way of a cache of pre-tokens.

The vocabulary lower-cases a text and cuts it into pre-tokens: runs of letters, single digits, runs of marks; white space
goes. Each pre-token is encoded on its own, so a text's ids are those of its pre-tokens in turn. Text of plain
characters is cut here; pre-tokens repeat, so most are found in a cache, and a new one goes to the library's merges
alone. A piece between blanks that holds any other character (an apostrophe, other scripts, control characters) goes to
the library whole, and so does a text with a special string.
"""

from __future__ import annotations

import os
import re
import struct

#: Entries a worker keeps in a cache before it starts afresh, and the longest text of an entry.
CACHE_SIZE, CACHED_CHARS = 600_000, 64

#: The plain characters, and how this vocabulary cuts them once they are in lower case.
ODD = re.compile(r"[^\x20\t\n\r!-&(-~À-ÖØ-öø-ÿ]")
ODD_PIECE = re.compile(r"[^\x20\t\n\r]*[^\x20\t\n\r!-&(-~À-ÖØ-öø-ÿ][^\x20\t\n\r]*")
PRE_TOKENS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\x20\t\n\r]+")


def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def specials(tokenizer) -> list[str]:
    """Strings the library reads as one token wherever they stand, across blanks too."""
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


def byte_names() -> list[str]:
    """Byte-level vocabularies write a visible Latin-1 byte as itself, the others as the characters from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, hidden = [], 256
    for b in range(256):
        names.append(chr(b) if b in visible else chr(hidden))
        hidden += b not in visible
    return names


def pre_tokens(plain: str) -> list[str]:
    return PRE_TOKENS.findall(plain.lower())


class Cache(dict):
    """``make`` of each text asked for; short texts are remembered, in a bounded table that begins with ``first``."""

    def __init__(self, make, first: dict | None = None):
        super().__init__(first or {})
        self.make, self.first = make, first or {}

    def __missing__(self, text: str):
        found = self.make(text)
        if len(text) <= CACHED_CHARS:
            if len(self) >= CACHE_SIZE + len(self.first):
                self.clear()
                self.update(self.first)
            self[text] = found
        return found


class Encoder:
    """``of(ids)`` of texts; ``total`` puts the values of parts together; ``first`` holds values known beforehand."""

    def __init__(self, path: str, of, total, first: dict | None = None):
        self.tokenizer, self.of, self.total = load(path), of, total
        self.specials = specials(self.tokenizer)
        self.merges, self.names = self.tokenizer.model, byte_names()
        self.known = Cache(self.pre_token, first)
        self.odd = Cache(self.whole)

    def whole(self, text: str):
        return self.of(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def pre_token(self, run: str):
        name = run if run.isascii() else "".join(map(self.names.__getitem__, run.encode()))
        return self.of([t.id for t in self.merges.tokenize(name)])

    def plain(self, text: str):
        return self.total(map(self.known.__getitem__, pre_tokens(text)))

    def parts(self, text: str):
        end = 0
        for m in ODD_PIECE.finditer(text):
            yield self.plain(text[end : m.start()])
            yield self.odd[m.group()]
            end = m.end()
        yield self.plain(text[end:])

    def __call__(self, text: str):
        if any(s in text for s in self.specials):
            return self.whole(text)
        return self.total(self.parts(text)) if ODD.search(text) else self.plain(text)


def little_endian(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_WORKER: dict[str, Encoder] = {}


def ids_encoder(path: str) -> Encoder:
    """Texts to little-endian 32-bit ids; kept with its caches for the next task of this worker."""
    if path not in _WORKER:
        _WORKER[path] = Encoder(path, little_endian, b"".join)
    return _WORKER[path]
