"""Benchmark passages in documents, by latent semantic retrieval.

Documents are read as half-blocks of 16 words; two neighbours make a passage of 32, so passages overlap by half.
Passages and benchmark items are TF-IDF vectors over the words of the benchmark, with frequencies over all documents;
a word the benchmark does not know counts towards a passage's norm only. A randomised SVD of the benchmark's passages
and those of all documents (side by side) gives the latent space: one pass counts the passages that hold each two words
of the benchmark, tasks multiply blocks of that matrix, and the driver orthogonalises a matrix of words by rank. Passages of documents are
then compared with items in that space (the benchmark in blocks of bounded size, broadcast), where the text near them
has as many of the item's words as the last step asks for. Pairs of enough cosine, in that space or of the words
themselves, are candidates; a longest common subsequence with the item, along the diagonal where they meet, decides,
and where the benchmark gives an answer, a look for its words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import text_of
from gridloom.session import settle, ship_package

#: Half a passage, in words.
HALF = 16
#: Bounds of a block of the benchmark: items and characters. A larger benchmark takes several blocks.
BLOCK_ITEMS, BLOCK_CHARS = 4_096, 4_000_000
#: Rank of the latent space, extra random columns, power rounds.
RANK, EXTRA, POWER = 256, 32, 2
#: Words of documents whose pairs are listed at once (whole passages); pairs a task holds, and those of a block of words at most.
STRETCH, CELLS = 1 << 16, 1 << 22
#: Tasks whose counts are added up first.
TASKS = 32
#: Share of an item's words it is not looked up by, at most; less than ``COMMON``.
SKIPPED = 0.4
#: Passages a task compares at once.
PASSAGES = 2_048
#: Least latent cosine of a candidate, least share of an item's words in order, least share of its answer's words.
COSINE, COMMON, ANSWER = 0.3, 0.6, 0.5

#: Marks that part words: those of ASCII, and the usual others.
_MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
_BLANKS = bytes.maketrans(_MARKS, b" " * len(_MARKS))
_OTHER_MARKS = "–—…“”„‘’«»¡¿·\u00a0"


def words(text: str) -> list[bytes]:
    """Words in lower case, without the marks around and between them."""
    if not text.isascii():
        for mark in _OTHER_MARKS:
            if mark in text:
                text = text.replace(mark, " ")
    return text.lower().encode().translate(_BLANKS).split()


@dataclass
class Item:
    item_id: int
    ids: np.ndarray
    answer: np.ndarray  # places in ``ids`` of the answer's words
    given: bool = False  # the benchmark names the answer


@dataclass
class Postings:
    """Items of each word, but for the commonest words of each item, which hold ``SKIPPED`` of its words at most.

    An item is found by ``COMMON`` of its words within ``span`` words of a text. Those it is not listed under are no
    more than it has of them, so ``need`` words it is listed under must stand there.
    """

    first: np.ndarray
    length: np.ndarray
    items: np.ndarray
    copies: np.ndarray  # how often the item has the word
    need: np.ndarray
    span: np.ndarray

    def of_words(self, ids: np.ndarray) -> np.ndarray:
        """Places of the entries of these words, one word after the other."""
        times = self.length[ids]
        return np.repeat(self.first[ids] - np.cumsum(times) + times, times) + np.arange(times.sum())

    @classmethod
    def of(cls, items: list[Item], weight: np.ndarray) -> Postings:
        word, copies, need = [], [], []
        for item in items:
            names, counts = np.unique(item.ids, return_counts=True)
            order = np.argsort(weight[names], kind="stable")
            listed = np.cumsum(counts[order]) > SKIPPED * len(item.ids)
            word.append(names[order][listed])
            copies.append(counts[order][listed])
            need.append(math.ceil(COMMON * len(item.ids) - 1e-9) - counts[order][~listed].sum())
        owner = np.repeat(np.arange(len(items)), [len(w) for w in word])
        every = np.concatenate(word)
        length = np.bincount(every, minlength=len(weight))
        span = np.array([len(i.ids) + 2 * _slack(len(i.ids)) for i in items])
        order = np.argsort(every, kind="stable")
        return cls(np.cumsum(length) - length, length, owner[order], np.concatenate(copies)[order], np.array(need), span)


@dataclass
class Block:
    """Items of a benchmark and their vocabulary; word 0 is every word the benchmark does not know."""

    vocabulary: dict[bytes, int]
    items: list[Item]
    owners: np.ndarray  # item of each item passage
    passages: list[np.ndarray]  # distinct words of each item passage
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    basis: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    postings: Postings | None = None
    latent: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))  # of length 1, by item passage
    scratch: np.ndarray | None = None  # zero for every word, between uses


def _answer(ids: np.ndarray, text: str, answer: str | None, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, bool]:
    """Places of the answer, and whether it is the given one; without one in the item, its last sentence, at least a quarter."""
    if answer and (own := [vocabulary.get(w, 0) for w in words(answer)]):
        for i in range(len(ids) - len(own), -1, -1):
            if ids[i : i + len(own)].tolist() == own:
                return np.arange(i, i + len(own)), True
    last = [s for s in re.split(r"[.!?]+\s", text.strip()) if words(s)]
    n = max(len(words(last[-1])) if last else 0, -(-len(ids) // 4))
    return np.arange(max(0, len(ids) - n), len(ids)), False


def read_blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark in blocks; null or wordless items and null ids are left out, repeated ones count once."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.where("item_id is not null and text is not null").select("item_id", "text", answer.alias("answer")).distinct()
    taken: list[tuple] = []
    chars = 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        if taken and (len(taken) == BLOCK_ITEMS or chars + len(r["text"]) > BLOCK_CHARS):
            yield _block(taken)
            taken, chars = [], 0
        taken.append(tuple(r))
        chars += len(r["text"])
    if taken:
        yield _block(taken)


def _block(rows: list[tuple]) -> Block:
    vocabulary: dict[bytes, int] = {}
    items, owners, passages = [], [], []
    for item_id, text, answer in rows:
        ids = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)], np.int32)
        if not len(ids):
            continue
        for i in range(0, max(1, len(ids) - HALF), 2 * HALF):
            # a short rest joins the passage before it
            end = len(ids) if len(ids) - i < 3 * HALF else i + 2 * HALF
            passages.append(np.unique(ids[i:end]))
            owners.append(len(items))
            if end == len(ids):
                break
        items.append(Item(item_id, ids, *_answer(ids, text, answer, vocabulary)))
    return Block(vocabulary, items, np.array(owners, np.int64), passages)


def _ids(text: str, vocabulary: dict[bytes, int]) -> np.ndarray:
    found = words(text)
    return np.fromiter(map(vocabulary.get, found, repeat(0)), np.int32, len(found))


def _half_blocks(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Known words of each half-block, each once: (half-block, word) in order; and the number of half-blocks."""
    n = -(-len(ids) // HALF)
    at = np.flatnonzero(ids)
    keys = np.unique((at // HALF) * np.int64(size) + ids[at])
    return keys // size, keys % size, n


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _pairs(ids: np.ndarray, size: int) -> np.ndarray:
    """Pairs of known words of each passage (two half-blocks), a word with itself included: ``first * size + second``, first <= second."""
    kind = np.int32 if size * size < 1 << 31 else np.int64
    at = np.flatnonzero(ids)
    keys = np.sort(at // (2 * HALF) * np.int64(size) + ids[at])
    keys = keys[np.flatnonzero(np.diff(keys, prepend=-1))]
    passage = keys // size
    word, place = (keys - passage * size).astype(kind), np.arange(len(keys), dtype=np.int32)
    ends = np.flatnonzero(np.diff(passage, append=-1)) + 1
    times = np.repeat(ends, np.diff(ends, prepend=0)) - place  # a word meets itself and those after it in its passage
    pairs, starts = np.repeat(word * kind(size), times), np.cumsum(times) - times
    pairs += word[np.arange(len(pairs), dtype=np.int32) - np.repeat((starts - place).astype(np.int32), times)]
    return pairs


def _packed(keys: np.ndarray, counts: np.ndarray, size: int, height: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Counts of pairs by block of ``height`` first words; keys in order."""
    blocks, first = np.unique(keys // size // height, return_index=True)
    for block, begin, end in zip(blocks.tolist(), first, [*first, len(keys)][1:], strict=True):
        yield block, keys[begin:end].tobytes(), counts[begin:end].tobytes()


def _listed(found: Iterable[tuple[int, bytes, bytes]], part: int = 0) -> pd.DataFrame:
    return pd.DataFrame([(block, part, keys, counts) for block, keys, counts in found], columns=["block", "part", "keys", "counts"])


def _height(size: int) -> int:
    """Words of a block of the pairs' matrix, whose rows are at most ``CELLS`` together."""
    return max(1, min(16, CELLS // size))


_COUNTS = "block int, part int, keys binary, counts binary"


def word_pairs(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, int, DataFrame]:
    """Documents that hold each word, the number of documents, and the passages of all documents that hold each two words.

    The passages' counts are a written symmetric matrix, ``block, keys, counts`` per block of rows (``_height``). Tasks count pairs
    in order (``_pairs``), Spark adds them up by block, first those of ``TASKS`` tasks, and each sum is then written on both sides of
    the diagonal.
    """
    spark, size = docs.sparkSession, len(vocabulary) + 1
    height = _height(size)
    shared = spark.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, seen, rows = shared.value, np.zeros(size, np.int64), 0
        task = TaskContext.get().partitionId() // TASKS
        held: list[np.ndarray] = []  # ids of passages not counted yet, padded with unknown words to whole passages
        words_held, raw, raw_held = 0, [], 0
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def merge() -> None:
            nonlocal keys, counts, raw, raw_held
            own, n = np.unique(np.concatenate(raw), return_counts=True)
            keys, counts = _merged(np.concatenate([keys, own]), np.concatenate([counts, n]))
            raw, raw_held = [], 0

        def pair() -> None:
            nonlocal held, words_held, raw_held
            every = np.concatenate(held)
            for i in range(0, len(every), STRETCH):
                raw.append(_pairs(every[i : i + STRETCH], size))
                raw_held += len(raw[-1])
                if raw_held >= CELLS:
                    merge()
            held, words_held = [], 0

        for batch in batches:
            for t in batch["t"]:
                ids = _ids(t, known)
                seen[np.unique(ids)] += 1
                held += [ids, np.zeros(-len(ids) % (2 * HALF), np.int32)]
                words_held += len(ids)
                if words_held >= STRETCH:
                    pair()
                if len(keys) >= CELLS:
                    yield _listed(_packed(keys, counts, size, height), task)
                    keys, counts = keys[:0], counts[:0]
            rows += len(batch)
        if rows:
            if held:
                pair()
            if raw:
                merge()
            seen[0] = rows
            own = np.flatnonzero(seen)
            yield _listed([(-1, own.tobytes(), seen[own].tobytes()), *_packed(keys, counts, size, height)], task)

    def total(parts: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for k, n in zip(parts["keys"], parts["counts"], strict=True):
            held.append((np.frombuffer(k, np.int64), np.frombuffer(n, np.int64)))
            if sum(len(x) for x, _ in held) >= 2 * CELLS:
                held = [_merged(*map(np.concatenate, zip(*held, strict=True)))]
        return _merged(*map(np.concatenate, zip(*held, strict=True)))

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        keys, counts = total(parts)
        return _listed([(int(parts["block"].iloc[0]), keys.tobytes(), counts.tobytes())])

    def mirror(parts: pd.DataFrame) -> pd.DataFrame:
        keys, counts = total(parts)
        if parts["block"].iloc[0] < 0:
            return _listed([(-1, keys.tobytes(), counts.tobytes())])
        off = keys // size != keys % size
        other = keys[off] % size * size + keys[off] // size
        order = np.argsort(other)
        return _listed([*_packed(keys, counts, size, height), *_packed(other[order], counts[off][order], size, height)])

    counted = docs.select(text_of().alias("t")).mapInPandas(count, _COUNTS)
    summed = counted.groupBy("block", "part").applyInPandas(add, _COUNTS)
    halves = settle(summed.groupBy("block").applyInPandas(mirror, _COUNTS))
    found = np.zeros(size, np.int64)
    for r in halves.where("block < 0").collect():
        found[np.frombuffer(r["keys"], np.int64)] = np.frombuffer(r["counts"], np.int64)
    return found, int(found[0]), settle(halves.where("block >= 0").groupBy("block").applyInPandas(add, _COUNTS).drop("part"))


def _weights(found: np.ndarray, total: int, items: list[Item]) -> np.ndarray:
    """Smoothed inverse frequencies; an unknown word weighs what an item's word does on average."""
    weight = np.log((total + 1) / (found + 0.5)).clip(0.1)
    weight[0] = np.sqrt(np.mean(np.concatenate([weight[i.ids] for i in items]) ** 2))
    return weight.astype(np.float32)


def latent_space(pairs: DataFrame, block: Block, rank: int = RANK) -> np.ndarray:
    """Words by rank: leading right singular vectors of the passages' matrix, by randomised subspace iteration.

    ``pairs`` has the passages of all documents, as ``word_pairs`` writes them.
    """
    spark, size = pairs.sparkSession, len(block.weight)
    rank = min(rank, size - 1, max(1, len(block.passages)))
    weight = block.weight.astype(np.float64)
    shared = spark.sparkContext.broadcast(weight)

    def times(product: np.ndarray) -> np.ndarray:
        """(AᵀA) times a matrix, A being the benchmark's passages and the documents', both of the same total weight."""
        given = spark.sparkContext.broadcast(product.astype(np.float32))

        def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            weight, right = shared.value, given.value
            for batch in batches:
                for k, n in zip(batch["keys"], batch["counts"], strict=True):
                    keys = np.frombuffer(k, np.int64)
                    rows, row = np.unique(keys // size, return_inverse=True)
                    columns, column = np.unique(keys % size, return_inverse=True)
                    part = np.zeros((len(rows), len(columns)), np.float32)
                    part[row, column] = np.frombuffer(n, np.int64) * weight[rows][row] * weight[columns][column]
                    energy = float(part[row, column][rows[row] == columns[column]].sum(dtype=np.float64))
                    yield pd.DataFrame({"rows": [rows.tobytes()], "energy": [energy], "product": [(part @ right[columns]).tobytes()]})

        own, energy = np.zeros((size, product.shape[1]), np.float64), 0.0
        for w in block.passages:
            v = block.weight[w]
            energy += float(v @ v)
            own[w] += np.outer(v, v @ product[w])
        every, theirs = np.zeros_like(own), 0.0
        for r in pairs.select("keys", "counts").mapInPandas(multiply, "rows binary, energy double, product binary").collect():
            rows = np.frombuffer(r["rows"], np.int64)
            every[rows] = np.frombuffer(r["product"], np.float32).reshape(len(rows), -1)
            theirs += r["energy"]
        given.unpersist()
        return own + every * (energy / theirs) if theirs else own

    random = np.random.default_rng(42).standard_normal((size, min(size, rank + EXTRA)))
    basis = np.linalg.qr(times(random))[0]
    for _ in range(POWER):
        basis = np.linalg.qr(times(basis))[0]
    values, vectors = np.linalg.eigh(basis.T @ times(basis))
    return (basis @ vectors[:, np.argsort(values)[::-1][:rank]]).astype(np.float32)


def common_subsequence(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence; 0 stands for any unknown word and matches nothing."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        if x:
            masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    state, states = full, []
    for y in b:  # one addition per word of b: the zero bits are where the best length grows
        states.append(state)
        hit = state & masks.get(y, 0)
        state = ((state + hit) | (state - hit)) & full
    found, i = [], len(a)
    for j in range(len(b) - 1, -1, -1):
        # the length over a[:i] fell by leaving out b[j]: b[j] was matched at the highest place where it counts
        after, before = state, states[j]
        mask = (1 << i) - 1
        if (~after & mask).bit_count() > (~before & mask).bit_count():
            own = masks.get(b[j], 0) & mask
            while own:
                top = own.bit_length() - 1
                if (~before & ((1 << top) - 1)).bit_count() + 1 == (~after & mask).bit_count():
                    found.append(top)
                    i = top
                    break
                own ^= 1 << top
        state = before
    return found[::-1]


def _slack(n: int) -> int:
    """Words a text may shift against an item of n words."""
    return max(3, n // 5)


def verify(ids: np.ndarray, start: int, item: Item) -> tuple[float, float]:
    """Share of the item's words, and of its answer's, in a common subsequence with the text near a passage."""
    n = len(item.ids)
    low, high = max(0, start - n), min(len(ids), start + 2 * HALF + n)
    region = ids[low:high]
    # The diagonal on which most words meet: those that occur once in the item, or all of them if they meet nowhere.
    names, counts = np.unique(item.ids, return_counts=True)
    once = np.isin(item.ids, names[counts == 1])
    for used in (np.flatnonzero(once), np.arange(n)):
        meet = np.zeros(len(region) + n, np.int64)  # by shift, from -n on
        for i in used:
            meet[np.flatnonzero(region == item.ids[i]) - i + n] += 1
        if meet.any():
            break
    else:
        return 0.0, 0.0
    shifts, around = np.flatnonzero(meet) - n, np.convolve(meet, np.ones(7, np.int64))[3:-3]
    middle = max(shifts.tolist(), key=lambda s: (around[s + n], -abs(s - (start - low))))
    slack = _slack(n)
    near = region[max(0, middle - slack) : middle + n + slack].tolist()
    places = np.array(common_subsequence(item.ids.tolist(), near), np.int64)
    return len(places) / n, float(np.isin(item.answer, places).mean())


def _open(ids: np.ndarray, block: Block, passages: int) -> Iterator[tuple[int, np.ndarray]]:
    """Items that can be verified somewhere in a text, each with the passages near enough to that place.

    Whatever the cosine, a pair left out here has too few of the item's words to be found.
    """
    listed = block.postings
    at = np.flatnonzero(listed.length[ids])
    # An item's word counts as often as the item has it, wherever the text has it.
    entries = listed.of_words(np.unique(ids[at]))
    enough = np.bincount(listed.items[entries], weights=listed.copies[entries], minlength=len(block.items)) >= listed.need
    if not enough.any():
        return
    times = listed.length[ids[at]]
    item = listed.items[listed.of_words(ids[at])]
    kept = enough[item]
    keys = np.sort(item[kept].astype(np.int64) * len(ids) + np.repeat(at, times)[kept])
    item, place = keys // len(ids), keys % len(ids)
    last = np.arange(len(keys)) + listed.need[item] - 1
    inside = np.flatnonzero(last < len(keys))
    last = last[inside]
    close = (item[last] == item[inside]) & (place[last] - place[inside] < listed.span[item[inside]])
    inside, last = inside[close], last[close]
    for k in np.unique(item[inside]):
        own, n = item[inside] == k, len(block.items[k].ids)
        # verify() looks at n words on either side of a passage
        low = (-(-(place[last[own]] + 1 - 2 * HALF - n) // HALF)).clip(0, passages)
        high = ((place[inside[own]] + n) // HALF).clip(-1, passages - 1)
        change = np.zeros(passages + 1, np.int64)
        np.add.at(change, low, 1)
        np.add.at(change, np.maximum(low, high + 1), -1)
        yield int(k), np.flatnonzero(np.cumsum(change)[:-1] > 0)


def candidates(ids: np.ndarray, block: Block) -> Iterator[tuple[int, int, float]]:
    """Pairs of a passage (its first half-block) and an item passage of enough cosine, with the latent cosine.

    The cosine is that in the latent space, of the two projections, or that of the words themselves: a space of few
    dimensions tells the passages of a large benchmark apart only in part.
    """
    # Few texts hold enough words of an item: only these are read as passages.
    found = list(_open(ids, block, max(1, -(-len(ids) // HALF) - 1)))
    if not found:
        return
    half, word, n = _half_blocks(ids, len(block.weight))
    square = block.weight.astype(np.float64) ** 2
    whole = np.bincount(half, weights=square[word], minlength=n + 1) + np.bincount(np.flatnonzero(ids == 0) // HALF, minlength=n + 1) * square[0]
    norm = np.sqrt(whole[:-1] + (whole[1:] if n > 1 else 0))
    if block.scratch is None:
        block.scratch = np.zeros(len(block.weight))
    for k, near in found:
        own = np.arange(*np.searchsorted(block.owners, (k, k + 1)))
        for i in range(0, len(near), PASSAGES):
            part = near[i : i + PASSAGES]
            low = part[0]
            first, end = np.searchsorted(half, (low, part[-1] + 2))
            rows, at = word[first:end], half[first:end] - low
            places, starts = np.unique(at, return_index=True)
            sums = np.zeros((part[-1] + 2 - low, block.basis.shape[1]), np.float32)
            if len(rows):
                sums[places] = np.add.reduceat(block.weight[rows, None] * block.basis[rows], starts)
            projected = sums[part - low] + sums[part - low + 1]
            latent = projected @ block.latent[own].T
            latent /= np.linalg.norm(projected, axis=1).clip(1e-9)[:, None]
            for column, q in enumerate(own):
                theirs = block.passages[q]
                block.scratch[theirs] = square[theirs]
                shared = np.bincount(at, weights=block.scratch[rows], minlength=len(sums))
                norms = norm[part] * np.sqrt(block.scratch[theirs].sum())
                block.scratch[theirs] = 0.0
                lexical = (shared[part - low] + shared[part - low + 1]) / norms
                for j in np.flatnonzero((lexical >= COSINE) | (latent[:, column] >= COSINE)):
                    yield int(part[j]), int(q), float(latent[j, column])


def search(text: str, block: Block) -> list[tuple[int, float, float, float]]:
    """Items a text holds: ``item_id, similarity, common, answer``, each with its best passage."""
    ids = _ids(text, block.vocabulary)
    best: dict[int, tuple[float, float, float]] = {}
    for passage, q, cosine in candidates(ids, block):
        item = block.items[block.owners[q]]
        common, answer = verify(ids, passage * HALF, item)
        if common >= COMMON and (answer >= ANSWER or not item.given):
            best[item.item_id] = max(best.get(item.item_id, (0.0, 0.0, 0.0)), (common, answer, min(1.0, cosine)))
    return [(k, s, c, a) for k, (c, a, s) in sorted(best.items())]


def prepare(docs: DataFrame, block: Block) -> Block:
    """The block with word weights over all documents, the latent space and the items' places in it."""
    found, total, pairs = word_pairs(docs, block.vocabulary)
    block.weight = _weights(found, total, block.items)
    block.basis = latent_space(pairs, block)
    weighted = block.weight[:, None] * block.basis
    rows = np.stack([weighted[w].sum(axis=0) for w in block.passages])
    block.latent = (rows / np.linalg.norm(rows, axis=1).clip(1e-9)[:, None]).astype(np.float32)
    block.postings = Postings.of(block.items, block.weight)
    return block


HITS = "array<struct<item_id: long, similarity: double, common: double, answer: double>>"


def hits(docs: DataFrame, block: Block, text: str = "text"):
    """Column with the items of a block that each text holds; null and empty texts hold none."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    @F.pandas_udf(HITS)
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("item_id", "similarity", "common", "answer"), h, strict=True)) for h in search(t, shared.value)] for t in texts], dtype=object)

    return found(text_of(text))


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, similarity, common, answer`` for each row of ``docs`` and item it holds.

    ``similarity`` is the latent cosine of the best passage (both projections at length 1), ``common`` the share of the item's words found in order,
    ``answer`` that of its answer's words (of its end, where no
    answer is given; it decides nothing then). Clean, null and empty texts give no row, nor do null or wordless items. Rows
    with equal or null ids are searched each for itself; other columns are not read.
    """
    ship_package(spark)
    out = None
    for block in read_blocks(benchmark):
        if not block.items:
            continue
        texts = docs.select("doc_id", "text")
        part = texts.select("doc_id", F.explode(hits(texts, prepare(texts, block))).alias("hit")).select("doc_id", "hit.*")
        out = part if out is None else out.unionAll(part)
    return out if out is not None else docs.select("doc_id").limit(0).selectExpr("doc_id", "0L item_id", "0D similarity", "0D common", "0D answer")


def keep_clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, columns as they are."""
    ship_package(spark)
    kept = docs
    for block in read_blocks(benchmark):
        if block.items:
            kept = kept.where(F.size(hits(docs, prepare(docs, block))) == 0)
    return kept
