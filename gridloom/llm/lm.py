"""A hidden Markov language model over words.

Words of all training texts are counted. The most frequent ones are symbols of their own; all other words, unknown ones
too, are one symbol, inside which a word has its share by count. Latent states and what they emit are trained by
Baum-Welch: tasks run forward and backward over their texts and add up expected counts, which Spark sums. Training is
incremental: texts fall into folds by hash, each step renews the counts of one fold, and the model is made from the
latest counts of all folds, so every text counts and the model improves several times per pass. The scaled forward
recursion then gives the exact probability of each whole text.

The emission table has a fixed number of symbols. Words beyond the broadcast table of counts are looked up by a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridloom.llm.common import remainder, text_of
from gridloom.session import settle, ship_package

#: Words whose counts are broadcast, at most; symbols the states emit (the first is the end, the last any other word).
TABLE, SYMBOLS = 131_072, 16_384
STATES, FOLDS, EPOCHS = 8, 4, 2
#: Strength, in tokens, of the prior that draws each state's emissions towards the corpus' frequencies.
PRIOR = 50.0
#: Tokens a task runs through at once, distinct words it counts before it hands them on, and sums per adding task.
BUNDLE, HELD, FAN = 400_000, 1_000_000, 64

END = b""


def tokens(text: str) -> list[bytes]:
    """Words of a text, with A-Z in lower case; both steps see ASCII only."""
    return text.encode().lower().split()


def count_words(texts: DataFrame) -> DataFrame:
    """``word, c`` of all texts, the end of a text as the empty word; tasks hand on sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(seen: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        seen: Counter[bytes] = Counter()
        for batch in batches:
            for t in batch.column(0):
                seen.update(tokens(t.as_py()))
                if len(seen) >= HELD:
                    yield rows(seen)
                    seen.clear()
            if batch.num_rows:
                seen[END] += batch.num_rows
        if seen:
            yield rows(seen)

    return texts.select(text_of().alias("t")).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Words:
    """Counts of the corpus and the words known to every task."""

    total: int  # N
    distinct: int  # V
    ranks: dict[bytes, int]  # by falling count, ties by word
    counts: np.ndarray  # by rank
    ends: int
    symbols: int

    @property
    def own(self) -> int:
        """Words with a symbol of their own."""
        return min(len(self.ranks), self.symbols - 2)

    @property
    def whole(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    @property
    def other(self) -> float:
        """What the last symbol weighs: other words, unseen ones and the unknown."""
        seen = int(self.counts[: self.own].sum()) + self.ends
        kinds = self.own + (self.ends > 0)
        return self.total - seen + 0.5 * (self.distinct - kinds + 1)

    def frequencies(self) -> np.ndarray:
        """Probabilities of the symbols as the unigram model has them."""
        out = np.zeros(self.symbols)
        out[0] = self.ends + 0.5
        out[1 : self.own + 1] = self.counts[: self.own] + 0.5
        out[-1] = self.other
        return out / out.sum()


def size_class(c: Column) -> Column:
    """Counts within about 4 % of each other."""
    return F.floor(F.log2(c) * 16).cast("int")


def known_words(counted: DataFrame, table: int = TABLE, symbols: int = SYMBOLS) -> tuple[Words, int]:
    """The most frequent words, ``table`` at most, and the first class of counts they come from.

    Whole classes of counts are taken, from the top, as long as their words fit. The driver gets a number per class (a
    thousand at most) and the words that fit, however many tasks there are.
    """
    classes = counted.where(F.length("word") > 0).groupBy(size_class(F.col("c")).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
    first, room = 1 << 20, table
    for k, n in sorted(((r["k"], r["n"]) for r in classes), reverse=True):
        if n > room:
            break
        first, room = k, room - n
    sums = counted.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.when(F.length("word") == 0, F.col("c"))).alias("ends")).first()
    top = counted.where((F.length("word") > 0) & (size_class(F.col("c")) >= first)).select("word", "c").toArrow()
    found = sorted(zip(top["word"].to_pylist(), top["c"].to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))
    ranks = {w: i for i, (w, _) in enumerate(found)}
    counts = np.array([c for _, c in found], np.int64)
    return Words(int(sums["n"] or 0), int(sums["v"]), ranks, counts, int(sums["ends"] or 0), symbols), first




ENCODED = "n_tokens long, n_known long, base double, inside double, symbols binary, rare array<struct<h: long, n: int>>"


def encode(rows: DataFrame, words: Words) -> DataFrame:
    """Texts as symbols, with the sums over words that every task knows and the hashes of those it doesn't."""
    shared = rows.sparkSession.sparkContext.broadcast(words)
    schema = StructType([*rows.drop("_text").schema.fields, *StructType.fromDDL(ENCODED).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        w = shared.value
        get, own, last = w.ranks.get, w.own, w.symbols - 1
        base_of = np.log10((w.counts + 0.5) / w.whole)
        inside_of = np.log10((w.counts + 0.5) / w.other)
        inside_of[:own] = 0.0
        end = math.log10((w.ends + 0.5) / w.whole)
        for batch in batches:
            out: list[tuple] = []
            for t in batch.column(batch.num_columns - 1):
                found = tokens(t.as_py())
                ranks = np.fromiter(map(get, found, repeat(-1)), np.int64, len(found))
                known = ranks[ranks >= 0]
                symbols = np.zeros(len(found) + 1, "<u2")
                symbols[:-1] = np.where((ranks >= 0) & (ranks < own), ranks + 1, last)
                rare = Counter(found[i] for i in np.flatnonzero(ranks < 0).tolist())
                hashed = [{"h": h - (1 << 64) if h >> 63 else h, "n": n} for h, n in ((xxh64_intdigest(x, 42), n) for x, n in rare.items())]
                out.append((len(found) + 1, len(known) + (w.ends > 0), float(base_of[known].sum()) + end, float(inside_of[known].sum()), symbols.tobytes(), hashed))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int32())]))]
            made = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=schema.names)

    return rows.mapInArrow(run, schema)


@dataclass
class Model:
    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray  # states by symbols


class Bundle:
    """Texts side by side, longest first: step t holds the t-th symbol of every text that has one."""

    def __init__(self, texts: list[np.ndarray]):
        lengths = np.array([len(t) for t in texts])
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # texts longer than t
        self.at = np.concatenate(([0], np.cumsum(active)))
        step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.text = np.repeat(np.arange(len(texts)), lengths)
        place = self.at[step] + self.text
        self.symbols = np.empty(len(place), np.int64)
        self.symbols[place] = np.concatenate([texts[i] for i in self.order])
        self.place, self.step = place, step

    def forward(self, model: Model, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the states emit, scaled forward probabilities, and the scale of each step."""
        emitted = np.ascontiguousarray(model.emits.T.astype(kind))[self.symbols]
        moves, at = model.moves.astype(kind), self.at
        ahead, scale = np.empty_like(emitted), np.empty(len(emitted), kind)
        now = model.start.astype(kind) * emitted[: at[1]]
        for t in range(len(at) - 1):
            low, high = at[t], at[t + 1]
            if t:
                now = now[: high - low] @ moves
                now *= emitted[low:high]
            s = now.sum(axis=1)
            now = now / s[:, None]
            ahead[low:high], scale[low:high] = now, s
        return emitted, ahead, scale

    def log10(self, model: Model) -> np.ndarray:
        """Exact log10 probabilities of the texts, in the order given."""
        _, _, scale = self.forward(model, np.float64)
        found = np.bincount(self.text, weights=np.log10(scale[self.place]), minlength=len(self.order))
        out = np.empty(len(found))
        out[self.order] = found
        return out

    def expected(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of starts, moves and emissions."""
        emitted, ahead, scale = self.forward(model, np.float32)
        moves, at = model.moves.astype(np.float32), self.at
        behind = np.ones_like(emitted)
        emitted /= scale[:, None]  # from here on: emitted and scaled
        for t in range(len(at) - 2, 0, -1):
            low, high = at[t], at[t + 1]
            emitted[low:high] *= behind[low:high]
            behind[at[t - 1] : at[t - 1] + high - low] = emitted[low:high] @ moves.T
        later = self.step > 0
        now, before = self.place[later], self.at[self.step[later] - 1] + self.text[later]
        moved = model.moves * (ahead[before].T @ emitted[now])
        states = ahead * behind
        emits = np.stack([np.bincount(self.symbols, weights=states[:, k], minlength=model.emits.shape[1]) for k in range(len(model.start))])
        return states[: at[1]].sum(axis=0), moved, emits


def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], list[dict]]]:
    """Texts of about ``BUNDLE`` tokens at a time; long texts wait for each other, so that steps hold several."""
    short: list[tuple[np.ndarray, dict]] = []
    long: list[tuple[np.ndarray, dict]] = []
    sizes = [0, 0]
    for batch in batches:
        symbols = batch.column(batch.schema.get_field_index("symbols"))
        rest = batch.drop_columns(["symbols"]).to_pylist()
        for s, row in zip(symbols, rest, strict=True):
            text = np.frombuffer(s.as_buffer(), "<u2")
            k = len(text) > 2000
            (long if k else short).append((text.copy(), row))
            sizes[k] += len(text)
            for which, held in ((0, short), (1, long)):
                if sizes[which] >= BUNDLE:
                    yield [x for x, _ in held], [r for _, r in held]
                    held.clear()
                    sizes[which] = 0
    for held in (short, long):
        if held:
            yield [x for x, _ in held], [r for _, r in held]


def add_up(parts: DataFrame, tasks: int) -> dict[int, np.ndarray]:
    """Sums of arrays ``part, block, body`` over parts, ``FAN`` at a time; only the sums come to the driver."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b, np.float64) for b in group["body"])
        return pd.DataFrame({"part": group["part"][:1], "block": group["block"][:1], "body": [total.tobytes()]})

    while True:
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("part", "block").applyInPandas(add, "part int, block int, body binary")
        tasks = -(-tasks // FAN)
        if tasks <= 1:
            return {r["block"]: np.frombuffer(r["body"], np.float64) for r in parts.collect()}


def expected_counts(texts: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """One expectation step over ``symbols``, one block per state and one for starts and moves."""
    states = len(model.start)
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for symbols, _ in bundles(batches):
            found = Bundle(symbols).expected(shared.value)
            total = found if total is None else tuple(x + y for x, y in zip(total, found, strict=True))
        if total is not None:
            bodies = [np.concatenate([total[0], total[1].ravel()]).astype(np.float64), *total[2].astype(np.float64)]
            part = [TaskContext.get().partitionId()] * len(bodies)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(range(len(bodies)), pa.int32()), pa.array([b.tobytes() for b in bodies], pa.binary())], names=["part", "block", "body"])

    parts = texts.select("symbols").mapInArrow(run, "part int, block int, body binary")
    sums = add_up(parts, texts.rdd.getNumPartitions())
    shared.unpersist()
    if not sums:
        return None
    return sums[0][:states], sums[0][states:].reshape(states, states), np.stack([sums[k + 1] for k in range(states)])


def train(texts: DataFrame, words: Words, states: int = STATES, folds: int = FOLDS, epochs: int = EPOCHS) -> Model:
    """Incremental Baum-Welch over ``symbols, fold``; without texts the states emit the corpus' frequencies."""
    frequencies = words.frequencies()
    random = np.random.default_rng(42)
    emits = frequencies * random.lognormal(0.0, 1.0, (states, words.symbols))
    stay = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    model = Model(np.full(states, 1 / states), stay, emits / emits.sum(axis=1, keepdims=True))
    if not words.total:
        return Model(model.start, model.moves, np.tile(frequencies, (states, 1)))
    latest: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for step in range(folds * epochs):
        fold = step % folds
        found = expected_counts(texts.where(F.col("fold") == fold), model)
        if found:
            latest[fold] = found
        start, moves, emits = (sum(x[k] for x in latest.values()) for k in range(3)) if latest else (0, 0, 0)
        start, moves, emits = start + 1 / states, moves + stay, emits + PRIOR * frequencies
        model = Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=1, keepdims=True))
    return model


def sequence_scores(encoded: DataFrame, model: Model) -> DataFrame:
    """``row, ahead``: log10 probability of each text's symbols."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for symbols, rows in bundles(batches):
            found = Bundle(symbols).log10(shared.value)
            yield pa.RecordBatch.from_arrays([pa.array([r["row"] for r in rows], pa.int64()), pa.array(found, pa.float64())], names=["row", "ahead"])

    return encoded.select("row", "symbols").mapInArrow(run, "row long, ahead double")


def held_out() -> Column:
    return remainder("doc_id", 5) == 1


def score_documents(docs: DataFrame, table: int = TABLE, symbols: int = SYMBOLS, states: int = STATES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    ``score`` is the model's log10 probability of the whole text with its end, unknown words as one kind; held-out rows
    teach nothing. Null and empty texts are an end alone. Rows with equal or null ids are each scored; null ids count as
    training. Without training rows all words are unknown and the model is the unigram one. An empty table gives none.
    """
    ship_package(docs.sparkSession)
    given = docs.select("doc_id", "text").withColumn("held_out", held_out())
    counted = settle(count_words(given.where("not held_out")))
    words, first = known_words(counted, table, symbols)
    fold = F.when(F.col("held_out"), -1).otherwise(F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int"))
    rows = given.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", fold.alias("fold"), text_of().alias("_text"))
    encoded = settle(encode(rows, words))
    model = train(encoded, words, states)
    # Words beyond the table, by the classes of counts that did not fit.
    beyond = counted.where((size_class(F.col("c")) < first) & (F.length("word") > 0)).groupBy(F.xxhash64("word").alias("h")).agg(F.max("c").alias("c"))
    rare = encoded.select("row", F.explode("rare").alias("x")).select("row", "x.h", "x.n").join(beyond, "h", "left")
    c = F.coalesce("c", F.lit(0)) + 0.5
    sums = rare.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(c / words.whole)).alias("rare_base"),
        F.sum(F.col("n") * F.log10(c / words.other)).alias("rare_inside"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"),
    )
    heads = encoded.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "inside")
    scored = heads.join(sequence_scores(encoded, model), "row").join(sums, "row", "left")
    none = F.lit(0.0)
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", none)).alias("base_score"),
        (F.col("ahead") + F.col("inside") + F.coalesce("rare_inside", none)).alias("score"),
    )
