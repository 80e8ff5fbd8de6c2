"""Best-fit packing with a swap-based local search.

All pieces of one length are alike, so the plan is made from the number of pieces of each length: at most
``capacity`` counts, whatever the corpus, and thus fit for the driver. Bins of equal content are one pattern with a
multiplicity. A cheap best fit gives the first patterns: falling lengths for the bulk, and the last ``TAIL`` pieces of
each length as they come, in scattered order. The local search then moves a piece, exchanges one for one or two for
one between underfull bins, each time so that the sum of squared fills grows, until the bins are as few as the tokens
allow or no exchange is left. The plan turns the rank of a piece among its length into a place.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm import encode
from gridloom.llm.common import text_of
from gridloom.session import settle, ship_package

#: Pieces of each length that the first packing takes in scattered order; they bound the work of the search.
TAIL = 1
#: Offers are held against so many contents at a time; the first ones with an exchange give the best of theirs.
BLOCK = 2048

Pattern = tuple[tuple[int, int], ...]  # (length, pieces of it), by falling length


def _fill(pattern: Pattern) -> int:
    return sum(length * n for length, n in pattern)


def _with(pattern: Pattern, add: dict[int, int]) -> Pattern:
    content = Counter(dict(pattern))
    for length, n in add.items():
        content[length] += n
    return tuple(sorted(((length, n) for length, n in content.items() if n), reverse=True))


def decreasing(counts: dict[int, int]) -> list[tuple[int, int]]:
    return sorted(counts.items(), reverse=True)


def scattered_tail(counts: dict[int, int], tail: int = TAIL) -> list[tuple[int, int]]:
    """The bulk of each length by falling length, then its last ``tail`` pieces in an order that knows no length."""
    bulk = [(length, n - tail) for length, n in decreasing(counts) if n > tail]
    return bulk + [(length, min(n, tail)) for length, n in sorted(counts.items(), key=lambda c: c[0] * 2654435761 % 2**32)]


def best_fit(pieces: Iterable[tuple[int, int]], capacity: int) -> Counter[Pattern]:
    """Patterns and multiplicities of best fit over lengths and their numbers, in the order given."""
    rooms: dict[int, Counter[Pattern]] = defaultdict(Counter)  # by room left
    for length, left in pieces:
        for room in sorted(r for r, found in rooms.items() if r >= length and found):
            if not left:
                break
            each = room // length
            for pattern, n in list(rooms[room].items()):
                whole = min(n, left // each)
                if whole:
                    rooms[room - each * length][_with(pattern, {length: each})] += whole
                    left -= whole * each
                rest = left if whole < n and left < each else 0
                if rest:
                    rooms[room - rest * length][_with(pattern, {length: rest})] += 1
                    left = 0
                rooms[room][pattern] -= whole + bool(rest)
                if not rooms[room][pattern]:
                    del rooms[room][pattern]
                if not left:
                    break
        each = capacity // length
        if left // each:
            rooms[capacity - each * length][((length, each),)] += left // each
        if left % each:
            rooms[capacity - left % each * length][((length, left % each),)] += 1
    return sum(rooms.values(), Counter())


def _groups(pattern: Pattern) -> list[tuple[int, ...]]:
    """Nothing, one piece, or two pieces of a bin, each content once."""
    sizes, have = [x for x, _ in pattern], dict(pattern)
    return [(), *[(x,) for x in sizes], *[(x, y) for i, x in enumerate(sizes) for y in sizes[i:] if x != y or have[x] > 1]]


class _Underfull:
    """Underfull patterns: what each can give (tokens, pieces, its room, its fill, its number) is a column of a table.

    Columns of patterns that are gone have room -1. ``seen`` tells up to which column a pattern has found no exchange.
    """

    def __init__(self) -> None:
        self.table, self.used = np.empty((5, 1 << 12), np.int64), 0
        self.number: dict[Pattern, int] = {}
        self.patterns: list[Pattern] = []
        self.columns: list[tuple[int, int]] = []
        self.seen: list[int] = []

    def enter(self, pattern: Pattern, fill: int, capacity: int) -> int:
        found = _groups(pattern)
        start, self.used = self.used, self.used + len(found)
        if self.used > self.table.shape[1]:
            self.table = np.concatenate([self.table, np.empty_like(self.table)], axis=1)
        own = self.table[:, start : self.used]
        own[0], own[1] = [sum(g) for g in found], [len(g) for g in found]
        own[2], own[3], own[4] = capacity - fill, fill, len(self.patterns)
        self.number[pattern] = len(self.patterns)
        self.patterns.append(pattern)
        self.columns.append((start, self.used))
        self.seen.append(0)
        return len(self.patterns) - 1

    def leave(self, pattern: Pattern) -> None:
        start, end = self.columns[self.number.pop(pattern)]
        self.table[2, start:end] = -1

    def shrink(self) -> None:
        """Columns of patterns that are gone go once they are most of the table."""
        live = self.table[2, : self.used] >= 0
        if self.used < 1 << 15 or 3 * np.count_nonzero(live) > self.used:
            return
        at = np.concatenate(([0], np.cumsum(live)))
        self.table[:, : at[-1]] = self.table[:, : self.used][:, live]
        self.used = int(at[-1])
        for i in self.number.values():
            self.seen[i] = int(at[self.seen[i]])
            self.columns[i] = tuple(int(at[c]) for c in self.columns[i])

    def exchange(self, i: int, alone: bool) -> tuple[Pattern, tuple[int, ...], tuple[int, ...]] | None:
        """A bin, what it takes from pattern ``i`` and what it gives back: one or two pieces, three in all at most.

        The sum of squares grows by 2 * moved * (moved + its fill - the giver's fill). ``alone``: the pattern is one bin.
        """
        offers = _groups(self.patterns[i])[1:]
        size, pieces = np.array([[sum(g), len(g)] for g in offers]).T[:, :, None]
        own = sum(x * n for x, n in self.patterns[i])
        end = self.used
        while end > self.seen[i]:
            start = max(self.seen[i], end - BLOCK)
            back, n, room, fill, number = self.table[:, start:end]
            moved = size - back
            rise = moved + fill - own
            fits = (moved > 0) & (moved <= room) & (rise > 0) & (n + pieces <= 3)
            if alone:
                fits &= number != i
            gain = np.where(fits, moved * rise, 0)
            best = int(gain.argmax())
            if gain.flat[best]:
                offer, column = divmod(best, end - start)
                other = int(number[column])
                return self.patterns[other], offers[offer], _groups(self.patterns[other])[start + column - self.columns[other][0]]
            end = start
        self.seen[i] = self.used
        return None


def local_search(bins: Counter[Pattern], capacity: int) -> tuple[Counter[Pattern], int]:
    """Exchanges between underfull bins until none helps, or the bins are as few as the tokens allow; and their number.

    The emptiest bins give first. Every exchange raises the sum of squared fills, so the search ends. A pattern
    without an exchange is held only against patterns that came later.
    """
    bins, steps = +bins, 0
    least, left = math.ceil(sum(_fill(p) * n for p, n in bins.items()) / capacity), sum(bins.values())
    under = _Underfull()
    givers = [(fill, under.enter(p, fill, capacity)) for p in bins for fill in (_fill(p),) if fill < capacity]
    heapq.heapify(givers)
    without: list[tuple[int, int]] = []
    while left > least and givers:
        fill, i = heapq.heappop(givers)
        giver = under.patterns[i]
        if under.number.get(giver) != i:
            continue
        found = under.exchange(i, bins[giver] < 2)
        if found is None:
            without.append((fill, i))
            continue
        taker, offer, back = found
        change = Counter(offer)
        change.subtract(back)
        times = bins[giver] // 2 if taker == giver else min(bins[giver], bins[taker])
        for old, new in ((taker, _with(taker, change)), (giver, _with(giver, {x: -n for x, n in change.items()}))):
            bins[old] -= times
            if not bins[old]:
                del bins[old]
                under.leave(old)
            if not new:
                left -= times
                continue
            if new in bins:
                if new in under.number:  # two of a kind may exchange where one could not
                    under.seen[under.number[new]] = 0
            elif _fill(new) < capacity:
                heapq.heappush(givers, (_fill(new), under.enter(new, _fill(new), capacity)))
            bins[new] += times
        for again in [*without, (fill, i)]:
            heapq.heappush(givers, again)
        without.clear()
        under.shrink()
        steps += 1
    return bins, steps


def packed(counts: dict[int, int], capacity: int) -> tuple[Counter[Pattern], int]:
    """The fewest bins the search finds, and its exchanges: a second start, falling lengths alone, where the first is above the bound."""
    least, best, steps = math.ceil(sum(x * n for x, n in counts.items()) / capacity), None, 0
    for order in (scattered_tail, decreasing):
        bins, n = local_search(best_fit(order(counts), capacity), capacity)
        steps += n
        if best is None or sum(bins.values()) < sum(best.values()):
            best = bins
        if sum(best.values()) == least:
            break
    return best, steps


def plan(counts: dict[int, int], capacity: int) -> pd.DataFrame:
    """Blocks ``length, slot, each, bin, offset``: from rank ``slot`` on, ``each`` pieces of a length go to each bin."""
    bins, _ = packed(counts, capacity)
    blocks, used, first = [], Counter(), 0
    for pattern, n in sorted(bins.items(), reverse=True):
        offset = 0
        for length, each in pattern:
            blocks.append((length, used[length], each, first, offset))
            used[length] += n * each
            offset += length * each
        first += n
    return pd.DataFrame(blocks, columns=["length", "slot", "each", "bin", "offset"]).astype("int64")


def pieces(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Columns but the text plus ``piece, start, length, ids_crc32``; longer documents are cut each ``capacity`` ids."""
    ship_package(docs.sparkSession)
    out = "array<struct<piece: int, start: long, length: long, ids_crc32: long>>"

    @F.pandas_udf(out)
    def cut(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from zlib import crc32

        encoder, end, step = encode.ids_encoder(path), encode.little_endian([end_id]), 4 * capacity
        for texts in parts:
            found = []
            for t in texts:
                ids = encoder(t) + end
                found.append([{"piece": k, "start": i // 4, "length": len(p) // 4, "ids_crc32": crc32(p)} for k, i in enumerate(range(0, len(ids), step)) for p in (ids[i : i + step],)])
            yield pd.Series(found, dtype=object)

    kept = [c for c in docs.columns if c != "text"]
    return docs.select(*kept, F.explode(cut(text_of())).alias("_piece")).select(*kept, "_piece.*")


def pack(cut: DataFrame, capacity: int = 4096) -> DataFrame:
    """Adds ``sequence_id, offset`` to rows with a ``length`` from 1 to ``capacity``.

    Ranks among a length are taken per writing task and shifted by the earlier tasks' counts, so no task sees all
    pieces of a length.
    """
    spark = cut.sparkSession
    ship_package(spark)
    rows = settle(cut.withColumns({"_task": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))
    counts = settle(rows.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_n")))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    blocks = spark.sparkContext.broadcast({int(k): g[["slot", "each", "bin", "offset"]].to_numpy().T for k, g in plan(totals, capacity).groupby("length")})

    @F.pandas_udf("sequence_id long, offset long")
    def places(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.empty((len(length), 2), np.int64)
        size, ranks = length.to_numpy(), rank.to_numpy()
        for k in np.unique(size):
            own = np.flatnonzero(size == k)
            slot, each, first, offset = blocks.value[int(k)]
            at = np.searchsorted(slot, ranks[own], side="right") - 1
            inside = ranks[own] - slot[at]
            out[own, 0] = first[at] + inside // each[at]
            out[own, 1] = offset[at] + inside % each[at] * k
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    before = counts.select("length", "_task", (F.sum("_n").over(Window.partitionBy("length").orderBy("_task")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("length", "_task").orderBy("_row")) - 1
    # The counts are many, one of a length and task, in small files; the rows lie in the order of a merge join already.
    ranked = rows.withColumn("_inside", inside).join(before.hint("merge"), ["length", "_task"])
    placed = ranked.withColumn("_place", places("length", (F.col("_before") + F.col("_inside")).cast("long")))
    return placed.select(*cut.columns, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece of a document.

    Null and empty texts are one piece that holds the end id. Rows with equal or null ids are packed each for itself;
    an empty table gives no rows; other columns are not read.
    """
    return pack(pieces(docs.select("doc_id", "text"), path, capacity, end_id), capacity)
