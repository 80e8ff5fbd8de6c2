"""Rules that carry a state from row to row, over blocks of a sheet.

``ordered.over_blocks`` answers one question per scan. A rule whose later steps read the results of earlier ones would
take a scan for each. Here such a rule sees a whole block at once and works out all its steps; what it must know of
the rows before (and the row after) is a small state. Three steps, of which none holds more than a block of rows or one summary
per block of a sheet:

1. ``summarise``: what a block does to a state that is not known yet;
2. ``chain``: over the summaries of one sheet, the state at the start of each block;
3. ``run``: the block's results, from its start.

Most sheets are one block, whose start needs no summaries (``alone``): it is run at once. Only blocks of longer sheets are
summarised and chained.

The facts a rule reads are written once, as small columns; the rows themselves are only read to work out the facts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.ordered import _BLOCK, with_blocks
from gridloom.session import settle, ship_package

#: Columns of a block by name, in the order of its rows.
Block = dict[str, np.ndarray]
#: Summaries and states; plain enough for JSON.
State = dict[str, Any]


class Rule(Protocol):
    """A rule in three steps; ``out`` is the schema of the columns of ``run``, ``at`` among its results tells their rows."""

    out: str

    def summarise(self, block: Block) -> State: ...

    def chain(self, summaries: list[State]) -> list[State]: ...

    def alone(self, block: Block) -> State: ...

    def run(self, block: Block, start: State) -> tuple[np.ndarray, dict[str, Any]]: ...


def _blocks(batches: Iterator[pd.DataFrame], group: Sequence[str]) -> Iterator[tuple[tuple, Block]]:
    """Whole blocks of rows sorted by block, however the batches cut them."""
    held: list[pd.DataFrame] = []
    last: tuple | None = None
    for pdf in batches:
        if not len(pdf):
            continue
        changes = np.zeros(len(pdf), bool)
        for name in group:
            column = pdf[name].to_numpy()
            changes[1:] |= column[1:] != column[:-1]
        first = tuple(pdf[list(group)].iloc[0])
        if held and first != last:
            yield last, _columns(held)
            held = []
        columns = {name: pdf[name].to_numpy() for name in pdf.columns}
        begins = [0, *np.flatnonzero(changes).tolist()]
        for begin, end in zip(begins, [*begins[1:], len(pdf)], strict=True):
            key = tuple(columns[name][begin] for name in group)
            if end < len(pdf):
                if held:
                    yield key, _columns([*held, pdf.iloc[begin:end]])
                    held = []
                else:
                    yield key, {name: c[begin:end] for name, c in columns.items()}
            else:
                held.append(pdf.iloc[begin:end])
                last = key
    if held:
        yield last, _columns(held)


def _columns(parts: list[pd.DataFrame]) -> Block:
    whole = parts[0] if len(parts) == 1 else pd.concat(parts)
    return {name: whole[name].to_numpy() for name in whole.columns}


def _stacked(held: list[tuple[tuple, np.ndarray, dict[str, Any]]], keys: Sequence[str], order: str) -> pd.DataFrame:
    """Results of many blocks as one frame: frames of a few rows each would cost more than the rule."""
    sizes = [len(places) for _, places, _ in held]
    columns: dict[str, Any] = {name: np.repeat(np.array([key[i] for key, _, _ in held], object), sizes) for i, name in enumerate(keys)}
    columns[order] = np.concatenate([places for _, places, _ in held]).astype(np.int64)
    for name in held[0][2]:
        columns[name] = np.concatenate([np.asarray(out[name]) for _, _, out in held])
    return pd.DataFrame(columns)


def carry_through(
    rows: DataFrame, keys: Sequence[str], order: str, facts: Mapping[str, Column], rule: Rule, rows_per_block: int | None = None
) -> DataFrame:
    """``keys, order`` and the columns of the rule, for the rows it gives a result for.

    ``facts`` must not be NULL unless they are texts; like ``keys`` and ``order`` they follow the module text of ``ordered``.
    """
    ship_package(rows.sparkSession)
    group = [*keys, _BLOCK]
    narrow = settle(with_blocks(rows, order, rows_per_block).select(*group, order, *[c.alias(n) for n, c in facts.items()]))
    types = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    named = lambda columns: ", ".join(f"{c} {types[c]}" for c in columns)

    def summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [(*key, json.dumps(rule.summarise(block))) for key, block in _blocks(batches, group)]
        if found:
            yield pd.DataFrame(found, columns=[*group, "__state"])

    def chained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Sheets one after the other in a task: most are small, and a group of its own for each would cost more than the rule.
        held: list[tuple] = []
        for key, sheet in _blocks(batches, keys):
            starts = rule.chain([json.loads(s) for s in sheet["__state"]])
            held += [(*key, block, json.dumps(s)) for block, s in zip(sheet[_BLOCK].tolist(), starts, strict=True)]
            if len(held) >= 10_000:
                yield pd.DataFrame(held, columns=[*group, "__state"])
                held = []
        if held:
            yield pd.DataFrame(held, columns=[*group, "__state"])

    def results(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[tuple, np.ndarray, dict[str, Any]]] = []
        size = 0
        for key, block in _blocks(batches, group):
            # The start stands in a row of its own, before all others; the only block of a sheet has none.
            if block["__state"][0] is None:
                start = rule.alone(block)
            else:
                start = json.loads(block["__state"][0])
                block = {name: c[1:] for name, c in block.items()}
            at, out = rule.run(block, start)
            if not len(at):
                continue
            held.append((key, block[order][at], out))
            size += len(at)
            if size >= 10_000:
                yield _stacked(held, keys, order)
                held, size = [], 0
        if held:
            yield _stacked(held, keys, order)

    spans = narrow.groupBy(*keys).agg(F.min(_BLOCK).alias("__low"), F.max(_BLOCK).alias("__high"))
    several = settle(spans.filter("__low < __high").select(*keys))
    in_several = narrow.join(several, list(keys), "left_semi").select(*narrow.columns)
    ends = in_several.repartition(*group).sortWithinPartitions(*group, order).mapInPandas(summaries, f"{named(group)}, __state string")
    in_order = ends.repartition(*keys).sortWithinPartitions(*group)
    starts = in_order.mapInPandas(chained, f"{named(group)}, __state string")
    # Facts are never NULL where they are numbers, so that a row of the start gives its own values for them.
    filler = [F.lit(None).cast(types[n]) if types[n] == "string" else F.lit(0).cast(types[n]) for n in facts]
    none = F.lit(None).cast("string").alias("__state")
    both = narrow.select(*group, order, *facts, none).unionAll(
        starts.select(*group, F.lit(-(1 << 62)).cast(types[order]).alias(order), *filler, "__state")
    )
    ready = both.repartition(*group).sortWithinPartitions(*group, order)
    return ready.mapInPandas(results, f"{named([*keys, order])}, {rule.out}")


# ---- helpers of rules -------------------------------------------------------------------------------------------


def latest(marks: np.ndarray) -> np.ndarray:
    """Place of the last marked row up to each row, -1 before the first."""
    return np.maximum.accumulate(np.where(marks, np.arange(len(marks)), -1)) if len(marks) else np.zeros(0, np.int64)


def before(values: np.ndarray, first: Any) -> np.ndarray:
    """The value of the row above; ``first`` for the first row."""
    above = np.empty_like(values)
    above[:1], above[1:] = first, values[:-1]
    return above


class Machine:
    """A rule of finitely many states, as moves by code of a row: next state, and whether the row is marked.

    A block is a function from state to state. Its rows are laid out in lanes of about the square root of their
    number: all lanes go forward together, from all states at once, and are then put one after the other.
    """

    def __init__(self, following: Sequence[Sequence[int]], marked: Sequence[Sequence[bool]]) -> None:
        states = range(len(following[0]))
        # One more code, which changes nothing, fills the last lane.
        self.following = np.array([*following, list(states)], np.int64)
        self.marked = np.array([*marked, [False] * len(states)], np.int64)

    def _lanes(self, codes: np.ndarray) -> np.ndarray:
        width = max(1, int(np.ceil(np.sqrt(len(codes)))))
        lanes = -(-len(codes) // width)
        filled = np.full(lanes * width, len(self.following) - 1, np.int64)
        filled[: len(codes)] = codes
        return filled.reshape(lanes, width)

    def ends(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per start state, the state after the rows and the number of marked ones."""
        states = np.arange(self.following.shape[1])
        marks = np.zeros_like(states)
        for to, count in zip(*self._forward(self._lanes(codes)), strict=True):
            marks, states = marks + count[states], to[states]
        return states, marks

    def _forward(self, lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for each lane by itself."""
        states = np.tile(np.arange(self.following.shape[1]), (len(lanes), 1))
        marks = np.zeros_like(states)
        for column in lanes.T[:, :, None]:
            marks += self.marked[column, states]
            states = self.following[column, states]
        return states, marks

    def marks(self, codes: np.ndarray, start: int) -> np.ndarray:
        """The marked rows, from a known start."""
        lanes = self._lanes(codes)
        state, starts = start, []
        for to in self._forward(lanes)[0]:
            starts.append(state)
            state = int(to[state])
        states, out = np.array(starts, np.int64), np.zeros(lanes.shape, bool)
        for i, column in enumerate(lanes.T):
            out[:, i] = self.marked[column, states]
            states = self.following[column, states]
        return out.ravel()[: len(codes)]
