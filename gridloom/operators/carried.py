"""Rules whose later steps read the results of earlier ones: carried labels and indentation, as ``functions.blockwise`` runs them.

The facts they read: ``n`` (cells of a row), ``role`` (1 body, 2 label, 0 other), ``first`` (text of a row that may be a label).
"""

from __future__ import annotations

from typing import Any

import numpy as np

from gridloom.functions.blockwise import Block, State, before, latest
from gridloom.functions.text import WHITE_SPACE

BODY, LABEL = 1, 2


def _after(cut: int, labels: np.ndarray, pieces: list[str]) -> str:
    """The pieces of the labels after a row."""
    return "".join(p for at, p in zip(labels.tolist(), pieces, strict=True) if at > cut)


class RunningLabel:
    """The label above body rows. Neighbouring lone cells join with a space, a later one replaces them, a blank row ends it.

    State: the label's text, and whether the row above has one cell.
    """

    out = "__label string"

    @staticmethod
    def _steps(block: Block, one: bool) -> tuple[np.ndarray, ...]:
        blank, label = block["n"] == 0, block["role"] == LABEL
        restart = blank | (label & ~before(block["n"] == 1, one))
        return blank, label, restart

    def summarise(self, block: Block) -> State:
        # As if the row above had one cell: only a label in the first row depends on it.
        blank, label, restart = self._steps(block, True)
        labels, first = np.flatnonzero(label), block["first"]
        cut = int(latest(restart)[-1])
        head = first[0] if label[0] else None
        tail = _after(max(cut, 0 if head is not None else -1), labels, [f" {first[i]}" for i in labels])
        if cut >= 0 and label[cut]:
            tail = first[cut] + tail
        return {"head": head, "cut": cut >= 0, "tail": tail, "one": bool(block["n"][-1] == 1)}

    def chain(self, summaries: list[State]) -> list[State]:
        text, one, starts = "", False, []
        for s in summaries:
            starts.append({"text": text, "one": one})
            if s["cut"]:
                text = s["tail"]
            else:
                if s["head"] is not None:
                    text = f"{text} {s['head']}" if one else s["head"]
                text += s["tail"]
            one = s["one"]
        return starts

    def alone(self, block: Block) -> State:
        return {"text": "", "one": False}

    def run(self, block: Block, start: State) -> tuple[np.ndarray, dict[str, Any]]:
        blank, label, restart = self._steps(block, start["one"])
        first, labels = block["first"], np.flatnonzero(label)
        body = np.flatnonzero(block["role"] == BODY)
        event, begun = latest(blank | label)[body], latest(restart)
        texts = {-1: start["text"]}
        for at in np.unique(event[event >= 0]).tolist():
            if blank[at]:
                texts[at] = ""
                continue
            cut = int(begun[at])
            low, high = np.searchsorted(labels, (cut + 1, at + 1))
            base = start["text"] if cut < 0 else first[cut] if label[cut] else ""
            texts[at] = base + "".join([f" {first[i]}" for i in labels[low:high]])
        found = np.array([texts[e] for e in event.tolist()], object)
        kept = found != ""
        return body[kept], {"__label": found[kept]}


class KeptLabels:
    """Lone cells that stay as rows, continuing the label above; ``moved`` goes in front of the next row.

    State: whether the row above has one cell, whether there is a label to continue, its text so far and its first
    piece, and whether the row kept before is the one that moves.
    """

    out = "__above boolean, __text string"

    def __init__(self, moved: str) -> None:
        self.moved = moved

    def _steps(self, block: Block, one: bool, above: bool) -> tuple[np.ndarray, ...]:
        blank, label, first = block["n"] == 0, block["role"] == LABEL, block["first"]
        event = before(latest(blank | label), -1)
        open_label = np.where(event >= 0, label[event], above)
        flush = np.zeros(len(label), bool)
        labels = np.flatnonzero(label)
        flush[labels] = [not first[i].startswith(" ") for i in labels]
        joins = label & before(block["n"] == 1, one) & open_label & flush
        return blank, label, joins, (label & ~joins) | blank

    def _could_move(self, begin: str, last: str) -> bool:
        return self.moved.startswith(begin) and self.moved.endswith(last.strip(WHITE_SPACE))

    def summarise(self, block: Block) -> State:
        first = block["first"]
        # As if the block stood below an open label: only its first label depends on that.
        blank, label, joins, restart = self._steps(block, True, True)
        events = np.flatnonzero(blank | label)
        head = int(events[0]) if len(events) and label[events[0]] else -1
        open_head = head >= 0 and bool(joins[head])
        cuts = latest(restart)
        cut = int(cuts[-1])
        joined = np.flatnonzero(joins)
        pieces = [f" {first[i].strip(' ')}" for i in joined]
        tail = _after(max(cut, head if open_head else -1), joined, pieces)
        if cut >= 0 and label[cut]:
            tail = first[cut] + tail
        kept = np.flatnonzero(block["role"] != 0)
        mover: bool | str | None = None  # no row kept: as before; a text: the label's text so far decides, with this after it
        if len(kept):
            at = int(kept[-1])
            if block["n"][at] != 1 or first[at] is None:
                mover = False
            elif not joins[at]:
                mover = first[at] == self.moved
            elif cuts[at] >= 0:
                begin = int(cuts[at])
                low, high = np.searchsorted(joined, (begin + 1, at + 1))
                mover = (first[begin] if label[begin] else "") + "".join(pieces[low:high]) == self.moved
            else:
                mover = "".join(p for i, p in zip(joined.tolist(), pieces, strict=True) if head < i <= at)
                if len(mover) > len(self.moved):
                    mover = False
        return {
            "head": first[head] if open_head else None,
            "needs_one": head == 0,
            "cut": cut >= 0,
            "begin": first[cut] if cut >= 0 and label[cut] else None,
            "tail": tail,
            "open": bool(label[events[-1]]) if len(events) else None,
            "one": bool(block["n"][-1] == 1),
            "mover": mover,
        }

    def chain(self, summaries: list[State]) -> list[State]:
        one, above, text, begin, mover, starts = False, False, "", "", False, []
        for s in summaries:
            starts.append({"one": one, "above": above, "text": text, "begin": begin, "mover": mover})
            if s["head"] is not None:
                if above and (one or not s["needs_one"]):
                    text = f"{text} {s['head'].strip(' ')}"
                else:
                    text = begin = s["head"]
            if isinstance(s["mover"], str):
                mover = text + s["mover"] == self.moved
            elif s["mover"] is not None:
                mover = s["mover"]
            if s["cut"]:
                text, begin = s["tail"], s["begin"] if s["begin"] is not None else begin
            else:
                text += s["tail"]
            if s["open"] is not None:
                above = s["open"]
            one = s["one"]
        return starts

    def alone(self, block: Block) -> State:
        return {"one": False, "above": False, "text": "", "begin": "", "mover": False}

    def run(self, block: Block, start: State) -> tuple[np.ndarray, dict[str, Any]]:
        first, lone = block["first"], block["n"] == 1
        kept = np.flatnonzero(block["role"] != 0)
        if not ((block["role"] == LABEL) | (lone & (block["role"] != 0))).any():
            # Nothing to join, move or drop.
            return kept, {"__above": before(np.zeros(len(kept), bool), start["mover"]), "__text": np.full(len(kept), None, object)}
        blank, label, joins, restart = self._steps(block, start["one"], start["above"])
        begun, joined = latest(restart), np.flatnonzero(joins)
        pieces = [f" {first[i].strip(' ')}" for i in joined]
        texts = np.full(len(first), None, object)
        for k, at in enumerate(joined.tolist()):
            cut = int(begun[at])
            begin = start["begin"] if cut < 0 else first[cut]
            # A joined label stays only if its text begins with a blank and ends without a colon; else no text is
            # needed but for the one that moves.
            if (begin.startswith(" ") and not pieces[k].endswith(":")) or self._could_move(begin, first[at]):
                base = start["text"] if cut < 0 else first[cut]
                texts[at] = base + "".join(pieces[int(np.searchsorted(joined, cut + 1)) : k + 1])
        shown = np.where(joins, texts, first)
        moves = lone[kept] & (shown[kept] == self.moved)
        above = before(moves, start["mover"])
        stays = np.ones(len(kept), bool)
        for k in np.flatnonzero(lone[kept]).tolist():
            text, at = shown[kept[k]], kept[k]
            if joins[at] and text is None:
                stays[k] = False
                continue
            final = " ".join(t for t in (self.moved if above[k] else None, text) if t is not None) if above[k] or text is not None else None
            stays[k] = final is None or (final.startswith(" ") and not final.endswith(":"))
        decided = stays & ~moves
        at = kept[decided]
        return at, {"__above": above[decided], "__text": np.where(joins[at], texts[at], None)}


class LoneRuns:
    """Runs of lone rows join into a label for all later rows; the last two rows of a sheet are exempt.

    State: rows before and in all, the run that is open (text and length), the label, and whether the row below is lone.
    """

    out = "prefix string, __text string"

    @staticmethod
    def _runs(lone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end (exclusive) of the runs."""
        edges = np.flatnonzero(np.diff(np.concatenate([[0], lone.astype(np.int8), [0]])))
        return edges[0::2], edges[1::2]

    def summarise(self, block: Block) -> State:
        lone, value = block["lone"], block["first"]
        begins, ends = self._runs(lone)
        n, texts = len(lone), []
        inner = [i for i in range(len(begins)) if begins[i] > 0 and ends[i] < n]
        text = lambda i: " ".join(value[begins[i] : ends[i]])
        whole = bool(len(begins) == 1 and begins[0] == 0 and ends[0] == n)
        leads = len(begins) > 0 and begins[0] == 0 and not whole
        trails = len(begins) > 0 and ends[-1] == n
        return {
            "rows": n,
            "lone": bool(lone[0]),
            "whole": whole,
            "lead": text(0) if leads else None,
            "inner": text(inner[-1]) if inner else None,
            "trail": text(len(begins) - 1) if trails else None,
            "length": int(ends[-1] - begins[-1]) if trails else 0,
        }

    def chain(self, summaries: list[State]) -> list[State]:
        total, at, run, length, prefix, starts = sum(s["rows"] for s in summaries), 0, None, 0, None, []
        for s, below in zip(summaries, [*summaries[1:], {"lone": False}], strict=True):
            starts.append({"at": at, "of": total, "run": run, "length": length, "prefix": prefix, "below": below["lone"]})
            goes_on = s["lone"] and run is not None and at + 1 <= total - 1
            if s["whole"]:
                run, length = (f"{run} {s['trail']}", length + s["length"]) if goes_on else (s["trail"], s["length"])
            else:
                if s["lead"] is not None:
                    prefix = f"{run} {s['lead']}" if goes_on else s["lead"]
                if s["inner"] is not None:
                    prefix = s["inner"]
                run, length = s["trail"], s["length"]
            at += s["rows"]
            if run is not None and not (below["lone"] and at + 1 <= total - 1):
                if at <= total - 2:
                    prefix = run
                run, length = None, 0
        return starts

    def alone(self, block: Block) -> State:
        return {"at": 0, "of": len(block["lone"]), "run": None, "length": 0, "prefix": None, "below": False}

    def run(self, block: Block, start: State) -> tuple[np.ndarray, dict[str, Any]]:
        lone, value = block["lone"], block["first"]
        at = start["at"] + 1 + np.arange(len(lone))
        goes_on = lone & before(lone, start["run"] is not None) & (at <= start["of"] - 1)
        below = start["below"] and at[-1] + 1 <= start["of"] - 1
        ends = lone & ~np.append(goes_on[1:], below)
        exempt = at > start["of"] - 2
        begun = latest(lone & ~goes_on)
        prefixes, texts = np.full(len(lone), None, object), np.full(len(lone), None, object)
        for i in np.flatnonzero(ends).tolist():
            begin = int(begun[i])
            own = " ".join(value[max(begin, 0) : i + 1])
            length = i + 1 - max(begin, 0) + (start["length"] if begin < 0 else 0)
            text = f"{start['run']} {own}" if begin < 0 else own
            if exempt[i]:
                texts[i] = text if length > 1 else None
            else:
                prefixes[i] = text
        labelled = latest(ends & ~exempt)
        carried = np.where(labelled >= 0, prefixes[labelled], start["prefix"])
        kept = np.flatnonzero(~lone | (exempt & ends))
        return kept, {"prefix": carried[kept], "__text": texts[kept]}


class Indentation:
    """Labels with those they are indented under. State: the labels that are open, with their depths.

    A row ends all open labels that are as deep or deeper. So of what is open before a block, the entries above its
    shallowest row stay, and its own open labels come after them.
    """

    out = "__path string"

    @staticmethod
    def _walk(block: Block, stack: list[list]) -> list[str | None]:
        """Paths of the rows that have a label, in order; the stack is left as it is after them."""
        paths = []
        for level, label in zip(block["level"].tolist(), block["label"], strict=True):
            if label is None:
                continue
            while stack and stack[-1][0] >= level:
                stack.pop()
            above = stack[-1][1] if stack else ""
            path = f"{above} {label}" if above and label else above or label
            stack.append([level, path])
            paths.append(path)
        return paths

    def summarise(self, block: Block) -> State:
        stack: list[list] = []
        pieces = {"level": block["level"], "label": block["label"]}
        self._walk(pieces, stack)
        levels = block["level"][[label is not None for label in block["label"]]]
        return {"lowest": int(levels.min()) if len(levels) else None, "stack": stack}

    def chain(self, summaries: list[State]) -> list[State]:
        stack: list[list] = []
        starts = []
        for s in summaries:
            starts.append({"stack": stack})
            if s["lowest"] is None:
                continue
            stack = [e for e in stack if e[0] < s["lowest"]]
            above = stack[-1][1] if stack else ""
            stack = stack + [[level, f"{above} {path}" if above and path else above or path] for level, path in s["stack"]]
        return starts

    def alone(self, block: Block) -> State:
        return {"stack": []}

    def run(self, block: Block, start: State) -> tuple[np.ndarray, dict[str, Any]]:
        paths = self._walk(block, [list(e) for e in start["stack"]])
        at = np.flatnonzero([label is not None for label in block["label"]])
        return at, {"__path": np.array(paths, object)}
