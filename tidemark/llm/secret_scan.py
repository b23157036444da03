"""Secrets by one combined automaton.

The rules' patterns are compiled together: syntax tree, nondeterministic automaton, subset construction, minimisation,
and a transition array over all 256 bytes. One pass over the bytes finds where any rule matches. Many stretches of
text are run side by side: bytes that lead from every state to the start ("resets", such as line feeds) cannot lie
inside a match, so texts are cut behind them. The few stretches with a match are read backwards by one automaton of all
patterns reversed, which tells for every byte the rules that have a match starting there. Spans are read from these starts
only, so no start fails and the time is linear in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import as_bytes, slices
from tidemark.llm.rolling import laid_out
from tidemark.session import column

# Bytes a stretch has at least, if its text is that long.
STRETCH_BYTES = 256
SLICE_BYTES = 4 << 20
# With fewer stretches left a step for all of them costs more than to read them one after the other.
SIDE_BY_SIDE = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the syntax of :class:`Parser`, leftmost, longest, without overlaps; shorter matches are dropped.

    ``needed`` matches inside every match that is kept. It starts the search, and is kept short where starts can
    overlap, as that multiplies states. With ``value`` the minimum is that of what
    follows the first ``:`` or ``=``, spaces and one quote.
    """

    kind: str
    pattern: str
    minimum: int
    needed: str
    value: bool = False

    def keeps(self, match: bytes) -> bool:
        if not self.value:
            return len(match) >= self.minimum
        _, _, rest = re.split(rb"([:=])", match, maxsplit=1)
        rest = rest.lstrip(b" ")
        return len(rest[1:] if rest[:1] in (b'"', b"'") else rest) >= self.minimum


def any_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


# The rules.
KEYWORDS = "(" + "|".join(any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + any_case("api") + "_?" + any_case("key") + ")"
ASSIGN = KEYWORDS + "[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]"
BASE_RULES = (
    Rule("assign", ASSIGN + "+", 6, ASSIGN, value=True),
    Rule("access", "AKIA[A-Z0-9]+", 20, "AKIA[A-Z0-9]"),
    Rule("hex", "[0-9a-f]+", 24, "[0-9a-f]{24}"),
)
RULES = (
    *BASE_RULES,
    Rule("github", "gh[oprsu]_[A-Za-z0-9]+", 40, "gh[oprsu]_[A-Za-z0-9]"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 30, "eyJ[A-Za-z0-9_-]"),
    Rule("key_block", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, "PRIVATE KEY-----"),
)


class Parser:
    """Literals, ``[...]`` with ranges, ``( | )``, ``? * + {n}``, into trees of byte sets."""

    def __init__(self, pattern: str) -> None:
        self.text, self.at = pattern, 0

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def choice(self) -> tuple:
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return ("any", options)

    def sequence(self) -> tuple:
        items = []
        while self.peek() not in ("", "|", ")"):
            item = self.item()
            if self.peek() in ("?", "*", "+"):
                low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}[self.take()]
                item = ("repeat", item, low, high)
            elif self.peek() == "{":
                end = self.text.index("}", self.at)
                count = int(self.text[self.at + 1 : end])
                item, self.at = ("repeat", item, count, count), end + 1
            items.append(item)
        return ("all", items)

    def item(self) -> tuple:
        char = self.take()
        if char == "(":
            inner = self.choice()
            self.take()
            return inner
        if char != "[":
            return ("bytes", frozenset([ord(char)]))
        members: set[int] = set()
        while self.peek() != "]":
            low = ord(self.take())
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                members.update(range(low, ord(self.take()) + 1))
            else:
                members.add(low)
        self.take()
        return ("bytes", frozenset(members))


class Nondeterministic:
    """States with edges on byte sets and free edges."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def add(self, tree: tuple, start: int) -> int:
        """The state reached from ``start`` through the tree."""
        if tree[0] == "bytes":
            end = self.state()
            self.edges[start].append((tree[1], end))
            return end
        if tree[0] == "all":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        if tree[0] == "any":
            end = self.state()
            for part in tree[1]:
                entry = self.state()
                self.free[start].append(entry)
                self.free[self.add(part, entry)].append(end)
            return end
        _, part, low, high = tree
        for _ in range(low):
            start = self.add(part, start)
        if high is None:
            hub = self.state()
            self.free[start].append(hub)
            self.free[self.add(part, hub)].append(hub)
            return hub
        end = self.state()
        self.free[start].append(end)
        for _ in range(high - low):
            start = self.add(part, start)
            self.free[start].append(end)
        return end

    def closure(self, states: set[int]) -> frozenset:
        found, todo = set(states), list(states)
        while todo:
            for other in self.free[todo.pop()]:
                if other not in found:
                    found.add(other)
                    todo.append(other)
        return frozenset(found)


def reversed_tree(tree: tuple) -> tuple:
    """The tree of the same strings read backwards."""
    kind, inner, *rest = tree
    if kind == "bytes":
        return tree
    if kind == "repeat":
        return (kind, reversed_tree(inner), *rest)
    parts = [reversed_tree(part) for part in inner]
    return (kind, parts[::-1] if kind == "all" else parts)


@dataclass(frozen=True)
class Automaton:
    """``table[state, byte]`` is the next state; state 0 is the start; accepting states come last.

    Bit n of ``matched[state]`` is set where pattern n matches.
    """

    table: np.ndarray
    accepting: int
    matched: list[int]


def compiled(patterns: list[str], search: bool, backwards: bool = False) -> Automaton:
    """One automaton for all patterns; with ``search`` they may start at any byte."""
    loose = Nondeterministic()
    begin = loose.state()
    ends: dict[int, int] = {}
    for number, pattern in enumerate(patterns):
        entry = loose.state()
        loose.free[begin].append(entry)
        tree = Parser(pattern).choice()
        ends[loose.add(reversed_tree(tree) if backwards else tree, entry)] = 1 << number
    # Bytes that no pattern tells apart share a column while states are built.
    sets = sorted({s for edges in loose.edges for s, _ in edges}, key=sorted)
    columns: dict[tuple, int] = {}
    of_byte = np.array([columns.setdefault(tuple(b in s for s in sets), len(columns)) for b in range(256)])
    samples = [int(np.flatnonzero(of_byte == c)[0]) for c in range(len(columns))]
    moves = [[{to for members, to in edges if b in members} for b in samples] for edges in loose.edges]
    first = loose.closure({begin})
    numbers, rows, order = {first: 0}, [], [first]
    for subset in order:
        row = []
        for c in range(len(samples)):
            target = loose.closure({to for state in subset for to in moves[state][c]} | ({begin} if search else set()))
            if target not in numbers:
                numbers[target] = len(order)
                order.append(target)
            row.append(numbers[target])
        rows.append(row)
    masks = [sum(ends[state] for state in subset if state in ends) for subset in order]
    table, group = np.array(rows), np.unique(np.array(masks), return_inverse=True)[1].ravel()
    # States stay together while their successors do.
    while True:
        _, finer = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == group.max():
            break
        group = finer
    matched = np.zeros(group.max() + 1, np.int64)
    matched[group] = masks
    accepts = matched > 0
    rank = np.lexsort((np.arange(len(accepts)) != group[0], accepts))
    place = np.empty(len(rank), np.int64)
    place[rank] = np.arange(len(rank))
    small = np.empty((len(rank), len(samples)), np.int32)
    small[place[group]] = place[group[table]]
    return Automaton(small[:, of_byte], int((~accepts).sum()), matched[rank].tolist())


class Scanner:
    """The combined automata, forwards to find stretches and backwards to find starts, and those of the single rules."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        self.all = compiled([rule.needed for rule in rules], search=True)
        self.flat = np.ascontiguousarray(self.all.table.ravel())
        self.resets = (self.all.table == 0).all(axis=0)
        assert self.resets[ord("\n")], "a line feed must not lie inside a match"
        self.rows = self.all.table.tolist()
        back = compiled([rule.pattern for rule in rules], search=True, backwards=True)
        self.back, self.back_accepting, self.begun = back.table.tolist(), back.accepting, back.matched
        self.single = []
        for rule in rules:
            one = compiled([rule.pattern], search=False)
            # The state that nothing leads out of and that accepts nothing.
            dead = next((s for s in range(one.accepting) if (one.table[s] == s).all()), -1)
            self.single.append((one.table.tolist(), one.accepting, dead))

    def stretches(self, buffer: np.ndarray) -> np.ndarray:
        """Starts of stretches, each behind a reset."""
        behind = np.flatnonzero(self.resets[buffer]) + 1
        picked = np.searchsorted(behind, np.arange(STRETCH_BYTES, len(buffer), STRETCH_BYTES))
        return np.unique(np.concatenate([[0], behind[picked[picked < len(behind)]]]))

    def hits(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the stretches in which some rule matches: one step for the next byte of all of them.

        The last few, which are the longest, are read one after the other.
        """
        starts = self.stretches(buffer)
        starts = starts[starts < len(buffer)]
        ends = np.append(starts[1:], len(buffer))
        order = np.argsort(starts - ends, kind="stable")  # the longest first, so that those at work stay in front
        at, size = starts[order], (ends - starts)[order]
        state, hit = np.zeros(len(at), np.int32), np.zeros(len(at), bool)
        # Steps with that many stretches or more still at work.
        steps = int(size[SIDE_BY_SIDE - 1]) if len(size) >= SIDE_BY_SIDE else 0
        live = len(at) - np.searchsorted(size[::-1], np.arange(steps), side="right")
        for step, n in enumerate(live.tolist()):
            now = self.flat[(state[:n] << 8) + buffer[at[:n] + step]]
            state[:n] = now
            hit[:n] |= now >= self.all.accepting
        for i in range(min(len(at), SIDE_BY_SIDE)):
            if not hit[i]:
                hit[i] = self.found(int(state[i]), buffer[at[i] + steps : at[i] + size[i]])
        chosen = np.sort(order[hit])
        return starts[chosen], ends[chosen]

    def found(self, state: int, rest: np.ndarray) -> bool:
        rows, accepting = self.rows, self.all.accepting
        for byte in rest.tobytes():
            state = rows[state][byte]
            if state >= accepting:
                return True
        return False

    def starts(self, data: bytes) -> list[list[int]]:
        """By rule: where its matches may start, in order; some match starts at each of these places."""
        rows, accepting, begun, state = self.back, self.back_accepting, self.begun, 0
        told: list[list[int]] = [[] for _ in self.rules]
        for i in range(len(data) - 1, -1, -1):
            state = rows[state][data[i]]
            if state >= accepting:
                mask = begun[state]
                while mask:
                    low = mask & -mask
                    told[low.bit_length() - 1].append(i)
                    mask ^= low
        return [places[::-1] for places in told]

    def spans(self, data: bytes, rule: int, starts: list[int]) -> Iterator[tuple[int, int]]:
        """Longest matches of a rule from the leftmost starts on, without overlaps."""
        table, accepting, dead = self.single[rule]
        keeps, at = self.rules[rule].keeps, 0
        for start in starts:
            if start < at:
                continue
            state, at = 0, start
            for i in range(start, len(data)):
                state = table[state][data[i]]
                if state == dead:
                    break
                if state >= accepting:
                    at = i + 1
            if keeps(data[start:at]):
                yield start, at

    def scan(self, texts: list[bytes]) -> list[list[tuple[str, int, int]]]:
        """Kind, start and end of each secret in each text, in code points; by start, then by rule."""
        buffer, begins, ends = laid_out(texts)
        found: list[list] = [[] for _ in texts]
        for start, end in zip(*self.hits(buffer)):
            piece = buffer[start:end].tobytes()
            first = int(np.searchsorted(ends, start, side="left"))
            for number, places in enumerate(self.starts(piece)):
                for low, high in self.spans(piece, number, places):
                    text = int(np.searchsorted(ends, start + low, side="left"))
                    found[text].append((int(start) + low, number, int(start) + high))
            assert first < len(texts) or not piece.strip()
        return [[self.told(span, buffer, begin) for span in sorted(spans)] for spans, begin in zip(found, begins)]

    def told(self, span: tuple[int, int, int], buffer: np.ndarray, begin: int) -> tuple[str, int, int]:
        low, number, high = span
        before = int(((buffer[begin:low] & 0xC0) != 0x80).sum())
        return self.rules[number].kind, before, before + (high - low)  # matches are ASCII


@lru_cache(maxsize=2)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


SPANS = "array<struct<kind:string,start:int,end:int>>"
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``secrets``: kind, start and end (exclusive) of each find, in code points, by start and kind.

    Spans of different kinds may overlap. One row for each row, repeated ones included; a null or empty text has an
    empty list; other columns are not read. There is no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = scanner(rules)
        for part in slices(batches, "text", SLICE_BYTES):
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in machine.scan(as_bytes(part, "text"))]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, ARROW_SPANS)], ["doc_id", "secrets"])

    rows = docs.select(column(id_column).alias("id"), column(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['id'].dataType.simpleString()}, secrets {SPANS}")


def mask_secrets(docs: DataFrame, text_column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The same rows and columns with each secret replaced by its kind in angle brackets.

    Overlapping spans become one, named after the first. Null texts stay null.
    """
    schema, name = docs.schema, text_column
    at = schema.names.index(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = scanner(rules)
        for part in slices(batches, name, SLICE_BYTES):
            texts = part.column(at).to_pylist()
            for i, spans in enumerate(machine.scan(as_bytes(part, name))):
                if spans:
                    texts[i] = masked(texts[i], spans)
            yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))

    return docs.mapInArrow(run, schema)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, their digest, and all spans of each document."""
    base = F.filter("secrets", lambda s: s["kind"].isin([rule.kind for rule in BASE_RULES]))
    kinds = F.transform("secrets", lambda s: s["kind"])
    counts = [(F.size("secrets") - F.size(F.array_remove(kinds, rule.kind))).cast("long").alias(f"n_{rule.kind}") for rule in BASE_RULES]
    return scan_secrets(docs).select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))
