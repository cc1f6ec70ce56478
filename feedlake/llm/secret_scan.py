"""Secrets in texts, found by one automaton for all rules.

The rules are regular expressions over bytes. They are turned round, joined and
compiled by subset construction into one deterministic automaton, which is
minimised and kept as an array of transitions. One pass over the bytes of a
text, from the last to the first, tells at each place which rules have a match
that starts there. A match is then measured from its start; that reads matches
only.

The bytes of many texts are one array, with a byte between texts that no rule
knows. It is cut into lanes that step through their bytes side by side, each as
if nothing stood behind it; where something did, the few steps until the states
agree are taken again.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, slices


@dataclass(frozen=True)
class Rule:
    """A kind of secret: ``head`` and then ``body``, of which at least ``least`` characters.

    Matches are leftmost and longest, and do not overlap others of their kind;
    only then those with a short body are dropped. The longest head that matches
    counts as the head. The expressions know classes, groups, ``|``, ``?``,
    ``*``, ``+`` and ``{m}``, ``{m,}``, ``{m,n}``, over ASCII.
    """

    kind: str
    head: str
    body: str
    least: int = 1
    any_case: bool = False


#: The kinds every scan has, in the order in which spans at one place are listed.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+", 8, True),
    Rule("access", r"AKIA", r"[A-Z0-9]+", 12),
    Rule("hex", r"", r"[0-9a-f]{32,}", 32),
)
#: Kinds that come on top: public token formats and the first line of a private key.
ADDED = (
    Rule("temporary_access", r"ASIA", r"[A-Z0-9]+", 12),
    Rule("github", r"gh[pousr]_", r"[A-Za-z0-9]+", 36),
    Rule("slack", r"xox[abprs]-", r"[A-Za-z0-9-]+", 10),
    Rule("google", r"AIza", r"[A-Za-z0-9_-]+", 35),
    Rule("stripe", r"[rs]k_(live|test)_", r"[A-Za-z0-9]+", 16),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", r"[A-Za-z0-9_-]+", 8),
    Rule("private_key", r"-----BEGIN ", r"([A-Z0-9]+ )*PRIVATE KEY-----"),
)
RULES = BASE + ADDED

#: Between texts; not a byte of UTF-8, so no rule has it.
_APART = 0xFF
#: Bytes that are scanned at a time, and lanes that step side by side.
SEGMENT = 1 << 21
LANES = 2048


# --- expressions -----------------------------------------------------------------------------


class _Places:
    """The positions of an expression: the bytes each one takes, and which may follow which.

    ``read`` returns whether the empty text matches, and the sets of first and of last positions.
    """

    def __init__(self):
        self.takes: list[frozenset[int]] = []
        self.follow: list[set[int]] = []

    def read(self, expression: str, any_case: bool = False):
        self.text, self.at, self.any_case = expression, 0, any_case
        found = self._either()
        if self.at < len(self.text):
            raise ValueError(f"{expression!r} is no expression, from place {self.at} on")
        return found

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def _either(self):
        empty, first, last = self._sequence()
        while self._peek() == "|":
            self.at += 1
            e, f, l = self._sequence()
            empty, first, last = empty or e, first | f, last | l
        return empty, first, last

    def join(self, a, b):
        for p in a[2]:
            self.follow[p] |= b[1]
        return a[0] and b[0], a[1] | (b[1] if a[0] else set()), b[2] | (a[2] if b[0] else set())

    def _sequence(self):
        found = True, set(), set()
        while self._peek() and self._peek() not in "|)":
            found = self.join(found, self._repeated())
        return found

    def _repeated(self):
        start = self.at
        one = self._one()
        sign = self._peek()
        if not sign or sign not in "?*+{":
            return one
        end = self.at
        self.at += 1
        least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(sign, (0, 0))
        if sign == "{":
            bounds, _, _ = self.text[self.at :].partition("}")
            self.at += len(bounds) + 1
            low, comma, high = bounds.partition(",")
            least, most = int(low), (int(high) if high else None) if comma else int(low)
        after = self.at

        def again():
            self.at = start
            found = self._one()
            assert self.at == end
            return found

        found, count = (one, 1) if most != 0 else ((True, set(), set()), 0)
        if least == 0:
            found = True, found[1], found[2]
        while count < least or (most is not None and count < most):
            more = again()
            found = self.join(found, (True, *more[1:]) if count >= least else more)
            one, count = more, count + 1
        if most is None:
            for p in one[2]:
                self.follow[p] |= one[1]
        self.at = after
        return found

    def _one(self):
        c = self._take()
        if c == "(":
            found = self._either()
            if self._peek() != ")":
                raise ValueError(f"{self.text!r} has an open group")
            self.at += 1
            return found
        if c == "[":
            return self._place(self._class())
        if c in "?*+{.":
            raise ValueError(f"{self.text!r}: {c!r} at place {self.at - 1} is not known there")
        return self._place({self._escaped() if c == "\\" else ord(c)})

    def _escaped(self) -> int:
        c = self._take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)

    def _class(self) -> set[int]:
        found: set[int] = set()
        while (c := self._take()) != "]":
            low = self._escaped() if c == "\\" else ord(c)
            high = low
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                c = self._take()
                high = self._escaped() if c == "\\" else ord(c)
            found |= set(range(low, high + 1))
        return found

    def _place(self, values: set[int]):
        if max(values) > 0x7F:
            raise ValueError("expressions are over ASCII")
        if self.any_case:
            values = values | {ord(chr(v).swapcase()) for v in values if chr(v).isalpha()}
        self.takes.append(frozenset(values))
        self.follow.append(set())
        p = {len(self.takes) - 1}
        return False, p, set(p)


# --- automata --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Automaton:
    """``step[state * width + kind_of_byte]`` is the next state times ``width``; ``marks[state]`` has a bit for each rule.

    State 0 is the first; if ``dead`` is not negative, no way leads out of that state.
    """

    classes: np.ndarray
    width: int
    step: np.ndarray
    marks: np.ndarray
    dead: int


def _byte_classes(takes: list[frozenset[int]]) -> tuple[np.ndarray, list[int]]:
    """Bytes that no position tells apart are one class; with each class one of its bytes."""
    known: dict[tuple[int, ...], int] = {}
    classes, samples = np.zeros(256, np.uint8), []
    for b in range(256):
        told = tuple(p for p, values in enumerate(takes) if b in values)
        if told not in known:
            known[told] = len(samples)
            samples.append(b)
        classes[b] = known[told]
    return classes, samples


def _subsets(takes, first: set[int], follow: list[set[int]], ends: dict[int, int], unanchored: bool) -> Automaton:
    """The deterministic automaton of the positions, minimal.

    ``ends`` has the bits of the rules that are complete after a position.
    Unanchored, a match may begin at any byte.
    """
    classes, samples = _byte_classes(takes)
    after = [frozenset(f) for f in follow]
    known, order, steps = {frozenset(): 0}, [frozenset()], []
    begin = frozenset(first)
    for n, state in enumerate(order):
        ways = set().union(*(after[p] for p in state if p >= 0))
        if unanchored or n == 0:
            ways |= begin
        row = []
        for b in samples:
            to = frozenset(p for p in ways if b in takes[p])
            if not to and not unanchored:
                to = frozenset([-1])  # apart from the first state, which has no position either
            if to not in known:
                known[to] = len(order)
                order.append(to)
            row.append(known[to])
        steps.append(row)
    marks = np.array([sum({1 << r for p in state for r in ends.get(p, ())}) for state in order], np.int64)
    return _minimal(classes, np.array(steps, np.int64), marks)


def _minimal(classes: np.ndarray, step: np.ndarray, marks: np.ndarray) -> Automaton:
    """States that no further bytes tell apart become one: groups are split until none changes."""
    group = np.unique(marks, return_inverse=True)[1]
    while True:
        told = np.column_stack([group, group[step]])
        new = np.unique(told, axis=0, return_inverse=True)[1].ravel()
        if new.max() == group.max():
            break
        group = new
    # the group of the first state becomes number 0
    number = np.concatenate(([group[0]], np.delete(np.arange(group.max() + 1), group[0])))
    place = np.argsort(number)
    one = np.zeros(len(number), np.int64)
    one[group] = np.arange(len(group))
    width = step.shape[1]
    small = place[group[step[one[number]]]]
    kept = marks[one[number]]
    stays = np.flatnonzero((small == np.arange(len(small))[:, None]).all(1) & (kept == 0))
    stays = stays[stays != 0]
    return Automaton(classes, width, (small * width).ravel().astype(np.int32), kept.astype(np.int32), int(stays[0]) if len(stays) else -1)


def _positions(rules: tuple[Rule, ...], parts: tuple[str, ...]):
    places = _Places()
    firsts, lasts = [], []
    for rule in rules:
        found = True, set(), set()
        for part in parts:
            found = places.join(found, places.read(getattr(rule, part), rule.any_case))
        if found[0] and parts == ("head", "body"):
            raise ValueError(f"{rule.kind}: matches the empty text")
        firsts.append(found[1])
        lasts.append(found[2])
    return places, firsts, lasts


@cache
def starts_automaton(rules: tuple[Rule, ...]) -> Automaton:
    """All rules turned round: its marks, read from the last byte on, say which rules match from a byte on."""
    places, firsts, lasts = _positions(rules, ("head", "body"))
    before: list[set[int]] = [set() for _ in places.takes]
    for p, following in enumerate(places.follow):
        for q in following:
            before[q].add(p)
    ends: dict[int, list[int]] = {}
    for r, positions in enumerate(firsts):
        for p in positions:
            ends.setdefault(p, []).append(r)
    return _subsets(places.takes, set().union(*lasts), before, ends, unanchored=True)


@cache
def _measure(rule: Rule, parts: tuple[str, ...]) -> tuple[list[list[int]], list[bool], int]:
    """Steps by state and byte, which states are complete, and the dead state, for short anchored runs."""
    places, firsts, lasts = _positions((rule,), parts)
    made = _subsets(places.takes, firsts[0], places.follow, {p: [0] for p in lasts[0]}, unanchored=False)
    by_byte = made.step.reshape(-1, made.width)[:, made.classes] // made.width
    return by_byte.tolist(), (made.marks > 0).tolist(), made.dead


def _longest(rule: Rule, parts: tuple[str, ...], data: memoryview, at: int) -> int:
    """Where the longest match from ``at`` on ends; ``at`` if there is none."""
    steps, complete, dead = _measure(rule, parts)
    state, end = 0, at
    for k in range(at, len(data)):
        state = steps[state][data[k]]
        if complete[state]:
            end = k + 1
        elif state == dead:
            break
    return end


# --- scan ------------------------------------------------------------------------------------


def _states(automaton: Automaton, data: np.ndarray, state: int) -> np.ndarray:
    """The state after each byte, in the order of ``data``, coming from ``state``."""
    kinds = automaton.classes[data].astype(np.int32)
    count = max(1, min(LANES, len(kinds) // 16))
    length = len(kinds) // count
    body = np.ascontiguousarray(kinds[: length * count].reshape(count, length).T)
    found = np.empty((length, count), np.int32)
    now = np.zeros(count, np.int32)
    now[0] = state
    for k in range(length):
        now = automaton.step.take(now + body[k], out=found[k], mode="clip")
    lanes = found.T.reshape(-1)
    found = np.concatenate([lanes, np.empty(len(kinds) - len(lanes), np.int32)])
    step, width = automaton.step, automaton.width

    def walk(at: int, state: int, until: int) -> None:
        # the bytes after a cut again, until the states agree with those of the lane
        for k in range(at, until):
            state = int(step[state + kinds[k]])
            if found[k] == state and k < len(lanes):
                return
            found[k] = state

    for k in range(1, count):
        came = int(found[k * length - 1])
        if came:
            walk(k * length, came, (k + 1) * length)
    if len(lanes) < len(kinds):
        walk(len(lanes), int(found[len(lanes) - 1]), len(kinds))
    return found // width


def starts(data: np.ndarray, rules: tuple[Rule, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Places from which on a rule matches, ascending, with the bits of those rules."""
    automaton = starts_automaton(rules)
    places, marks, state = [], [], 0
    for end in range(len(data), 0, -SEGMENT):
        part = data[max(0, end - SEGMENT) : end][::-1]
        states = _states(automaton, part, state)
        state = int(states[-1]) * automaton.width
        told = automaton.marks[states]
        hits = np.flatnonzero(told)
        places.append(end - 1 - hits)
        marks.append(told[hits])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(places)[::-1], np.concatenate(marks)[::-1]


def _spans(data: np.ndarray, rules: tuple[Rule, ...]) -> list[tuple[int, int, int]]:
    """``(start, end, rule)`` of all matches, in bytes, in order."""
    places, marks = starts(data, rules)
    view, found = memoryview(data), []
    for r, rule in enumerate(rules):
        own = places[(marks >> r & 1) > 0].tolist()
        k = 0
        while k < len(own):
            at = own[k]
            end = _longest(rule, ("head", "body"), view, at)
            body = _longest(rule, ("head",), view, at) if rule.head else at
            if end - body >= rule.least:
                found.append((at, end, r))
            k = bisect_left(own, end, k + 1)
    return sorted(found, key=lambda s: (s[0], s[2]))


def scan(texts: list[bytes], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[str, int, int]]]:
    """``(kind, start, end)`` of the secrets of each text, in code points, by start and then by rule."""
    data = np.frombuffer(b"\xff".join(texts), np.uint8)
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    points = -1, None
    for start, end, r in _spans(data, rules):
        n = int(np.searchsorted(bounds, start, "right")) - 1
        if points[0] != n:
            own = data[bounds[n] : bounds[n + 1] - 1]
            points = n, np.concatenate(([0], np.cumsum((own & 0xC0) != 0x80)))
        at = points[1]
        found[n].append((rules[r].kind, int(at[start - bounds[n]]), int(at[end - bounds[n]])))
    return found


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(df: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """``df`` with a column ``out``: the secrets of each whole text as ``kind``, ``start`` and ``end``.

    Places are code points, ``end`` exclusive; spans stand in order of their
    start, those of one start in the order of ``rules``. Spans of different kinds
    may overlap. Null and empty texts have no secrets (an empty list). Repeated
    rows are scanned row by row; an empty table stays empty. A column named
    ``out`` is replaced, all others stay. A text of any length is read whole, a
    segment at a time.
    """

    @F.arrow_udf(SPANS)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [_as_array(scan([(t.as_py() or "").encode() for t in some], rules)) for some in slices(batch, SEGMENT)]
            yield pa.concat_arrays(found or [_as_array([])])

    made = free_name(df, "__secrets")
    kept = [f"`{c}`" for c in df.columns if c.lower() != out.lower()]
    return df.withColumn(made, find(F.col(text_col).cast("string"))).select(*kept, F.col(made).alias(out))


def _as_array(found: list[list[tuple[str, int, int]]]) -> pa.Array:
    rows = [[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in found]
    return pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))


def listed(spans: Column) -> Column:
    """Spans as one text, ``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every secret replaced by its kind in brackets; of overlapping spans the first one counts."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def put(a: Column, s: Column) -> Column:
        until = F.concat(a["done"], F.substr(text, a["at"] + 1, s["start"] - a["at"]), F.lit("["), s["kind"], F.lit("]"))
        skipped = s["start"] < a["at"]
        return F.struct(F.when(skipped, F.greatest(a["at"], s["end"])).otherwise(s["end"]).alias("at"), F.when(skipped, a["done"]).otherwise(until).alias("done"))

    rest = lambda a: F.concat(a["done"], F.substr(text, a["at"] + 1, F.length(text)))
    return F.aggregate(spans, state, put, rest)
