"""Secret scans by one combined deterministic automaton.

Rules are regular expressions, written as small trees. All of them go whole into one nondeterministic automaton, which
subset construction makes deterministic and partition refinement minimal; the result is a transition array over byte
classes whose states say which rules' expressions end there. Texts are cut into lanes at bytes that occur in no rule, so
no finding crosses a cut, and all lanes of a block step through the array together, one byte a step: every byte is read
once for all rules. A match ends where its rule's mark goes out. From there the rule's own reversed automaton walks back to
the farthest start, no farther than the end of the rule's match before: leftmost, longest, not overlapping within a rule.
Matches with too few characters are dropped after that. Least lengths are kept out of the expressions (but for runs
without a prefix), since counters of several rules that run side by side would multiply the states.

A null or empty text has no finding.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from string import ascii_letters, ascii_lowercase, ascii_uppercase, digits

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import map_arrow
from .textbuf import blocks, utf8

#: An expression: ("set", bytes), ("seq", parts), ("alt", parts), or ("repeat", part, least, most or None).
Tree = tuple


def one(chars: str) -> Tree:
    return ("set", frozenset(chars.encode()))


def seq(*parts: Tree | str) -> Tree:
    """Parts in a row; a string stands for its characters."""
    return ("seq", [x for p in parts for x in ([one(c) for c in p] if isinstance(p, str) else [p])])


def alt(*parts: Tree | str) -> Tree:
    return ("alt", [seq(p) for p in parts])


def repeat(part: Tree, least: int, most: int | None = None) -> Tree:
    return ("repeat", part, least, most)


def either_case(word: str) -> Tree:
    return ("seq", [one(c.lower() + c.upper()) for c in word])


@dataclass(frozen=True)
class Rule:
    """``least`` characters that a match must have, or what ``part`` takes of it; else the match is dropped."""

    kind: str
    tree: Tree
    least: int = 0
    part: Callable[[bytes], bytes] | None = None


def assigned(match: bytes) -> bytes:
    """The value of an assignment: what follows the first colon or equals sign, blanks, and a quote."""
    at = min(k for k in (match.find(b":"), match.find(b"=")) if k >= 0)
    value = match[at + 1 :].lstrip(b" ")
    return value[1:] if value[:1] in (b'"', b"'") else value


_VALUE = one(ascii_letters + digits + "+/_.=-")
_QUOTE, _BLANKS = repeat(one("\"'"), 0, 1), repeat(one(" "), 0)
_NAMES = alt(*map(either_case, ("password", "passwd", "secret", "token")), seq(either_case("api"), repeat(one("_"), 0, 1), either_case("key")))
_WORD = ascii_letters + digits
#: The three base rules, then common formats of issued keys.
BASE = (
    Rule("assign", seq(_NAMES, _QUOTE, _BLANKS, one(":="), _BLANKS, _QUOTE, repeat(_VALUE, 1)), 6, assigned),
    Rule("access", seq("AKIA", repeat(one(ascii_uppercase + digits), 1)), 20),
    Rule("hex", repeat(one("abcdef" + digits), 24)),
)
MORE = (
    Rule("github", seq("gh", one("pousr"), "_", repeat(one(_WORD), 1)), 40),
    Rule("slack", seq("xox", one("abprs"), "-", repeat(one(_WORD + "-"), 1)), 15),
    Rule("google", seq("AIza", repeat(one(_WORD + "_-"), 1)), 39),
    Rule("stripe", seq(one("rs"), "k_", alt("live", "test"), "_", repeat(one(_WORD), 1)), 24),
    Rule("private", seq("-----BEGIN ", repeat(one(ascii_uppercase + " "), 0), "PRIVATE KEY-----")),
    Rule("jwt", seq("eyJ", repeat(one(_WORD + "_-"), 1), ".eyJ", repeat(one(_WORD + "_.-"), 1)), 30),
)
RULES = BASE + MORE
#: Bytes of a block that steps through the automaton together, and the least length of a lane.
BLOCK, LANE = 1 << 22, 192


class _Graph:
    """A nondeterministic automaton: edges by byte set, and empty edges."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.edges: list[list[tuple[frozenset[int], int]]] = []

    def node(self) -> int:
        self.empty.append([])
        self.edges.append([])
        return len(self.edges) - 1

    def add(self, tree: Tree, at: int, back: bool = False) -> int:
        """Adds an expression, or its mirror image, from node ``at`` on; its last node."""
        kind, what = tree[:2]
        if kind == "set":
            to = self.node()
            self.edges[at].append((what, to))
            return to
        if kind == "seq":
            for part in reversed(what) if back else what:
                at = self.add(part, at, back)
            return at
        to = self.node()
        if kind == "alt":
            for part in what:
                self.empty[self.add(part, at, back)].append(to)
            return to
        least, most = tree[2:]
        for _ in range(least):
            at = self.add(what, at, back)
        self.empty[at].append(to)
        if most is None:
            self.empty[self.add(what, to, back)].append(to)
        for _ in range(0 if most is None else most - least):
            at = self.add(what, at, back)
            self.empty[at].append(to)
        return to

    def closures(self) -> list[int]:
        """For each node, as bits, the nodes that empty edges reach from it."""
        out = []
        for k in range(len(self.empty)):
            seen, todo = 1 << k, [k]
            while todo:
                for x in self.empty[todo.pop()]:
                    if not seen >> x & 1:
                        seen |= 1 << x
                        todo.append(x)
            out.append(seen)
        return out


def _bits(x: int) -> Iterable[int]:
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


def _determined(g: _Graph, start: int, ends: dict[int, int], anywhere: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte classes, steps (states x classes) and what each state found, of the least automaton; state 0 is the start's.
    ``anywhere``: a match may begin at any byte; else the last state may be one that nothing leads out of."""
    sets = sorted({chars for edges in g.edges for chars, _ in edges}, key=sorted)
    sign = [tuple(b in s for s in sets) for b in range(256)]
    names = {s: i for i, s in enumerate(dict.fromkeys(sign))}
    classes = np.array([names[s] for s in sign], np.uint8)
    sample = [sign.index(s) for s in names]
    closure = g.closures()
    # of each node, by class, the nodes it leads to
    leads = []
    for edges in g.edges:
        row = [0] * len(sample)
        for chars, to in edges:
            for c, b in enumerate(sample):
                if b in chars:
                    row[c] |= closure[to]
        leads.append(row)
    home = closure[start]
    always = home if anywhere else 0
    numbers, rows, todo = {home: 0}, [], [home]
    for now in todo:
        own = [leads[x] for x in _bits(now) if any(leads[x])]
        row = []
        for c in range(len(sample)):
            to = always
            for x in own:
                to |= x[c]
            if to not in numbers:
                numbers[to] = len(numbers)
                todo.append(to)
            row.append(numbers[to])
        rows.append(row)
    step = np.array(rows)
    found = np.array([sum(bit for x, bit in ends.items() if s >> x & 1) for s in todo], np.int64)
    # minimisation: split the parts until all states of a part step into the same parts
    part = np.unique(found, return_inverse=True)[1].ravel()
    while True:
        finer = np.unique(np.column_stack([part, part[step]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == part.max():
            break
        part = finer
    # the start's part is state 0; states that found something come last
    firsts = np.unique(part, return_index=True)[1]
    order = sorted(range(len(firsts)), key=lambda p: (p != part[0], found[firsts[p]] > 0))
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    chosen = firsts[order]
    return classes, number[part[step[chosen]]], found[chosen]


@dataclass(frozen=True)
class Backward:
    """A rule's reversed automaton, from the end of a match."""

    classes: bytes
    step: list[list[int]]
    found: list[bool]
    dead: int  # the state without a way to a match, if any

    def start(self, data: bytes, end: int, least: int) -> int | None:
        """The farthest start, not before ``least``, of a match that ends at ``end``."""
        state, out = 0, None
        for k in range(end - 1, least - 1, -1):
            state = self.step[state][self.classes[data[k]]]
            if state == self.dead:
                break
            if self.found[state]:
                out = k
        return out


@dataclass(frozen=True)
class Automaton:
    classes: np.ndarray  # class of each byte
    step: np.ndarray  # (state * width + class) to the next state * width
    width: int
    first_found: int  # states * width from here on have found something
    found: np.ndarray  # rules found, a bit each, by state
    cut: np.ndarray  # bytes that occur in no rule
    back: list[Backward]


def compile_rules(rules: tuple[Rule, ...]) -> Automaton:
    g = _Graph()
    start, ends, back = g.node(), {}, []
    for k, rule in enumerate(rules):
        first = g.node()
        g.empty[start].append(first)
        ends[g.add(rule.tree, first)] = 1 << k
        own = _Graph()
        home = own.node()
        last = own.add(rule.tree, home, True)
        classes, step, found = _determined(own, home, {last: 1}, False)
        dead = [i for i in range(len(step)) if not found[i] and (step[i] == i).all()]
        back.append(Backward(classes.tobytes(), step.tolist(), (found > 0).tolist(), dead[0] if dead else -1))
    classes, step, found = _determined(g, start, ends, True)
    width = step.shape[1]
    used = {b for edges in g.edges for chars, _ in edges for b in chars}
    first_found = len(found) - np.count_nonzero(found)
    return Automaton(classes, (step * width).astype(np.int32).ravel(), width, first_found * width, found, np.array([b not in used for b in range(256)]), back)


def _lanes(buf: np.ndarray, offs: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    places = np.flatnonzero(cut[buf]) + 1
    at = np.searchsorted(places, np.arange(LANE, len(buf), LANE))
    bounds = np.unique(np.concatenate([places[at[at < len(places)]], offs]))
    return bounds[:-1], np.diff(bounds)


def scan_block(dfa: Automaton, buf: np.ndarray, offs: np.ndarray) -> list[tuple[int, int, int]]:
    """(start of the lane, end of a match, rule), in order."""
    if not len(buf):
        return []
    starts, lengths = _lanes(buf, offs, dfa.cut)
    order = np.argsort(-lengths, kind="stable")
    first, sizes = starts[order], lengths[order]
    active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(int(sizes[0])), "right")
    state, coded, at = np.zeros(len(first), np.int32), dfa.classes[buf], first.copy()
    marks, lit, out = np.zeros(len(first), np.int64), 0, []

    def ended(lanes: np.ndarray, gone: np.ndarray, place: np.ndarray) -> None:
        for lane, bits, end in zip(first[lanes].tolist(), gone.tolist(), place.tolist(), strict=True):
            out.extend((lane, end, k) for k in _bits(bits))

    for n in active.tolist():
        now = dfa.step[state[:n] + coded[at[:n]]]
        state[:n] = now
        if lit or now.max() >= dfa.first_found:
            new = dfa.found[now // dfa.width]
            gone = marks[:n] & ~new
            lanes = np.flatnonzero(gone)
            ended(lanes, gone[lanes], at[lanes])
            marks[:n] = new
            lit = np.count_nonzero(marks)
        at[:n] += 1
    lanes = np.flatnonzero(marks)
    ended(lanes, marks[lanes], first[lanes] + sizes[lanes])
    return sorted(out)


def find(dfa: Automaton, rules: tuple[Rule, ...], buf: np.ndarray, offs: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """For each row the (start, end, rule number), in code points, by start and then rule."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offs) - 1)]
    for a, b in blocks(offs, BLOCK):
        own, base = buf[offs[a] : offs[b]], offs[a]
        data, row, last = own.tobytes(), -1, {}
        for lane, end, rule in scan_block(dfa, own, offs[a : b + 1] - base):
            if (to := int(np.searchsorted(offs, base + lane, "right")) - 1) != row:
                row, last = to, {}
                heads = np.concatenate([[0], np.cumsum((own[offs[row] - base : offs[row + 1] - base] & 0xC0) != 0x80)])
            start = dfa.back[rule].start(data, end, max(lane, last.get(rule, 0)))
            if start is None:  # it overlaps the match before
                continue
            last[rule] = end
            match = data[start:end]
            if len(rules[rule].part(match) if rules[rule].part else match) >= rules[rule].least:
                out[row].append((int(heads[start - (offs[row] - base)]), int(heads[end - (offs[row] - base)]), rule))
    for found in out:
        found.sort(key=lambda x: (x[0], x[2], x[1]))
    return out


def scan(df: DataFrame, id_col: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each row ``id_col`` and ``spans``: an array of (kind, start, end), in code points, end exclusive, by start and
    then in the rules' order."""
    dfa = compile_rules(rules)

    def run(batches):
        for batch in batches:
            found = find(dfa, rules, *utf8(batch.column(1)))
            spans = [[{"kind": rules[k].kind, "start": s, "end": e} for s, e, k in row] for row in found]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=[id_col, "spans"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_arrow(df.select(id_col, text), run, f"`{id_col}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def digest(found: list[tuple[str, int, int]]) -> str:
    """SHA-256 of spans as kind:start:end, comma-joined."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in found).encode()).hexdigest()
