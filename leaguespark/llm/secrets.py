"""Secret scans by one combined deterministic automaton.

The rules' full expressions are compiled together: Thompson fragments, subset
construction over classes of bytes that no rule tells apart, and minimisation by
partition refinement give one transition array.  The start state is part of every
subset, so the automaton looks for all rules at every offset, and a text is read
once, byte by byte, for all rules.  A state also knows which rules have just ended:
rules that accepted up to the byte before and not with this one.  Such an end is the
end of a match, and the match's start is where the rule's reversed automaton, run
back from the end, accepts last; it never runs back beyond the rule's last match.
So every span comes from the automata, in time proportional to the text.

Two properties of the rules make these the leftmost, not overlapping matches that a
backtracking engine finds, and every rule here has both: where a rule accepts at two
bytes in a row, one match has become longer (a match ends with a run of one class of
bytes, or with a byte that can't follow itself as an end), and no match that starts
later ends before one that started earlier.  Matches that fail the rule's length are dropped, and what they
covered is not searched again; where the length is that of a group, the group is
read off the span.

Kinds: the three base kinds of the contract (assign, access, hex) and the kinds
this method adds.  Offsets are code points, end exclusive.

Defined cases: null and empty texts have no spans; repeated rows are scanned
alike, repeated spans each count; texts of one endless line are read like others;
an existing column ``__secrets`` is replaced; other columns are kept, never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguespark.llm.common import small_batches

#: kind, expression, group whose length counts, least length.
#: The first three rows are the contract's, the others public token formats.
RULES = (
    ("assign", rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", rb"AKIA[A-Z0-9]+", 0, 18),
    ("hex", rb"[0-9a-f]{4,}", 0, 16),
    ("github", rb"gh[oprsu]_[A-Za-z0-9]+", 0, 40),
    ("slack", rb"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    ("google", rb"AIza[A-Za-z0-9_-]+", 0, 39),
    ("stripe", rb"[rs]k_(live|test)_[A-Za-z0-9]+", 0, 24),
    ("jwt", rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    ("pem", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("userinfo", rb"[a-z][a-z0-9+.-]*://[A-Za-z0-9._-]+:[A-Za-z0-9._%+!$-]+@", 0, 0),
)
KINDS = tuple(rule[0] for rule in RULES)
BASE = 3


class Fragments:
    """A nondeterministic automaton: byte edges and empty edges by state."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def add(self, items, start: int, fold: bool = False) -> int:
        """Append parsed items after a state; returns the state after them."""
        for kind, value in items:
            if kind is op.LITERAL:
                start = self.step(start, {value}, fold)
            elif kind is op.IN:
                start = self.step(start, self.members(value), fold)
            elif kind is op.SUBPATTERN:
                start = self.add(value[3], start, fold or bool(value[1] & re.IGNORECASE))
            elif kind is op.BRANCH:
                end = self.state()
                for choice in value[1]:
                    first = self.state()
                    self.empty[start].append(first)
                    self.empty[self.add(choice, first, fold)].append(end)
                start = end
            elif kind is op.MAX_REPEAT:
                least, most, body = value
                for _ in range(least):
                    start = self.add(body, start, fold)
                if most is op.MAXREPEAT:
                    loop = self.state()
                    self.empty[start].append(loop)
                    self.empty[self.add(body, loop, fold)].append(loop)
                    start = loop
                else:
                    end = self.state()
                    for _ in range(most - least):
                        self.empty[start].append(end)
                        start = self.add(body, start, fold)
                    self.empty[start].append(end)
                    start = end
            else:
                raise ValueError(f"a rule uses {kind}, which the automaton does not support")
        return start

    def step(self, start: int, chars: set[int], fold: bool) -> int:
        if fold:
            chars = {ord(c) for x in chars for c in (chr(x).lower(), chr(x).upper()) if x < 128} | chars
        end = self.state()
        self.edges[start].append((frozenset(chars), end))
        return end

    @staticmethod
    def members(items) -> set[int]:
        out: set[int] = set()
        for kind, value in items:
            if kind is op.LITERAL:
                out.add(value)
            elif kind is op.RANGE:
                out.update(range(value[0], value[1] + 1))
            else:
                raise ValueError(f"a class uses {kind}, which the automaton does not support")
        return out

    def reversed(self) -> Fragments:
        back = Fragments()
        for _ in self.edges:
            back.state()
        for s, edges in enumerate(self.edges):
            for chars, end in edges:
                back.edges[end].append((chars, s))
            for end in self.empty[s]:
                back.empty[end].append(s)
        return back

    def closures(self) -> list[int]:
        """For each state the states that it reaches without a byte, as bits."""
        found = []
        for state in range(len(self.edges)):
            todo, seen = [state], {state}
            while todo:
                for x in self.empty[todo.pop()]:
                    if x not in seen:
                        seen.add(x)
                        todo.append(x)
            found.append(sum(1 << x for x in seen))
        return found


def _bits(subset: int) -> Iterator[int]:
    while subset:
        low = subset & -subset
        yield low.bit_length() - 1
        subset ^= low


class Automaton:
    """``classes``: byte -> class; ``table[state + class]`` -> next state (a multiple of the width).

    ``outputs[state]`` holds the output of a state as a bit mask; states from
    ``first_output`` on have one.  With ``ends``, a state's output are the rules that
    accepted before it and do not any more, and the start is part of every subset;
    else they are the rules that accept, and state 0 is dead.
    """

    def __init__(self, nfa: Fragments, root: int, accepting: dict[int, int], ends: bool) -> None:
        # Bytes that every edge treats alike share a class.
        used = {chars for edges in nfa.edges for chars, _ in edges}
        marks: dict[tuple, int] = {}
        classes = [marks.setdefault(tuple(b in chars for chars in used), len(marks)) for b in range(256)]
        width = len(marks)
        members = {c: b for b, c in enumerate(classes)}
        # Only states with byte edges or an output tell subsets apart.
        kept = sum(1 << s for s, edges in enumerate(nfa.edges) if edges or s in accepting)
        closures = [c & kept for c in nfa.closures()]
        # The moves of a state under all classes stand side by side in one number.
        size = (len(closures) + 7) // 8
        moves = []
        for edges in nfa.edges:
            row = 0
            for chars, end in edges:
                for c in range(width):
                    if members[c] in chars:
                        row |= closures[end] << 8 * size * c
            moves.append(row)
        start, final = closures[root], sum(1 << s for s in accepting)
        always = sum(start << 8 * size * c for c in range(width)) if ends else 0

        @lru_cache(None)
        def accepted(subset: bytes) -> int:
            mask = 0
            for s in _bits(int.from_bytes(subset, "little") & final):
                mask |= accepting[s]
            return mask

        begin = start.to_bytes(size, "little")
        first = (begin, 0 if ends else accepted(begin))
        dead = first if ends else (bytes(size), 0)
        numbers, rows, todo = {dead: 0}, [], [dead]
        if first not in numbers:
            numbers[first] = 1
            todo.append(first)
        for subset, _ in todo:  # subset construction; what is new is appended
            had, moved = accepted(subset), always
            for s in _bits(int.from_bytes(subset, "little")):
                moved |= moves[s]
            side, row = moved.to_bytes(size * width, "little"), []
            for c in range(0, size * width, size):
                after = side[c : c + size]
                now = accepted(after)
                pair = (after, had & ~now if ends else now)
                number = numbers.get(pair)
                if number is None:
                    number = numbers[pair] = len(numbers)
                    todo.append(pair)
                row.append(number)
            rows.append(row)
        table, masks = np.array(rows, np.int64), [mask for _, mask in todo]
        block = _minimised(table, np.unique(masks, return_inverse=True)[1])
        number, first_of = {}, {}
        for s, b in enumerate(block.tolist()):
            first_of.setdefault(b, s)
        for b in sorted(first_of, key=lambda b: (masks[first_of[b]] != 0 and b != block[0], first_of[b])):
            number[b] = len(number)
        order = [first_of[b] for b in number]
        self.subsets, self.width, self.states = len(rows), width, len(order)
        self.classes = bytes(classes)
        self.table = (np.array([number[b] for b in block.tolist()], np.int32)[table[order]] * width).ravel()
        self.start = number[int(block[numbers[first]])] * width
        self.outputs = {i * width: masks[s] for i, s in enumerate(order) if masks[s]}
        self.first_output = min(self.outputs, default=len(order) * width)

    @property
    def steps(self) -> list[int]:
        """The table as a list that shares its numbers."""
        if not hasattr(self, "_steps"):
            states = list(range(0, self.states * self.width, self.width))
            self._steps = [states[s] for s in (self.table // self.width).tolist()]
        return self._steps

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_steps"}


def _minimised(table: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The coarsest partition that respects ``block`` and the table: refined by the blocks that each class leads to."""
    rng = np.random.default_rng(1)
    while True:
        mixed = np.zeros(len(table), np.uint64)
        for column, factor in zip((block, *table.T), rng.integers(1, 1 << 63, table.shape[1] + 1, np.uint64) * np.uint64(2) + np.uint64(1), strict=True):
            own = (column if column is block else block[column]).astype(np.uint64) + np.uint64(1)
            own ^= own << np.uint64(29)
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + own * factor
        _, first, refined = np.unique(mixed, return_index=True, return_inverse=True)
        signs = np.column_stack([block, block[table]])
        if not (signs == signs[first[refined]]).all():
            continue  # two signatures share a number: mix anew
        if len(first) == block.max() + 1:
            return refined
        block = refined


class Scanner:
    """The combined automaton of all rules, and the reversed one of each."""

    def __init__(self, rules: tuple = RULES) -> None:
        self.kinds = tuple(rule[0] for rule in rules)
        self.limits = [(re.compile(rule[1]), rule[2], rule[3]) for rule in rules]
        every, root, accepting, self.back = Fragments(), None, {}, []
        root = every.state()
        for i, (_, pattern, _, _) in enumerate(rules):
            first = every.state()
            every.empty[root].append(first)
            accepting[every.add(parser.parse(pattern), first)] = 1 << i
            own = Fragments()
            begin = own.state()
            end = own.add(parser.parse(pattern), begin)
            self.back.append(Automaton(own.reversed(), end, {begin: 1}, False))
        self.automaton = Automaton(every, root, accepting, True)

    def ends(self, raw: bytes) -> list[tuple[int, int]]:
        """(offset, rules): where matches end, in one pass."""
        automaton = self.automaton
        steps, outputs, least, state, found = automaton.steps, automaton.outputs, automaton.first_output, automaton.start, []
        # A line feed, which no rule takes, ends what the text leaves open.
        for i, c in enumerate((raw + b"\n").translate(automaton.classes)):
            state = steps[state + c]
            if state >= least:
                found.append((i, outputs[state]))
        return found

    def start_of(self, kind: int, raw: bytes, end: int, limit: int) -> int | None:
        """The leftmost start of a match with this end, not before the limit."""
        back = self.back[kind]
        steps, classes, accepting, state, found = back.steps, back.classes, back.outputs, back.start, None
        for i in range(end - 1, limit - 1, -1):
            state = steps[state + classes[raw[i]]]
            if state in accepting:
                found = i
            elif not state:
                break
        return found

    def spans(self, raw: bytes) -> list[tuple[int, int, int]]:
        """(start, kind, end) in code points, sorted."""
        last, found = [0] * len(self.kinds), []
        for end, mask in self.ends(raw):
            for kind in _bits(mask):
                start = self.start_of(kind, raw, end, last[kind])
                if start is None:
                    continue
                last[kind] = end
                pattern, group, least = self.limits[kind]
                size = end - start
                if group:
                    matched = pattern.fullmatch(raw, start, end)
                    size = len(matched[group]) if matched else 0
                if size >= least:
                    found.append((start, kind, end))
        found.sort()
        if raw.isascii():
            return found
        points, chars, upto = {}, 0, 0
        for at in sorted({x for start, _, end in found for x in (start, end)}):
            chars += len(raw[upto:at].decode("utf-8", "replace"))
            points[at], upto = chars, at
        return [(points[start], kind, points[end]) for start, kind, end in found]


@lru_cache(4)
def scanner(rules: tuple = RULES) -> Scanner:
    return Scanner(rules)


def scan(docs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """The documents' columns and __secrets, an array of (kind, start, end) by start, then kind."""
    small_batches(docs.sparkSession)
    docs = docs.drop("__secrets")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(scanner(rules))
    kind_of = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at_text = shared.value, names.index("text")
        for batch in batches:
            spans = [[{"kind": own.kinds[k], "start": s, "end": e} for s, k, e in own.spans((t.as_py() or "").encode("utf-8", "replace"))] for t in batch.column(at_text)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, pa.list_(kind_of))], [*names, "__secrets"])

    schema = docs.limit(0).withColumn("__secrets", F.lit(None).cast("array<struct<kind:string,start:bigint,end:bigint>>")).schema
    return docs.mapInArrow(apply, schema)
