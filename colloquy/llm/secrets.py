"""Secret scan with one combined deterministic automaton.

Every rule's regular expression becomes a position automaton; the rules are
determinised together (subset construction), the product is minimised, and its
transition arrays read each byte of a text once, whatever the number of rules.
A state carries the rules whose match has just ended; the start of a match is
found by running the rule backwards from its end, never past the rule's
previous match.

Matches are leftmost and non-overlapping per rule, as greedy as Python's
``re`` (checked against it in the tests).  A pattern is refused at compile time
if it could need to look back: once it has matched, each further byte must
either extend the match or end it, and no later start may match while an
earlier one is still open.

Null text counts as empty.  Offsets are code points, end exclusive.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import ship, text_bytes

_CHUNK = 1 << 16
_MAX_STATES = 20_000


@dataclass(frozen=True)
class Rule:
    """``pattern``: literals, ``[...]``, ``(...)``, ``|``, ``? * + {m,n}``, ``\\xHH``.
    A match shorter than ``min_chars``, or whose last group is shorter than
    ``min_value``, is dropped (it still uses up its characters)."""
    kind: str
    pattern: str
    ignore_case: bool = False
    min_chars: int = 0
    min_value: int = 0


BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         ignore_case=True, min_value=6),
    Rule("access", r"AKIA[A-Z0-9]+", min_chars=20),
    Rule("hex", r"[0-9a-f]+", min_chars=24),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", min_chars=40),
    Rule("host_token", r"gh[pousr]_[A-Za-z0-9]+", min_chars=40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", min_chars=20),
)
RULES = BASE_RULES + MORE_RULES


# ---- regular expression -> position automaton -------------------------------

class _Positions:
    """Glushkov automaton: one state per character set of the pattern."""

    def __init__(self, rule: Rule):
        self.sets: list[frozenset[int]] = []
        self.follow: list[set[int]] = []
        self.case = rule.ignore_case
        self.text, self.at = rule.pattern, 0
        nullable, self.first, self.last = self._alternatives()
        if nullable or self.at < len(self.text):
            raise ValueError(f"{rule.kind}: empty match or stray character in {rule.pattern!r}")
        self.preceded: list[set[int]] = [set() for _ in self.sets]
        for p, following in enumerate(self.follow):
            for q in following:
                self.preceded[q].add(p)

    def _peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def _alternatives(self):
        nullable, first, last = self._sequence()
        while self._peek() == "|":
            self.at += 1
            n, f, e = self._sequence()
            nullable, first, last = nullable or n, first | f, last | e
        return nullable, first, last

    def _sequence(self):
        done = (True, set(), set())
        while self._peek() not in ("", "|", ")"):
            done = self._then(done, self._repeated())
        return done

    def _then(self, a, b):
        for p in a[2]:
            self.follow[p] |= b[1]
        return a[0] and b[0], a[1] | b[1] if a[0] else a[1], b[2] | a[2] if b[0] else b[2]

    def _repeated(self):
        start = self.at
        one = self._atom()
        end, mark = self.at, self._peek()
        if mark and mark in "?*+":
            self.at += 1
            if mark in "*+":
                for p in one[2]:
                    self.follow[p] |= one[1]
            return (one[0] or mark in "?*", one[1], one[2])
        if mark == "{":
            low, _, high = self.text[end + 1:(close := self.text.index("}", end))].partition(",")
            bounded = "," not in self.text[end:close] or bool(high)
            copies = [one]
            for _ in range(max(int(high or low), 1) - 1):
                self.at = start
                copies.append(self._atom())
            self.at = close + 1
            done = (True, set(), set())
            for k, c in enumerate(copies):
                done = self._then(done, c if k < int(low) else (True, c[1], c[2]))
            if not bounded:
                for p in copies[-1][2]:
                    self.follow[p] |= copies[-1][1]
            return done
        return one

    def _atom(self):
        c = self._peek()
        if c == "(":
            self.at += 1
            inner = self._alternatives()
            if self._peek() != ")":
                raise ValueError(f"unclosed group in {self.text!r}")
            self.at += 1
            return inner
        if c == "[":
            return self._position(self._class())
        return self._position({self._char()})

    def _char(self) -> int:
        c = self.text[self.at]
        self.at += 1
        if c == "\\":
            c = self.text[self.at]
            self.at += 1
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2:self.at], 16)
            if c.isalnum():
                raise ValueError(f"escape \\{c} is not supported")
        elif c in ".^$*+?{":
            raise ValueError(f"{c!r} is not supported in {self.text!r}")
        if ord(c) > 127:
            raise ValueError("patterns are ASCII")
        return ord(c)

    def _class(self) -> set[int]:
        self.at += 1
        negated = self._peek() == "^"
        self.at += negated
        members: set[int] = set()
        while self._peek() != "]":
            if self._peek() in ".^$*+?{":
                low = ord(self._peek())
                self.at += 1
            else:
                low = self._char()
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                members |= set(range(low, self._char() + 1))
            else:
                members.add(low)
        self.at += 1
        return set(range(256)) - members if negated else members

    def _position(self, members: set[int]):
        if self.case:
            members = members | {ord(chr(m).swapcase()) for m in members if chr(m).isascii() and chr(m).isalpha()}
        self.sets.append(frozenset(members))
        self.follow.append(set())
        p = {len(self.sets) - 1}
        return False, p, set(p)


# ---- determinisation and minimisation ---------------------------------------

class _RuleStates:
    """One rule's deterministic states: the open starts in order, each a set of
    positions, whether the first has matched, and whether a match just ended."""

    def __init__(self, rule: Rule):
        self.rule, self.nfa = rule, _Positions(rule)

    def start(self):
        return (), False, False

    def step(self, state, byte: int | None):
        groups, matched, _ = state
        nfa = self.nfa
        if matched:
            alive = self._move(groups[0], byte)
            if alive:
                if not alive & nfa.last:
                    raise ValueError(f"{self.rule.kind}: a match would have to look back")
                return (frozenset(alive),), True, False
            groups = ()
        seen: set[int] = set()
        out = []
        for k, g in enumerate([*groups, None]):
            alive = self._move(g, byte) - seen
            if alive & nfa.last:
                if out:
                    raise ValueError(f"{self.rule.kind}: a later start matches before an earlier one ends")
                return (frozenset(alive),), True, matched
            if alive:
                seen |= alive
                out.append(frozenset(alive))
        return tuple(out), False, matched

    def _move(self, group, byte):
        targets = self.nfa.first if group is None else set().union(*(self.nfa.follow[p] for p in group))
        return {q for q in targets if byte is not None and byte in self.nfa.sets[q]}


class Automaton:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        parts = [_RuleStates(r) for r in rules]
        self.nfas = [p.nfa for p in parts]
        # bytes that no rule tells apart share a class; the last class is the end of the text
        sets = sorted({s for n in self.nfas for s in n.sets}, key=sorted)
        signature = [tuple(b in s for s in sets) for b in range(256)]
        classes = {s: k for k, s in enumerate(dict.fromkeys(signature))}
        self.classes = bytes(classes[s] for s in signature)
        samples: list[int | None] = [self.classes.index(k) for k in range(len(classes))] + [None]
        states = {tuple(p.start() for p in parts): 0}
        queue, moves = list(states), []
        steps = [{} for _ in parts]
        for state in queue:  # subset construction, all rules at once
            row = []
            for b in samples:
                nxt = []
                for p, s, memo in zip(parts, state, steps):
                    if (s, b) not in memo:
                        memo[s, b] = p.step(s, b)
                    nxt.append(memo[s, b])
                nxt = tuple(nxt)
                if nxt not in states:
                    states[nxt] = len(states)
                    queue.append(nxt)
                    if len(states) > _MAX_STATES:
                        raise ValueError(f"more than {_MAX_STATES} states; split the rule set")
                row.append(states[nxt])
            moves.append(row)
        ended = np.array([sum(1 << k for k, s in enumerate(state) if s[2]) for state in queue])
        table, event, first = _minimise(np.array(moves), ended)
        masks = sorted(set(event.tolist()))
        if len(masks) > 256:
            raise ValueError("too many combinations of rules end together; split the rule set")
        self.table, self.masks = table, np.array(masks)
        code = {m: k for k, m in enumerate(masks)}  # masks[0] is 0: nothing ended
        self.rows: list[list] = [[] for _ in table]
        for row, to, mask in zip(self.rows, table.tolist(), event.tolist()):
            row.extend(self.rows[t] for t in to)
            row.append(code[mask])
        self.first = self.rows[first]
        self.exact = [re.compile(r.pattern.encode(), re.I if r.ignore_case else 0) for r in rules]
        self._back: list[dict] = [{} for _ in rules]

    def _ends(self, text: bytes) -> list[np.ndarray]:
        """Ends of each rule's matches, in order: one pass over the bytes."""
        code, row, at_end, masks = itemgetter(-1), self.first, [], []
        data = text.translate(self.classes) + bytes([self.table.shape[1] - 1])
        for at in range(0, len(data), _CHUNK):
            rows = list(accumulate(data[at:at + _CHUNK], getitem, initial=row))
            row = rows[-1]
            events = np.frombuffer(bytes(map(code, rows)), np.uint8)[1:]
            hits = np.flatnonzero(events)
            at_end.append(hits + at)
            masks.append(self.masks[events[hits]])
        ends, mask = np.concatenate(at_end), np.concatenate(masks)
        return [ends[(mask >> k & 1).astype(bool)] for k in range(len(self.rules))]

    def _start(self, k: int, text: bytes, low: int, end: int) -> int:
        """Where rule k's match that ends at ``end`` starts, from ``low`` on."""
        nfa, memo = self.nfas[k], self._back[k]
        state, best = None, -1
        for at in range(end - 1, low - 1, -1):
            key = (state, text[at])
            if key not in memo:
                options = nfa.last if state is None else set().union(*(nfa.preceded[p] for p in state))
                memo[key] = frozenset(p for p in options if text[at] in nfa.sets[p])
            state = memo[key]
            if not state:
                break
            if state & nfa.first:
                best = at
        return best

    def spans(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in code points, by start and then rule."""
        found = []
        for k, (rule, ends) in enumerate(zip(self.rules, self._ends(text))):
            # a match starts after the one before, so most are short at a glance
            after = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            room = np.flatnonzero(ends - after >= rule.min_chars)
            for low, end in zip(after[room].tolist(), ends[room].tolist()):
                start = self._start(k, text, low, end)
                if end - start < rule.min_chars:
                    continue
                if rule.min_value:
                    groups = self.exact[k].fullmatch(text, start, end).groups()
                    if len(groups[-1]) < rule.min_value:
                        continue
                found.append((start, k, end))
        if found and not text.isascii():
            before = np.concatenate([[0], np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80)])
            found = [(int(before[s]), k, int(before[e])) for s, k, e in found]
        return sorted(found)


def _minimise(moves: np.ndarray, ended: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Merge states that no text tells apart (partition refinement)."""
    block = np.unique(ended, return_inverse=True)[1]
    while True:
        _, finer = np.unique(np.column_stack([block, block[moves]]), axis=0, return_inverse=True)
        if finer.max() == block.max():
            break
        block = finer
    one = np.unique(block, return_index=True)[1]
    return block[moves[one]], ended[one], int(block[0])


@lru_cache(maxsize=8)
def automaton(rules: tuple[Rule, ...]) -> Automaton:
    return Automaton(rules)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan(df: DataFrame, text_col: str = "text", out_col: str = "spans",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with the secrets of every whole text, ordered by start and then
    by the rules' order, as ``array<struct<kind,start,end>>``."""
    automaton(rules)  # refuse bad patterns here, not in a task
    ship(df.sparkSession)

    @F.arrow_udf("array<struct<kind:string,start:int,end:int>>")
    def find(texts: pa.Array) -> pa.Array:
        a = automaton(rules)
        return pa.array([[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in a.spans(t)]
                         for t in text_bytes(texts)], _SPANS)

    return df.withColumn(out_col, find.asNondeterministic()(F.col(text_col)))


def redact(df: DataFrame, text_col: str = "text", mask: str = "[secret]",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with every secret (overlapping ones as one) replaced in the text;
    null texts stay null."""
    automaton(rules)
    ship(df.sparkSession)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        a = automaton(rules)
        out = []
        for text, raw in zip(texts.to_pylist(), text_bytes(texts)):
            if text is not None and (spans := a.spans(raw)):
                kept, done = [], 0
                for start, _, end in spans:
                    if start >= done:
                        kept += [text[done:start], mask]
                    done = max(done, end)
                text = "".join(kept) + text[done:]
            out.append(text)
        return pa.array(out, pa.string())

    return df.withColumn(text_col, clean(F.col(text_col)))


def op5_secrets(documents: DataFrame) -> DataFrame:
    found = scan(documents.select("doc_id", "text"))
    base = F.array(*(F.lit(r.kind) for r in BASE_RULES))
    written = lambda spans: F.array_join(F.transform(
        spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(written(F.filter("spans", lambda x: F.array_contains(base, x["kind"]))), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"))
