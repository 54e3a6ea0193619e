"""Token counts by a compiled finite-state transducer.

The transducer reads the symbols of a word. A state holds, for every suffix
of what was read that begins some vocabulary token, the last token of the
encoding that ends before that suffix and how many tokens that encoding is
behind; so the next symbol determines which token ends there (the one that
stays apart from the token before it, pair rule in ``bpe``), and the
transition is annotated with the change in the number of emitted tokens.
States are finite and determinised as they are met; the table lives in the
Python worker and is emptied when full, which changes no result.

Long texts are cut into chunks. A chunk's state map is kept as (head, count,
tail): the unfinished word it takes over, the tokens of what lies between its
first and last white space, the unfinished word it leaves. A chunk without
white space is a head alone. Maps compose associatively; the rounds of the
scan that give the whole text's count compose neighbours, so they are
log2(chunks) and each holds no more than the text.

Defined results: null or empty text has 0 tokens and 0 bytes; special strings
count as one token; whole texts of any length; repeated rows give repeated
rows; other columns, also clashing names, are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import FAR, WordBpe, load
from .common import map_texts

CACHE = 400_000
STATES = 300_000
#: Code points of a chunk.
CHUNK = 16_384
START = 0


class Transducer:
    """Deterministic transducer over word symbols; ``step`` compiles the
    missing transition, ``count`` runs a word."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        cut = len(bpe.end)
        self.plain = {t: i for t, i in bpe.vocab.items() if bpe.reachable[i] and not t.endswith(bpe.end)}
        self.final = {t[:-cut]: i for t, i in bpe.vocab.items() if bpe.reachable[i] and t.endswith(bpe.end)}
        self.begins = {t[:k] for t in [*self.plain, *self.final] for k in range(len(t) + 1)}
        self.left, self.right, self.rank = bpe.left.tolist(), bpe.right.tolist(), bpe.rank.tolist()
        self.ok: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        #: A state: (suffix, token before it or -1 at the word's start, tokens behind) per live suffix.
        self.states = [(("", -1, 0),)]
        self.number = {self.states[0]: START}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.ends: list[dict[str, int]] = [{}]

    def apart(self, a: int, b: int) -> bool:
        """Pair rule for one pair, from the spines."""
        if a < 0:
            return True
        got = self.ok.get((a, b))
        if got is None:
            bpe, got = self.bpe, True
            r, above = a, FAR
            while r >= 0 and got:
                left, over = b, FAR
                while left >= 0:
                    m = bpe.merges.get((r, left))
                    if m and m[0] < above and m[0] <= over:
                        got = False
                        break
                    left, over = self.left[left], self.rank[left]
                r, above = self.right[r], self.rank[r]
            if len(self.ok) > 4 * CACHE:
                self.ok.clear()
            self.ok[a, b] = got
        return got

    def step(self, state: int, symbol: str) -> tuple[int, int]:
        """Next state and the change in emitted tokens for an inner symbol."""
        live, last, change = [], -1, 0
        for suffix, before, behind in self.states[state]:
            grown = suffix + symbol
            token = self.plain.get(grown)
            if token is not None and self.apart(before, token):
                last, change = token, 1 - behind
            if grown in self.begins:
                live.append((grown, before, behind))
        key = (*[(s, t, n + change) for s, t, n in live], ("", last, 0))
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            self.ends.append({})
        self.moves[state][symbol] = (to, change)
        return to, change

    def finish(self, state: int, symbol: str) -> int:
        """Change in emitted tokens for the word-final symbol."""
        for suffix, before, behind in self.states[state]:
            token = self.final.get(suffix + symbol)
            if token is not None and self.apart(before, token):
                self.ends[state][symbol] = 1 - behind
                return 1 - behind
        raise AssertionError("no token ends the word")

    def count(self, word: str) -> int:
        """Tokens of a word of byte symbols."""
        if len(self.states) > STATES:
            self.reset()
        state, total = START, 0
        for s in word[:-1]:
            move = self.moves[state].get(s)
            state, change = move if move is not None else self.step(state, s)
            total += change
        end = self.ends[state].get(word[-1])
        return total + (end if end is not None else self.finish(state, word[-1]))


class UnitCounts(dict):
    """Unit -> tokens, through the transducer on a miss."""

    def __init__(self, bpe: WordBpe):
        super().__init__()
        self.bpe, self.machine, self.words = bpe, Transducer(bpe), {}

    def word(self, raw: str) -> int:
        n = self.words.get(raw)
        if n is None:
            if len(self.words) > CACHE:
                self.words.clear()
            n = self.words[raw] = self.machine.count("".join([self.bpe.symbols[b] for b in raw.encode()]))
        return n

    def __missing__(self, unit) -> int:
        if isinstance(unit, int):
            n = 1
        elif isinstance(unit, tuple):
            n = self.machine.count(unit[0])
        else:
            n = sum(map(self.word, self.bpe.pre.findall(unit)))
        if len(self) > CACHE:
            self.clear()
        self[unit] = n
        return n


def chunk_map(counts: UnitCounts, chunk: str) -> tuple[str, int, str | None]:
    """(head, count, tail) of a chunk; tail None if it has no white space."""
    parts = chunk.split(None, 1)
    if not parts:
        return ("", 0, "" if chunk else None)
    head = "" if chunk[0].isspace() else parts[0]
    if head == chunk:
        return (chunk, 0, None)
    tail = "" if chunk[-1].isspace() else chunk.rsplit(None, 1)[-1]
    inner = chunk[len(head): len(chunk) - len(tail)]
    return (head, sum(map(counts.__getitem__, inner.split())), tail)


def compose(counts: UnitCounts, a: tuple, b: tuple) -> tuple:
    """The state map of chunk a followed by chunk b."""
    if a[2] is None:
        return (a[0] + b[0], b[1], b[2])
    if b[2] is None:
        return (a[0], a[1], a[2] + b[0])
    middle = a[2] + b[0]
    return (a[0], a[1] + (counts[middle] if middle else 0) + b[1], b[2])


def scan(counts: UnitCounts, maps: list[tuple]) -> list[tuple]:
    """Up-sweep of the prefix scan: every round composes neighbours, so the maps
    of a round are of disjoint stretches. The last one is the whole text's."""
    out = list(maps)
    while len(out) > 1:
        out = [compose(counts, *out[i:i + 2]) if i + 1 < len(out) else out[i] for i in range(0, len(out), 2)]
    return out


def count_text(counts: UnitCounts, text: str, chunk: int = CHUNK) -> int:
    """Tokens of a whole text."""
    bpe = counts.bpe
    if bpe.cut is not None and "<" in text and bpe.cut.search(text):
        return sum(1 if p in bpe.special else count_text(counts, p, chunk) for p in bpe.cut.split(text) if p)
    normal = bpe.normal(text)
    if normal is None:
        return sum(map(counts.__getitem__, bpe.units(text)))
    if len(normal) <= chunk:
        return sum(map(counts.__getitem__, normal.split()))
    maps = [chunk_map(counts, normal[k:k + chunk]) for k in range(0, len(normal), chunk)]
    head, n, tail = scan(counts, maps)[-1]
    return n + sum(counts[x] for x in (head, tail) if x)


_STATE: dict[str, UnitCounts] = {}


def unit_counts(path: str) -> UnitCounts:
    if path not in _STATE:
        _STATE[path] = UnitCounts(load(path))
    return _STATE[path]


def token_counts(df: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit."""
    fields = [(id_col, pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]

    def run(keys, texts):
        counts = unit_counts(path)
        n = [count_text(counts, t) for t in texts]
        return {id_col: keys, "n_bytes": [len(t.encode()) for t in texts], "n_tokens": n, "over_limit": [x > limit for x in n]}

    return map_texts(df, id_col, text_col, run, fields)
