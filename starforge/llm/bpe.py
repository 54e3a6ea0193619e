"""A public BPE tokenizer file (`tokenizers` format, word ends marked) as
tables: text units, symbols, merges, pair compatibility.

Every merge of such a file makes one token of its own, and its parts are made
by earlier merges (checked on loading). So a token has one derivation tree.

Pair rule. Tokens ``a`` and ``b`` stay apart next to each other iff no merge
crosses their border. A crossing merge joins a node ``r`` of the right spine
of ``a`` to a node ``l`` of the left spine of ``b``; it fires iff its rank is
below the rank that consumes ``r`` inside ``a`` (at equal rank the left place
merges first) and not above the rank that consumes ``l`` inside ``b``. A token
sequence is the encoding of its word iff each token encodes to itself and
every adjacent pair stays apart: the first merge crossing any border would
also cross it with the two tokens alone.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import regex

FAR = np.int64(1) << 40
NO_PAIR = 1 << 62
#: Words of more symbols are merged with a heap.
LONG_WORD = 100
#: Code points whose normal form and class are the same in Python and in the
#: library (tests run through all of them); a text with others takes the
#: library's own normalizer and pre-tokenizer.
_OTHER = re.compile("[^\x00-\x1b\x20-՗]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE:
    itself where Latin-1 prints it, else the next code point from 256 on."""
    out, spare = [], 256
    for b in range(256):
        shown = 33 <= b <= 126 or 161 <= b <= 255 and b != 173
        out.append(chr(b if shown else spare))
        spare += not shown
    return out


class WordBpe:
    """Tables of one tokenizer file. ``units(text)`` gives what is cached and
    encoded on its own: white-space separated strings, a tuple of a pre-token
    in byte symbols (texts with rare characters), or a special token's id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pre = regex.compile(pattern)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        size = max(*self.vocab.values(), *self.special.values()) + 1
        self.token = [""] * size
        for t, i in [*self.vocab.items(), *self.special.items()]:
            self.token[i] = t
        self.symbols = byte_symbols()
        self.byte_of = {s: b for b, s in enumerate(self.symbols)}
        self.plain = [self.vocab[s] for s in self.symbols]
        self.final = [self.vocab[s + self.end] for s in self.symbols]
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.rank = np.full(size, -1, np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for r, pair in enumerate(model["merges"]):
            x, y = pair.split(" ") if isinstance(pair, str) else pair
            a, b, t = self.vocab[x], self.vocab[y], self.vocab[x + y]
            if self.rank[t] >= 0 or max(self.rank[a], self.rank[b]) >= r:
                raise ValueError(f"merge {r} of {path} is not the only one for its token, or comes too early")
            self.left[t], self.right[t], self.rank[t] = a, b, r
            self.merges[a, b] = (r, t)
        self.pair_code = {a << 20 | b: (r + 1) << 20 | t for (a, b), (r, t) in self.merges.items()}
        self._spines()
        made = np.flatnonzero(self.rank >= 0)
        self.reachable = np.ones(size, bool)
        self.reachable[made] = self.first_crossing(self.left[made], self.right[made]) == self.rank[made]
        for t in made[np.argsort(self.rank[made])]:
            self.reachable[t] &= self.reachable[self.left[t]] and self.reachable[self.right[t]]
        self.longest = max(map(len, self.vocab))

    # ---- text to units

    def units(self, text: str) -> list:
        if self.cut is None or "<" not in text:
            return self._plain_units(text)
        out: list = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self._plain_units(part)
        return out

    def normal(self, text: str) -> str | None:
        """The normalised text, or None if it holds rare characters."""
        if _OTHER.search(text):
            return None
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # no final form, as in the library

    def _plain_units(self, text: str) -> list:
        normal = self.normal(text)
        if normal is None:
            return [(w,) for w, _ in self.lib.pre_tokenizer.pre_tokenize_str(self.lib.normalizer.normalize_str(text))]
        return normal.split()

    def words(self, unit) -> list[list[int]]:
        """The unit's pre-tokens as symbol ids, the last one word-final."""
        if isinstance(unit, tuple):
            return [self._ids([self.byte_of[s] for s in unit[0]])]
        return [self._ids(w.encode()) for w in self.pre.findall(unit)]

    def _ids(self, data) -> list[int]:
        ids = [self.plain[b] for b in data]
        ids[-1] = self.final[data[-1]]
        return ids

    # ---- exact merging

    def merge(self, ids: list[int]) -> list[int]:
        """Merge by lowest rank, leftmost first. ``code`` holds per adjacent
        pair rank << 20 | token, so its minimum is the merge to do next."""
        get, none = self.pair_code.get, NO_PAIR
        if len(ids) > LONG_WORD:
            return self._merge_long(ids)
        ids = list(ids)
        code = [get(a << 20 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while code and (best := min(code)) < none:
            i = code.index(best)
            ids[i] = token = best & 0xFFFFF
            del ids[i + 1], code[i]
            if i < len(code):
                code[i] = get(token << 20 | ids[i + 1], none)
            if i:
                code[i - 1] = get(ids[i - 1] << 20 | token, none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and links, for words of many symbols."""
        get, ids, n = self.pair_code.get, list(ids), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(c, i, ids[i], ids[i + 1]) for i in range(n - 1) if (c := get(ids[i] << 20 | ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            c, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = c & 0xFFFFF, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for h in (before[i], i):
                if h >= 0 and after[h] < n and (c := get(ids[h] << 20 | ids[after[h]])):
                    heapq.heappush(heap, (c, h, ids[h], ids[after[h]]))
        return [t for t in ids if t >= 0]

    # ---- pair compatibility, vectorised

    def _spines(self) -> None:
        """Per token the nodes down its right and its left side, with the rank
        of the merge that consumes each node (FAR for the token itself)."""
        self.spine = {}
        for side, child in (("right", self.right), ("left", self.left)):
            node, used = np.arange(len(child)), np.full(len(child), FAR)
            nodes, ranks = [node], [used]
            while (node >= 0).any():
                used = np.where(node >= 0, self.rank[node], -1)
                node = np.where(node >= 0, child[node], -1)
                nodes.append(node)
                ranks.append(used)
            self.spine[side] = (np.stack(nodes, 1), np.stack(ranks, 1))
        pairs = sorted((a << 20 | b, r) for (a, b), (r, _) in self.merges.items())
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], np.int64)

    def first_crossing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the first merge across each border a|b, FAR if there is none."""
        best = np.full(len(a), FAR)
        (rn, rr), (ln, lr) = self.spine["right"], self.spine["left"]
        for i in range(rn.shape[1]):
            live = np.flatnonzero(rn[a, i] >= 0)
            if not len(live):
                break
            for j in range(ln.shape[1]):
                live = live[ln[b[live], j] >= 0]
                if not len(live):
                    break
                x, y = a[live], b[live]
                keys = rn[x, i] << 20 | ln[y, j]
                at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
                r = np.where(self.pair_keys[at] == keys, self.pair_ranks[at], FAR)
                fires = (r < rr[x, i]) & (r <= lr[y, j])
                best[live] = np.minimum(best[live], np.where(fires, r, FAR))
        return best


@lru_cache(maxsize=4)
def load(path: str) -> WordBpe:
    """The tables of a file, once per Python process."""
    return WordBpe(path)
