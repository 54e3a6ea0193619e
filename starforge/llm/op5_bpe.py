"""BPE encoding and decoding by speculate and verify.

Greedy longest match proposes the tokens of each new word; one vectorised
check tests every adjacent pair of the proposals (pair rule in ``bpe``); only
the words with a failing pair are merged exactly. Words are cached per Python
worker, so a word's cost falls on its first occurrence.

Defined results: null or empty text encodes to no ids (``n_tokens`` 0, digests
of the empty string); special strings in a text become their special ids, as
the library's default does; texts are whole, whatever their length; repeated
rows give repeated rows; other columns, also clashing names, are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import FAR, WordBpe, load
from .common import map_texts

#: Units and words kept per worker; a full cache is emptied, results don't change.
CACHE = 400_000


class Encoder:
    """Encodes units with caches for words, units and checked pairs."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.word_ids: dict[tuple, tuple[int, ...]] = {}
        self.pair_ok: dict[int, bool] = {}
        self.merged = self.speculated = 0
        self.plain_of = {t: i for t, i in bpe.vocab.items() if bpe.reachable[i] and not t.endswith(bpe.end)}
        self.final_of = {t[: -len(bpe.end)]: i for t, i in bpe.vocab.items() if bpe.reachable[i] and t.endswith(bpe.end)}

    def propose(self, symbols: str) -> list[int]:
        """Greedy longest match from the left; only the last token is word-final."""
        out, at, n, most = [], 0, len(symbols), self.bpe.longest
        plain, final = self.plain_of, self.final_of
        while at < n:
            if n - at <= most and (t := final.get(symbols[at:])) is not None:
                out.append(t)
                break
            for to in range(min(n - 1, at + most), at, -1):
                if (t := plain.get(symbols[at:to])) is not None:
                    out.append(t)
                    at = to
                    break
        return out

    def apart(self, pairs: np.ndarray) -> np.ndarray:
        """Whether each coded pair of tokens stays apart."""
        own, back = np.unique(pairs, return_inverse=True)
        keys = own.tolist()
        new = np.array([k for k in keys if k not in self.pair_ok], np.int64)
        if len(new):
            if len(self.pair_ok) > 4 * CACHE:
                self.pair_ok.clear()
                new = own
            ok = self.bpe.first_crossing(new >> 20, new & 0xFFFFF) == FAR
            self.pair_ok.update(zip(new.tolist(), ok.tolist(), strict=True))
        return np.fromiter((self.pair_ok[k] for k in keys), bool, len(keys))[back]

    def encode_words(self, words: list[tuple[int, ...]]) -> None:
        """Fill the cache for words given as symbol ids."""
        bpe = self.bpe
        plans = [self.propose("".join(bpe.token[i] for i in w).removesuffix(bpe.end)) for w in words]
        sizes = np.array([len(p) for p in plans])
        flat = np.array([t for p in plans for t in p], np.int64)
        word = np.repeat(np.arange(len(plans)), sizes)
        inner = np.flatnonzero(word[:-1] == word[1:])
        bad = word[inner[~self.apart(flat[inner] << 20 | flat[inner + 1])]] if len(inner) else inner
        failing = set(bad.tolist())
        self.speculated += len(words)
        self.merged += len(failing)
        for k, (w, p) in enumerate(zip(words, plans, strict=True)):
            self.word_ids[w] = tuple(bpe.merge(list(w))) if k in failing else tuple(p)

    def encode_units(self, units: list) -> list[tuple[int, ...]]:
        """The ids of each unit; new words of all units are encoded together."""
        split = [(u,) if isinstance(u, int) else [tuple(w) for w in self.bpe.words(u)] for u in units]
        if len(self.word_ids) > CACHE:
            self.word_ids.clear()
        new = {w for u, ws in zip(units, split, strict=True) if not isinstance(u, int) for w in ws if w not in self.word_ids}
        if new:
            self.encode_words(list(new))
        return [ws if isinstance(u, int) else tuple(t for w in ws for t in self.word_ids[w]) for u, ws in zip(units, split, strict=True)]


_STATE: dict = {}


def cached(path: str, kind: str, make):
    """Per-worker cache unit -> ``make(bpe, ids)``; returns a function that
    fills it for many texts' units and the dict itself."""
    if (path, kind) not in _STATE:
        _STATE[path, kind] = (Encoder(load(path)), {})
    encoder, known = _STATE[path, kind]

    def fill(lists: list[list]) -> dict:
        new = list(set().union(*lists).difference(known)) if lists else []
        if len(known) + len(new) > CACHE:
            known.clear()
            new = list(set().union(*lists))
        for u, ids in zip(new, encoder.encode_units(new), strict=True):
            known[u] = make(encoder.bpe, ids)
        return known

    return encoder, fill


def decode(bpe: WordBpe, ids) -> str:
    """As the library decodes with no decoder set: tokens joined by a space."""
    return " ".join([bpe.token[i] for i in ids])


def encode_texts(texts: list[str], path: str) -> list[list[int]]:
    """Ids of each text."""
    encoder, fill = cached(path, "ids", lambda bpe, ids: ids)
    lists = [encoder.bpe.units(t) for t in texts]
    known = fill(lists)
    return [[i for u in units for i in known[u]] for units in lists]


def encode_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``ids`` (array of int), ``decoded``."""
    fields = [(id_col, pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]

    def run(keys, texts):
        ids = encode_texts(texts, path)
        return {id_col: keys, "ids": ids, "decoded": [decode(load(path), x) for x in ids]}

    return map_texts(df, id_col, text_col, run, fields)


def encode_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256 and decoded_sha256, made
    in the task that encodes, so ids and decoded texts are never shipped."""
    fields = [(id_col, pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]

    def run(keys, texts):
        encoder, fill = cached(path, "strings", lambda bpe, ids: (len(ids), " ".join(map(str, ids)), decode(bpe, ids)))
        lists = [encoder.bpe.units(t) for t in texts]
        known = fill(lists)
        out = {id_col: keys, "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for units in lists:
            parts = [p for u in units if (p := known[u])[0]]
            out["n_tokens"].append(sum(p[0] for p in parts))
            for k, name in ((1, "ids_sha256"), (2, "decoded_sha256")):
                out[name].append(hashlib.sha256(" ".join([p[k] for p in parts]).encode()).hexdigest())
        return out

    return map_texts(df, id_col, text_col, run, fields)
