"""Quality rules: fixed base rules, then gradient-boosted trees over document
statistics.

The trees are fitted here (logistic loss, histogram splits) on at most
``sample`` labelled documents, the ones whose id hashes lowest, so the model
doesn't depend on how the tables are partitioned. Features that can only speak
against a document (symbols, repeated lines and words, shouting) carry a
monotonic constraint: a split on them must not raise the score, and the
children inherit bounds from the middle of the two leaf values. The fitted
trees are flattened into arrays (feature, threshold, left, right, value), and
all trees move all rows of a batch one level at a time.

Defined results: null or empty text has no words, so its base fails and it is
not kept; without labels, or with labels of one class, only the base rules
decide; rows with a null label are ignored, of repeated labels of one document
the smallest counts; a label may be missing; repeated rows give repeated rows;
an empty table gives an empty table; other columns are carried or ignored as
asked.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, map_texts
from .words import per_text, window_starts, windows, words_of

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MIN_WORDS = 50
BLANK = " \t\n\x0b\x0c\r"
#: Labelled documents that the trees are fitted on, at most.
SAMPLE = 10_000

FEATURES = ["log_words", "word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "stutter_rate", "capital_rate", "shout_rate", "stop_rate"]
#: -1: the score may only fall as the feature rises.
MONOTONE = np.array([0, 0, -1, -1, -1, -1, -1, -1, 0])
BASE = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64())]


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(BLANK)]
    return len(lines), len(lines) - len(set(lines))


def statistics(texts: list[str]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The base counts and the feature matrix of whole texts."""
    w, n = words_of(texts), len(texts)
    n_words = np.bincount(w.doc, minlength=n)
    lead = (w.data & 0xC0) != 0x80
    inside = np.zeros(len(w.data) + 1, np.int8)
    inside[w.start] += 1
    inside[w.end] -= 1
    word_chars = per_text(w, lead & (np.cumsum(inside[:-1]) > 0))
    n_symbols = per_text(w, SYMBOLS[w.data])
    at, (doc, h) = window_starts(w, 3), windows(w, 3)
    own, count = _groups(doc, h)
    hit = at[count[own] > 1]
    covered = np.zeros(len(w.doc), bool)
    for k in range(3):
        covered[hit + k] = True
    n_repeat = np.bincount(w.doc[covered], minlength=n)
    lines = np.array([_lines(t) for t in texts], np.int64).reshape(-1, 2)
    same = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    stutter = np.bincount(w.doc[1:][same], minlength=n)
    capitals = per_text(w, (w.data >= 65) & (w.data <= 90))
    shouts, stops = per_text(w, w.data == 33), per_text(w, w.data == 46)
    base = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": lines[:, 1], "n_repeat_words": n_repeat}
    words, chars = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    x = np.stack([np.log1p(n_words), word_chars / words, n_symbols / chars, lines[:, 1] / np.maximum(lines[:, 0], 1), n_repeat / words,
                  stutter / words, capitals / chars, shouts / words, stops / words], 1)
    return base, x


def _groups(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each (doc, hash) and the groups' sizes."""
    order = np.lexsort((h, doc))
    d, k = doc[order], h[order]
    first = np.ones(len(order), bool)
    first[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
    number = np.cumsum(first) - 1
    own = np.empty(len(order), np.int64)
    own[order] = number
    return own, np.bincount(number) if len(number) else np.zeros(0, np.int64)


# ---- the model

class Trees(NamedTuple):
    feature: np.ndarray    # -1: leaf
    threshold: np.ndarray  # to the left if value <= threshold
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float
    depth: int


def score(trees: Trees, x: np.ndarray) -> np.ndarray:
    """Probability of good quality; all trees step down all rows together."""
    if not len(trees.roots):
        return np.full(len(x), 1 / (1 + np.exp(-trees.start)))
    node = np.repeat(trees.roots[None, :], len(x), 0)
    rows = np.arange(len(x))[:, None]
    for _ in range(trees.depth):
        f = trees.feature[node]
        below = x[rows, np.maximum(f, 0)] <= trees.threshold[node]
        node = np.where(f < 0, node, np.where(below, trees.left[node], trees.right[node]))
    return 1 / (1 + np.exp(-(trees.start + trees.value[node].sum(1))))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0, bins: int = 64, monotone: np.ndarray = MONOTONE) -> Trees:
    """Boosted trees with logistic loss and monotonic constraints."""
    prior = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 1.0 - 1e-6
    start = float(np.log(prior / (1 - prior)))
    cols: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []
    if not len(y) or y.min() == y.max():
        start = 10.0
        rounds = 0
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])] if rounds else []
    code = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1) if rounds else x
    margin = np.full(len(y), start)

    def node() -> int:
        for k, v in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", 0.0)):
            cols[k].append(v)
        return len(cols["value"]) - 1

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        me, gs, hs = node(), g[rows].sum(), h[rows].sum()
        best, cut = 1e-6, None
        if level < depth and len(rows) >= 20:
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                gl = np.bincount(code[rows, j], g[rows], len(c) + 1).cumsum()[:-1]
                hl = np.bincount(code[rows, j], h[rows], len(c) + 1).cumsum()[:-1]
                vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-(gs - gl) / (hs - hl + ridge), low, high)
                gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                gain[(hl < 1) | (hs - hl < 1) | (monotone[j] * (vr - vl) < 0)] = 0
                k = int(gain.argmax())
                if gain[k] > best:
                    best, cut = gain[k], (j, k, vl[k], vr[k])
        if cut is None:
            v = float(np.clip(-gs / (hs + ridge), low, high)) * rate
            cols["value"][me] = v
            margin[rows] += v
            return me
        j, k, vl, vr = cut
        middle, below = (vl + vr) / 2, code[rows, j] <= k
        bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[int(monotone[j])]
        cols["feature"][me], cols["threshold"][me] = j, float(cuts[j][k])
        cols["left"][me] = grow(rows[below], g, h, level + 1, *bounds[0])
        cols["right"][me] = grow(rows[~below], g, h, level + 1, *bounds[1])
        return me

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -10.0, 10.0))
    return Trees(np.array(cols["feature"], np.int64), np.array(cols["threshold"]), np.array(cols["left"], np.int64), np.array(cols["right"], np.int64), np.array(cols["value"]), np.array(roots, np.int64), start, depth)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality") -> Trees:
    """Fit on the ``sample`` labelled documents whose id hashes lowest; of rows that
    share an id the one whose text hashes lowest is taken, chosen map-side."""
    key = fresh(docs, "_label_id")
    good = fresh(docs, "_good")
    chosen = (labels.where(labels[label_col].isNotNull() & labels[label_id].isNotNull())
              .groupBy(labels[label_id].cast("long").alias(key)).agg(F.min(label_col).alias(good))
              .orderBy(F.xxhash64(key), key).limit(sample))
    own = docs.select(docs[id_col].cast("long").alias(id_col), docs[text_col])
    held = own.join(F.broadcast(chosen), own[id_col] == chosen[key])  # at most `sample` rows of two numbers
    joined = held.groupBy(id_col).agg(F.min(F.struct(F.xxhash64(text_col), text_col)).alias("_first")).select(id_col, f"_first.{text_col}")

    def run(keys, texts):
        return {"id": keys, "x": statistics(texts)[1].tolist()}

    fields = [("id", pa.int64()), ("x", pa.list_(pa.float64()))]
    rows = map_texts(joined, id_col, text_col, run, fields).collect()  # at most `sample` documents' features
    truth = dict(chosen.collect())
    rows.sort(key=lambda r: (r["id"], r["x"]))
    x = np.array([r["x"] for r in rows], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([truth[r["id"]] for r in rows], float))


def judge(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, carry: bool = False) -> DataFrame:
    """Base counts, ``base_failed``, ``score`` and ``kept`` per row, after the
    id or (``carry``) after all columns."""
    names = {k: fresh(docs, k) if carry else k for k in [*dict(BASE), "base_failed", "score", "kept"]}
    fields = [(names[k], t) for k, t in [*BASE, ("base_failed", pa.bool_()), ("score", pa.float64()), ("kept", pa.bool_())]]

    def run(keys, texts):
        base, x = statistics(texts)
        failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
        p = score(trees, x)
        cols = {names[k]: v for k, v in [*base.items(), ("base_failed", failed), ("score", p), ("kept", ~failed & (p >= threshold))]}
        return cols | ({} if carry else {id_col: keys})

    return map_texts(docs, id_col, text_col, run, fields if carry else [(id_col, pa.int64()), *fields], carry)


def keep_good(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``."""
    kept = fresh(docs, "kept")
    return judge(docs, trees, id_col, text_col, carry=True).where(F.col(f"`{kept}`")).select(*[f"`{c}`" for c in docs.columns])
