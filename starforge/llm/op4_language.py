"""Language ID by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary.
A word's probability is the sum over all ways to segment it into pieces, which
the forward algorithm computes; EM with the matching forward-backward counts
fits the pieces. A character outside the vocabulary is a piece of its own with
one small probability for all languages. Words are runs of letters, lower-cased,
with the vocabulary's word-begin mark; a text's score is the sum of its words'
log probabilities, and ``score`` the posterior of the best language under
equal priors.

The model is fitted on at most ``per_language`` labelled documents of each
language, the ones whose id hashes lowest, never on held-out ones (crc32 of
the id's text modulo 4 is 2). Each language's EM is one task over the sample's
word counts. Scoring caches a word's log probabilities in the Python worker.

Defined results: null text or text without a letter is ``und`` with score 0;
no labelled document at all makes every text ``und``; ties go to the language
first in alphabetical order; rows without lang or id are not learned from;
repeated rows give repeated rows; whole texts of any length; an empty table
gives an empty table; other columns are carried or ignored as asked.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, map_texts, ship_code

#: Labelled documents per language that the model is fitted on, at most.
PER_LANGUAGE = 300
LETTERS = regex.compile(r"\p{L}+")
MARK = "▁"
UNKNOWN = 1e-7
#: Words of a cache generation; those of the one before are kept beside it.
CACHE = 250_000
#: Words whose lattices are worked on at once.
BLOCK = 2000
#: Words of more characters are scored in parts of this size, as pieces never are longer.
LONGEST_WORD = 64


def vocabulary(path: str) -> dict[str, int]:
    """Letter pieces of a sentencepiece model file: piece -> number."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
    return {p: k for k, p in enumerate(sorted({p.lower() for p in pieces if LETTERS.fullmatch(p.removeprefix(MARK) or "x")}))}


def split_word(word: str) -> list[str]:
    """A word with its begin mark, in parts of bounded size."""
    word = MARK + word
    return [word[k:k + LONGEST_WORD] for k in range(0, len(word), LONGEST_WORD)]


class Trie:
    """The pieces as a tree of characters, held in sorted arrays, so that all
    start positions of many words walk it at once."""

    def __init__(self, vocab: dict[str, int]):
        prefixes = sorted({p[:k] for p in vocab for k in range(1, len(p) + 1)})
        node = {"": 0} | {p: k for k, p in enumerate(prefixes, 1)}
        keys = np.array([node[p[:-1]] << 21 | ord(p[-1]) for p in prefixes], np.int64)
        order = np.argsort(keys)
        self.keys, self.child = np.append(keys[order], np.iinfo(np.int64).max), order + 1
        self.piece = np.array([vocab.get(p, -1) for p in ["", *prefixes]], np.int32)
        self.size, self.longest = len(vocab), max(map(len, vocab))


def walk(parts: list[str], trie: Trie) -> tuple[np.ndarray, np.ndarray]:
    """(pieces, lengths): ``pieces[w, i, k]`` is the piece of k + 1 characters
    that ends before character i + 1 of part w, -1 if none; unknown single
    characters get the number after the last piece."""
    sizes = np.array([len(p) for p in parts], np.int64)
    table = np.full((len(parts), int(sizes.max(initial=0)), trie.longest), -1, np.int32)
    chars = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(parts)), sizes)
    column = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    table[row, column, 0] = trie.size
    at, left, node = np.arange(len(chars)), sizes[row] - column, np.zeros(len(chars), np.int64)
    for k in range(trie.longest):
        key = node << 21 | chars[at + k]
        edge = np.searchsorted(trie.keys, key)
        hit = trie.keys[edge] == key
        at, left, node = at[hit], left[hit], trie.child[edge[hit]]
        piece = trie.piece[node]
        found = piece >= 0
        table[row[at[found]], column[at[found]] + k, k] = piece[found]
        more = left > k + 1
        at, left, node = at[more], left[more], node[more]
    return table, sizes


def lattice(parts: list[str], vocab: dict[str, int], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`walk` over the pieces of at most ``longest`` characters."""
    return walk(parts, Trie({p: k for p, k in vocab.items() if len(p) <= longest}))


def forward(table: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """alpha[w, i, l]: probability of the first i characters of part w in
    language l, summed over all segmentations. prob: (pieces + 1, languages)."""
    words, width, longest = table.shape
    ends = np.ascontiguousarray(table.transpose(1, 2, 0))
    alpha = np.zeros((width + 1, words, prob.shape[1]))
    alpha[0] = 1
    for i in range(width):
        for k in range(min(i + 1, longest)):
            live = np.flatnonzero(ends[i, k] >= 0)
            if len(live):
                alpha[i + 1][live] += alpha[i - k][live] * prob[ends[i, k][live]]
    return alpha.transpose(1, 0, 2)


def em(words: list[str], counts: np.ndarray, vocab: dict[str, int], rounds: int = 3) -> np.ndarray:
    """Piece probabilities of one language from word counts."""
    trie = Trie(vocab)
    parts = [(p, c) for w, c in zip(words, counts, strict=True) for p in split_word(w)]
    parts.sort(key=lambda x: len(x[0]))
    blocks = [parts[k:k + 5000] for k in range(0, len(parts), 5000)]
    tables = [(*walk([p for p, _ in b], trie), np.array([c for _, c in b], float)) for b in blocks]
    size = len(vocab) + 1
    use = np.zeros(size)
    for table, _, weight in tables:  # begin with every occurrence of every piece
        w, i, k = np.nonzero(table >= 0)
        use += np.bincount(table[w, i, k], weight[w], size)
    for step in range(rounds + 1):
        use[-1] = 0
        p = (use + 0.01) / (use.sum() + 0.01 * size)
        p[-1] = UNKNOWN
        if step == rounds:
            return p
        use, column = np.zeros(size), np.append(p, 0.0)
        for table, sizes, weight in tables:
            alpha = forward(table, p[:, None])[:, :, 0]
            beta = np.zeros_like(alpha)
            beta[np.arange(len(sizes)), sizes] = 1
            whole = np.maximum(alpha[np.arange(len(sizes)), sizes], 1e-300)
            for i in range(table.shape[1] - 1, -1, -1):
                for k in range(min(i + 1, table.shape[2])):
                    piece = table[:, i, k]
                    step_p = column[piece] * beta[:, i + 1]
                    beta[:, i - k] += step_p
                    live = piece >= 0
                    use += np.bincount(piece[live], (weight * alpha[:, i - k] * step_p / whole)[live], size)


def split_texts(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(sizes, words, which): text k's lower-cased words are the next sizes[k]
    of words[which]. A text without letters has the one word ""."""
    plain = pc.replace_substring_regex(pa.array([t.lower() for t in texts], pa.large_string()), r"\P{L}+", " ")
    lists = pc.split_pattern(pc.utf8_trim(plain, " "), " ")
    coded = lists.flatten().dictionary_encode()
    return pc.list_value_length(lists).to_numpy(), coded.dictionary.to_pylist(), coded.indices.to_numpy()


class Model:
    """Log probabilities of words in every language, cached."""

    def __init__(self, languages: list[str], prob: np.ndarray, path: str):
        self.languages, self.prob, self.path = languages, prob, path
        self.trie = None

    def __getstate__(self):
        return (self.languages, self.prob, self.path)

    def __setstate__(self, state):
        self.__init__(*state)

    def _open(self) -> None:
        self.trie = Trie(vocabulary(self.path))
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.languages)))
        self.before: dict[str, int] = {}

    def _next_generation(self) -> None:
        """Put the cache aside; words met again come back from there."""
        old, rows = self.known, self.rows
        self._clear()
        self.before, self.before_rows = old, rows

    def _add(self, words: list[str], rows: np.ndarray) -> None:
        at, end = len(self.known), len(self.known) + len(words)
        if end > len(self.rows):
            self.rows = np.vstack([self.rows, np.zeros((len(words) + len(self.rows), self.rows.shape[1]))])
        self.rows[at:end] = rows
        self.known.update(zip(words, range(at, end), strict=True))

    def learn(self, words: list[str]) -> None:
        """Rows of log P(word) for words that ``known`` lacks."""
        if self.before:
            met = [w for w in words if w in self.before]
            self._add(met, self.before_rows[[self.before[w] for w in met]])
            words = [w for w in words if w not in self.before]
        self._add(words, self.word_logs(words))

    def word_logs(self, words: list[str]) -> np.ndarray:
        """log P(word) per language; 0 for the empty word."""
        out = np.zeros((len(words), len(self.languages)))
        sizes = np.array([len(w) for w in words], np.int64)
        order = np.argsort(sizes, kind="stable")
        first, last = np.searchsorted(sizes[order], [1, LONGEST_WORD])
        for a in range(first, last, BLOCK):
            own = order[a:min(a + BLOCK, last)]
            out[own] = self._part_logs([MARK + words[k] for k in own.tolist()])
        for k in order[last:].tolist():
            out[k] = self._part_logs(split_word(words[k])).sum(0)
        return out

    def _part_logs(self, parts: list[str]) -> np.ndarray:
        table, sizes = walk(parts, self.trie)
        return np.log(np.maximum(forward(table, self.prob)[np.arange(len(sizes)), sizes], 1e-300))

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and posterior of each whole text."""
        if not self.languages or not texts:
            return ["und"] * len(texts), [0.0] * len(texts)
        if self.trie is None:
            self._open()
        sizes, words, which = split_texts(texts)
        if len(self.known) + len(words) > CACHE:
            self._next_generation()
        new = [w for w in words if w not in self.known]
        if new:
            self.learn(new)
        logs = self.rows[[self.known[w] for w in words]]
        owner, spelt = np.repeat(np.arange(len(texts)), sizes), np.array([w != "" for w in words])[which]
        total = np.stack([np.bincount(owner, logs[which, k], len(texts)) for k in range(len(self.languages))], axis=1)
        best = total.argmax(1)
        score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        known = np.bincount(owner, spelt, len(texts)) > 0
        return [self.languages[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)], np.where(known, score, 0.0).tolist()


def held_out(id_col) -> F.Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, path: str, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit the piece probabilities of every language of the labelled rows."""
    ship_code(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
    languages = sorted(r[0] for r in rows.select("lang").distinct().collect())
    if not languages:
        return Model([], np.zeros((1, 0)), path)
    place = F.xxhash64("id")
    lowest = [rows.where(F.col("lang") == x).select("id", "lang").orderBy(place, "id").limit(per_language) for x in languages]
    chosen = lowest[0]
    for more in lowest[1:]:
        chosen = chosen.unionAll(more)
    chosen = F.broadcast(chosen.distinct().select(F.col("id").alias("chosen_id"), F.col("lang").alias("chosen_lang")))
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))
    sample = rows.join(chosen, (F.col("id") == F.col("chosen_id")) & (F.col("lang") == F.col("chosen_lang")))
    counts = sample.select("lang", words.alias("word")).groupBy("lang", "word").count()

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("word")
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "prob": [em(pdf["word"].tolist(), pdf["count"].to_numpy(float), vocabulary(path)).tolist()]})

    fitted = dict(counts.groupBy("lang").applyInPandas(one, "lang string, prob array<double>").collect())  # languages x vocabulary
    languages = sorted(fitted)
    return Model(languages, np.array([fitted[x] for x in languages]).T if languages else np.zeros((1, 0)), path)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``lang_pred`` and ``score`` after the id or (``carry``) all columns."""
    lang, sure = (fresh(docs, "lang_pred"), fresh(docs, "score")) if carry else ("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(keys, texts):
        names, scores = shared.value.predict(texts)
        return {lang: names, sure: scores} | ({} if carry else {id_col: keys})

    fields = [(lang, pa.string()), (sure, pa.float64())]
    return map_texts(docs, id_col, text_col, run, fields if carry else [(id_col, pa.int64()), *fields], carry)


def keep_identified(docs: DataFrame, model: Model, min_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose language is known with ``min_score`` at least; ``und``
    goes. The columns of ``docs``."""
    lang, sure = fresh(docs, "lang_pred"), fresh(docs, "score")
    return (identify(docs, model, id_col, text_col, carry=True)
            .where((F.col(f"`{lang}`") != "und") & (F.col(f"`{sure}`") >= min_score)).select(*[f"`{c}`" for c in docs.columns]))
