"""Cross-tokenizer alignment by white-space anchors.

Both tokenizers run over the whole text. A place where a space-marked token
begins is an anchor candidate; a candidate of one tokenizer that the byte
offsets verify as a candidate of the other is an anchor, and anchors split the
document into windows of token ids. The bytes of a token depend on its id
alone, so a window's alignment depends on its ids alone: per chunk a memo holds
one alignment for each distinct tuple of ids. Windows are hashed, grouped and
compared id by id as arrays; only a memo entry is made in Python code.

Corpus counts: tasks write the distinct linked pairs of each chunk of about
``CHUNK_CHARS`` code points with counts, and each document's distinct pairs by
place among them with counts. Only (chunk, pair, count) rows are summed up and
joined back, so no link is shipped on its own, and every chunk meets its own
pairs' corpus counts again in one cogroup. A chunk's documents are written in
rows of about ``PIECE`` distinct pairs, as plain bytes and in small row groups,
so no reader or sort holds whole chunks as nested columns.

Defined results: null and empty texts, and texts whose tokens' bytes are not a
space and the text (a literal U+2581, say), have no tokens: all numbers are 0
and the digest is ''. Special strings are plain text. Texts are whole; a text
longer than a chunk is a chunk of its own. Of counts that tie for a B id all
are highest. Repeated rows give repeated rows and count each; a null id stays
null; other columns, also clashing names, are ignored; an empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .bpe import byte_symbols
from .common import small_batches
from .words import _BACK, _BASE, _powers, mix

#: Code points of a chunk; a longer text makes a longer chunk.
CHUNK_CHARS = 2_000_000
#: Distinct pairs of documents in a row of a chunk; a document is not divided.
PIECE = 16_384
#: Parquet's row groups of chunks: a reader decodes one as a whole.
ROW_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "8"}
#: A pair of ids as one number: A id << PAIR_BITS | B id.
PAIR_BITS = 20
SPACE = "\N{LOWER ONE EIGHTH BLOCK}"


class ByteLevel:
    """Tokenizer A: byte-level BPE from a `tokenizers` file. The file's merges
    make ids in order, so its ids are ranks and tiktoken merges alike, faster;
    what tiktoken's pattern engine can't hold goes to the library itself."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        if spec["normalizer"] is not None:
            raise ValueError(f"{path} changes texts before it encodes them")
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        self.bytes = [b""] * len(model["vocab"])
        for token, i in model["vocab"].items():
            self.bytes[i] = bytes(byte_of[s] for s in token)
        for r, pair in enumerate(model["merges"]):
            if model["vocab"]["".join(pair.split(" ") if isinstance(pair, str) else pair)] != 256 + r:
                raise ValueError(f"merge {r} of {path} doesn't make the token of its rank")
        self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in enumerate(self.bytes)}, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        try:
            return np.array(self.fast.encode_ordinary(text), np.int32)
        except BaseException as e:
            if type(e).__name__ != "PanicException":
                raise
            return np.array(self.lib.encode(text, add_special_tokens=False).ids, np.int32)


class Pieces:
    """Tokenizer B: a sentencepiece model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.lib.id_to_piece(i) for i in range(self.lib.vocab_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.lib.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]

    def encode(self, text: str) -> list[int]:
        return self.lib.encode(text)


class Aligner:
    """Both tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.size = [np.array([len(x) for x in t.bytes]) for t in (self.a, self.b)]
        self.names = [pa.array([str(i) for i in range(len(t.bytes))], pa.string()) for t in (self.a, self.b)]
        self.marked = [np.array([x[:1] == b" " for x in t.bytes]) for t in (self.a, self.b)]

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids by A and B, both empty if they don't make up the text. A's do
        by construction: the file has no normaliser."""
        if text:
            b = self.b.encode(text)
            if b"".join([self.b.bytes[i] for i in b]) == b" " + text.encode():
                return self.a.encode(" " + text), np.array(b, np.int32)
        return np.zeros(0, np.int32), np.zeros(0, np.int32)


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


# ---- windows of a chunk

class Windows(NamedTuple):
    per_doc: np.ndarray   # number of windows of each document
    number: np.ndarray    # of every window, in order: its place in the memo
    shown: pa.Array       # memo: the groups of each distinct window
    n_pairs: np.ndarray   # memo: links of each distinct window
    pairs: np.ndarray     # memo: their pairs of ids


def parts(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices of runs that begin at ``begin`` and have ``size`` members."""
    skip = np.cumsum(size) - size
    return np.repeat(begin - skip, size) + np.arange(int(size.sum()))


def run_hash(ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of ids."""
    total = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(ids)), out=total[1:])
    return mix((total[begin + size] - total[begin]) * _powers(_BACK, len(ids) + 1)[begin] + size.astype(np.uint64))


def distinct(hashes: np.ndarray, sides: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """The first window of each tuple of ids, in order, and each window's number
    among them. Windows of one hash are compared id by id with the first; those
    that differ get another hash."""
    while True:
        _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
        own, bad = first[number], np.zeros(len(hashes), bool)
        for ids, begin, size in sides:
            bad |= size != size[own]
        for ids, begin, size in sides:
            n = np.where(bad, 0, size)
            differs = ids[parts(begin, n)] != ids[parts(begin[own], n)]
            bad[np.repeat(np.arange(len(n)), n)[differs]] = True
        if not bad.any():
            order = np.argsort(first)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            return first[order], place[number]
        hashes = np.where(bad, mix(hashes + np.uint64(0x51ED270B)), hashes)


def windows_of(al: Aligner, docs: list[tuple[np.ndarray, np.ndarray]]) -> Windows:
    """All documents cut into windows at verified anchors, and one alignment
    for each distinct window."""
    ids, begins, starts, ends = [], [], [], []
    for k in (0, 1):
        lengths = np.array([len(d[k]) for d in docs], np.int64)
        x = np.concatenate([d[k] for d in docs]).astype(np.int64) if docs else np.zeros(0, np.int64)
        end = np.cumsum(al.size[k][x])
        start = end - al.size[k][x]
        cut = al.marked[k][x]
        cut[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
        ids.append(x)
        begins.append(np.flatnonzero(cut))
        starts.append(start)
        ends.append(end)
    at = [starts[k][begins[k]] for k in (0, 1)]
    found = np.minimum(np.searchsorted(at[1], at[0]), max(len(at[1]) - 1, 0))
    both = at[1][found] == at[0] if len(at[0]) else np.zeros(0, bool)
    begin = [begins[0][both], begins[1][found[both]]]
    size = [np.diff(np.append(begin[k], len(ids[k]))) for k in (0, 1)]
    doc_start = np.cumsum([0, *[len(d[0]) for d in docs]])
    per_doc = np.diff(np.searchsorted(begin[0], doc_start))
    sides = [(ids[k], begin[k], size[k]) for k in (0, 1)]
    first, number = distinct(run_hash(*sides[0]) * _BASE + run_hash(*sides[1]), sides)
    # the distinct windows' own tokens, in order of their place in the chunk
    take = [parts(begin[k][first], size[k][first]) for k in (0, 1)]
    end_a, end_b = ends[0][take[0]], ends[1][take[1]]
    to = np.minimum(np.searchsorted(end_b, end_a), max(len(end_b) - 1, 0))
    link_a = np.flatnonzero(end_b[to] == end_a) if len(end_a) else np.zeros(0, np.int64)
    link_b = to[link_a]
    x, y = ids[0][take[0]], ids[1][take[1]]
    window = np.repeat(np.arange(len(first)), size[0][first])[link_a]
    n_pairs = np.bincount(window, minlength=len(first))
    sides_of = [pc.binary_join(joined(al.names[k].take(pa.array(v)), np.append(0, link + 1)), ",") for k, v, link in ((0, x, link_a), (1, y, link_b))]
    groups = pc.binary_join_element_wise(*sides_of, "|")
    return Windows(per_doc, number, pc.binary_join(joined(groups, np.append(0, np.cumsum(n_pairs))), ";"), n_pairs, x[link_a] << PAIR_BITS | y[link_b])


def joined(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    """Lists of ``values`` between neighbouring ``offsets``."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def shown_groups(w: Windows) -> pa.Array:
    """The groups of each document as text."""
    return pc.binary_join(joined(w.shown.take(pa.array(w.number)), np.append(0, np.cumsum(w.per_doc))), ";")


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of each run of ``values``, runs of ``sizes``."""
    total = np.concatenate([[0], np.cumsum(values)])
    end = np.cumsum(sizes)
    return total[end] - total[end - sizes]


# ---- chunks

LONGS, INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
CHUNK = pa.schema([("chunk", pa.int64()), ("ids", LONGS), ("n_a", LONGS), ("n_b", LONGS), ("shown", pa.list_(pa.string())), ("n_windows", LONGS),
                   ("n_groups", LONGS), ("n_pairs", INTS), ("pairs", pa.binary()), ("times", pa.binary()), ("pair", LONGS), ("pair_n", LONGS)])


def doc_pairs(w: Windows, index: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each document the links and the distinct pairs; of these, in order of
    the documents, the place among the chunk's ``n`` pairs and the links.
    ``index``: the place of each of the memo's pairs."""
    size = w.n_pairs[w.number]
    links = sums(size, w.per_doc)
    key = index[parts((np.cumsum(w.n_pairs) - w.n_pairs)[w.number], size)]
    key += np.repeat(np.arange(len(links)) * n, links)
    key, times = np.unique(key, return_counts=True)
    doc, place = np.divmod(key, max(n, 1))
    return links, np.bincount(doc, minlength=len(links)), place, times


def chunk_row(al: Aligner, chunk: int, keys: list, docs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """The rows for the documents of a chunk, given their ids by A and B; the
    first has the chunk's pairs."""
    w = windows_of(al, docs)
    pair, back = np.unique(w.pairs, return_inverse=True)
    links, n_pairs, place, times = doc_pairs(w, back, len(pair))
    pair_n = np.bincount(place, weights=times, minlength=len(pair)).astype(np.int64)
    shown = [hashlib.sha256(g.encode()).hexdigest() if n else "" for g, n in zip(shown_groups(w).to_pylist(), w.per_doc, strict=True)]
    end = np.cumsum(n_pairs)
    cut = np.flatnonzero(np.diff((end - n_pairs) // PIECE)) + 1
    at, cut = np.concatenate([[0], end])[np.concatenate([[0], cut, [len(docs)]])], np.concatenate([[0], cut, [len(docs)]])
    first = np.append(0, np.full(len(cut) - 1, len(pair)))
    by_doc = [keys, [len(a) for a, _ in docs], [len(b) for _, b in docs], shown, w.per_doc, links, n_pairs]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(cut) - 1, chunk), pa.int64()), *(joined(pa.array(v, type=CHUNK.field(k + 1).type.value_type), cut) for k, v in enumerate(by_doc)),
         *(pa.array([v[i:j].astype(np.int32).tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary()) for v in (place, times)),
         *(joined(pa.array(v, pa.int64()), first) for v in (pair, pair_n))], schema=CHUNK)


def chunks(df: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """The documents, tokenised and aligned, in rows of ``CHUNK``."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al, keys, docs, chars, made = aligner(path_a, path_b), [], [], 0, TaskContext.get().partitionId() << 33
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                if docs and chars + len(text) > CHUNK_CHARS:
                    yield chunk_row(al, made, keys, docs)
                    keys, docs, chars, made = [], [], 0, made + 1
                keys.append(key)
                docs.append(al.encode(text))
                chars += len(text)
        if docs:
            yield chunk_row(al, made, keys, docs)

    return df.select(df[id_col], df[text_col]).mapInArrow(
        run, "chunk long, ids array<long>, n_a array<long>, n_b array<long>, shown array<string>, n_windows array<long>, n_groups array<long>, "
             "n_pairs array<int>, pairs binary, times binary, pair array<long>, pair_n array<long>")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, total, top) of every linked pair of ids: its links in the whole
    corpus, and whether no other pair of its B id has more."""
    b = F.col("pair").bitwiseAND((1 << PAIR_BITS) - 1).alias("b")
    counts = rows.groupBy("pair").agg(F.sum("n").alias("total")).select("pair", "total", b)
    most = counts.groupBy("b").agg(F.max("total").alias("most"))
    return counts.join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("top"))


def align(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    made = materialize(chunks(df, path_a, path_b, id_col, text_col), "aligned-chunks", ROW_GROUPS)
    rows = (made.select(F.col("chunk").alias("of"), F.posexplode(F.arrays_zip("pair", "pair_n")).alias("at", "p"))
            .select("of", "at", F.col("p.pair").alias("pair"), F.col("p.pair_n").alias("n")))
    counted = materialize(pair_counts(rows), "aligned-pairs")
    told = rows.join(counted, "pair").select("of", "at", "total", "top")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        c = {k: left[k].combine_chunks().flatten() for k in ("ids", "n_a", "n_b", "n_groups", "n_pairs", "shown")}
        pairs, times = (np.frombuffer(b"".join(left[k].to_pylist()), np.int32) for k in ("pairs", "times"))
        place = np.argsort(right["at"].to_numpy())
        total, top = (right[k].to_numpy()[place].astype(np.int64) for k in ("total", "top"))
        n_best, count_sum = (pa.array(sums(v[pairs] * times, c["n_pairs"].to_numpy()), pa.int64()) for v in (top, total))
        return pa.table({"id": c["ids"], "n_a": c["n_a"], "n_b": c["n_b"], "n_groups": c["n_groups"], "n_links": c["n_groups"], "n_best": n_best,
                         "count_sum": count_sum, "groups_sha256": c["shown"]})

    out = made.drop("n_windows", "pair", "pair_n").groupBy("chunk").cogroup(told.groupBy("of")).applyInArrow(
        finish, "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return out.withColumnRenamed("id", id_col)


def align_texts(texts: list[str | None], path_a: str, path_b: str) -> list[list[tuple[tuple[int, ...], tuple[int, ...]]]]:
    """The groups of each text as pairs of id tuples, in order."""
    al = aligner(path_a, path_b)
    return [[tuple(tuple(map(int, side.split(","))) for side in g.split("|")) for g in shown.split(";") if g]
            for shown in shown_groups(windows_of(al, [al.encode(t) for t in texts])).to_pylist()]
