"""Best-fit packing planned over the histogram of lengths.

Documents are tokenised, longer ones cut into pieces of ``capacity`` tokens,
and only the number of pieces of each length (at most ``capacity`` rows) goes
to the driver. Best-fit-decreasing runs over those counts: of all sequences
with the same room, a length fills whole ranges at once. The plan is a list of
runs (length, ranks from..to, first sequence, pieces per sequence, offset).
Each step at least halves the room of the sequences it touches, and each
length adds at most three ranges of sequences, so the plan has at most
3 * capacity * (log2(capacity) + 1) runs whatever the corpus size; that bound
is what allows its broadcast. Pieces take their slots by joining on length and
rank. Ranks come from (length, bucket) groups plus the buckets' offsets; buckets
are a hash that takes in a row number, so neither a length nor an id (null too)
that holds a third of all pieces is one group.

Defined results: null or empty text is one piece holding the separator id;
repeated rows are packed once each; other columns, also clashing names, are
ignored; an empty table gives an empty table; texts of any length are cut, none
is dropped.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .bpe import load
from .common import map_texts
from .op5_bpe import CACHE

SEPARATOR = 0
PLAN_SCHEMA = "length long, rank_from long, rank_to long, first_sequence long, per_sequence long, base long"


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, rank from, rank to, first sequence, pieces per sequence,
    offset) that place ``counts[length]`` pieces of each length by best fit,
    longest first."""
    runs, rooms, ranges, opened = [], [], {}, 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in ranges:
                insort(rooms, room)
                ranges[room] = []
            ranges[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = ranges[room].pop()
                if not ranges[room]:
                    del ranges[room], rooms[at]
            else:
                room = capacity
                first, n = opened, -(-left // (capacity // length))
                opened += n
            per = room // length
            full = min(n, left // per)
            if full:
                runs.append((length, rank, rank + full * per, first, per, capacity - room))
                put(room - per * length, first, full)
                rank, left, first, n = rank + full * per, left - full * per, first + full, n - full
            if n and 0 < left < per:
                runs.append((length, rank, rank + left, first, left, capacity - room))
                put(room - left * length, first, 1)
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            put(room, first, n)
    return runs


class _Bytes(dict):
    """Unit -> its ids as little-endian bytes. A full cache becomes the older
    generation, from which units and words still in use come back."""

    def __init__(self, path: str):
        super().__init__()
        self.bpe, self.older = load(path), {}
        self.words, self.older_words = {}, {}

    def word(self, raw: str) -> bytes:
        out = self.words.get(raw)
        if out is None:
            out = self.older_words.get(raw)
            if out is None:
                out = self.model_ids(raw if raw.isascii() and raw.isprintable() else "".join([self.bpe.symbols[b] for b in raw.encode()]))
            if len(self.words) >= CACHE // 2:
                self.older_words, self.words = self.words, {}
            self.words[raw] = out
        return out

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def __missing__(self, unit) -> bytes:
        out = self.older.get(unit)
        if out is None:
            out = self.encode(unit)
        if len(self) >= CACHE // 2:
            self.older = dict(self)
            self.clear()
        self[unit] = out
        return out

    def model_ids(self, symbols: str) -> bytes:
        """Ids of one pre-token, given in byte symbols, by the library's model."""
        return self._pack([t.id for t in self.bpe.lib.model.tokenize(symbols)])

    def encode(self, unit) -> bytes:
        if isinstance(unit, int):
            return self._pack([unit])
        if isinstance(unit, tuple):
            return self.model_ids(unit[0])
        if unit.isalpha():  # letters alone are one pre-token
            return self.word(unit)
        return b"".join(map(self.word, self.bpe.pre.findall(unit)))


_STATE: dict[str, _Bytes] = {}


def pieces(df: DataFrame, path: str, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document's pieces."""
    fields = [(id_col, pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]

    def run(keys, texts):
        if path not in _STATE:
            _STATE[path] = _Bytes(path)
        known = _STATE[path]
        out: dict[str, list] = {f: [] for f, _ in fields}
        for key, text in zip(keys, texts, strict=True):
            ids = b"".join([*map(known.__getitem__, known.bpe.units(text)), SEPARATOR.to_bytes(4, "little")])
            for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at:at + 4 * capacity]
                for name, v in zip(out, (key, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                    out[name].append(v)
        return out

    return map_texts(df, id_col, text_col, run, fields)


def with_rank(df: DataFrame, group: str, order: list[str], buckets: int) -> DataFrame:
    """Adds ``rank``, 0.. without gaps within each value of ``group``; rows of
    one value are numbered in ``buckets`` tasks."""
    spread = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    starts = (spread.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.partitionBy(group).orderBy("_bucket")) - F.col("_n"))
              .drop("_n"))
    local = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*order)) - 1
    return (spread.withColumn("_local", local).join(starts, [group, "_bucket"])
            .withColumn("rank", F.col("_local") + F.col("_before")).drop("_local", "_before", "_bucket"))


def pack(df: DataFrame, path: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id,
    offset."""
    spark = df.sparkSession
    cut = materialize(pieces(df, path, capacity, id_col, text_col).withColumn("_row", F.monotonically_increasing_id()), "packing-pieces")
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = spark.createDataFrame(best_fit(counts, capacity), PLAN_SCHEMA).withColumnRenamed("length", "_length")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = with_rank(cut, "length", [id_col, "piece", "_row"], buckets)
    step = F.col("rank") - F.col("rank_from")
    return (ranked.join(F.broadcast(plan), (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")))
            .select(id_col, "piece", "start", "length", "ids_crc32",
                    (F.col("first_sequence") + F.floor(step / F.col("per_sequence"))).cast("long").alias("sequence_id"),
                    (F.col("base") + step % F.col("per_sequence") * F.col("length")).cast("long").alias("offset")))
