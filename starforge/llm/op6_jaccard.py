"""N-gram Jaccard join as a metric-space join.

Jaccard distance is a metric. Documents of equal shingle sets are one point,
named by a 64-bit digest of the set. Regions: shingles are put in one global
order, commonest last (by a count sketch of fixed size over all shingles), and
a point lies in the region of each of its first n - ceil(0.8 n) + 1 shingles.
Two points within the distance share one of these, so boundary points are
replicated exactly as far as needed and no link is lost. Points alone in all
their regions are done: nothing is within the distance.

A pair is taken in a region only if the shingles from that region's on, in the
global order, suffice for a link. Its sets are only fetched if its parity
signatures allow a link: bit k of a signature is the parity of the shingles that
hash to k, so two signatures differ in at most |x xor y| bits, and a link needs
|x xor y| <= 0.2 |x or y|.

Each region's pivot is its point of smallest digest, the same for most regions
of a group of near copies. Distances to the pivots are computed once per pair.
Points that link with the pivot are of one component and need no comparison
among themselves. A region whose points are not yet in one component joins
again: more pivots (``GROWTH`` times as many each round, all points in the
end) meet the points of other components in the triangle-inequality window
|d(x, p) - d(y, p)| <= 0.2 of the region's pivot and in the size window
0.8 <= |x| / |y| <= 1.25, and pairs compared before are left out. The rounds end
when every region is of one component or compared in full, so the result is
exact (up to collisions of 64-bit hashes).

Defined results: null text and text without words have an empty set, link with
nothing and are components of their own; fewer than five words make one
shingle; repeated rows are copies of each other and all are returned by
``jaccard_components``; rows are told apart by a hash of id and text, so rows
with one id and different texts are different documents, whose components may
have the same id as smallest; a null id is never a component's smallest, and a
component of rows without id has none; ``keep_one`` returns one row of each
component, and every row with an empty set; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import flag_ids, fresh, map_texts, ship_code, small_batches, text_groups
from .graph import components, merged
from .words import Words, mix, window_starts, windows, words_of

SIZE = 5
PERCENT = 80
#: Counters of the sketch; its 16 MB don't grow with the corpus.
SKETCH_BITS = 22
BLOCKS = 16
#: Bits of a parity signature.
PARITY_BITS = 10
#: The signature folded to 512 bits, as columns for join conditions.
SIGNS = [f"s{k}" for k in range(8)]
#: Pivots of a region in the first round after its own, and their growth.
PIVOTS, GROWTH = 16, 16


def shingle_sets(texts: list[str], size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(begin, hashes): the sorted distinct shingle hashes of text k are
    hashes[begin[k]:begin[k + 1]]."""
    w = words_of(texts, lower=True)
    doc, h = windows(w, size)
    short = np.flatnonzero((np.bincount(w.doc, minlength=len(texts)) < size) & (np.bincount(w.doc, minlength=len(texts)) > 0))
    if len(short):
        extra = _whole(w, short)
        doc, h = np.concatenate([doc, short]), np.concatenate([h, extra])
    h = h.view(np.int64)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = np.ones(len(h), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return np.searchsorted(doc[first], np.arange(len(texts) + 1)), h[first]


def _whole(w: Words, docs: np.ndarray) -> np.ndarray:
    """One hash of each given text's whole word sequence."""
    begin = np.searchsorted(w.doc, docs)
    end = np.searchsorted(w.doc, docs, "right")
    h = (end - begin).astype(np.uint64)
    for k in range(int((end - begin).max())):
        live = begin + k < end
        h[live] = mix(h[live] * np.uint64(0xD6E8FEB86659FD93) + w.hash[begin[live] + k])
    return h


def bucket(h: np.ndarray) -> np.ndarray:
    return h.view(np.uint64) >> np.uint64(64 - SKETCH_BITS)


def added(rows: DataFrame, count, size: int, kind: str) -> np.ndarray:
    """Sum (saturating, of ``kind``) over all tasks of the fixed-size arrays
    that ``count(column, array)`` fills from batches of the one column."""
    block = size // BLOCKS

    def task(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            count(batch.column(0).to_pylist(), total)
        if total.any():
            held = np.minimum(total, np.iinfo(kind).max).astype(kind)
            parts = [held[k * block:(k + 1) * block].tobytes() for k in range(BLOCKS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array(parts, pa.binary())], names=["block", "counts"])

    def add(pdf):
        import pandas as pd

        total = np.zeros(block, np.int64)
        for x in pdf["counts"]:
            total += np.frombuffer(x, kind)
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "counts": [np.minimum(total, np.iinfo(np.int32).max).astype("<i4").tobytes()]})

    out = np.zeros(size, np.int32)
    made = rows.mapInArrow(task, "block int, counts binary").groupBy("block").applyInPandas(add, "block int, counts binary")
    for r in made.collect():  # BLOCKS rows, 4 * size bytes in all
        out[r[0] * block:(r[0] + 1) * block] = np.frombuffer(r[1], "<i4")
    return out


def sketch(docs: DataFrame, text_col: str) -> np.ndarray:
    """How often shingles fall into each of 2**SKETCH_BITS counters, over all
    documents."""
    def count(texts, total):
        for a, b in text_groups(texts):
            np.add.at(total, bucket(shingle_sets([t or "" for t in texts[a:b]])[1]), 1)

    small_batches(docs.sparkSession)
    return added(docs.select(docs[text_col]), count, 1 << SKETCH_BITS, "<u2")


def row_key(docs: DataFrame, id_col: str, text_col: str):
    """A row's id and text as one hash; other columns don't count."""
    return F.xxhash64(docs[id_col].cast("long"), docs[text_col])


def texts_of(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(point, text) of the chosen (point, pick) rows. Most other texts drop out
    before the shuffle, and the chosen ones are shuffled once."""
    rows = docs.select(row_key(docs, id_col, text_col).alias("row"), docs[text_col].alias("text"))
    held = flag_ids(rows, "row", chosen.select("pick"), "wanted").where("wanted").select("row", "text").dropDuplicates(["row"])
    return held.join(chosen.hint("merge"), F.col("row") == F.col("pick")).select("point", "text")


def points(docs: DataFrame, counts: np.ndarray, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(id, row, n, point, prefix, parity) of every document; row is its key,
    point is 0 for empty sets."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(keys, texts):
        begin, h = shingle_sets(texts)
        out: dict[str, list] = {"id": [k["id"] for k in keys], "row": [k["row"] for k in keys], "n": [], "point": [], "prefix": [], "parity": []}
        for a, b in zip(begin[:-1], begin[1:], strict=True):
            own, n = h[a:b], int(b - a)
            out["n"].append(n)
            out["point"].append((xxhash.xxh3_64_intdigest(own.tobytes()) >> 1 | 1) if n else 0)
            keep = n - (percent * n + 99) // 100 + 1 if n else 0
            out["prefix"].append(own[np.lexsort((own, shared.value[bucket(own)]))[:keep]])
            odd = np.bincount(own & (1 << PARITY_BITS) - 1, minlength=1 << PARITY_BITS) & 1
            out["parity"].append(np.packbits(odd.astype(bool)).tobytes())
        return out

    named = F.struct(docs[id_col].cast("long").alias("id"), row_key(docs, id_col, text_col).alias("row"))
    keyed = docs.select(named.alias("_key"), docs[text_col].alias("_text"))
    return map_texts(keyed, "_key", "_text", run, [("id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("point", pa.int64()), ("prefix", pa.list_(pa.int64())), ("parity", pa.binary())])


def possible(pairs: DataFrame, parities: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and parity signatures don't rule out."""
    left = parities.select(F.col("point").alias("a"), F.col("n").alias("n"), F.col("parity").alias("x"))
    right = parities.select(F.col("point").alias("b"), F.col("n").alias("m"), F.col("parity").alias("y"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (4, 5))
            n, m = (batch.column(k).to_numpy() for k in (2, 3))
            differ = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
            # |x xor y| = n + m - 2 common, and a link needs 100 common >= percent (n + m - common)
            common = -(-percent * (n + m) // (100 + percent))
            yield batch.select([0, 1]).filter(pa.array(differ <= n + m - 2 * common))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "n", "m", "x", "y")
    return joined.mapInArrow(run, "a long, b long")


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, together): sizes of intersection and union per pair."""
    left = sets.select(F.col("point").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("point").alias("b"), F.col("shingles").alias("y"))

    def run(batches):
        for batch in batches:
            common, together = [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                k = len(np.intersect1d(x, y, assume_unique=True))
                common.append(k)
                together.append(len(x) + len(y) - k)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(together, pa.int64())],
                                             names=["a", "b", "common", "together"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(run, "a long, b long, common long, together long")


def linked(percent: int):
    return F.col("common") * 100 >= F.col("together") * percent


def size_window(n, m, percent: int):
    return (n * 100 >= m * percent) & (m * 100 >= n * percent)


def enough_left(n, at, m, p_at, percent: int):
    """Whether two sets of n and m shingles that meet in a region can link if it
    is the first they share: they then have no common shingle before their
    places at and p_at in the global order. A pair that links passes in the
    first region it shares, so the others need not bring it up."""
    return F.least(n - at, m - p_at) * (100 + percent) >= (n + m) * percent


def point_components(docs: DataFrame, known: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame | None:
    """(point, component) of the points that link with another; None if no two
    points share a region."""
    spark = docs.sparkSession
    cells = known.where("n > 0").select(F.posexplode("prefix").alias("at", "cell"), "point", "n").repartition("cell")
    # the aggregate reads the columns that the join reads, so both read one shuffle
    lead = (cells.groupBy("cell").agg(F.min("point").alias("pivot"), F.min_by("n", "point").alias("pivot_n"), F.min_by("at", "point").alias("pivot_at"), F.max("point").alias("other"))
            .where("pivot != other").drop("other"))
    named = ["cell", "point", "n", "at", "pivot", "pivot_n", "pivot_at"]
    met = materialize(cells.join(lead, "cell").groupBy(*named).agg(F.lit(1).alias("_one")).drop("_one"), "regions")
    regions = met.select("cell", "point", "n", "at", "pivot")
    first = (met.where((F.col("point") != F.col("pivot")) & size_window(F.col("n"), F.col("pivot_n"), percent)
                       & enough_left(F.col("n"), F.col("at"), F.col("pivot_n"), F.col("pivot_at"), percent))
             .select(F.col("pivot").alias("a"), F.col("point").alias("b")).distinct())

    parities = materialize(known.join(regions.select(F.col("point").alias("_p")).distinct(), known["point"] == F.col("_p"), "left_semi")
                           .groupBy("point").agg(F.any_value("n").alias("n"), F.any_value("parity").alias("parity"), F.min("row").alias("pick")), "parities")
    half = F.transform(F.sequence(F.lit(0), F.lit(2 * len(SIGNS) - 1)), lambda k: F.conv(F.hex(F.substring("parity", k * 8 + 1, F.lit(8))), 16, -10).cast("long"))
    signs = parities.select("point", half.alias("h")).select("point", *[F.col("h")[k].bitwiseXOR(F.col("h")[k + len(SIGNS)]).alias(c) for k, c in enumerate(SIGNS)])
    first = materialize(possible(first, parities, percent), "pairs")
    sets = wanted_sets(docs, parities, first, id_col, text_col)

    checked = materialize(distances(first, sets), "distances")
    links = checked.where(linked(percent)).select("a", "b")
    comp = components(links) if links.limit(1).count() else None
    near = 1 - percent / 100
    goal = PIVOTS
    while True:
        if comp is None:
            named = regions.withColumn("component", F.col("point"))
        else:
            named = regions.join(comp.withColumnRenamed("id", "point"), "point", "left").withColumn("component", F.coalesce("component", "point"))
        open_cells = (named.groupBy("cell").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("members"))
                      .where("lo != hi").where(F.col("members") > (0 if goal == PIVOTS else goal // GROWTH)).select("cell", "members"))
        live = materialize(named.join(open_cells, "cell"), "open-regions")
        if not live.limit(1).count():
            return comp
        regions = live.select("cell", "point", "n", "at", "pivot")  # the others are done
        away = checked.select(F.col("a").alias("pivot"), F.col("b").alias("point"), (1 - F.col("common") / F.col("together")).alias("away"))
        live = live.join(away, ["pivot", "point"], "left").join(signs, "point")
        chance = F.lit(float(goal)) / F.col("members")
        # by the point alone: regions of the same points then take the same pivots
        draw = F.pmod(F.xxhash64("point"), F.lit(1 << 20)) / float(1 << 20)
        # sizes within the window differ by one class at most
        size_class = F.floor(F.log("n") / np.log(100 / percent))
        more = live.where("point != pivot").where((draw < chance) | (F.col("members") <= goal)).select(
            "cell", F.explode(F.array(size_class - 1, size_class, size_class + 1)).alias("size_class"), F.col("point").alias("p"), F.col("n").alias("p_n"), F.col("at").alias("p_at"),
            F.col("component").alias("p_component"), F.col("away").alias("p_away"), *[F.col(c).alias("p_" + c) for c in SIGNS])
        window = F.coalesce(F.abs(F.col("away") - F.col("p_away")) <= near + 1e-9, F.lit(True))
        both = F.col("n") + F.col("p_n")
        differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col("p_" + c))) for c in SIGNS), F.lit(0))
        pairs = (live.where("point != pivot").withColumn("size_class", size_class).join(more, ["cell", "size_class"])
                 .where((F.col("component") != F.col("p_component")) & size_window(F.col("n"), F.col("p_n"), percent) & window
                        & enough_left(F.col("n"), F.col("at"), F.col("p_n"), F.col("p_at"), percent)
                        & (differ <= both - 2 * F.ceil(both * percent / (100 + percent))))
                 .select(F.least("point", "p").alias("a"), F.greatest("point", "p").alias("b")).distinct())
        more_pairs = materialize(possible(pairs.join(checked.select("a", "b"), ["a", "b"], "left_anti"), parities, percent), "pairs")
        goal *= GROWTH
        if not more_pairs.limit(1).count():
            continue
        new = materialize(distances(more_pairs, wanted_sets(docs, parities, more_pairs, id_col, text_col)), "distances")
        checked = checked.unionAll(new)
        found = new.where(linked(percent)).select("a", "b")
        if found.limit(1).count():
            comp = materialize(merged(comp, found) if comp is not None else components(found), "components")


def wanted_sets(docs: DataFrame, parities: DataFrame, pairs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(point, shingles) of the points in the pairs."""
    ends = pairs.select(F.col("a").alias("_p")).unionAll(pairs.select(F.col("b").alias("_p"))).distinct()
    chosen = materialize(parities.join(ends, parities["point"] == ends["_p"], "left_semi").select("point", "pick"), "chosen")

    def run(keys, whole):
        begin, h = shingle_sets(whole)
        return {"point": keys, "shingles": [h[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)]}

    texts = texts_of(docs, chosen, id_col, text_col)
    return materialize(map_texts(texts, "point", "text", run, [("point", pa.int64()), ("shingles", pa.list_(pa.int64()))]), "shingle-sets")


def grouped(docs: DataFrame, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, row, n, point, ...) of every document, and (point, component,
    least) of every set that is not empty; least is the row of smallest id
    with that set."""
    ship_code(docs.sparkSession)
    known = materialize(points(docs, sketch(docs, text_col), id_col, text_col, percent), "points")
    comp = point_components(docs, known, id_col, text_col, percent)
    least = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")).alias("least")
    small = known.where("n > 0").groupBy("point").agg(least)
    if comp is None:
        return known, small.withColumn("component", F.col("point"))
    return known, small.join(comp.withColumnRenamed("id", "point"), "point", "left").withColumn("component", F.coalesce("component", "point"))


def jaccard_components(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id."""
    known, small = grouped(docs, percent, id_col, text_col)
    ends = small.groupBy("component").agg(F.min("least.id").alias("component_id"))
    small = small.join(ends, "component").select("point", "component_id")
    return (known.select("id", "n", "point").join(small, "point", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")))


def keep_one(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of smallest id of each component, one of them if it is repeated,
    and all rows with an empty set."""
    known, small = grouped(docs, percent, id_col, text_col)
    key, row, flag = (fresh(docs, x) for x in ("_known_row", "_row", "_flag"))
    first = small.groupBy("component").agg(F.min("least").alias("least")).select(F.col("least.row").alias("row"), F.lit(True).alias("kept"))
    counted = known.where("n > 0").groupBy("row").agg(F.count(F.lit(1)).alias("copies"))
    # all other rows stay, and stay where they are
    told = counted.join(first, "row", "left").where("kept IS NULL OR copies > 1").select(F.col("row").alias(key), F.col("kept").alias("kept"))
    told = materialize(told, "told-rows")
    held = flag_ids(docs.withColumn(row, row_key(docs, id_col, text_col)), row, told.select(key), flag)
    rest = held.where(flag).join(told.hint("merge"), F.col(row) == F.col(key), "left_anti")
    once = held.where(~F.col(flag)).unionAll(rest)
    repeated = told.where("kept").select(key)
    if repeated.limit(1).count():
        once = once.unionAll(held.where(flag).join(repeated.hint("merge"), F.col(row) == F.col(key), "left_semi").dropDuplicates([row]))
    return once.drop(row, flag)
