"""Line dedup by a deletion-neighbourhood join.

Lines are compared as word sequences. Lines with equal words are one class. Of
lines with at least ``MIN_NEAR`` words, two are also near if one word inserted,
deleted or replaced turns one into the other. A line goes if an earlier line of
the corpus, by (document id, line number), is equal or near; the earliest stay.

Near lines are found among the classes' first lines in three steps:

1. One edit leaves the first or the second half of a line as it is, so only
   lines that share the hash of a half (both lengths that fit a partner one
   word longer or shorter) with another line go on. That keeps the
   neighbourhoods of lines without any partner from being emitted.
2. The others emit their deletion neighbourhood: for each word the hashed key
   of the line without it, and the key of the whole line. The key is the XOR of
   the words' hashes with the length, so a line of n words costs n steps, not
   n * n. Keys that only one line has fall away.
3. For the surviving variants the remaining word sequence itself is compared:
   equal rests at the same place mean a replaced word, a rest equal to a whole
   line a deleted one. Groups only pass on their earliest line, so a group of
   many lines costs one row per line, and no pairs are emitted.

All steps are DataFrame functions in the JVM.

Defined results: null text has no lines; lines without a word are never
counted, dropped or compared; white space inside a line doesn't matter; a
document whose every line with a word is dropped goes in ``dedup_lines``, one
that never had such a line stays as it is; ids should be unique, rows that
repeat both id and text share one result, as do rows with a null id; an empty
table gives an empty table; other columns, also clashing names, are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import flag_ids, fresh

#: Words that a line needs to be compared for nearness.
MIN_NEAR = 8


def words(line: Column) -> Column:
    """Runs without 0x20 and 0x09-0x0D (a line holds no 0x0A)."""
    return F.array_remove(F.split(F.translate(line, "\t\x0b\x0c\r", "    "), " "), "")


def lines_with_words(text: Column) -> Column:
    """Number of lines with a word; 0 if the text is null."""
    return F.coalesce(F.size(F.array_remove(F.split(F.translate(text, "\t\x0b\x0c\r ", ""), "\n"), "")), F.lit(0)).cast("long")


def digests(w: Column) -> list[Column]:
    """Hashes of the first and of the second half, which together are the
    line's 128-bit digest, and of the one other half that a partner with a word
    more or less may share (its shorter first or second half)."""
    n = F.size(w)

    def first(k: Column) -> Column:
        return F.xxhash64(F.lit("first"), F.slice(w, F.lit(1), k))

    def last(k: Column) -> Column:
        return F.xxhash64(F.lit("last"), F.slice(w, n - k + 1, k))

    half = F.shiftright(n, 1)
    return [first(half), last(n - half), F.when(n >= MIN_NEAR, F.when(n % 2 == 0, first(half - 1)).otherwise(last(half)))]


def line_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, at, a, b, c) of every line with a word: position and half hashes; c
    is null for lines too short to be near another."""
    lines = df.select(df[id_col].alias("id"), F.posexplode(F.split(df[text_col], "\n")).alias("at", "line"))
    split = lines.select("id", "at", words(F.col("line")).alias("w")).where(F.size("w") > 0)
    return split.select("id", "at", *[x.alias(name) for x, name in zip(digests(F.col("w")), "abc", strict=True)])


def near_lines(df: DataFrame, firsts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, at) of first lines that are near an earlier line. ``firsts``: (id,
    at, a, b, c) of the classes' first lines."""
    halves = firsts.where(F.col("c").isNotNull()).select("id", "at", F.explode(F.array("a", "b", "c")).alias("key"))
    shared = halves.groupBy("key").count().where("count > 1").select("key")
    wanted = halves.join(shared, "key", "left_semi").groupBy("id").agg(F.collect_set("at").alias("ats"))
    wanted = materialize(wanted.withColumnRenamed("id", "_id"), "line-wanted")
    # only texts that may have a wanted line are shuffled
    texts = flag_ids(df.select(df[id_col].alias("id"), df[text_col].alias("text")), "id", wanted.select("_id"), "flag").where("flag")
    # split below the join: a lambda would split the text again for every line
    parts = texts.select("id", F.split("text", "\n").alias("parts"))
    held = parts.join(wanted.hint("merge"), F.col("id").eqNullSafe(F.col("_id"))).drop("_id")
    chosen = held.select("id", F.explode(F.transform("ats", lambda k: F.struct(k.alias("at"), F.get("parts", k).alias("line")))).alias("x"))
    split = chosen.select("id", "x.at", words(F.col("x.line")).alias("w"))
    whole = F.aggregate("w", F.lit(0).cast("long"), lambda acc, x: acc.bitwiseXOR(F.xxhash64(x)))
    lines = materialize(split.select("id", "at", "w", whole.alias("whole")), "line-candidates")

    n = F.size("w")
    variants = F.concat(
        F.array(F.struct(F.lit(-1).alias("place"), F.xxhash64(n, F.col("whole")).alias("key"))),
        F.transform("w", lambda x, i: F.struct(i.alias("place"), F.xxhash64(n - 1, F.col("whole").bitwiseXOR(F.xxhash64(x))).alias("key"))))
    emitted = lines.select("id", "at", F.explode(variants).alias("v")).select("id", "at", "v.place", "v.key")
    line = F.struct("id", "at")
    many = emitted.groupBy("key").agg(F.min(line).alias("lo"), F.max(line).alias("hi")).where("lo != hi").select("key")
    alive = emitted.join(many, "key", "left_semi").groupBy("id", "at").agg(F.collect_set("place").alias("places")).select(F.col("id").alias("_id"), F.col("at").alias("_at"), "places")
    held = lines.join(alive, F.col("id").eqNullSafe(F.col("_id")) & (F.col("at") == F.col("_at"))).select("id", "at", "w", F.explode("places").alias("place"))
    rest = F.when(F.col("place") < 0, F.col("w")).otherwise(
        F.concat(F.slice("w", F.lit(1), F.col("place")), F.slice("w", F.col("place") + 2, F.greatest(n - F.col("place") - 1, F.lit(0)))))
    rests = materialize(held.select("id", "at", "place", F.xxhash64(F.lit(1), rest).alias("a"), F.xxhash64(F.lit(2), rest).alias("b")), "line-rests")

    def before(groups: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
        """Rows whose group has an earlier line."""
        return rows.join(groups, on).where(F.col("first") < line).select("id", "at")

    cut, kept = rests.where("place >= 0"), rests.where("place < 0")
    replaced = before(cut.groupBy("a", "b", "place").agg(F.min(line).alias("first")), cut, ["a", "b", "place"])
    longer = before(kept.groupBy("a", "b").agg(F.min(line).alias("first")), cut, ["a", "b"])
    shorter = before(cut.groupBy("a", "b").agg(F.min(line).alias("first")), kept, ["a", "b"])
    return replaced.unionAll(longer).unionAll(shorter).distinct()


def dropped_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, drop) per id that has lines: lines with a word, and the
    positions of those that go."""
    lines = materialize(line_table(df, id_col, text_col), "lines")
    classes = lines.groupBy("a", "b").agg(F.min(F.struct("id", "at")).alias("first"), F.any_value("c").alias("c"))
    firsts = materialize(classes.select("first.id", "first.at", "a", "b", "c"), "first-lines")
    near = near_lines(df, firsts, id_col, text_col)
    stay = (firsts.select("id", "at", F.lit(1).alias("stays")).unionAll(near.select("id", "at", F.lit(-1).alias("stays"))))
    verdict = (lines.select("id", "at", F.lit(0).alias("stays")).unionAll(stay).groupBy("id", "at").agg(F.sum("stays").alias("stays")))
    return verdict.groupBy("id").agg(F.count(F.lit(1)).alias("n_lines"), F.collect_list(F.when(F.col("stays") <= 0, F.col("at"))).alias("drop"))


def deduped(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``df``, the text without its dropped lines, and after
    them ``n_lines`` and ``n_dropped`` (fresh names; returned by position)."""
    key, parts, total, drop, flag = (fresh(df, x) for x in ("_line_id", "_parts", "n_lines", "n_dropped", "_flag"))
    verdict = dropped_lines(df, id_col, text_col).select(F.col("id").alias(key), F.col("n_lines").alias(total), F.col("drop").alias(drop))
    shared = df.groupBy(df[id_col].alias("_shared")).count().where("count > 1").select("_shared", F.lit(True).alias("_is_shared"))
    # a row alone with its id and without a dropped line needs no verdict
    verdict = verdict.join(shared, F.col(key).eqNullSafe(F.col("_shared")), "left").where((F.size(drop) > 0) | F.col("_is_shared"))
    verdict = materialize(verdict.select(key, total, drop), "line-verdicts")
    flagged = flag_ids(df, id_col, verdict.select(key), flag)
    split = flagged.where(flag).select(*[F.split(df[c], "\n").alias(parts) if c == text_col else F.col(f"`{c}`") for c in df.columns])
    joined = split.join(verdict.hint("merge"), F.col(f"`{id_col}`").eqNullSafe(F.col(key)), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(drop))
    left = F.when(F.size(drop) > 0, F.transform(stay, lambda k: F.get(parts, k))).otherwise(F.col(parts))
    kept = [F.array_join(left, "\n").alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns]
    counted = F.coalesce(F.col(total), lines_with_words(F.array_join(parts, "\n"))).alias(total)
    moved = joined.select(*kept, counted, F.coalesce(F.size(drop), F.lit(0)).alias(drop))
    whole = flagged.where(~F.col(flag)).select(*[F.col(f"`{c}`") for c in df.columns], lines_with_words(df[text_col]).alias(total), F.lit(0).alias(drop))
    return whole.unionAll(moved)


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with shortened texts, without the documents that lost every line
    with a word."""
    out = deduped(df, id_col, text_col)
    total, drop = out.columns[-2:]
    return out.where((F.col(total) == 0) | (F.col(drop) < F.col(total))).select(*[f"`{c}`" for c in df.columns])
