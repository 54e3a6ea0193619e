"""Exact dedup by tree-merging sorted digest runs.

Every input partition makes one run: its digests, each with the best row of
the partition that has it (most code points, then smallest id) and its number
of rows. Runs then merge in rounds, ``FAN_IN`` neighbours at a time, as in a
binomial tree: the run number is divided by the fan-in and equal digests of
the merged runs keep the best identifier. A key (run, digest) never holds more
than ``FAN_IN`` rows, so a group of copies with a third of all rows costs one
row per run and level, not one task. Sort-based aggregation merges the runs.

Digests are verified on every level: rows are equal only if the SHA-256, an
independent 64-bit hash and the length of the normalised text all agree.

Defined results: null text counts as empty, and empty texts form one group; of
rows that tie on length and id (repeated rows) exactly one is kept; a null id
is smaller than any other; an empty table gives an empty table; other columns,
also clashing names, are ignored by ``exact_duplicates`` and kept by
``keep_first``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import fresh

#: Deleted before texts are compared: 0x20 and 0x09-0x0D.
BLANK = " \t\n\x0b\x0c\r"
FAN_IN = 8
KEY = ["digest", "check", "length"]


def digest_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, digest, check, length, run, row) per row, written once so that
    run and row numbers stay as they are."""
    text = F.coalesce(df[text_col], F.lit(""))
    plain = df.select(df[id_col].alias("id"), F.char_length(text).alias("n"), F.translate(text, BLANK, "").alias("plain"))
    rows = plain.select("id", "n", F.unhex(F.sha2(F.col("plain"), 256)).alias("digest"), F.xxhash64("plain").alias("check"),
                        F.octet_length("plain").alias("length"),
                        F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("row"))
    return materialize(rows, "digest-runs")


def merge_runs(runs: DataFrame) -> DataFrame:
    """One row per digest: ``best`` (-code points, id, row) and ``size``."""
    width = (runs.agg(F.max("run")).first()[0] or 0) + 1
    level = (runs.groupBy("run", *KEY)
             .agg(F.min(F.struct((-F.col("n")).alias("less"), F.col("id"), F.col("row"))).alias("best"), F.count(F.lit(1)).alias("size")))
    while width > 1:
        level = (level.withColumn("run", F.floor(F.col("run") / FAN_IN).cast("int")).groupBy("run", *KEY)
                 .agg(F.min("best").alias("best"), F.sum("size").alias("size")))
        width = -(-width // FAN_IN)
    return level.drop("run")


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    runs = digest_runs(df, id_col, text_col)
    best = merge_runs(runs)
    return (runs.join(best, KEY)
            .select(F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"),
                    (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")))


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose (id) is kept; ids must be unique."""
    key = fresh(df, "_kept_id")
    kept = exact_duplicates(df, id_col, text_col).where("kept").select(F.col(id_col).alias(key))
    return df.join(kept, df[id_col].eqNullSafe(kept[key]), "left_semi")
