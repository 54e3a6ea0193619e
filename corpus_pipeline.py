"""The corpus pipeline: raw documents to packed training sequences.

``STAGES`` are applied in order; each takes (spark, docs, sf_dir) and works on
all rows that its predecessor returned. All but the last return the columns of
``documents``. ``run`` writes every stage's rows under the checkpoint folder
and rereads them, so a lost executor never costs more than one stage.

1. language ID: documents of no known language, or known with less than half
   of the posterior, go.
2. quality rules: documents that fail the base rules or the boosted trees go.
3. line dedup: lines equal to or one word away from an earlier line go, and
   documents left without a line.
4. n-gram Jaccard join: of each group of linked documents the smallest id stays.
5. best-fit packing: the rest is tokenised and packed into sequences.

An empty table passes through all stages; null texts go in the first one;
extra columns are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.llm import op1_quality, op3_line_dedup, op4_language, op6_jaccard, op9_packing
from starforge.llm.common import table
from starforge.llm.queries import tokenizer_path
from starforge.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    return op4_language.keep_identified(docs, op4_language.train(docs, tokenizer_path("piece_bpe_32k.model")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, with trees fitted on the labels."""
    return op1_quality.keep_good(docs, op1_quality.train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat earlier ones; ``n_chars``
    follows the shorter text."""
    out = op3_line_dedup.dedup_lines(docs)
    if "n_chars" not in out.columns:
        return out
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return op6_jaccard.keep_one(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences of 2048 tokens."""
    return op9_packing.pack(docs, tokenizer_path())


STAGES = [("language_id", language_id), ("quality_rules", quality_rules), ("line_dedup", line_dedup),
          ("ngram_jaccard", ngram_jaccard), ("packing", packing)]

#: No SQL form: models are fitted, tokens merged. tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` through all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
