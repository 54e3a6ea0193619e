"""Fits take one row per labelled id; label and page columns may clash."""
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def test_quality_fit_sees_one_row_per_id(spark, monkeypatch):
    from starforge.llm import op1_quality as op

    seen = []
    fit = op.fit
    monkeypatch.setattr(op, "fit", lambda x, y, *a, **k: (seen.append(len(x)), fit(x, y, *a, **k))[1])
    rows = [(1, f"text {i} of one id") for i in range(500)] + [(i, f"word {i} " * i) for i in range(2, 30)] + [(None, "x"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 30)] + [(1, 0), (None, 1)], "doc_id long, quality long")
    op.train(docs, labels)
    op.train(docs.orderBy(F.desc("text")), labels, sample=2)
    assert seen == [29, 2]


def test_url_rules_with_clashing_columns(spark):
    from starforge.llm.op10_urls import judge_urls

    pages = spark.createDataFrame([(i, f"http://h{i % 3}.org/bad/{i}" if i % 2 else f"http://h.org/x/{i}", 1, "r", 0) for i in range(40)],
                                  "page_id long, url string, bad int, rule string, _label_id int")
    labels = spark.createDataFrame([(i, 0 if i % 2 else 1, 0) for i in range(40)], "doc_id long, quality long, toxic long")
    got = {r.page_id: r.verdict for r in judge_urls(pages, labels).collect()}
    assert len(got) == 40 and got == {r.page_id: r.verdict for r in judge_urls(pages.drop("bad", "rule", "_label_id"), labels).collect()}
    assert "block" in got.values()


def test_op9_hot_and_null_ids_spread_over_buckets(spark):
    from starforge.llm.op9_packing import with_rank

    rows = spark.range(600).select(F.when(F.col("id") >= 200, F.lit(7)).cast("long").alias("doc_id"), F.lit(0).alias("piece"),
                                   F.lit(3).alias("length"), F.col("id").alias("_row"))
    ranked = with_rank(rows, "length", ["doc_id", "piece", "_row"], 8)
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(600))
    spread = rows.groupBy("doc_id", F.pmod(F.xxhash64("doc_id", "piece", "_row"), F.lit(8)).alias("b")).count().collect()
    assert len(spread) == 16 and max(r["count"] for r in spread) < 100


def test_op9_ids_equal_the_library_on_odd_texts(spark):
    from tokenizers import Tokenizer

    from starforge.llm import op9_packing

    known = op9_packing._Bytes(PATH)
    lib = Tokenizer.from_file(PATH)
    for text in ["plain words, 's it's don't!! a1b2c3", "\x01a\x7fb \x02", "caf\u00e9 na\u00efve \u00df \u0130", "\u65e5\u672c \U0001f600 \u201cq\u201d", "x" * 5000, ""]:
        ids = b"".join(map(known.__getitem__, known.bpe.units(text)))
        want = lib.encode(text, add_special_tokens=False).ids
        assert ids == b"".join(i.to_bytes(4, "little") for i in want)
