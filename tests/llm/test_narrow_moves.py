"""Only what may matter is shuffled: texts with a dropped line, pairs whose places allow a link."""

from pyspark.sql import functions as F


def test_line_dedup_shuffles_only_texts_with_candidates(spark, monkeypatch):
    from starforge.llm import op3_line_dedup as op3

    seen = []
    flag_ids = op3.flag_ids

    def spy(df, id_col, ids, flag):
        seen.append(flag_ids(df, id_col, ids, flag).where(F.col(flag)))
        return flag_ids(df, id_col, ids, flag)

    monkeypatch.setattr(op3, "flag_ids", spy)
    long = "one two three four five six seven eight nine"
    rows = [(k, f"a{k} b{k} c{k} d{k} e{k} f{k} g{k} h{k}\n\nshort {k}") for k in range(300)]
    rows += [(300, f"{long}\nmine"), (301, f"{long} ten\nother"), (302, "short 7"), (303, None), (303, "x\n\n y"), (None, "\nown line"), (None, "p\n q\n"), (304, " \t\n")]
    got = {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in op3.deduped(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {(k, t, 2, 0) for k, t in rows[:301]} | {(301, "other", 2, 1), (302, "", 1, 1), (303, None, 2, 0), (303, "x\n\n y", 2, 0), (304, " \t\n", 0, 0)}
    # rows without an id share one count of places: lines 0 and 1
    assert got == want | {(None, "\nown line", 2, 0), (None, "p\n q\n", 2, 0)}
    wanted, touched = ({r.id if "id" in r else r.doc_id for r in x.collect()} for x in seen)
    assert wanted == {300, 301} and touched == {301, 302, 303, None}


def test_flag_ids_never_misses(spark):
    from starforge.llm.common import flag_ids

    df = spark.range(2000).select(F.when(F.col("id") > 0, F.col("id") * 7919 - 5000).alias("k"), F.lit("x").alias("_bits"))
    ids = df.where("k IS NULL OR k % 3 = 0").select(F.col("k").alias("i"))
    out = flag_ids(df, "k", ids, "hit")
    assert out.columns == ["k", "_bits", "hit"] and out.count() == 2000
    assert out.where("(k IS NULL OR k % 3 = 0) AND NOT hit").count() == 0 and out.where("k % 3 <> 0 AND hit").count() <= 5
    assert flag_ids(df, "k", ids.limit(0), "hit").where("hit").count() == 0


def test_jaccard_takes_only_pairs_whose_places_allow_a_link(spark, monkeypatch):
    from starforge.llm import op6_jaccard as op6

    seen = []
    possible = op6.possible
    monkeypatch.setattr(op6, "possible", lambda pairs, *a: seen.append(pairs.count()) or possible(pairs, *a))
    # texts of equal size that share 40 of 100 words: they meet in regions, but can't link
    texts = [" ".join([f"s{k}" for k in range(40)] + [f"own{d}x{k}" for k in range(60)]) for d in range(30)]
    texts += [texts[0] + " end", texts[7].upper()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in op6.jaccard_components(docs).collect()}
    assert got == {k: k for k in range(30)} | {30: 0, 31: 7}
    assert sum(seen) <= 60


def test_enough_left_holds_where_linked_sets_first_meet(spark):
    import random

    from starforge.llm.op6_jaccard import enough_left

    rng = random.Random(5)
    rows = []
    for _ in range(300):
        x = set(rng.sample(range(1000), rng.randint(1, 40)))
        y = (x - set(rng.sample(sorted(x), rng.randint(0, len(x) // 5)))) | set(rng.sample(range(1000), rng.randint(0, 4)))
        if y and 100 * len(x & y) >= 80 * len(x | y):
            s = min(x & y)
            rows.append((len(x), sorted(x).index(s), len(y), sorted(y).index(s)))
    df = spark.createDataFrame(rows, "n long, at int, m long, p long")
    ok = enough_left(F.col("n"), F.col("at"), F.col("m"), F.col("p"), 80)
    assert len(rows) > 50 and df.where(ok).count() == len(rows)
    assert spark.sql("SELECT 100L n, 12 at, 100L m, 0 p").where(ok).count() == 0


def test_keep_one_leaves_kept_rows_in_place(spark, monkeypatch):
    from starforge.llm import op6_jaccard as op6

    seen = []
    flag_ids = op6.flag_ids
    monkeypatch.setattr(op6, "flag_ids", lambda *a: seen.append(flag_ids(*a)) or flag_ids(*a))
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(30))) for k in range(100)]
    rows += [(200, rows[3][1]), (4, rows[4][1]), (None, None), (201, ""), (201, "")]
    kept = op6.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    want = rows[:100] + [(None, None), (201, ""), (201, "")]
    assert sorted(map(repr, kept.collect())) == sorted(f"Row(doc_id={k!r}, text={t!r})" for k, t in want)
    assert {(r.doc_id) for r in seen[-1].where("_flag").collect()} == {200, 4}
