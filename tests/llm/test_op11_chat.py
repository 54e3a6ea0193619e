"""Reply trees against a brute-force walk, the template's round trip, the query's digests."""
import hashlib
import random

import pytest

from starforge.llm.op11_chat import digests, escape, format_paths, from_replies, from_turns, read_loss, read_turns, unescape

ODD = ["", "plain", "<turn user>", "</turn>\n<turn assistant>", "<\\turn", "<\\\\/turn>", "\\### Assistant: </turn> ok", "a<b>\\", "ü" * 3, "x\n</turn>\n", "$1 \\1", "😀 </turn> é"]


def paths(nodes):
    """Every root-to-leaf path of {id: (parent, role, text, score)}."""
    inner = {p for p, *_ in nodes.values() if p in nodes}
    for leaf in set(nodes) - inner:
        path, at = [], leaf
        while at in nodes:
            path.append(at)
            at = nodes[at][0]
        yield leaf, path[::-1]


def test_template_round_trip(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(t,) for t in ODD], "t string")
    for r in df.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and "<turn" not in r.e and "</turn" not in r.e and (r.e == r.t or "turn" in r.t)


def test_branches_match_a_walk(spark):
    rng = random.Random(3)
    rows, trees = [], {}
    for tree, size, near in [("hot", 400, 0), ("deep", 70, 1), ("one", 1, 0), (None, 9, 0), ("loop", 0, 0)]:
        nodes = {}
        for i in range(size):
            parent = None if i == 0 else (i - 1 if near else rng.randrange(-1, i))  # -1: the parent is missing
            nodes[i] = (parent, rng.choice(["user", "assistant", "a>b c", None]), rng.choice([*ODD, None]), rng.choice([None, 0.5, 1.0, 2.0]))
        trees[tree] = nodes
        rows += [(tree, i, *m, "extra") for i, m in nodes.items()]
    rows += rows[:50]
    rows += [("loop", 4, 6, "user", "c", None, ""), ("loop", 6, 5, "user", "b", None, ""), ("loop", 5, 4, "user", "a", None, ""), ("loop", 9, 6, "assistant", "d", 1.0, "")]
    trees["loop"] = {4: (None, "user", "c", None), 5: (4, "user", "a", None), 6: (5, "user", "b", None), 9: (6, "assistant", "d", 1.0)}
    df = spark.createDataFrame(rows, "tree_id string, message_id long, parent_id long, role string, text string, points double, rank string")
    out = format_paths(from_replies(df, score_col="points"), branches=3)
    got = {(r.tree, r["rank"]): r for r in out.select("*", read_turns(out.formatted).alias("turns"), read_loss(out.formatted, out.loss_spans).alias("loss")).collect()}
    n = 0
    for tree, nodes in trees.items():
        ranked = []
        for leaf, path in paths(nodes):
            points = [nodes[i][3] for i in path if nodes[i][3] is not None]
            score = sum(points) / len(points) if points else None
            ranked.append((score is None, -(score or 0), -len(path), leaf, score, path))
        for k, (_, _, _, leaf, score, path) in enumerate(sorted(ranked)[:3], 1):
            r, said = got[tree, k], [(nodes[i][1] or "", nodes[i][2] or "") for i in path]
            assert (r.leaf, r.n_turns, [tuple(t) for t in r.turns]) == (leaf, len(path), said)
            assert r.score == (pytest.approx(score) if score is not None else None)
            assert r.loss == "".join(t for role, t in said if role == "assistant") and len(r.loss_spans) == sum(x == "assistant" for x, _ in said)
            n += 1
    assert n == len(got)


def test_conversations_as_chains(spark):
    rows = [(1, 1, "assistant", "b", 0), (1, 0, "user", "a", 0), (1, 1, "assistant", "b", 0), (None, None, None, None, 0), (None, 2, "assistant", None, 0),
            (2, 0, "assistant", "é" * 300_000 + "</turn>", 0), (3, 0, "user", "", 0), *[(4, t, "user" if t % 2 else "assistant", f"t{t}", 0) for t in range(130)]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node int")
    got = {r.conv_id: r for r in digests(format_paths(from_turns(df))).collect()}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append((-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
    assert set(got) == set(by)
    for conv, said in by.items():
        said.sort()
        loss = "".join(t for _, role, t in said if role == "assistant")
        want = hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in said).encode()).hexdigest()
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(said), want, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert digests(format_paths(from_turns(df.limit(0)))).count() == 0
    assert not any("Python" in str(x) for x in [digests(format_paths(from_turns(df.limit(1))))._jdf.queryExecution().executedPlan()])
