"""The manifest against a plain recursive tree, over several blocks and odd rows."""
import hashlib
import zlib

from starforge.llm.op13_merkle import build, lower_every_third, verify, versions


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(doc_id, text, lang, source, n, low=False):
    if low and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return h(*map(framed, (doc_id, source, lang, n, text)))


def tree(nodes):
    """Levels of the tree over ``nodes``."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, k):
    for level in levels[:-1]:
        yield "".join(level[k - k % 8:k]), "".join(level[k + 1:k - k % 8 + 8])
        k //= 8


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r[:5]), r))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([d for *_, d, _ in sorted(by[x], key=lambda t: t[:3])]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    out = []
    for g, x in enumerate(langs):
        for k, (*_, own, r) in enumerate(sorted(by[x], key=lambda t: t[:3])):
            siblings = [*path(trees[x], k), *path(top, g)]
            d = leaf(*r[:5], low=True) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else own
            n_new = len(siblings) + 1 if d != own or (r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0) else 0
            for a, b in siblings:
                d = h(a, d, b)
            out.append((r[0], own, trees[x][-1][0], top[-1][0], h(*[a + b for a, b in siblings]), d, d == top[-1][0], n_new))
    return out


COLS = "doc_id long, text string, lang string, source string, n_chars long, pos long, known string, digest string, changed int, block long, row long, size long"


def test_manifest_matches_a_plain_tree(spark):
    rows = [(i, f"Text {i}" if i % 7 else None, "en", "web", i) for i in range(34_000)]
    rows += [(i, f"Plain {i}", f"l{i % 70}", None, None) for i in range(300)]
    rows += [(5, "Äb Z", None, None, 3), (None, "x", None, "s", None), (None, None, None, None, None), (9, "", "", "", 0), (9, "A", "de", "s", 1), (9, "B", "de", "s", 1),
             (12, "long Ü " * 100_000, "de", "s", 1)]
    rows += [rows[3]] * 9 + [rows[-1]]
    df = spark.createDataFrame([(*r, 1, "k", "d", 2, 3, 4, 5) for r in rows], COLS)
    m = build(df, lower_every_third(df))
    got = sorted((tuple(r) for r in verify(m).collect()), key=repr)
    want = brute(rows)
    assert got == sorted((w[:7] for w in want), key=repr)
    assert any(w[6] for w in want) and not all(w[6] for w in want)
    copies = versions(m).groupBy("known", "part", "leaf_pos").count()
    assert sorted(r["count"] for r in copies.collect()) == sorted(w[7] for w in want if w[7])


def test_empty_and_single(spark):
    df = spark.createDataFrame([(3, "Ab", "en", "s", 2)], "doc_id long, text string, lang string, source string, n_chars long")
    empty = df.limit(0)
    assert verify(build(empty, lower_every_third(empty))).collect() == []
    own = leaf(3, "Ab", "en", "s", 2)
    assert [tuple(r) for r in verify(build(df)).collect()] == [(3, own, own, own, h(""), own, True)]
