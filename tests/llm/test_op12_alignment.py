"""Alignment against the libraries and plain byte offsets, without windows or chunks."""
import collections
import hashlib
import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def texts():
    rng = random.Random(7)
    letters = "abcdeghinorst  \n\t'’.,!019<|>éü中😀▁"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 120))) for _ in range(300)]
    words = ["the", "token", "don't", "Über", "naïve", "x1y2", "1234", "中文", "<s>", "<|endoftext|>", "\n\n", "  ", "http://a.b/c?d=e", "<0x0A>"]
    out += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(200)]
    return [*out, None, "", " ", "▁", "the " * 40_000, "ab" * 30_000, "\n" * 120_000 + "x", "　a b", "a\x00b"]


def brute(given):
    import sentencepiece
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    docs, links = [], collections.Counter()
    for t in given:
        t = t or ""
        a, b = lib.encode(" " + t, add_special_tokens=False).ids if t else [], sp.encode(t)
        raw_a = [bytes(byte_of[c] for c in lib.id_to_token(i)) for i in a]
        pieces = [sp.id_to_piece(i) for i in b]
        raw_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if not t or b"".join(raw_a) != (" " + t).encode() or b"".join(raw_b) != (" " + t).encode():
            docs.append((0, 0, [], []))
            continue
        ends = []
        for raw in (raw_a, raw_b):
            n, e = 0, {}
            for k, x in enumerate(raw):
                n += len(x)
                e[n] = k
            ends.append(e)
        pairs, groups, i, j = [], [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0][e], ends[1][e]
            pairs.append((a[x], b[y]))
            groups.append((tuple(a[i:x + 1]), tuple(b[j:y + 1])))
            i, j = x + 1, y + 1
        docs.append((len(a), len(b), groups, pairs))
        links.update(pairs)
    most = collections.Counter()
    for (x, y), n in links.items():
        most[y] = max(most[y], n)
    for n_a, n_b, groups, pairs in docs:
        s = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (n_a, n_b, len(groups), len(pairs), sum(links[p] == most[p[1]] for p in pairs), sum(links[p] for p in pairs),
               hashlib.sha256(s.encode()).hexdigest() if n_a else "", groups)


def test_alignment_matches_plain_offsets(spark, monkeypatch):
    from starforge.llm import op12_alignment as op

    given = texts()
    given += given[:5]
    want = list(brute(given))
    assert sum(w[0] == 0 for w in want) > 3 and op.align_texts(given, A, B) == [w[7] for w in want]
    rows = [(i if i else None, t, 1, "x", i) for i, t in enumerate(given)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a int, chunk string, pair long").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in op.align(df, A, B).collect()}
    assert got == {i if i else None: w[:7] for i, w in enumerate(want)}
    assert op.align(df.limit(0), A, B).count() == 0


def test_chunks_and_hashes_do_not_matter(monkeypatch):
    import numpy as np

    from starforge.llm import op12_alignment as op

    al = op.aligner(A, B)
    docs = [al.encode(t) for t in texts()[300:360]] + [al.encode(None)]
    one = [op.shown_groups(op.windows_of(al, [d])).to_pylist()[0] for d in docs]
    assert op.shown_groups(op.windows_of(al, docs)).to_pylist() == one and one[-1] == ""
    monkeypatch.setattr(op, "run_hash", lambda ids, begin, size: size.astype(np.uint64))  # windows of one length collide
    assert op.shown_groups(op.windows_of(al, docs)).to_pylist() == one
    assert op.chunk_row(al, 3, [7], [al.encode("")]).column("n_windows").to_pylist() == [[0]]


def test_chunks_are_written_in_small_rows(monkeypatch):
    import numpy as np

    from starforge.llm import op12_alignment as op

    al, given = op.aligner(A, B), [*texts()[300:500], None, "", "the token " * 30_000]
    want, docs = list(brute(given)), [al.encode(t) for t in given]
    links = [collections.Counter((x[-1], y[-1]) for x, y in w[7]) for w in want]
    for piece in (1, 500, op.PIECE):
        monkeypatch.setattr(op, "PIECE", piece)
        batch = op.chunk_row(al, 5, list(range(len(given))), docs)
        c = batch.to_pydict()
        held = [len(p) // 4 for p in c["pairs"]]
        assert set(c["chunk"]) == {5} and (piece > 500 or batch.num_rows > 5)
        assert all(n - per[-1] <= piece for n, per in zip(held, c["n_pairs"]))  # a row ends with the document that fills it
        assert sum(c["ids"], []) == list(range(len(given))) and sum(c["n_groups"], []) == [w[2] for w in want]
        pair, pair_n = sum(c["pair"], []), sum(c["pair_n"], [])
        names = [(p >> op.PAIR_BITS, p & (1 << op.PAIR_BITS) - 1) for p in pair]
        assert dict(zip(names, pair_n)) == sum(links, collections.Counter())
        place, times = (np.frombuffer(b"".join(c[k]), np.int32).tolist() for k in ("pairs", "times"))
        at = 0
        for n, own in zip(sum(c["n_pairs"], []), links):
            assert {names[p]: t for p, t in zip(place[at:at + n], times[at:at + n])} == own
            at += n
        assert at == len(place)


def test_chunk_rows_do_not_grow_with_the_chunk():
    from starforge.llm import op12_alignment as op

    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeghinorst") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    given = [" ".join(rng.choice(words) for _ in range(500)) for _ in range(200)]
    al = op.aligner(A, B)
    batch = op.chunk_row(al, 0, list(range(200)), [al.encode(t) for t in given])
    assert batch.num_rows > 3 and max(batch.slice(i, 1).nbytes for i in range(batch.num_rows)) < 250_000
    text = op.chunk_row(al, 0, [1], [al.encode(" ".join(given))])  # a repeated pair takes no more room
    assert text.nbytes < len(" ".join(given)) / 4


def test_row_groups_of_chunks_are_small(spark):
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from starforge.llm import op12_alignment as op
    from starforge.session import materialize

    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(8000)), lambda k: F.sha2(F.concat_ws(".", "id", k), 256)), "")
    made = materialize(spark.range(0, 96, 1, 1).select("id", text.alias("x")), "row-groups", op.ROW_GROUPS)
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in made.inputFiles()]
    assert made.count() == 96 and max(m.row_group(i).total_byte_size for m in files for i in range(m.num_row_groups)) < 20e6
