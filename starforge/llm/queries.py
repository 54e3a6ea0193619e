"""The registered queries of this subpackage: one ``opN_<name>`` per operator,
over its whole table with production parameters, and their SQL where SQL can
express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    """Token counts of every document by the compiled transducer."""
    from .op2_tokens import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op5_bpe_round_trip")
def op5_bpe_round_trip(spark, sf_dir):
    """Ids and decoded texts of every document, as digests."""
    from .op5_bpe import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark, sf_dir):
    """All documents packed into sequences of 2048 tokens."""
    from .op9_packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op1_quality_rules")
def op1_quality_rules(spark, sf_dir):
    """Base rules and boosted trees over every document."""
    from .op1_quality import judge, train

    docs = table(spark, sf_dir, "documents")
    return judge(docs, train(docs, table(spark, sf_dir, "labels")))


@query("op4_language_id")
def op4_language_id(spark, sf_dir):
    """Predicted language of every document."""
    from .op4_language import held_out, identify, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs, tokenizer_path("piece_bpe_32k.model"))
    out = identify(docs, model)
    return out.select("doc_id", held_out(out["doc_id"]).alias("held_out"), "lang_pred", "score")


@query("op7_html_text")
def op7_html_text(spark, sf_dir):
    """Main text of every page."""
    from .op7_html import extract

    return extract(table(spark, sf_dir, "pages"))


@query("op8_exact_dedup", r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents),
g AS (SELECT doc_id, plain, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size,
             row_number() OVER w = 1 AS kept
      FROM d WINDOW w AS (PARTITION BY plain ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, kept, sha256(plain) AS text_sha256 FROM g""")
def op8_exact_dedup(spark, sf_dir):
    """Groups of documents equal but for white space."""
    from .op8_exact_dedup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents"))


@query("op10_url_filters")
def op10_url_filters(spark, sf_dir):
    """Every page's URL judged by fixed and mined rules."""
    from .op10_urls import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query("op3_line_dedup", r"""
WITH split AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
w AS (SELECT doc_id, pos, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM split),
l AS (SELECT doc_id, pos, w, len(w) AS n, array_to_string(w, ' ') AS line FROM w WHERE len(w) > 0),
f AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) = 1 AS is_first FROM l),
long AS (SELECT doc_id, pos, w, n, line FROM f WHERE is_first AND n >= 8),
cut AS (SELECT doc_id, pos, n, place, md5(array_to_string(list_concat(w[1:place - 1], w[place + 1:]), ' ')) AS rest
        FROM (SELECT *, unnest(range(1, n + 1)) AS place FROM long)),
replaced AS (SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY n, place, rest ORDER BY doc_id, pos) AS k FROM cut) WHERE k > 1),
pairs AS (SELECT c.doc_id AS cd, c.pos AS ca, s.doc_id AS sd, s.pos AS sa FROM cut c JOIN long s ON c.rest = md5(s.line) AND s.n = c.n - 1),
near AS (SELECT doc_id, pos FROM replaced UNION SELECT cd, ca FROM pairs WHERE (sd, sa) < (cd, ca) UNION SELECT sd, sa FROM pairs WHERE (cd, ca) < (sd, sa)),
v AS (SELECT f.doc_id, f.pos, NOT f.is_first OR near.pos IS NOT NULL AS goes FROM f LEFT JOIN near ON near.doc_id = f.doc_id AND near.pos = f.pos),
per AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped FROM v GROUP BY 1),
kept AS (SELECT s.doc_id, string_agg(s.line, chr(10) ORDER BY s.pos) AS text
         FROM split s LEFT JOIN v ON v.doc_id = s.doc_id AND v.pos = s.pos WHERE NOT coalesce(v.goes, FALSE) GROUP BY 1)
SELECT d.doc_id, coalesce(per.n_lines, 0) AS n_lines, CAST(coalesce(per.n_dropped, 0) AS INTEGER) AS n_dropped,
       sha256(coalesce(kept.text, '')) AS text_sha256
FROM documents d LEFT JOIN per USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def op3_line_dedup(spark, sf_dir):
    """Every document without the lines that repeat earlier ones."""
    from pyspark.sql import functions as F

    from .op3_line_dedup import deduped

    out = deduped(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@query("op6_ngram_jaccard")
def op6_ngram_jaccard(spark, sf_dir):
    """Components of documents whose 5-word shingles overlap by 80 percent."""
    from .op6_jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op11_reply_trees", r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
           UNION ALL SELECT -7, n, role, said, role, said
           FROM (SELECT unnest([0, 1]) AS n, unnest(['user', 'assistant']) AS role, '\### Assistant: </turn> ok' AS said)),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) AS turns,
             coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, t NULLS FIRST) FILTER (role = 'assistant'), '') AS loss,
             sum(15 + length(url_encode(role)) + length(regexp_replace(text, '<(\\*)(/?turn)', '<\\\1\2', 'g'))) AS chars
      FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM g""")
def op11_reply_trees(spark, sf_dir):
    """Every conversation, and one full of control strings, as a reply tree."""
    from .op11_chat import digests, format_paths, from_turns

    control = spark.sql(r"SELECT -7L AS conv_id, turn, role, r'\### Assistant: </turn> ok' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(format_paths(from_turns(said.unionByName(control))))


def merkle_sql(levels: int = 8, group_levels: int = 4) -> str:
    """SQL of ``op13_merkle_manifest``, each level spelled out (``levels`` of a
    language's tree: 8**levels rows at most, ``group_levels`` of the languages')."""
    framed = "coalesce(CAST(strlen({0}) AS VARCHAR) || ':' || {0}, '-')"
    leaf = "sha256(" + " || ".join(framed.format(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars")) + " || {})"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))"
    crc = ("xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))), "
           f"lambda c, b: {bits}), 4294967295)")
    out = [f"d AS MATERIALIZED (SELECT doc_id, lang, {leaf.format(framed.format('text'))} AS leaf, {leaf.format(framed.format(low))} AS low, {crc} AS crc FROM documents)",
           "l AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM d)",
           "n0 AS (SELECT lang, p, leaf AS h, count(*) OVER (PARTITION BY lang) AS m FROM l)",
           "f0 AS (SELECT *, p AS p0, CASE WHEN crc % 3 = 0 THEN low ELSE leaf END AS fold, '' AS proof FROM l)"]

    def tree(n: str, f: str, key: str, count: int) -> None:
        for k in range(count):
            run = f"OVER (PARTITION BY {key}, p // 8 ORDER BY p ROWS BETWEEN "
            out.append(f"""s{n}{k} AS MATERIALIZED (SELECT {key}, p, m, coalesce(string_agg(h, '') {run}UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
              coalesce(string_agg(h, '') {run}1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM {n}{k})""")
            out.append(f"""{n}{k + 1} AS MATERIALIZED (SELECT {key}, p // 8 AS p, CASE WHEN m > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE min(h) END AS h, (m + 7) // 8 AS m
              FROM {n}{k} GROUP BY {key}, p // 8, m)""")
            out.append(f"""{f}{k + 1} AS MATERIALIZED (SELECT f.* REPLACE (f.p0 // 8 AS p0, CASE WHEN m > 1 THEN sha256(a || fold || b) ELSE fold END AS fold,
              CASE WHEN m > 1 THEN proof || a || b ELSE proof END AS proof) FROM {f}{k} f JOIN s{n}{k} s ON s.{key} IS NOT DISTINCT FROM f.{key} AND s.p = f.p0)""")

    tree("n", "f", "lang", levels)
    out.append(f"g0 AS MATERIALIZED (SELECT TRUE AS one, lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p, h, count(*) OVER () AS m FROM n{levels})")
    out.append(f"e0 AS MATERIALIZED (SELECT f.* REPLACE (g0.p AS p0), g0.h AS subroot, TRUE AS one FROM f{levels} f JOIN g0 ON g0.lang IS NOT DISTINCT FROM f.lang)")
    tree("g", "e", "one", group_levels)
    return ("WITH " + ",\n".join(out) + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = h AS verified FROM e{group_levels}, g{group_levels}""")


@query("op13_merkle_manifest", merkle_sql())
def op13_merkle_manifest(spark, sf_dir):
    """Every document's leaf, proof and the root of its own version."""
    from .op13_merkle import build, lower_every_third, verify

    docs = table(spark, sf_dir, "documents")
    return verify(build(docs, lower_every_third(docs)))


@query("op12_token_alignment")
def op12_token_alignment(spark, sf_dir):
    """Every document's tokens of two tokenizers aligned, with corpus counts."""
    from .op12_alignment import align

    return align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
