"""URL filters by association rules.

Fixed (host, path) rules decide first. For the other URLs, FP-growth mines
combinations of URL tokens over the labelled pages, with the label as one more
item; rules "tokens -> block" are kept if their support (a number of pages) and
confidence reach the thresholds and no rule over fewer of the same tokens is as
confident. A page's label is that of the document it shows: the number that is
the last part of its path, with or without an ending; only a page whose path
ends in no number takes the label of its own id. Tokens on fewer bad pages than
the support are in no rule and are left out before mining. Rules
match through an inverted index: each rule is filed under its rarest token, so
a URL meets only rules filed under its own tokens, and an array test checks the
rest of the combination. All of it is DataFrame and ML-library code in the JVM.

Tokens of a URL: parts of the host ("h:") and of the path ("p:"), lower-cased
A-Z, split at anything but letters and digits, plus the names of the query's
parameters ("q:").

Defined results: a null URL or one without "://" has an empty host and path,
meets no fixed rule and is allowed; a page without a label is judged like any
other but not learned from; of repeated labels the worst counts; repeated rows
give repeated rows; without labels nothing is mined and the verdict is allow;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import fresh

#: Fixed rules: verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: Bad pages that a rule needs, however many pages there are.
MIN_COUNT = 5
MIN_CONFIDENCE = 0.9
BAD = "@block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and query of a URL."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1))


def fixed_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fixed rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL."""
    host, path, query = parts(url)

    def split(text: Column, kind: str) -> Column:
        return F.transform(F.filter(F.split(F.translate(text, UPPER, LOWER), r"[^\p{L}\p{N}]+"), lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))

    names = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, r"^([^=]*)", 1))
    return F.array_distinct(F.concat(split(host, "h:"), split(path, "p:"),
                                     F.transform(F.filter(names, lambda x: x != ""), lambda x: F.concat(F.lit("q:"), x))))


def document(url: Column, page_id: Column) -> Column:
    """Id of the document that a page shows."""
    number = F.regexp_extract(F.coalesce(parts(url)[1], F.lit("")), r"/(\d{1,18})(?:\.[A-Za-z0-9]+)?/?$", 1)
    return F.when(number != "", number.try_cast("long")).otherwise(page_id)


def mine(pages: DataFrame, labels: DataFrame, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE,
         id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id") -> DataFrame | None:
    """Rules (antecedent, confidence) for blocking; None without labels. A page
    is bad if its label says toxic or not of quality."""
    key, flag = fresh(pages, "_label_id"), fresh(pages, "_bad")
    bad = (labels.where(labels[label_id].isNotNull()).groupBy(labels[label_id].alias(key))
           .agg(F.max(F.coalesce((labels["toxic"] == 1) | (labels["quality"] == 0), F.lit(False))).alias(flag)))
    known = pages.join(bad, document(pages[url_col], pages[id_col]) == bad[key]).select(tokens(pages[url_col]).alias("items"), bad[flag].alias("bad"))
    known = materialize(known.where(F.size("items") > 0), "url-baskets")
    row = fresh(known, "_row")
    spread = known.withColumn(row, F.monotonically_increasing_id()).select(row, "bad", F.explode("items").alias("item"))
    often = spread.where("bad").groupBy("item").count().where(F.col("count") >= min_count).select("item")
    held = spread.join(often, "item", "left_semi").groupBy(row).agg(F.collect_list("item").alias("items"), F.any_value("bad").alias("bad"))
    baskets = materialize(held.select(F.when(F.col("bad"), F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items")), "url-often")
    total = baskets.count()
    if not total:
        return None
    # half a page less, so that the product with the total is never rounded above the count
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (min_count - 0.5) / total), minConfidence=min_confidence).fit(baskets)
    found = (model.associationRules.where(F.col("consequent")[0] == BAD)
             .select(F.array_sort("antecedent").alias("antecedent"), "confidence"))
    # A rule whose tokens contain those of a rule at least as confident adds nothing: file rules under
    # each token, so only rules that share a token meet.
    filed = found.select(F.explode("antecedent").alias("token"), "antecedent", "confidence")
    small = found.select(F.col("antecedent")[0].alias("token"), F.col("antecedent").alias("fewer"), F.col("confidence").alias("sure"))
    beaten = (filed.join(small, "token")
              .where((F.size("fewer") < F.size("antecedent")) & (F.size(F.array_except("fewer", "antecedent")) == 0) & (F.col("sure") >= F.col("confidence")))
              .select("antecedent").distinct())
    return materialize(found.join(beaten, "antecedent", "left_anti"), "url-rules")


def matched(urls: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """The distinct URLs that some rule matches."""
    held = urls.select(url_col).distinct().select(url_col, tokens(F.col(url_col)).alias("items"))
    spread = held.select(url_col, "items", F.explode("items").alias("token"))
    wanted = rules.select(F.explode("antecedent").alias("token")).distinct()
    common = spread.join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    spot = rules.select("antecedent", F.explode("antecedent").alias("token")).join(common, "token", "left")
    filed = spot.groupBy("antecedent").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    return (spread.join(filed, "token").where(F.size(F.array_except("antecedent", "items")) == 0)
            .select(url_col).distinct())


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", **thresholds) -> DataFrame:
    """One row per page: id, host, path, rule, verdict."""
    own = pages.select(pages[id_col].alias(id_col), pages[url_col].alias(url_col))
    mined = mine(pages, labels, id_col=id_col, url_col=url_col, **thresholds)
    if mined is None:
        out = own.withColumn("_hit", F.lit(False))
    else:
        hits = matched(own.where(F.col(url_col).isNotNull()), mined, url_col).select(F.col(url_col).alias("_url"), F.lit(True).alias("_hit"))
        out = own.join(hits, own[url_col] == hits["_url"], "left")
    host, path, _ = parts(F.col(url_col))
    rule, verdict = fixed_rule(host, path, rules)
    return out.select(id_col, host.alias("host"), path.alias("path"), rule.alias("rule"),
                      F.coalesce(verdict, F.when(F.col("_hit"), "block"), F.lit("allow")).alias("verdict"))
