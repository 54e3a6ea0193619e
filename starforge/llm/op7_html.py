"""HTML extraction with site template removal.

Pages are parsed into element trees. Every element's subtree is hashed (tag,
class, text, children), and Spark counts on how many distinct pages of a host
each hash occurs at the same place: below the same tags and classes and, for
elements without class, id or role, as the same child from the start or from
the end. Pages of a host with equal main text, under many URLs, with other
adverts or repeated as rows, count once. Subtrees on ``min_pages`` distinct
pages or more, and on ``percent`` of the host's distinct pages or more, are
deleted, inside articles too, besides what markup itself names as no content
(menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
reader comments). A passage that some articles quote stays. Where unmarked
subtrees hold more than half of a page's main text, the page is a near copy of
others rather than filled into a template, and they stay.

The main text is that of the page's ``article`` elements, else of ``main``,
else of the whole body. Only elements in it are counted. A host's template is
no longer than its mean page has elements times 200 / ``percent``, however many
pages it has, so it is joined to the pages as one list (in ``SALTS`` copies, so
that a host's pages are dealt to many tasks).

Defined results: null or empty html gives an empty text with 0 characters; a
null url is a host of its own; unclosed and misnested tags are closed as HTML
does for paragraphs, list items and table cells; a page that ends early keeps
what it has; repeated rows give repeated rows; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_texts

#: Distinct pages, and percent of the host's distinct pages, that make a subtree template.
MIN_PAGES, PERCENT = 10, 30
#: Parts that a host's rows are dealt to in joins.
SALTS = 32

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp".split())
BLOCK = set("address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
            "head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that never hold content.
DROP = set("script style textarea title noscript template iframe head nav footer aside form button select menu dialog svg object header".split())
#: Words of class, id and role that mark such elements.
MARKS = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal "
            "overlay newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs header footer masthead topbar comment "
            "comments disqus respond replies related recommended share sharing social widget toolbar pagination pager copyright login search contentinfo "
            "complementary".split())
KEEP = {"html", "body", "article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: An open element of the first kind ends when one of the second begins.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot", "thead"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
          "option": {"option"}, "p": BLOCK - {"html", "body", "head", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}}
#: The other way round: what the start of a tag can end.
ENDED_BY = {tag: {t for t, by in CLOSES.items() if tag in by} for tag in set().union(*CLOSES.values())}
SCOPE = {"table", "ul", "ol", "dl", "td", "th", "html", "body", "article", "section", "div"}


class Element:
    __slots__ = ("tag", "marks", "parts", "hash")

    def __init__(self, tag: str, marks: str = ""):
        self.tag, self.marks, self.parts, self.hash = tag, marks, [], 0


class Open:
    """The open elements from the root down, with the places of each tag, so that
    no tag walks the stack; an element is pushed and removed once."""

    def __init__(self, root: Element):
        self.stack, self.places, self.blocks = [root], {}, [0]

    def top(self) -> Element:
        return self.stack[-1]

    def last(self, tags) -> int:
        """Place of the innermost open element of the tags, 0 if none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def push(self, e: Element) -> None:
        self.places.setdefault(e.tag, []).append(len(self.stack))
        if e.tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(e)

    def cut(self, place: int) -> None:
        while len(self.stack) > place:
            tag = self.stack.pop().tag
            self.places[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def begin(self, tag: str) -> None:
        """Remove the elements that the start of ``tag`` ends, within its scope."""
        ends = ENDED_BY.get(tag)
        while ends and (place := self.last(ends)) > self.last(SCOPE - ends):
            self.cut(place)

    def end(self, tag: str) -> None:
        """An end tag closes up to its element; an inline one not beyond a block."""
        place = self.last((tag,))
        if place and (tag in BLOCK or place > self.blocks[-1]):
            self.cut(place)


def parse(html: str) -> Element:
    """The element tree; ``parts`` of an element are texts and elements."""
    root = Element("html")
    open_, at, n = Open(root), 0, len(html)
    last = html.rfind(">") + 1  # behind it only a comment is markup
    while at < n:
        m = TOKEN.search(html, at, last) if at < last else None
        if m is None:
            comment = html.find("<!--", max(at, last))
            if comment != at:
                open_.top().parts.append(html[at:comment if comment >= 0 else n])
            break
        if m.start() > at:
            open_.top().parts.append(html[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                open_.top().parts.append(m[0][9:-3].replace("&", "&amp;"))
            elif m[0].startswith("<!--") and not (len(m[0]) >= len("<!---->") and m[0].endswith("-->")):
                break  # never closed
            continue
        tag, attributes = tag.lower(), m[3] or m[6] or ""
        if m[1] or m[4]:
            open_.end(tag)
            continue
        open_.begin(tag)
        marks = " ".join(f"{a[0].lower()}={a[1] or a[2] or a[3]}" for a in ATTRIBUTE.findall(attributes)) if "=" in attributes else ""
        new = Element(tag, marks)
        open_.top().parts.append(new)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else n
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            open_.push(new)
    return root


def dropped(e: Element) -> bool:
    """Whether the element's tag, class, id or role says it is no content."""
    if e.tag in DROP:
        return True
    return bool(e.marks) and e.tag not in KEEP and not MARKS.isdisjoint(re.split(r"[^a-z0-9]+", re.sub(r"(?:^| )(?:class|id|role)=", " ", e.marks).lower()))


def hash_subtrees(e: Element, out: set[int]) -> None:
    """Fill in subtree hashes bottom-up and collect those that hold text."""
    todo, order = [e], []
    while todo:  # no recursion: pages may be nested deeply
        x = todo.pop()
        order.append(x)
        todo += [p for p in x.parts if not isinstance(p, str)]
    filled: dict[int, bool] = {}
    for x in reversed(order):
        inside = [" ".join(p.split()) if isinstance(p, str) else f"<{p.hash:x}>" for p in x.parts]
        x.hash = xxhash.xxh3_64_intdigest("\x00".join([x.tag, x.marks, *filter(None, inside)])) >> 1
        filled[id(x)] = any(p.strip() if isinstance(p, str) else filled[id(p)] for p in x.parts)
        if filled[id(x)] and x.tag not in KEEP:
            out.add(x.hash)


def _roots(root: Element) -> list[Element]:
    return _find(root, "article") or _find(root, "main") or [root]


def _headings_only(x: Element, inside: bool) -> bool:
    """Whether of a dropped element the headings stay: headers in articles."""
    return inside and (x.tag == "header" or bool(re.search(r"\bheader\b", x.marks)))


def placed(root: Element):
    """(element, keys) of the main text's elements that hold text. Keys hash
    the subtree with its place: the tags and marks above it and, if it has no
    marks, its position among its parent's elements from either end."""
    filled: set[int] = set()
    hash_subtrees(root, filled)
    for top in _roots(root):
        inside = top.tag in ("article", "main")
        todo = [(top, top.tag)]
        while todo:
            x, path = todo.pop()
            own = [p for p in x.parts if not isinstance(p, str)]
            for k, e in enumerate(own):
                if dropped(e) and not _headings_only(e, inside):
                    continue
                if e.hash in filled and e.tag not in KEEP:
                    places = (path,) if e.marks else (f"{path}+{k}", f"{path}-{len(own) - k}")
                    yield e, [xxhash.xxh3_64_intdigest(f"{e.hash:x} {place}") >> 1 for place in places]
                todo.append((e, f"{xxhash.xxh3_64_intdigest(path):x}/{e.tag} {e.marks}"))


def page_text(root: Element, often: set[int]) -> str:
    """The main text without the subtrees whose keys are ``often``."""
    template = [e for e, keys in placed(root) if not often.isdisjoint(keys)] if often else []
    got = main_text(root, {id(e) for e in template})
    if any(not e.marks for e in template):
        whole = main_text(root, {id(e) for e in template if e.marks})
        if 2 * len(got) < len(whole):
            return whole
    return got


def main_text(root: Element, template: set[int]) -> str:
    """Blocks of the main text joined by an empty line, without the elements
    whose ``id()`` is in ``template``."""
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(line)).split())
        if text:
            blocks.append(text)
        line.clear()

    for top in _roots(root):
        inside = top.tag in ("article", "main")
        todo: list[tuple[str, object, bool]] = [("in", top, False)]
        while todo:
            what, x, headings = todo.pop()
            if what == "text":
                if not headings:
                    line.append(x)
            elif what == "out":
                flush()
            else:
                only = headings
                if x is not top:
                    if dropped(x):
                        if not _headings_only(x, inside):
                            continue
                        only = True
                    if id(x) in template:
                        continue
                if only and x.tag in HEADINGS:
                    only = False
                if x.tag == "br":
                    line.append(" ")
                    continue
                if x.tag in BLOCK:
                    flush()
                    todo.append(("out", None, False))
                todo += [("text", p, only) if isinstance(p, str) else ("in", p, only) for p in reversed(x.parts)]
        flush()
    return "\n\n".join(blocks)


def _find(root: Element, tag: str) -> list[Element]:
    """The outermost elements of a tag that no dropped element holds."""
    found, todo = [], [root]
    while todo:
        x = todo.pop()
        if x.tag == tag and not re.search(r"\bcomments?\b", x.marks):
            found.append(x)
        elif x is root or not dropped(x):
            todo += [p for p in reversed(x.parts) if not isinstance(p, str)]
    return found


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, percent: int = PERCENT) -> DataFrame:
    """(site, often) per host that has a template: the keys of its subtrees.
    ``pages``: (site, html)."""
    def marks(sites, texts):
        out: dict[str, list] = {"site": [], "subtree": [], "content": []}
        for site, text in zip(sites, texts, strict=True):
            root = parse(text)
            whole = main_text(root, set())
            if not whole:
                continue
            found = {None} | {key for _, keys in placed(root) for key in keys}  # None counts the host's pages
            out["site"] += [site] * len(found)
            out["subtree"] += found
            out["content"] += [xxhash.xxh3_64_intdigest(whole) >> 1] * len(found)
        return out

    seen = map_texts(pages, "site", "html", marks, [("site", pa.int64()), ("subtree", pa.int64()), ("content", pa.int64())])
    counts = seen.distinct().groupBy("site", "subtree").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    counts = materialize(counts, "subtree-counts")
    sites = counts.where("subtree IS NULL").select("site", F.col("n").alias("pages"), every_salt())
    own = counts.where("subtree IS NOT NULL").withColumn("salt", salt("subtree"))
    often = own.join(sites, ["site", "salt"]).where(F.col("n") * 100 >= F.col("pages") * percent)
    return materialize(often.groupBy("site").agg(F.collect_set("subtree").alias("often")), "site-templates")


def salt(*by) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(SALTS))


def every_salt() -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", percent: int = PERCENT) -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    own = pages.select(pages[id_col].alias(id_col), pages[url_col].alias(url_col), pages[html_col].alias(html_col))
    own = own.withColumn("_site", F.xxhash64(host(F.col(url_col))))
    lists = templates(own.select(F.col("_site").alias("site"), F.col(html_col).alias("html")), min_pages, percent)
    lists = lists.select(F.col("site").alias("_of"), F.col("often").alias("_often"), every_salt().alias("_salt"))
    joined = own.join(lists, (own["_site"] == lists["_of"]) & (salt(own[id_col], own[url_col]) == lists["_salt"]), "left")
    work = joined.select(F.struct(id_col, url_col, "_often").alias("_key"), html_col)

    def texts_of(keys, texts):
        out: dict[str, list] = {id_col: [], url_col: [], "text": [], "n_chars": []}
        for k, text in zip(keys, texts, strict=True):
            got = page_text(parse(text), set(k["_often"] or ()))
            for name, v in ((id_col, k[id_col]), (url_col, k[url_col]), ("text", got), ("n_chars", len(got))):
                out[name].append(v)
        return out

    return map_texts(work, "_key", html_col, texts_of, [(id_col, pa.int64()), (url_col, pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
