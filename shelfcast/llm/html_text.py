"""Main text of web pages with removal of site templates.

One pass parses every page into blocks of text, each with the hashes of the
element subtrees around it, and writes them. Spark counts, for every host and
subtree hash, the distinct page contents that hold it; a subtree found in many
pages of its host belongs to the site's template, and its blocks go. What is never
text (scripts, styles, forms) and containers that name themselves as navigation,
header, footer, sidebar, notice, advert or reader comment go while parsing. Such a
label counts if all of its words say so ("cookie-notice", not "related-work" or
"no-sidebar"); ids inside an <article> or <main> name topics and count for comments
only. A labelled container with most of the page's text, or with an article that
isn't a comment, stays; so do headings and paragraphs. The count decides the rest.

A page's content root is its <article> (outermost ones in page order), else <main>,
else <body>, else everything. Inside an <article> or <main> plain paragraphs,
headings, lists, quotes, tables and the like are the text itself and stay however
often they recur (a passage that many articles quote is no template); other
elements, and any with a class, id or role, are subject to the count.

The templates of a host are bounded: a subtree must be in ``share`` of the host's
distinct pages, so there are at most 1 / share times a page's mean number of
subtrees. Copies of one page count once, or every page of a mirrored site would be
a template.

Defined results: a null html is an empty page and gives an empty text; so does one
without text; null urls form one host; repeated rows come back as often as they
occur; an empty table gives an empty result. Only the named columns are read.
"""
from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# Element names of the HTML standard by what they mean here.
DROPPED = {"script", "style", "noscript", "template", "head", "title", "nav", "header", "footer", "aside", "form",
           "button", "select", "option", "textarea", "input", "label", "fieldset", "iframe", "object", "embed", "svg",
           "canvas", "audio", "video", "menu", "dialog"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr"}
FLOW = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "blockquote", "pre", "table",
        "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "figure", "figcaption", "img", "br", "hr", "address",
        "details", "summary"} | INLINE
# An open element of the first kind is closed by a start tag of the second.
CLOSED_BY = {"p": {"p", "div", "ul", "ol", "dl", "table", "blockquote", "pre", "section", "article", "main", "aside",
                   "header", "footer", "nav", "form", "figure", "hr", "address", "fieldset", "details",
                   "h1", "h2", "h3", "h4", "h5", "h6"},
             "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
             "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
             "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "option": {"option"}, "head": {"body"}}
SCOPE = {"table", "ul", "ol", "dl", "article", "main", "section", "aside", "nav", "header", "footer", "body", "html", "div"}
# Words of class, id and role that name what isn't the article.
LABELS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner",
          "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar",
          "aside", "complementary", "contentinfo", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup",
          "modal", "newsletter", "subscribe", "signup", "login", "share", "sharing", "social", "related", "recommended",
          "comment", "comments", "disqus", "replies", "pagination", "pager", "search", "toolbar", "widget", "skip"}
COMMENTS = {"comment", "comments", "disqus", "replies"}
# Words that say no more than that a label's element is a box.
FRAME = {"area", "bar", "block", "box", "container", "list", "section", "thread", "wrap", "wrapper"}
CONTAINERS = {"ul", "ol", "li", "dl", "table"}  # of FLOW, those that a label can drop
LABEL_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")
SPACE = re.compile(r"\s+")


def _hash(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "replace"), 7) - (1 << 63)


NOTHING: frozenset = frozenset()


def _says(attrs, names: Sequence[str]) -> frozenset:
    """The words of LABELS in those whole labels that hold no others."""
    out: set[str] = set()
    for k, v in attrs:
        if k in names and v:
            for label in v.split():
                words = {w.lower() for w in LABEL_WORD.findall(label)}
                if words <= LABELS | FRAME:
                    out |= words & LABELS
    return frozenset(out)


class Node:
    __slots__ = ("tag", "label", "children", "hash", "counted", "holds", "says", "says_inside", "off", "size")

    def __init__(self, tag: str, label: str = "", says: frozenset = NOTHING, says_inside: frozenset = NOTHING, off: bool = False):
        self.tag, self.label, self.children, self.hash, self.counted, self.holds = tag, label, [], 0, False, False
        self.says, self.says_inside = says, says_inside  # label words by class, id and role; those that count inside an article
        self.off = off or tag in ("aside", "nav") or bool(says & COMMENTS)
        self.size = 0  # characters of text without what goes by its element


class Tree(HTMLParser):
    """A forgiving tree: paragraphs, items and cells close as the standard says, end
    tags without a start are passed over, and the end of the page closes the rest."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        depth = len(self.open) - 1
        while depth > 0:
            t = self.open[depth].tag
            if tag in CLOSED_BY.get(t, ()):
                del self.open[depth:]
                break
            if t in SCOPE:
                break
            depth -= 1
        says = _says(attrs, ("class", "id", "role"))
        node = Node(tag, " ".join(v for k, v in attrs if k in ("class", "id", "role") and v), says,
                    says and _says(attrs, ("class", "role")) | (says & COMMENTS), self.open[-1].off)
        self.open[-1].children.append(node)
        if tag in ("article", "main") and not node.off:
            for n in self.open:
                n.holds = True  # a label such as "with-sidebar" doesn't drop the content
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "path") and self.open[-1].tag == tag:
            self.open.pop()

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return
            if tag in INLINE and self.open[depth].tag not in INLINE:
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def dropped(node: Node) -> bool:
    return node.tag in DROPPED and (not node.holds or node.tag in ("aside", "nav"))


def sized(root: Node) -> None:
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if not isinstance(c, str)]
    for node in reversed(order):
        if not dropped(node):
            node.size = sum(len(c.strip()) if isinstance(c, str) else c.size for c in node.children)


def unwanted(node: Node, inside: bool, total: int) -> bool:
    """Whether it goes from a page of ``total`` characters; ``inside`` an article or main."""
    if dropped(node):
        return True
    if node.tag in FLOW and node.tag not in CONTAINERS or node.tag in ("html", "body", "main"):
        return False
    says = node.says_inside if inside else node.says
    if says & COMMENTS:  # often longer than the article
        return not node.holds and node.size < total
    return bool(says) and not node.holds and node.tag != "article" and 2 * node.size <= total


def prune(root: Node) -> list[Node]:
    """Drop what is unwanted; return the content roots: an iterative walk, as pages
    can nest deeper than Python's stack."""
    sized(root)
    # below an article; below an article or main
    todo, articles, mains, bodies = [(root, False, False)], [], [], []
    while todo:
        node, inside, text = todo.pop()
        text = text or node.tag in ("article", "main")
        keep = []
        for c in node.children:
            if isinstance(c, str):
                keep.append(c)
            elif not unwanted(c, text, root.size):
                keep.append(c)
        node.children = keep
        if node.tag == "article" and not inside:
            articles.append(node)
        elif node.tag == "main":
            mains.append(node)
        elif node.tag == "body":
            bodies.append(node)
        inside = inside or node.tag == "article"
        todo += [(c, inside, text) for c in reversed(keep) if not isinstance(c, str)]
    return articles or mains[:1] or bodies or [root]


def hashed(root: Node) -> None:
    """Hash of every subtree from its tag, label, text and children's hashes."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if not isinstance(c, str)]
    for node in reversed(order):
        parts = [SPACE.sub(" ", c).strip() if isinstance(c, str) else f"{c.hash:x}" for c in node.children]
        node.hash = _hash("\x1f".join([node.tag, node.label, *filter(None, parts)]))


def blocks(html: str | None) -> tuple[list[tuple[str, list[int]]], int]:
    """(text, hashes of the subtrees around it that may be templates) of every block
    in page order, and the hash of the page's content."""
    root = Tree(html or "").root
    tops = prune(root)
    plain_stays = tops[0].tag in ("article", "main")
    out: list[tuple[str, list[int]]] = []
    text: list[str] = []
    around: list[int] = []

    def end_block():
        if s := SPACE.sub(" ", "".join(text)).strip():
            out.append((s, list(around)))
        text.clear()
    for top in tops:
        hashed(top)
        todo: list = [(c, 0) for c in reversed(top.children)]
        while todo:
            item, kind = todo.pop()
            if isinstance(item, str):
                text.append(item)
            elif kind:  # the end of a block element
                end_block()
                if item.counted:
                    around.pop()
            elif item.tag == "br":
                text.append(" ")
            else:
                if item.tag not in INLINE:
                    item.counted = item.tag not in FLOW or bool(item.label) or not plain_stays
                    end_block()
                    if item.counted:
                        around.append(item.hash)
                    todo.append((item, 1))
                todo += [(c, 0) for c in reversed(item.children)]
        end_block()
    return out, _hash("\x1f".join(s for s, _ in out))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def main_text(pages: DataFrame, html: str = "html", url: str = "url", keep: Sequence[str] = ("page_id",),
              share: float = 0.2, min_pages: int = 5) -> DataFrame:
    """The ``keep`` columns, url and text. A subtree is a template if at least
    ``min_pages`` distinct pages of its host and ``share`` of them hold it."""
    carried = [c for c in keep if c.lower() not in ("text", url.lower())]
    parsed = written(
        pages.select(F.struct(F.col(url).alias("_url"), *[F.col(c) for c in carried]).alias("_in"),
                     host_of(F.col(url)).alias("_host"), _parser()(F.col(html)).alias("_p"))
        .select("_in", "_host", "_p.*"), "html-blocks")
    contents = parsed.select("_host", "page").distinct().groupBy("_host").agg(F.count("*").alias("_pages"))
    found = (parsed.select("_host", "page", F.explode(F.array_distinct(F.flatten("around"))).alias("subtree"))
             .distinct().groupBy("_host", "subtree").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_pages))
    templates = written(found.join(contents, "_host").where(F.col("_n") >= share * F.col("_pages"))
                        .groupBy("_host").agg(F.collect_set("subtree").alias("_templates")), "html-templates")
    marked = parsed.join(templates, "_host", "left")
    index = F.sequence(F.lit(0), F.size("blocks") - 1)
    stays = F.when(F.size("blocks") > 0, F.filter(index, lambda i: ~F.coalesce(
        F.arrays_overlap(F.get("around", i), F.col("_templates")), F.lit(False))))
    text = F.when(F.col("_templates").isNull(), F.array_join("blocks", " ")).otherwise(
        F.array_join(F.transform(stays, lambda i: F.get("blocks", i)), " "))
    return marked.select(*[F.col("_in")[c].alias(c) for c in carried], F.col("_in._url").alias(url),
                         F.coalesce(text, F.lit("")).alias("text"))


def _parser():
    @F.pandas_udf("blocks array<string>, around array<array<bigint>>, page bigint")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for htmls in batches:
            rows = []
            for h in htmls:
                found, page = blocks(h)
                rows.append(([s for s, _ in found], [a for _, a in found], page))
            yield pd.DataFrame(rows, columns=["blocks", "around", "page"], index=htmls.index)
    return parse
