"""HTML extraction by site style trees.

The pages of a host are merged into one tree. A node is a path of presentations
(tag, classes, id), with how often each sequence of children and each own text
occurs. Many different ones make a node important, the same ones everywhere make
it a part of the template:

    importance of a text, or of a sequence of children: its entropy to the base
    of the number of pages with the node, 1 at most;
    of a branch: the mean of its children's importance and of its own texts',
    and for a part ``OWN`` that of its sequences of children.

A page keeps what is important in its main content. That is its articles or, if
it has none, its ``main`` elements or else its body, without what its markup
declares to be something else (menus, headers outside articles, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments, hidden
parts). A branch of it goes if it is less important than ``LEAST``; importance is
only known of nodes on ``PAGES`` pages of a host or more, is 1 for all others, and
is not used if nothing would be left.

Entropies are sums over counts that are added up per task before they are
shuffled, so a host may have a third of all pages. What joins the pages is a
row per host with its nodes.

White space inside a block becomes one space, blocks are joined by line breaks;
a ``br`` is white space. Missing pages count as empty and have the empty text.
Pages without host are judged by their markup alone. Repeated rows are extracted
repeatedly (and counted so), other columns ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.llm.common import ship
from almoner.llm.dom import BLOCKS, RAW, Element, parse

LEAST, OWN, PAGES = 0.2, 0.2, 5

#: What isn't content, in natural order: tags, roles, and words of classes and ids.
NOISE_TAGS = RAW | frozenset("aside audio button canvas datalist dialog embed footer form head input map menu nav object picture select svg textarea video".split())
NOISE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
NOISE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo promoted related search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
HEADER_WORDS = frozenset({"header"})
COMMENT_WORDS = frozenset("comment comments disqus".split())
#: Words that say where a part stands or what shape it has, not what it is.
NEUTRAL_WORDS = frozenset(
    "area bar block bottom box container content global group inner item items left link links list main outer page panel "
    "post posts primary right row secondary section site top wrap wrapper".split()
)
#: Inside an article these tags may hold content.
IN_ARTICLE_TAGS = frozenset({"button", "dialog"})
#: Inside an article only these declare something else.
IN_ARTICLE_WORDS = COMMENT_WORDS | frozenset("ad ads advert advertisement adverts newsletter promo promoted related share sharing sponsor sponsored".split())
CONTENT = frozenset({"article", "main"})
WORDS = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")


def host_of(url: Column) -> Column:
    """The host's name in lower case; empty without one."""
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def presentation(element: Element) -> str:
    a = element.attributes
    return DIGITS.sub("0", f"{element.tag}.{' '.join(sorted(a.get('class', '').split()))}#{a.get('id', '')}")


def below(parent: int, element: Element) -> int:
    return xxhash.xxh3_64_intdigest(f"{parent:x}/{presentation(element)}".encode("utf-8", "surrogatepass"))


def holds_content(element: Element) -> bool:
    return any(e.tag in CONTENT or holds_content(e) for e in element.elements())


def names(element: Element) -> list[list[str]]:
    """The words of each of an element's classes, and of its id."""
    a = element.attributes
    return [WORDS.findall(c) for c in (*a.get("class", "").lower().split(), a.get("id", "").lower())]


def named(element: Element, words: frozenset) -> bool:
    """Whether a class or the id as a whole says one of ``words``: beside these it may
    have words of place and shape alone, so that ``main-nav`` does and ``has-sidebar``
    doesn't."""
    return any(set(found) & words and set(found) <= words | NEUTRAL_WORDS for found in names(element))


def declared_noise(element: Element, in_article: bool) -> bool:
    a = element.attributes
    if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower():
        return True
    if element.tag in NOISE_TAGS:
        return not (in_article and element.tag in IN_ARTICLE_TAGS)
    if element.tag in ("html", "body", "main"):
        return False
    if named(element, COMMENT_WORDS):  # also with articles in it, one for each comment
        return True
    if element.tag == "article":
        return False
    if in_article:
        return named(element, IN_ARTICLE_WORDS)
    told = a.get("role", "").lower() in NOISE_ROLES or element.tag == "header" or named(element, NOISE_WORDS | HEADER_WORDS)
    return told and not holds_content(element)


def cleaned(element: Element, in_article: bool = False) -> Element:
    """Without what the markup declares to be no content."""
    in_article = in_article or element.tag == "article"
    items = [x if isinstance(x, str) else cleaned(x, in_article) for x in element.items if isinstance(x, str) or not declared_noise(x, in_article)]
    return Element(element.tag, element.attributes, items)


def outermost(element: Element, tag: str) -> list[Element]:
    return [x for e in element.elements() for x in ([e] if e.tag == tag else outermost(e, tag))]


def main_content(page: Element) -> list[Element]:
    page = cleaned(page)
    for tag in ("article", "main", "body"):
        if found := [e for e in outermost(page, tag) if blocks([e])]:
            return found
    return [page]


def blocks(elements: list[Element]) -> list[str]:
    """The text of each block, in order."""
    done, begun = [], []

    def cut() -> None:
        if text := " ".join("".join(begun).split()):
            done.append(text)
        begun.clear()

    todo: list = list(reversed(elements))
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            begun.append(item)
        elif item is None:
            cut()
        elif item.tag == "br":
            begun.append(" ")
        elif item.tag in BLOCKS or item.tag == "#root":
            cut()
            todo.append(None)
            todo += reversed(item.items)
        else:
            todo += reversed(item.items)
    cut()
    return done


def own_text(element: Element) -> str:
    return " ".join("".join(x for x in element.items if isinstance(x, str)).split())


# --- the tree of a host ------------------------------------------------------


def nodes(content: list[Element]):
    """Every element's path, sequence of children and own text."""
    todo = [(0, e) for e in content]
    while todo:
        parent, element = todo.pop()
        path = below(parent, element)
        yield path, " ".join(presentation(e) for e in element.elements()), own_text(element)
        todo += [(path, e) for e in element.elements()]


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def node_counts(pages: DataFrame) -> DataFrame:
    """Rows ``(host, path, kind, value, n)``, added up within each batch.

    ``kind`` is ``p`` for the pages with a node, ``s`` for its sequences of
    children, ``t`` for its texts.
    """

    def run(batches):
        for batch in batches:
            for part in range(0, batch.num_rows, 2000):
                rows, counts = batch.slice(part, 2000), Counter()
                for host, source in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    seen = set()
                    for path, children, text in nodes(main_content(parse(source or ""))):
                        path = signed(path)
                        if path not in seen:
                            seen.add(path)
                            counts[host, path, "p", 0] += 1
                        for kind, value in (("s", children), ("t", text)):
                            if value:
                                counts[host, path, kind, signed(xxhash.xxh3_64_intdigest(value.encode("utf-8", "surrogatepass")))] += 1
                columns = list(zip(*counts)) or [[], [], [], []]
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds)), pa.array(counts.values(), pa.int64())], names=["host", "path", "kind", "value", "n"])

    rows = pages.select(host_of(pages["url"]).alias("host"), pages["html"].cast("string")).filter("host <> ''")
    return rows.mapInArrow(run, "host string, path long, kind string, value long, n long")


def importance(pages: DataFrame, least_pages: int = PAGES) -> DataFrame:
    """Per host its known nodes: path, importance of texts and of sequences of children."""
    counts = node_counts(pages).groupBy("host", "path", "kind", "value").agg(F.sum("n").alias("n"))
    n = F.col("n").cast("double")

    def of(kind: str, value) -> Column:
        return F.sum(F.when(F.col("kind") == kind, value))

    def entropy(kind: str) -> Column:
        total, m = F.col(f"{kind}_n"), F.col("m")
        bits = (F.log(total) - F.col(f"{kind}_log") / total) / F.log(m)
        return F.when(total > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), bits)))

    sums = counts.groupBy("host", "path").agg(
        of("p", n).alias("m"),
        *[of(k, n).alias(f"{k}_n") for k in "st"],
        *[of(k, n * F.log(n)).alias(f"{k}_log") for k in "st"],
    )
    known = sums.filter(F.col("m") >= least_pages).select("host", F.struct("path", entropy("t").alias("texts"), entropy("s").alias("children")).alias("node"))
    return known.groupBy("host").agg(F.collect_list("node").alias("nodes"))


# --- extraction --------------------------------------------------------------


def weighed(element: Element, parent: int, known: dict[int, tuple[float | None, float | None]]) -> tuple[float, Element]:
    """A branch's importance, and the branch without unimportant ones."""
    path = below(parent, element)
    texts, children = known.get(signed(path), (None, None))
    parts, items = [], []
    for x in element.items:
        if isinstance(x, str):
            items.append(x)
        else:
            weight, kept = weighed(x, path, known)
            parts.append(weight)
            if weight >= LEAST:
                items.append(kept)
            elif x.tag in BLOCKS:
                items.append(Element("hr"))  # what stands around it stays apart
    if own_text(element):
        parts.append(1.0 if texts is None else texts)
    inner = sum(parts) / len(parts) if parts else 1.0
    if element.elements():
        inner = (1 - OWN) * inner + OWN * (1.0 if children is None else children)
    return inner, Element(element.tag, element.attributes, items)


def extract(source: str, known: dict[int, tuple[float | None, float | None]]) -> str:
    content = main_content(parse(source))
    if known:
        kept = [e for weight, e in (weighed(e, 0, known) for e in content) if weight >= LEAST]
        if text := "\n".join(blocks(kept)):
            return text
    return "\n".join(blocks(content))


def extracted(pages: DataFrame) -> DataFrame:
    """Per page its url and the main text."""
    ship(pages.sparkSession)
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html"), host_of(pages["url"]).alias("h"))
    joined = rows.join(importance(pages), F.col("h") == F.col("host"), "left").select("page_id", "url", "html", "nodes")

    def run(batches):
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                cut = batch.slice(part, 500)
                texts = []
                for source, found in zip(cut.column(2).to_pylist(), cut.column(3).to_pylist()):
                    known = {n["path"]: (n["texts"], n["children"]) for n in found or ()}
                    texts.append(extract(source or "", known))
                yield pa.RecordBatch.from_arrays([cut.column(0), cut.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
