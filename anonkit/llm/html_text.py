"""Main text of web pages by site style trees.

The elements of all pages of a host are merged by style path: the tags from the root down with their class,
id and role, where elements of equal style under one parent are one node. A node has a content entropy,
from how its whole text is shared by the host's pages, and a presentation entropy, from the orders of child
styles it appears with. Text that differs from page to page makes a node important, text that is the same
everywhere does not. Branches of low importance are removed from each page of the host, and so are elements
whose tag or names say that they are menus, page headers, footers, sidebars, notices, adverts, forms or comments.
A name is a whole class, role or id whose parts all say so or say nothing (``site-footer``, but not ``has-sidebar``
or ``related-work``); ids inside the main part are made from titles and say nothing. Names alone never remove the
body, the main part, an article or a heading, nor an element that holds the main part, an article or an h1, nor, on
pages without a marked main part, one with over half of the text.
If the page marks its article or main part, the text is taken from there. A branch of low importance goes
where the branch around it is important, and stays if it holds over half of what is left of the page, so
copies of one article on a host do not remove it.

Each page gives one row per style path, with hashes for text and child styles, so the merge is a plain
aggregation that combines on the map side; a host of any size is never in one task. A path that is on
``least_pages`` pages of its host is judged by them, whatever the size of the host. All others, those of small hosts
among them, are judged together over all hosts: such a path is unimportant where it is on ``least_pages`` pages of
them and shows the same there, as the boxes of site builders do. Hosts with up to ``LIST_PATHS`` paths to remove hand their
list to their pages; on other hosts the paths of each page are joined to those to remove, by host, path and salt,
and each page gets its own ones. Both ways give the same text.

Defined cases: null and empty html give empty text; pages without host form a host of their own, the empty
one; a path on fewer than ``least_pages`` pages of all such hosts stays; repeated rows count as pages each; markup
that is cut off or never closed is read as far as it goes; an empty table gives no rows; other columns have
no effect.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anonkit.llm.common import own_columns, pa_schema, salted_join, written
from anonkit.llm.url_filters import host_column

LEAST_PAGES = 10
LIST_PATHS = 2000
LEAST_IMPORTANCE = 0.3
CONTENT_WEIGHT = 0.9
DEPTH = 64  # of the style tree; what is nested deeper belongs to the node at this level

# Elements by their role in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
NOISE_TAGS = set(
    "head nav footer aside form script style noscript iframe template textarea button select option dialog menu svg canvas"
    " object title label input".split()
)
NOISE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent"
    " gdpr notice alert popup modal overlay newsletter subscribe signup social share sharing related recommended comments comment"
    " disqus replies reply respond sidebar menu nav navbar navigation breadcrumb breadcrumbs footer copyright pagination pager"
    " toolbar widget login search skip hidden navigation banner complementary contentinfo".split()
)
PAGE_HEADER_NAMES = set("header masthead topbar".split())
# Parts of names that say nothing by themselves.
NEUTRAL_NAMES = set(
    "area bar block bottom box col column container global group inner item items left link links list main outer page panel"
    " primary right row secondary section site slot top unit wrap wrapper".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
NEVER_BY_NAME = {"html", "body", "main", "article"} | HEADINGS
# An open element of the second kind is closed when one of the first kind starts.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
CLOSES_P = BLOCK - {"br", "body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "legend"}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)",
    re.S,
)
_STYLE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_NAME = re.compile(r"[^a-z]+")


@dataclass
class Element:
    tag: str
    has_path: bool
    noise: bool
    main: bool
    named: bool


@dataclass
class Block:
    """Text between two block boundaries, with the paths of all elements around it."""

    paths: list[str]
    noise: bool
    main: bool
    text: str
    named: tuple[int, ...]  # numbers of the elements around it whose names say noise


def _named(values: list[str], kinds: set[str]) -> bool:
    """Whether one of the whole names says one of ``kinds`` and nothing else."""
    for value in values:
        for name in value.split():
            parts = {p for p in _NAME.split(name) if len(p) > 1}
            if parts & kinds and parts <= kinds | NEUTRAL_NAMES:
                return True
    return False


def _style(tag: str, rest: str, inside_main: bool) -> tuple[str, bool, bool, bool]:
    """Style name; whether the tag says noise; whether it says main part; whether names say noise."""
    found = {}
    if "=" in rest:
        found = {k.lower(): v.strip("\"'").lower() for k, v in _STYLE.findall(rest)}
    main = tag in ("article", "main") or found.get("role") in ("main", "article")
    outside = not inside_main and not main
    noise = tag in NOISE_TAGS or (outside and tag == "header")
    kinds = NOISE_NAMES | PAGE_HEADER_NAMES if outside else NOISE_NAMES
    named = tag not in NEVER_BY_NAME and not main and _named([v for k, v in found.items() if k != "id" or not inside_main], kinds)
    shown = "".join(f"[{k}={' '.join(sorted(v.split()))}]" for k, v in sorted(found.items()) if k != "id" or not re.search(r"\d", v))
    return tag + shown, noise, main, named


class Page:
    """Blocks of one page, and the child styles of each path."""

    def __init__(self, source: str | None):
        self.blocks: list[Block] = []
        self.children: dict[str, list[str]] = {}
        self._stack: list[Element] = []
        self._paths: list[str] = []  # of the stack, as deep as the style tree goes
        self._open_tags: Counter[str] = Counter()
        self._noise = self._main = 0  # open elements of that kind
        self._named: list[int] = []  # open elements whose names say noise
        self._names = 0
        self._cleared: set[int] = set()  # those that hold what names cannot remove
        self._text: list[str] = []
        source = source or ""
        at = 0
        while at < len(source):
            found = _MARKUP.search(source, at)
            self._text.append(source[at : found.start() if found else len(source)])
            if not found:
                break
            at = found.end()
            tag = (found["tag"] or found["tag2"] or "").lower()
            if not tag:
                continue
            if found["end"] or found["end2"]:
                self._close(tag)
                continue
            rest = found["rest"] or found["rest2"] or ""
            self._open(tag, rest)
            if tag in RAW:
                closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
                at = closing.end() if closing else len(source)
                self._close(tag)
        self._flush()

    def _flush(self) -> None:
        if not self._text:
            return
        text = " ".join(references.unescape("".join(self._text)).split())
        self._text = []
        if text:
            self.blocks.append(Block(self._paths.copy(), self._noise > 0, self._main > 0, text, tuple(self._named)))

    def _open(self, tag: str, rest: str) -> None:
        if tag in BLOCK:
            self._flush()
        if tag in CLOSES_P:
            self._close("p")
        for kind in CLOSES.get(tag, ()):
            # only within the list or table that this element belongs to
            for element in reversed(self._stack if self._open_tags[kind] else ()):
                if element.tag == kind:
                    self._close(kind)
                    break
                if element.tag in ("ul", "ol", "dl", "table", "select"):
                    break
        if tag in VOID:
            return
        name, noise, main, named = _style(tag, rest, self._main > 0)
        if (main or tag == "h1") and not self._main and not self._noise:
            self._cleared.update(self._named)
        if tag in BLOCK or noise or main or named:
            if (noise or named) and tag not in BLOCK:
                self._flush()
            deep = len(self._paths) < DEPTH
            if deep:
                parent = self._paths[-1] if self._paths else ""
                order = self.children.setdefault(parent, [])
                if not order or order[-1] != name:
                    order.append(name)
                self._paths.append(f"{parent}>{name}")
            self._stack.append(Element(tag, deep, noise, main, named))
            self._open_tags[tag] += 1
            self._noise += noise
            self._main += main
            if named:
                self._names += 1
                self._named.append(self._names)

    def _close(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        if not self._open_tags[tag]:
            return
        self._flush()
        while True:
            element = self._stack.pop()
            self._open_tags[element.tag] -= 1
            self._noise -= element.noise
            self._main -= element.main
            if element.named:
                self._named.pop()
            if element.has_path:
                self._paths.pop()
            if element.tag == tag:
                return

    def branches(self) -> dict[str, tuple[str, str]]:
        """Whole text and child styles of each path."""
        texts: dict[str, list[str]] = {}
        for block in self.blocks:
            for path in dict.fromkeys(block.paths):
                texts.setdefault(path, []).append(block.text)
        return {p: ("\n".join(t), " ".join(self.children.get(p, ()))) for p, t in texts.items()}

    def main_text(self, unimportant: set[str]) -> str:
        kept = [b for b in self.blocks if not b.noise]
        cleared = self._cleared
        if not any(b.main for b in kept):
            held: Counter[int] = Counter()
            for block in kept:
                for number in block.named:
                    held[number] += len(block.text)
            most = sum(len(b.text) for b in kept) / 2
            cleared = cleared | {number for number, size in held.items() if size > most}
        kept = [b for b in kept if cleared.issuperset(b.named)]
        marked = [b for b in kept if b.main]
        kept = marked or kept
        if unimportant and kept:
            size: Counter[str] = Counter()
            for block in kept:
                for path in set(block.paths):
                    size[path] += len(block.text)
            half = sum(len(b.text) for b in kept) / 2

            def removed(paths: list[str]) -> bool:
                above = ""
                for path in paths:
                    if path in unimportant and size[path] <= half and above not in unimportant:
                        return True
                    above = path
                return False

            kept = [b for b in kept if not removed(b.paths)]
        return "\n".join(b.text for b in kept)


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def merged_paths(pages: DataFrame, host: str, html: str) -> DataFrame:
    """Per host, style path, text and child styles the number of pages, as a table: pages are parsed once for it."""
    schema = "host string, path bigint, content bigint, style bigint, n bigint"
    target = pa_schema(schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[tuple] = Counter()
            for host_, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                for path, (text, styles) in Page(source).branches().items():
                    found[host_, _hash(path), _hash(text), _hash(styles)] += 1
            columns = zip(*found, strict=True) if found else ([],) * 4
            arrays = [*columns, list(found.values())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(arrays, target, strict=True)], schema=target)

    rows = pages.select(F.col(host).alias("host"), F.col(html).alias("html")).mapInArrow(merge, schema)
    return written(rows.groupBy("host", "path", "content", "style").agg(F.sum("n").alias("n")), "paths")


def importance(merged: DataFrame, node: list[str]) -> DataFrame:
    """Per node of the tree: pages it is on, and its importance from 0 to 1.

    With a feature shared by k of a node's m pages, log(k) / log(m) is its entropy; content counts by one minus
    the mean of it, presentation by the entropy of the child orders, so both are high where pages differ.
    """
    # k log k is summed per feature, first over contents, then over styles
    weight = F.sum("n") * F.log(F.sum("n"))
    content = merged.groupBy(*node, "content").agg(F.sum("n").alias("n"), weight.alias("w"))
    content = content.groupBy(*node).agg(F.sum("n").alias("m"), F.sum("w").alias("content"))
    style = merged.groupBy(*node, "style").agg(weight.alias("w")).groupBy(*node).agg(F.sum("w").alias("style"))
    most = F.col("m") * F.log("m")
    value = (CONTENT_WEIGHT * (most - F.col("content")) + (1 - CONTENT_WEIGHT) * (most - F.col("style"))) / most
    return content.where("m > 1").join(style, node).select(*node, "m", value.alias("importance"))


def unimportant_paths(pages: DataFrame, host: str, html: str, *, least_pages: int, least_importance: float) -> DataFrame:
    """The host and hash of each path to remove, written as a table so that Spark knows its size."""
    merged = merged_paths(pages, host, html)
    enough, low = F.col("m") >= least_pages, F.col("importance") < least_importance
    node = ["host", "path"]
    judged = written(importance(merged, node).where(enough), "styletree")
    rare = salted_join(merged, judged.select(*node), node, "left_anti", ["content"])
    anywhere = importance(rare, ["path"]).where(enough & low).select("path")
    shared = salted_join(rare.select(*node).distinct(), anywhere, ["path"], "inner", ["host"])
    return written(judged.where(low).select(*node).union(shared.select(*node)), "unimportant")


def paths_of_pages(pages: DataFrame, low: DataFrame, host: str, html: str, digest: str) -> DataFrame:
    """Per host and digest of a page the hashes of its own paths that are in ``low``."""
    schema = "host string, digest string, path bigint"
    target = pa_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, str, int]] = []
            for host_, digest_, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found += [(host_, digest_, path) for path in {_hash(p) for block in Page(source).blocks for p in block.paths}]
            columns = zip(*found, strict=True) if found else ([],) * len(target)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    rows = pages.select(F.col(host).alias("host"), F.col(digest).alias("digest"), F.col(html).alias("html")).mapInArrow(work, schema)
    found = salted_join(rows, low, ["host", "path"], "inner", ["digest"])
    return found.groupBy("host", "digest").agg(F.collect_set("path").alias("paths"))


def extract(
    pages: DataFrame,
    *,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_pages: int = LEAST_PAGES,
    least_importance: float = LEAST_IMPORTANCE,
    list_paths: int = LIST_PATHS,
) -> DataFrame:
    """``key``, ``url``, main text, and its number of characters for every page."""
    own = own_columns(pages)
    host, paths, digest = own("host"), own("paths"), own("digest")
    rows = pages.select(key, url, F.col(html).alias("html"), host_column(F.col(url)).alias(host))
    low = unimportant_paths(rows, host, "html", least_pages=least_pages, least_importance=least_importance)
    counted = low.groupBy("host").agg(F.count("*").alias("n"))
    wide = written(counted.where(F.col("n") > list_paths).select("host"), "widehosts")
    short = low.join(wide, "host", "left_anti").groupBy("host").agg(F.collect_list("path").alias(paths))
    by_page = [F.col(key), F.col(url), F.col("html")]
    named = wide.withColumnRenamed("host", host)
    some = not wide.isEmpty()
    rest = salted_join(rows, named, [host], "left_anti", by_page) if some else rows
    joined = salted_join(rest, short.withColumnRenamed("host", host), [host], "left", by_page).select(key, url, "html", paths)
    if some:
        marked = salted_join(rows, named, [host], "left_semi", by_page).withColumn(digest, F.sha2("html", 256))
        lists = paths_of_pages(marked, low.join(wide, "host", "left_semi"), host, "html", digest)
        lists = lists.select(F.col("host").alias(host), F.col("digest").alias(digest), F.col("paths").alias(paths))
        joined = joined.union(salted_join(marked, lists, [host, digest], "left", by_page).select(key, url, "html", paths))

    @F.arrow_udf("string")
    def text_of(sources: pa.Array, removed: pa.Array) -> pa.Array:
        def one(source: str | None, hashes: list[int] | None) -> str:
            page = Page(source)
            low = set(hashes or ())
            unimportant = {p for p in {p for b in page.blocks for p in b.paths} if _hash(p) in low} if low else set()
            return page.main_text(unimportant)

        return pa.array([one(s, h) for s, h in zip(sources.to_pylist(), removed.to_pylist(), strict=True)], pa.string())

    found = joined.select(key, url, text_of("html", paths).alias("text"))
    return found.select(key, url, "text", F.char_length("text").cast("bigint").alias("n_chars"))
