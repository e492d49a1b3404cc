"""Main text of web pages by removing what a site repeats.

Every page is parsed once, into text blocks and a hash of every element's subtree. Spark counts beside how many
different contents of a host each subtree stands, told by the rest of the page's blocks without it; those that recur
beside many are the site's template, and blocks inside them are deleted, wherever they stand. Copies of one page have
one content, whatever their titles, so a repeated article is no template; running text inside an article and elements
around one never are. Blocks in elements that HTML or whole class names mark as no part of an article (menus, footers,
adverts, comments, ...) are deleted also where they occur once, but no mark holds for an element around the article.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import stored

# Element names by their role in HTML, and words of class names and ids.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
NEVER = frozenset(
    "nav footer aside form script style noscript template iframe svg button select textarea dialog menu head object "
    "canvas video audio map title".split()
)
ARTICLE = frozenset(("article", "main"))
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dl dt dd table tr td th thead tbody figure figcaption".split())
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
        "section table ul".split()
    ),
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr",)),
    "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "option": frozenset(("option",)),
}
# Whole class names and ids; the second pattern's are no marks inside an article, which has headers of its own.
MARKED = re.compile(
    r"(?:(?:site|page|main|global|post|top|bottom|left|right)[_-])?(?:ads?|adverts?|advertisements?|sponsor(?:ed|s)?|"
    r"banner|promos?|promotions?|cookies?|cookie-(?:notice|banner|consent)|consent|gdpr|popup|modal|nav|navbar|navigation|"
    r"menu|breadcrumbs?|sidebar|footer|masthead|comments?|replies|disqus|share|sharing|social|related|recommended|"
    r"recommendations|newsletter|subscribe|signup|login|search|pagination|pager|toc|skip|widget)",
    re.I,
)
MARKED_OUTSIDE = re.compile(r"(?:(?:site|page|main|global|top)[_-])?header|notice|alert|side|respond", re.I)

#: Elements nested deeper are text of their ancestors and no subtrees of their own, so that work stays linear.
DEEPEST = 128

_TAG = re.compile(r"""<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>)""")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class _Element:
    __slots__ = ("tag", "index", "parent", "mark", "article", "parts", "counted", "holds", "off")

    def __init__(self, tag: str, index: int, parent: _Element | None, mark: int, article: bool, counted: bool):
        self.tag, self.index, self.parent, self.mark, self.article, self.counted = tag, index, parent, mark, article, counted
        self.holds = self.off = False
        self.parts: list[str] = [tag]


#: How an element is marked as no part of an article: not, by class or id, or by its tag or an attribute of HTML.
NO_MARK, BY_NAME, BY_HTML = 0, 1, 2


def _mark(attributes: str, article: bool) -> int:
    """What class, id, role or style say of an element, inside an article or outside."""
    mark = NO_MARK
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            if any(MARKED.fullmatch(x) or not article and MARKED_OUTSIDE.fullmatch(x) for x in value.split()):
                mark = BY_NAME
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return BY_HTML
        if name == "role" and value.lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog"):
            return BY_HTML
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return BY_HTML
    return mark


class Page:
    """A parsed page: its unmarked blocks as ``kept``, (text, indices of the counted elements around it), those of them
    inside an article as ``blocks`` (all, if there is none), and ``hashes`` of counted elements.

    The parser is tolerant: tags left open are closed by what encloses them, stray end tags are ignored, and a ``<``
    that begins no tag is text. Work is linear in the page's length.
    """

    def __init__(self, source: str):
        self.hashes: dict[int, int] = {}
        self._all: list[tuple[_Element, str, list[int]]] = []
        self._elements = [_Element("", 0, None, NO_MARK, False, False)]
        self._stack = list(self._elements)
        self._open: Counter[str] = Counter()
        self._buffer: list[str] = []
        self._parse(source)
        while len(self._stack) > 1:
            self._close()
        self._flush()
        found = self._unmarked(BY_NAME) or self._unmarked(BY_HTML)  # names alone never empty a page
        self.kept = [(text, [i for i in around if i in self.hashes]) for _, text, around in found]
        inside = [top.article for top, _, _ in found]
        self.blocks = [block for block, article in zip(self.kept, inside, strict=True) if article or not any(inside)]

    def _unmarked(self, least: int) -> list[tuple[_Element, str, list[int]]]:
        """Blocks in no element with a mark of ``least`` or more; marks around the page's only articles do not hold."""

        def judge(around_articles: bool) -> None:
            for e in self._elements[1:]:  # parents come first
                e.off = e.parent.off or e.mark >= least and (around_articles or not e.holds)

        judge(True)
        if not any(e.tag in ARTICLE and not e.off for e in self._elements):
            judge(False)
        return [block for block in self._all if not block[0].off]

    def contents(self) -> dict[int, int]:
        """For every subtree around kept blocks a hash of the texts of all other kept blocks."""
        total, within = 0, Counter()
        for text, around in self.kept:
            digest = xxhash.xxh3_64_intdigest(text)
            total += digest
            within.update(dict.fromkeys((self.hashes[i] for i in around), digest))
        return {subtree: _signed(total - digest) for subtree, digest in within.items()} | {None: _signed(total)}

    def _parse(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            begin = source.find("<", at)
            if begin < 0:
                begin = size
            if begin > at:
                self._buffer.append(source[at:begin])
            if begin == size:
                return
            match = _TAG.match(source, begin)
            if not match:  # no tag: an unclosed quote in one, or a plain "<"
                close = source.find(">", begin)
                if close < 0:  # nothing closes from here on
                    self._buffer.append(source[begin:])
                    return
                tag_like = re.match(r"</?[a-zA-Z]", source[begin : begin + 3])
                if not tag_like:
                    self._buffer.append("<")
                at = close + 1 if tag_like else begin + 1
                continue
            comment, declaration, closing, name, attributes = match.groups()
            if comment:
                end = source.find("-->", begin + 4)
                at = size if end < 0 else end + 3
            elif declaration:
                end = source.find(">", begin)
                at = size if end < 0 else end + 1
            else:
                at = self._tag(source, closing, name.lower(), attributes, match.end())

    def _tag(self, source: str, closing: str, tag: str, attributes: str, at: int) -> int:
        if tag in INLINE:
            if tag in ("br", "img"):
                self._buffer.append(" ")
            return at
        self._flush()
        if closing:
            if self._open[tag]:
                while self._stack[-1].tag != tag:
                    self._close()
                self._close()
            return at
        while (closers := CLOSED_BY.get(self._stack[-1].tag)) and tag in closers:
            self._close()
        if tag in VOID:
            return at
        if tag in RAW:
            end = _RAW_END[tag].search(source, at)
            if not end:
                return len(source)
            return source.find(">", end.end()) + 1 or len(source)
        parent = self._stack[-1]
        article = parent.article or tag in ARTICLE
        mark = BY_HTML if tag in NEVER or tag == "header" and not parent.article else NO_MARK
        if not mark and tag not in ("body", "html"):
            mark = _mark(attributes, parent.article)
        # Running text of an article is never a template; without an article anything can be.
        counted = tag not in ("html", "body", *ARTICLE) and not (article and tag in RUNNING) and len(self._stack) < DEEPEST
        self._open[tag] += 1
        element = _Element(tag, len(self._elements), parent, mark, article, counted)
        self._elements.append(element)
        self._stack.append(element)
        if tag in ARTICLE:
            while element and not element.holds:
                element.holds = True
                element = element.parent
        return at

    def _close(self) -> None:
        self._flush()
        element = self._stack.pop()
        self._open[element.tag] -= 1
        digest = xxhash.xxh3_64_intdigest("\x1f".join(element.parts))
        self._stack[-1].parts.append(f"\x1e{digest:x}")
        if element.counted and not element.holds:
            self.hashes[element.index] = digest - (1 << 63)

    def _flush(self) -> None:
        if self._buffer:
            text = "".join(self._buffer)
            self._buffer = []
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                top = self._stack[-1]
                top.parts.append(text)
                self._all.append((top, text, [e.index for e in self._stack[:DEEPEST] if e.counted]))


def _signed(value: int) -> int:
    return (value + (1 << 63)) % (1 << 64) - (1 << 63)


BLOCKS = (
    "struct<content:bigint,subtrees:array<struct<subtree:bigint,content:bigint>>,"
    "blocks:array<struct<text:string,around:array<bigint>>>>"
)
_BLOCKS = pa.struct(
    [("content", pa.int64()), ("subtrees", pa.list_(pa.struct([("subtree", pa.int64()), ("content", pa.int64())]))),
     ("blocks", pa.list_(pa.struct([("text", pa.string()), ("around", pa.list_(pa.int64()))])))]
)


def parse(source: Column) -> Column:
    """A hash of the content, subtrees around blocks with a hash of the content without each, and blocks with the
    hashes of the subtrees around them."""

    @F.arrow_udf(BLOCKS)
    def parsed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for value in batch:
                page = Page(value.as_py() or "")
                blocks = [{"text": text, "around": [page.hashes[i] for i in around]} for text, around in page.kept]
                contents = page.contents()
                whole = contents.pop(None)
                subtrees = [{"subtree": subtree, "content": rest} for subtree, rest in sorted(contents.items())]
                rows.append({"content": whole, "subtrees": subtrees, "blocks": blocks})
            yield pa.array(rows, _BLOCKS)

    return parsed(source)


def host(url: Column) -> Column:
    """The host of a URL in lower case without a leading ``www.``; the empty string for none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?(?:www\.)?([^/?#:]*)", 1)), F.lit(""))


def extract(
    pages: DataFrame, *, url: str = "url", source: str = "html", out: str = "text", least: int = 3, share: float = 0.02, enough: int = 10
) -> DataFrame:
    """``pages`` with the main text in ``out``: blocks in page order, joined by line ends; empty if there are none.

    A subtree is template if it stands beside ``least`` different contents on its host, and these are ``share`` of the
    host's contents or ``enough`` by themselves, however large the host is. Null and empty pages give an empty text, a null URL is a host of its own. Repeated rows are extracted alike. A column
    named like ``out`` is replaced, ``source`` is dropped, other columns pass through.
    """
    kept = [c for c in pages.columns if c not in (out, source)]
    parsed = stored(
        pages.select(*kept, F.xxhash64(url, source).alias("__page"), host(F.col(url)).alias("__host"), parse(F.col(source)).alias("__parsed")),
        "pages",
    )
    sizes = parsed.select("__host", F.col("__parsed.content").alias("content")).groupBy("__host").agg(
        F.count_distinct("content").alias("pages")
    )
    seen = parsed.select("__host", F.inline("__parsed.subtrees"))
    counts = seen.groupBy("__host", "subtree").agg(F.count_distinct("content").alias("n")).filter(F.col("n") >= least)
    often = F.col("n") >= F.least(share * F.col("pages"), F.lit(float(enough)))
    template = counts.join(sizes, "__host").filter(often).select("__host", "subtree")
    # What recurs on a page is looked up for blocks that are left, so pages whose blocks are in no counted subtree are not shuffled.
    inside = parsed.select("__page", "__host", F.explode(F.array_distinct(F.flatten("__parsed.blocks.around"))).alias("subtree"))
    repeated = inside.distinct().join(template, ["__host", "subtree"]).groupBy(F.col("__page").alias("__of")).agg(
        F.collect_set("subtree").alias("__template")  # of one page
    )
    blocks = F.col("__parsed.blocks")
    enclosed = F.exists(blocks, lambda b: F.size(b["around"]) > 0)

    def text(blocks: Column) -> Column:
        return F.array_join(F.transform(blocks, lambda b: b["text"]), "\n").alias(out)

    met = parsed.filter(enclosed).join(repeated, F.col("__page") == F.col("__of"), "left")
    left = F.filter(blocks, lambda b: ~F.coalesce(F.arrays_overlap(b["around"], F.col("__template")), F.lit(False)))
    return parsed.filter(~enclosed).select(*kept, text(blocks)).unionByName(met.select(*kept, text(left)))
