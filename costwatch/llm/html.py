"""HTML extraction: site template removal by subtrees that recur on a host's pages.

Every element of a page has a hash of its subtree (tag, text, children). Spark counts, per host, on
how many different articles a subtree stands; those on at least `LEAST_PAGES` of them and on a
share of `LEAST_SHARE` of the host's articles belong to the site's template and are deleted with
all that is in them. A page's article is its `article` or `main` element, else the whole body;
pages with equal articles count once, so copies of an article do not make it a template. Elements
that no article contains by their kind (scripts, forms, navigation, adverts, comments) are deleted
by tag, role, class and id. A class, an id or a form alone decides nothing about an element that
holds most of the page's text, or the page's articles where none stands outside such elements; the
count decides about these. On pages without an article element, paragraphs, headings, lists' items
and quotes count by the longest other text of the page, and this must differ on half of the pages
on which they stand: so near copies of a text do not make its paragraphs a template.

Inside an `article` or `main` element authors repeat lines. Elements there are template if they hold
a small part of its text; paragraphs, headings, lists' items and quotes only if they stand among the
first `EDGE` or the last `EDGE` of them on a share of `MOST_SHARE` of the host's different articles.
For these, articles that are equal in the longest of their other paragraphs count once, so near
copies of an article do not make its paragraphs a template. A class or an id says something there
only if it is made of such names alone, on an element that is no paragraph or the like, and the
count decides: elements of that tag and these names must stand in `LEAST_PAGES` different articles
of the host and a share of `LEAST_SHARE` of them. Only for hosts of fewer articles the names decide.

Null and empty pages give an empty text. A null url is a host of its own. Equal rows get equal
texts. An empty table gives an empty one. Unclosed, misnested and cut-off markup is read as far as
it goes: a paragraph ends at the next block, a raw text element at the end of the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costwatch.staging import stage

LEAST_PAGES = 5
LEAST_SHARE = 0.02
MOST_SHARE = 0.6
EDGE = 3
MOST_OF_ARTICLE = 0.3
OTHERS_SHARE = 0.5
COUNTED = 1  # in a host's template: the host has articles enough to judge by names in them

# Elements and names by their meaning in HTML and by common usage.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes textarea title".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
NEVER = set(
    "head script style noscript template iframe object embed applet svg math canvas audio video map nav "
    "menu footer aside form button select option input textarea label dialog search noembed "
    "noframes title".split()
)
ARTICLE = {"article", "main"}
AUTHORED = set("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre tr td th article main body html".split())
CLOSED_BY_BLOCK = {"p"}
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
STOPS = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
    "th": {"tr", "table"}, "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"},
}
NAMES = set(
    "ad ads adv advert adverts advertisement advertisements adsense sponsor sponsored promo promotion "
    "banner sidebar nav navbar navigation menu breadcrumb breadcrumbs pagination pager footer masthead "
    "topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login paywall share sharing social comment comments commentlist "
    "disqus respond reply replies related recommended trending widget widgets skip hidden".split()
)
NAMES_OUTSIDE = {"header"}  # inside an article a header holds its title
ROLES = set("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW}
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Element:
    tag: str
    parent: int
    dropped: bool
    article: int = -1  # the article or main element that this one is in
    parts: list = field(default_factory=list)  # texts, and numbers of child elements
    digest: int = 0
    size: int = 0  # characters of text below
    doubtful: bool = False  # dropped by name, unless the page's text is in it
    named: int = 0  # in an article: hash of the tag and the names that make it doubtful


def unwanted(tag: str, attributes: str, inside: bool) -> tuple[bool, bool, int]:
    """Whether an element is no part of an article by its kind; whether its name or form says so.

    Inside an article, the last value is a hash of the tag and its names, if these say so.
    """
    if (tag in NEVER and tag != "form") or (tag == "header" and not inside):
        return True, False, 0
    doubtful = tag == "form"
    if not attributes or attributes.isspace() or tag in ("body", "html"):
        return False, doubtful, 0
    named: list[str] = []
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            if inside:
                if tag not in AUTHORED | ARTICLE:
                    named += whole_names(value)
            elif tag not in ARTICLE and set(re.split(r"[^a-z]+", value.lower())) & (NAMES | NAMES_OUTSIDE):
                doubtful = True
        elif name == "role" and value.lower() in ROLES:
            if value.lower() != "form":
                return True, False, 0
            doubtful = True
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, False, 0
        elif name == "style" and HIDDEN.search(value):
            return True, False, 0
    if named and not doubtful:
        return False, True, xxhash.xxh64_intdigest(" ".join(["named", tag, *sorted(set(named))]))
    return False, doubtful, 0


def whole_names(value: str) -> list[str]:
    """Those of the classes or ids in an attribute that are made of names alone, without numbers."""
    tokens = ([part for part in re.split(r"[^a-z]+", token) if part] for token in value.lower().split())
    return ["-".join(parts) for parts in tokens if parts and NAMES.issuperset(parts)]


def parse(page: str, template: frozenset | set = frozenset()) -> list[Element]:
    """Elements in page order; the first is the page itself."""
    elements = [Element("#page", -1, False)]
    stack = [0]

    def close(wanted: set[str], stops: set[str] = frozenset()) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            tag = elements[stack[depth]].tag
            if tag in wanted:
                del stack[depth:]
                return
            if tag in stops:
                return

    at = 0
    while True:
        found = TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            elements[stack[-1]].parts.append(html.unescape(text))
        if not found:
            settle(elements, template)
            return elements
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag = tag.lower()
        closing, attributes = (found[1], found[3]) if found[2] else (found[4], found[6])
        if closing:
            if tag in ("p", "br"):
                elements[stack[-1]].parts.append("\n") if tag == "br" else close({"p"}, BLOCK - {"p"})
            else:
                close({tag}, ARTICLE if tag not in ARTICLE | {"body", "html"} else frozenset())
            continue
        if tag == "br":
            elements[stack[-1]].parts.append("\n")
            continue
        if tag in BLOCK:
            close({"p"}, BLOCK - {"p"})
        if tag in CLOSES:
            while True:
                before = len(stack)
                close(CLOSES[tag], STOPS[tag])
                if len(stack) == before:
                    break
        parent = elements[stack[-1]]
        inside = parent.article >= 0
        number = len(elements)
        never, doubtful, named = unwanted(tag, attributes, inside)
        element = Element(
            tag, stack[-1], parent.dropped or never, parent.article, doubtful=doubtful, named=named
        )
        if tag in ARTICLE and not inside and not element.dropped:
            element.article = number
        elements.append(element)
        parent.parts.append(number)
        if tag in VOID:
            continue
        if tag in RAW:
            end = RAW_END[tag].search(page, at)
            stop = end.start() if end else len(page)
            element.parts.append(page[at:stop])
            at = stop
        if not attributes.endswith("/") or tag in BLOCK or tag in RAW:
            stack.append(number)


def settle(elements: list[Element], template: frozenset | set = frozenset()) -> None:
    """Drops doubtful elements, but for those in which the page's text or its articles lie.

    Where the host has been counted, names inside articles tell only what recurs there.
    """
    if COUNTED in template:
        for element in elements:
            if element.named and element.named not in template:
                element.doubtful = False
    if not any(e.doubtful for e in elements):
        return
    sizes, depths = [0] * len(elements), [0] * len(elements)
    for number, element in enumerate(elements):
        if element.parent >= 0:
            depths[number] = depths[element.parent] + element.doubtful
    for number in range(len(elements) - 1, -1, -1):
        element = elements[number]
        if not element.dropped:
            sizes[number] += sum(len(part.strip()) for part in element.parts if isinstance(part, str))
            if number:
                sizes[element.parent] += sizes[number]
    articles = [i for i, e in enumerate(elements) if e.article == i and sizes[i]]
    # Articles below the fewest doubtful elements are the page's: others can be teasers or comments.
    fewest = min((depths[i] for i in articles), default=0)
    around: set[int] = set()
    for number in articles:
        above = elements[number].parent if depths[number] == fewest else -1
        while above >= 0 and above not in around:
            around.add(above)
            above = elements[above].parent
    for number, element in enumerate(elements):
        if number and elements[element.parent].dropped:
            element.dropped = True
        elif element.doubtful and number not in around:
            element.dropped |= 2 * sizes[number] <= sizes[0]
        if element.dropped:
            element.article = -1


def digests(elements: list[Element]) -> None:
    """Hash and text size of every subtree, children before parents."""
    for number in range(len(elements) - 1, -1, -1):
        element = elements[number]
        if element.dropped:
            continue
        state = xxhash.xxh64(element.tag)
        for part in element.parts:
            if isinstance(part, int):
                child = elements[part]
                if not child.dropped:
                    state.update(child.digest.to_bytes(8, "little"))
                    element.size += child.size
            elif words := " ".join(part.split()):
                state.update("\x00" + words)
                element.size += len(words)
        element.digest = state.intdigest()


def may_recur(element: Element, elements: list[Element]) -> bool:
    """Whether the element can be a part of a template."""
    if element.dropped or not element.size or element.tag not in BLOCK or element.parent < 0:
        return False
    if element.article < 0:
        return element.tag not in ("body", "html")
    return element.tag not in AUTHORED and element.size <= MOST_OF_ARTICLE * elements[element.article].size


def edges(elements: list[Element]) -> Iterator[tuple[int, int, int]]:
    """Paragraphs at an end of their article: number, key of subtree and end, longest other paragraph."""
    articles: dict[int, list[int]] = {}
    below: set[int] = set()
    for number, element in enumerate(elements):
        if element.parent in below:
            below.add(number)
        elif element.article >= 0 and element.size and element.tag in AUTHORED - ARTICLE - {"body", "html"}:
            below.add(number)
            articles.setdefault(element.article, []).append(number)
    for numbers in articles.values():
        longest = sorted(numbers, key=lambda i: -elements[i].size)[:2]
        for end, some in ((b"first", numbers[:EDGE]), (b"last", numbers[-EDGE:])):
            for i in some:
                other = next((elements[j].digest for j in longest if j != i), 0)
                yield i, xxhash.xxh64_intdigest(end + elements[i].digest.to_bytes(8, "little")), other


def strict(element: Element) -> bool:
    """Whether the element recurs by the longest other texts of its pages, not by the pages."""
    return element.article < 0 and element.tag in AUTHORED


def strict_key(element: Element) -> int:
    return xxhash.xxh64_intdigest(b"strict" + element.digest.to_bytes(8, "little"))


def longest_others(elements: list[Element]) -> Iterator[tuple[int, int]]:
    """Key of every strict element that may recur, and a hash of the page's longest text outside it."""
    numbers = [i for i, e in enumerate(elements) if strict(e) and may_recur(e, elements)]
    if not numbers:
        return
    own = [
        "" if e.dropped else " ".join(" ".join(p for p in e.parts if isinstance(p, str)).split())
        for e in elements
    ]
    # Elements below another one follow it at once, so they end where the next one begins.
    n = len(elements)
    end = list(range(1, n + 1))
    before, after = [""] * (n + 1), [""] * (n + 1)
    for i in range(n):
        before[i + 1] = max(before[i], own[i], key=len)
    for i in range(n - 1, -1, -1):
        after[i] = max(own[i], after[i + 1], key=len)
        if i:
            end[elements[i].parent] = max(end[elements[i].parent], end[i])
    for i in numbers:
        other = max(before[i], after[end[i]], key=len)
        yield strict_key(elements[i]), xxhash.xxh64_intdigest(other)


def blocks(elements: list[Element], template: frozenset | set = frozenset()) -> list[str]:
    """Texts of the blocks of the article in page order."""
    ending = {i for i, key, _ in edges(elements) if key in template} if template else ()
    whole = all(e.article < 0 or e.dropped for e in elements)
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            out.append(text)

    # An explicit stack, as markup can be nested deeper than Python's calls: number, next part.
    todo = [(0, 0)]
    while todo:
        number, at = todo.pop()
        element = elements[number]
        if at == 0:
            gone = element.dropped or number in ending or (
                template
                and (strict_key(element) if strict(element) else element.digest) in template
                and may_recur(element, elements)
            )
            if element.tag in BLOCK:
                flush()
            if gone:
                continue
        shown = whole or element.article >= 0
        while at < len(element.parts):
            part = element.parts[at]
            at += 1
            if isinstance(part, int):
                todo.append((number, at))
                todo.append((part, 0))
                break
            if shown:
                run.append(part)
        else:
            if element.tag in BLOCK:
                flush()
    flush()
    return out


def _host(url: str | None) -> str | None:
    found = re.match(r"\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else None


def host_key(url: str | None) -> int:
    return _signed(xxhash.xxh64_intdigest(_host(url) or ""))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def page_subtrees(pages: DataFrame) -> DataFrame:
    """host, article (hash), subtree (a key; null once per page), ending, page: distinct per page.

    For paragraphs at an end of their article (`ending`), article is the longest other one. For
    strict elements it is the longest other text, and the page's hash in further rows (`page`).
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, int | None, bool, bool]] = []
            for url, page in zip(batch.column(0), batch.column(1), strict=True):
                elements = parse(page.as_py() or "")
                digests(elements)
                host = host_key(url.as_py())
                roots = sorted(e.digest for i, e in enumerate(elements) if e.article == i)
                article = _signed(xxhash.xxh64_intdigest(str(roots or elements[0].digest)))
                found = {e.digest for e in elements if may_recur(e, elements) and not strict(e)}
                named = {e.named for e in elements if e.named and e.dropped}
                found |= named | {COUNTED} if named else set()
                rows.append((host, article, None, False, False))
                rows += [(host, article, _signed(x), False, False) for x in found]
                rows += [(host, _signed(y), _signed(x), True, False) for x, y in {(k, o) for _, k, o in edges(elements)}]
                others = set(longest_others(elements))
                rows += [(host, _signed(y), _signed(x), False, False) for x, y in others]
                rows += [(host, article, _signed(x), False, True) for x in {x for x, _ in others}]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64()] * 3 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["host", "article", "subtree", "ending", "page"],
            )

    schema = "host long, article long, subtree long, ending boolean, page boolean"
    return pages.select("url", "html").mapInArrow(scan, schema)


def templates(pages: DataFrame) -> DataFrame:
    """host and its recurring subtrees. A host has at most (subtrees a page) / LEAST_SHARE of them."""
    counted = F.col("subtree") == COUNTED
    # Written, as both sides of the join below read it: pages are counted in one pass.
    counts = stage(
        page_subtrees(pages)
        .distinct()
        .groupBy("host", "subtree", "ending")
        .agg(F.count_if(~F.col("page")).alias("n"), F.count_if("page").alias("pages"))
        .filter(F.col("subtree").isNull() | (F.col("n") >= LEAST_PAGES) | counted),
        "subtree_counts",
    )
    total = counts.filter("subtree is null").select(F.col("host"), F.col("n").alias("articles"))
    share = F.when(F.col("ending"), MOST_SHARE).otherwise(LEAST_SHARE)
    often = F.greatest(F.lit(LEAST_PAGES), F.col("articles") * share, F.col("pages") * OTHERS_SHARE)
    return (
        counts.filter(F.col("subtree").isNotNull())
        .join(total, "host")
        .filter(F.when(counted, F.col("articles") >= LEAST_PAGES).otherwise(F.col("n") >= often))
        .groupBy("host")
        .agg(F.collect_list("subtree").alias("subtrees"))
    )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, frozenset] = {}
        for batch in batches:
            texts = []
            for page, host, subtrees in zip(*map(batch.column, (2, 3, 4)), strict=True):
                key = host.as_py()
                if key not in known:
                    if len(known) > 256:
                        known.clear()
                    known[key] = frozenset(x & (1 << 64) - 1 for x in subtrees.as_py() or ())
                elements = parse(page.as_py() or "", known[key])
                digests(elements)
                texts.append("\n".join(blocks(elements, known[key])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    @F.pandas_udf("long")
    def hosts(urls):
        return urls.map(host_key)

    keyed = pages.select("page_id", "url", "html").withColumn("host", hosts("url"))
    # Written first: of known size it is broadcast where it is small, and pages are not shuffled.
    known_sites = stage(templates(pages), "site_templates")
    joined = keyed.join(known_sites, "host", "left").select("page_id", "url", "html", "host", "subtrees")
    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(read, f"page_id {kind}, url string, text string, n_chars long")
