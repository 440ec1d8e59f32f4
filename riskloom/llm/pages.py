"""Main text of web pages by tag-path ratios.

A page becomes blocks of text, each with its path of block elements from the
root. Per path the text length, the punctuation and the text inside links are
summed over the path's blocks; their ratios to the number of blocks are fused
into one score, smoothed with the score of the content root, the part of the page
where the text is, so that a short heading or a cell shares in the article it
stands in, however deep, and held against a share of the root's score. What an
element declares itself to be (navigation, advert, form, comments, hidden)
settles its paths without ratios.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import read

#: Share of the content root's score that a path's smoothed score must reach. Smoothing alone gives half of it, so this
#: asks a path itself for a fiftieth.
THRESHOLD = 0.51
#: The same for a path outside the content root, whose own ratios must do.
THRESHOLD_OUTSIDE = 0.5
#: A path is a menu, whatever its length, if links hold more than this share of its text.
LINK_SHARE = 0.5
#: The content root lies where this share of the page's score is: at article or main, or else above all that stands beside it as text.
ROOT_SHARE = 0.6
#: Share of the text in the page's frame (body and what only wraps it) that is a section of its own, not furniture.
SECTION_SHARE = 0.1
SMOOTHING = 0.5

_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)(?:((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)|([^>]*)(?:>|\Z)))", re.S
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：¿¡]")
_WORDS = re.compile(r"[a-z]+|\d+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _set(names: str) -> frozenset[str]:
    return frozenset(names.split())


#: HTML's void, raw-text and block elements, and the start tags that end an open element.
_VOID = _set("area base br col embed hr img input link meta param source track wbr")
_RAW = _set("script style textarea title noscript template iframe noembed noframes xmp svg annotation annotation-xml")
_FOREIGN = _set("svg annotation annotation-xml")
_BLOCK = _set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul caption option optgroup select button"
)
_HEADINGS = _set("h1 h2 h3 h4 h5 h6")
_PROSE = _HEADINGS | _set("p blockquote pre")
_CELLS = _set("li dt dd td th figcaption caption")
_TABLE = _set("table thead tbody tfoot tr ul ol dl")
_MAIN = _set("article main")
_KEEPS_P = _set("td th option optgroup tbody thead tfoot tr caption legend button select body html head")
_ENDS = {
    "li": (_set("li"), _set("ul ol menu dir")), "dt": (_set("dt dd"), _set("dl")), "dd": (_set("dt dd"), _set("dl")),
    "tr": (_set("tr td th"), _set("table")), "td": (_set("td th"), _set("tr table")), "th": (_set("td th"), _set("tr table")),
    "tbody": (_set("tbody thead tfoot tr td th caption"), _set("table")), "thead": (_set("caption"), _set("table")),
    "tfoot": (_set("tbody thead tr td th"), _set("table")), "option": (_set("option"), _set("select")),
}
_NOT_CONTENT = _set("nav footer aside button select option menu dialog head script style noscript template iframe svg object canvas audio video map input")
#: Words in class, id or role by which an element declares itself to be something else than the article.
_DECLARED = _set(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promoted promotion "
    "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toolbar sidebar aside rail complementary footer "
    "contentinfo masthead cookie cookies consent gdpr notice notices alert popup modal overlay paywall comment comments "
    "commentlist reply replies respond disqus discussion share sharing social related recommended recommendations "
    "newsletter subscribe subscription signup login search widget widgets tags skip hidden copyright legal teaser"
)
#: Such words that are as well the titles of sections, of which ids are often made, or say what a paragraph is about.
_TITLES = _set(
    "ad advertising alert alerts discussion legal login menu notice notices overlay promo promotion recommended recommendations "
    "related reply replies search share sharing signup skip social sponsor sponsors subscribe subscription tags teaser toolbar copyright"
)
#: Words that ids of furniture are filled up with.
_FILLING = _set("area block bottom box container content form inner left list main outer right section thread title top wrap wrapper")
#: A form is furniture unless its text outside labels and controls is this long, and this much longer per control.
FORM_TEXT, TEXT_PER_CONTROL = 500, 60
#: Words that also name headings of an article, so they count outside one only.
_OUTSIDE = _set("header topbar")
#: Words that say an element is only arranged around such things ("has-sidebar").
_AROUND = _set("has with no without layout")


def _declared(name: str, attributes: str, inside_article: bool) -> tuple[bool, str]:
    """Whether the attributes declare an element to be no content, and its label within a path.

    Ids are often made of headings: that of a heading, a paragraph or a section tells nothing by a word that may be a
    title, nor does any container's id inside an article; and an id tells only if all its words do. Headings and
    paragraphs of an article are told by unambiguous class names alone."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        return True, ""
    words = lambda *keys: set(_WORDS.findall(_CAMEL.sub("-", " ".join(found.get(k, "") for k in keys)).lower()))
    named, marked = words("class", "role"), words("id")
    prose = name in _PROSE or name in _CELLS
    if prose:
        marked = set()
    elif inside_article or name == "section":
        if marked & _TITLES or not marked <= _DECLARED | _OUTSIDE | _FILLING | {w for w in marked if w.isdigit()}:
            marked = set()
    if prose and inside_article:
        named -= _TITLES
    both = named | marked
    told = (both & _DECLARED or (both & _OUTSIDE and not inside_article)) and not both & _AROUND
    return bool(told), min(_WORDS.findall(found.get("class", "").lower()) or [""])


_FORM_EDGE = re.compile(r"<(?:/form|form)\b", re.I)
_CONTROL = re.compile(r"<(?:input|select|textarea|button)\b", re.I)
_NOT_TEXT = re.compile(r"<(script|style|select|textarea|button|label|option|a)\b.*?(?:</\1\b[^>]*>|\Z)|<[^>]*(?:>|\Z)", re.I | re.S)


def _is_furniture(page: str, at: int) -> bool:
    """Whether the form that starts before ``at`` has more to fill in than to read. Looked at up to where it, or the
    next one, has an edge, so that all forms of a page together are read once."""
    edge = _FORM_EDGE.search(page, at)
    inner = page[at : edge.start() if edge else len(page)]
    text = len(" ".join(_NOT_TEXT.sub(" ", inner).split()))
    return text < FORM_TEXT or text < TEXT_PER_CONTROL * len(_CONTROL.findall(inner))


class _Page:
    def __init__(self, trusting: bool):
        self.trusting = trusting
        self.stack: list[tuple[str, bool, int, bool]] = []  # name, declared no content, path, is a link
        self.paths: dict[tuple[int, str], int] = {}
        self.parents = [-1]
        self.names = [""]
        self.blocks: list[tuple[int, str, int]] = []
        self.parts: list[str] = []
        self.linked = self.skipped = self.links = self.articles = 0
        self.open: dict[str, list[int]] = {}  # places on the stack by name, the innermost last

    @property
    def path(self) -> int:
        return self.stack[-1][2] if self.stack else 0

    def text(self, raw: str) -> None:
        if not self.skipped and raw:
            text = html.unescape(raw) if "&" in raw else raw
            self.parts.append(text)
            if self.links:
                self.linked += len("".join(text.split()))

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append((self.path, text, self.linked))
            self.parts, self.linked = [], 0

    def _gone(self, entry: tuple[str, bool, int, bool]) -> None:
        self.open[entry[0]].pop()
        self.skipped -= entry[1]
        self.links -= entry[3]
        self.articles -= entry[0] in ("article", "main")

    def cut(self, size: int) -> None:
        """Close all elements beyond the first ``size``."""
        if any(e[0] in _BLOCK for e in self.stack[size:]):
            self.flush()
        while len(self.stack) > size:
            entry = self.stack.pop()
            if entry[0]:
                self._gone(entry)

    def _last(self, names: frozenset[str]) -> int:
        """Place of the innermost open element of these names, -1 if none is open."""
        return max((at[-1] for n in names if (at := self.open.get(n))), default=-1)

    def _end_open(self, ends: frozenset[str], within: frozenset[str]) -> None:
        boundary = self._last(within)
        while (k := self._last(ends)) > boundary:
            self.cut(k)

    def start(self, name: str, attributes: str, furniture: bool = False) -> None:
        block = name in _BLOCK
        if block:
            if name not in _KEEPS_P:
                self._end_open(frozenset("p"), _set("td th caption button object body html"))
            if name in _ENDS:
                self._end_open(*_ENDS[name])
            self.flush()
        if name in _VOID:
            if name in ("br", "hr"):
                self.text(" ")
            return
        told, label = _declared(name, attributes, self.articles > 0) if attributes.strip() else (False, "")
        told = told and self.trusting and name not in ("html", "body", "main", "article")
        told = told or furniture or name in _NOT_CONTENT or (name == "header" and not self.articles)
        path = self.path
        if block:
            path = self.paths.setdefault((self.path, f"{name}.{label}"), len(self.parents))
            if path == len(self.parents):
                self.parents.append(self.path)
                self.names.append(name)
        self.open.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, told, path, name == "a"))
        self.skipped += told
        self.links += name == "a"
        self.articles += name in ("article", "main")

    def end(self, name: str) -> None:
        if not self.open.get(name):
            return
        k = self.open[name][-1]
        if name in _BLOCK:
            self.cut(k)
            return
        # An inline element may end inside a block that began after it: its place stays, empty, until the top is reached.
        entry = self.stack[k]
        self._gone(entry)
        self.stack[k] = ("", False, entry[2], False)
        while self.stack and not self.stack[-1][0]:
            self.stack.pop()


def page_blocks(page: str, trusting: bool = True) -> tuple[list[tuple[int, str, int]], list[int], list[str]]:
    """(path, text, characters in links) of a page's undeclared blocks, in order, and the parent and the element of each
    path. Without trust in class names, only elements count as declarations."""
    at, built = 0, _Page(trusting)
    closes: dict[str, re.Pattern] = {}
    never: set[str] = set()
    while (m := _TAG.search(page, at)) is not None:
        built.text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            built.end(name)
        elif name in _RAW:
            if name in _FOREIGN and m[0].endswith("/>"):
                continue
            close = closes.setdefault(name, re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I)).search(page, at) if name not in never else None
            if close:
                at = close.end()
            elif name in _FOREIGN:  # without an end it is a stray tag, not the rest of the page
                never.add(name)
            else:
                at = len(page)
        else:
            furniture = name == "form" and not built.open.get("form") and _is_furniture(page, at)
            built.start(name, m[3] if m[3] is not None else m[4] or "", furniture)
    built.text(page[at:])
    built.cut(0)
    built.flush()
    return built.blocks, built.parents, built.names


def _root(parents: list[int], names: list[str], mass: list[float], own: list[int]) -> int:
    """The content root. On the way to an article or main that holds ROOT_SHARE of the page's score nothing else counts.
    Without one it is the last element that ROOT_SHARE leads to before unlinked text (``own``, per path) would be left
    beside it; in the page's frame only prose right there and sections of some size are such text."""
    n, plain, children = len(parents), own[:], {}
    leads = [names[p] in _MAIN and mass[p] >= ROOT_SHARE * mass[0] for p in range(n)]
    for p in range(n - 1, 0, -1):
        plain[parents[p]] += plain[p]
        leads[parents[p]] |= leads[p]
        children.setdefault(parents[p], []).append(p)
    root, frame = 0, True
    while names[root] not in _MAIN:
        best = max(reversed(children.get(root, [])), key=lambda p: (leads[p], mass[p]), default=None)
        if best is None or mass[best] < ROOT_SHARE * mass[0] or not (leads[best] or children.get(best)):
            break
        beside = [p for p in children[root] if p != best and plain[p]]
        if not leads[best]:
            stands = lambda p: not frame or (own[p] and names[p] in _PROSE) or plain[p] >= SECTION_SHARE * plain[root]
            if own[root] or any(map(stands, beside)):
                break
        root, frame = best, frame and (not beside or names[best] == "body")
    return root


def content(blocks: list[tuple[int, str, int]], parents: list[int], names: list[str]) -> list[str]:
    """Texts of the blocks whose path scores as content."""
    n = len(parents)
    size, linked, marks, count = [0] * n, [0] * n, [0] * n, [0] * n
    for path, text, links in blocks:
        size[path] += len(text)
        linked[path] += links
        marks[path] += len(_PUNCTUATION.findall(text))
        count[path] += 1
    # Fused ratios of a path: unlinked text per block, raised by punctuation per block.
    fused = [
        (size[p] - linked[p]) / count[p] * (1 + marks[p] / count[p]) ** 0.5 if count[p] else 0.0 for p in range(n)
    ]
    mass, text = [f * s for f, s in zip(fused, size, strict=True)], size[:]
    for p in range(n - 1, 0, -1):  # a parent's number is below its children's
        mass[parents[p]] += mass[p]
        text[parents[p]] += text[p]
    unlinked = [linked[p] <= LINK_SHARE * size[p] for p in range(n)]
    root = _root(parents, names, mass, [size[p] if unlinked[p] else 0 for p in range(n)])
    mean = lambda p: mass[p] / text[p] if text[p] else 0.0
    inside, score = [False] * n, [0.0] * n
    inside[root], score[root] = True, mean(root)
    for p in range(root + 1, n):
        if inside[parents[p]]:
            inside[p] = True
            score[p] = SMOOTHING * mean(p) + (1 - SMOOTHING) * score[root]
    # All text of an article stays, and prose, cells and tables of any content root; bare containers have to reach it.
    sure = lambda p: names[root] in _MAIN or names[p] in _PROSE or names[p] in _CELLS or names[p] in _TABLE
    reaches = lambda p: sure(p) or score[p] >= THRESHOLD * score[root] if inside[p] else mean(p) >= THRESHOLD_OUTSIDE * score[root]
    # A heading of the article stays also where it is a link, as titles often are.
    title = lambda p: inside[p] and names[root] in _MAIN and names[p] in _HEADINGS
    keep = [count[p] and reaches(p) and (unlinked[p] or title(p)) for p in range(n)]
    return [t for path, t, _ in blocks if keep[path]]


def main_text(page: str | None) -> str:
    """The article's blocks, one per line; empty if the page is null, empty or has none. Where class names declare a whole
    page to be something else ("page sidebar-left"), they are not believed."""
    if not page:
        return ""
    return "\n".join(content(*page_blocks(page)) or content(*page_blocks(page, trusting=False)))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars. A null or empty page has an empty text; repeated and null ids are
    pages like any other; other columns are ignored. Broken markup is read as far as it can be: unknown end tags are
    ignored, open elements end with the page."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([main_text(p) for p in b.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), texts], schema=schema)

    made = pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string")
    return made.withColumn("n_chars", F.length("text").cast("long"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article's text of every row of ``pages``, see :func:`extract` for nulls, repeated ids and broken markup."""
    return extract(read(spark, sf_dir, "pages"))
