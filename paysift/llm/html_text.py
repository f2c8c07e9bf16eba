"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of tags and words. A word scores between 0 and 1: how often
words directly in such an element belong to the article. A tag scores below
zero: the more so, the more often it lies outside of articles. Both weights come
from labelled pages (those whose article is marked by <article> or <main>), with
prior counts for elements that they don't show. One linear scan finds the
contiguous region with the largest sum. The region is then fitted to the page's
tree: it grows to the smallest element that holds it (the article around it, if
there is one), and blocks of boilerplate elements inside are left out.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysift.llm.sampling import in_share

#: Bounds of the model: labelled pages (expected) and element kinds.
SAMPLE_PAGES, MAX_KINDS = 1_000, 5_000
#: A prior's weight, in tags or words.
PRIOR = 4.0
#: What any tag costs at least.
TAG_COST = 0.05

#: Elements by their role.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
BOILERPLATE = frozenset("head nav footer aside form menu button select option input label fieldset dialog".split())
RAW = "script style noscript template iframe textarea svg canvas object"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset(("article", "main"))
_CONTAINERS = frozenset("article main section div td body html".split())
#: Class, id and role names that mark boilerplate, whole but for a place or a part's name around them ("left-sidebar",
#: "cookie-notice"); names that tell a state or a layout ("has-sidebar", "no-sidebar", "share-enabled") don't.
_STATES = re.compile(r"(?:^|[_-])(?:has|no|not|with|without|is|hide|show|enabled?|disabled?|open|closed|active|layout)(?:$|[_-])", re.IGNORECASE)
#: A marked wrapper or form with more than this share of the page's words may be the page itself; it is, if it has the
#: title or <main>, or if what else is shown has less than the second share of its words.
MOST_WORDS, FEW_WORDS = 0.5, 0.1
_MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|cookies?|consent|gdpr|notices?|popup|modal|overlay|sidebar|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|site-header|page-header"
    r"|comments?|commentlist|disqus|repl(?:y|ies)|respond|share|sharing|social|related|recommended|promo\w*|sponsor\w*|newsletter|subscri\w+|signup|login|search|widget|toolbar|pagination|pager"
    r"|complementary|contentinfo)(?:$|[\s_-])",
    re.IGNORECASE,
)
_TOKEN = re.compile(
    rf"(?P<comment><!--.*?(?:-->|\Z))|<(?P<raw>{RAW.replace(' ', '|')})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*)>|(?P<other><[!?/][^>]*>)|(?P<text>[^<]+|<)""",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none""", re.IGNORECASE)


class Element:
    __slots__ = ("name", "kind", "parent", "junk", "depth", "own", "wraps", "hidden")

    def __init__(self, name: str, rest: str, parent: Element | None):
        marks = " ".join(m[2].strip("\"'") for m in _ATTRIBUTE.finditer(rest)) if "=" in rest else ""
        self.name, self.parent, self.depth = name, parent, 0 if parent is None else parent.depth + 1
        marked = bool(marks) and name not in ARTICLE and name not in ("html", "body") and any(_MARKS.search(m) and not _STATES.search(m) for m in marks.split())
        own = name in BOILERPLATE or marked or bool(rest and _HIDDEN.search(rest))
        if name == "header":  # a page's header; an article's own may hold its title
            own = own or not any(e.name in ARTICLE for e in (parent.path() if parent else ()))
        self.hidden = bool(rest and _HIDDEN.search(rest)) or (parent is not None and parent.hidden)
        self.own, self.wraps = own, own and not self.hidden and (marked or name == "form")
        self.junk = own or (parent is not None and parent.junk)
        self.kind = f"{name}.{marks.split()[0].lower()}" if marks.split() else name

    def path(self) -> Iterator[Element]:
        e: Element | None = self
        while e is not None:
            yield e
            e = e.parent


def tokens(page: str) -> Iterator[tuple[str, Element | None, str]]:
    """('open' | 'close' | 'text' | 'break', element, text) of a page, in order.

    Elements that a page leaves open end with the element around them, a
    paragraph or list item also with the next block.
    """
    top: Element | None = None
    for m in _TOKEN.finditer(page):
        kind = m.lastgroup
        if m["text"] is not None:
            yield "text", top, m["text"]
        elif m["name"] is not None:
            name = m["name"].lower()
            if m["close"]:
                if top is not None and any(e.name == name for e in top.path()):
                    while top.name != name:
                        yield "close", top, ""
                        top = top.parent
                    yield "close", top, ""
                    top = top.parent
                elif name in BLOCK:
                    yield "break", top, ""
            elif name in VOID:
                if name == "br":
                    yield "text", top, " "
                elif name in BLOCK:
                    yield "break", top, ""
            else:
                if name in BLOCK:
                    ends = ("li",) if name == "li" else ("dt", "dd") if name in ("dt", "dd") else ("p",)
                    limit = ("ul", "ol", "dl", "td", "th", "table", "div", "article", "section", "body") if ends != ("p",) else ("td", "th", "button")
                    found = None
                    for e in top.path() if top is not None else ():
                        if e.name in limit:
                            break
                        if e.name in ends:
                            found = e
                            break
                    while found is not None and top is not found.parent:
                        yield "close", top, ""
                        top = top.parent
                top = Element(name, m["rest"], top)
                yield "open", top, ""
                if m["rest"].endswith("/") and name not in BLOCK:
                    yield "close", top, ""
                    top = top.parent
        elif kind == "raw":
            continue


class Weights:
    """Scores of words and tags by element kind, from counts (kind, is word) -> [inside, outside]."""

    def __init__(self, counts: dict[tuple[str, bool], list[int]]):
        self.counts = counts
        self.known: dict[tuple[str, bool, bool], float] = {}

    def score(self, e: Element | None, word: bool) -> float:
        key = (e.kind, e.junk, word) if e is not None else ("", False, word)
        if key not in self.known:
            inside, outside = self.counts.get((key[0], word), (0, 0))
            prior = 0.0 if key[1] else 1.0
            share = (inside + PRIOR * prior) / (inside + outside + PRIOR)
            if key[1]:
                share = min(share, 0.05)
            self.known[key] = share if word else -(1.0 - share) - TAG_COST
        return self.known[key]


def label_counts(page: str) -> Counter:
    """(kind, is word, is inside) -> count of a page whose article is marked; empty if none is."""
    found: Counter = Counter()
    marked = False
    for what, e, text in tokens(page):
        inside = e is not None and any(x.name in ARTICLE for x in e.path())
        marked |= inside
        if what == "text":
            found[e.kind if e is not None else "", True, inside] += len(text.split())
        elif what == "open":
            found[e.kind, False, inside] += 1
    return found if marked else Counter()


def unwrap(found: list[tuple[str, Element | None, str]]) -> None:
    """Take the mark of boilerplate off what holds the page itself: wrappers and
    forms (see MOST_WORDS), <main>, and the longest <article> if all of the
    page's stand in boilerplate. Hidden elements stay out. Linear in the tokens."""
    elements = [e for what, e, _ in found if what == "open"]  # parents come first
    doubt = [e for e in elements if e.junk and not e.hidden and (e.wraps or e.name in ARTICLE)]
    if not doubt:
        return
    words: Counter = Counter()
    for what, e, text in found:
        if what == "text":
            words[e] += len(text.split())
    shown = sum(c for e, c in words.items() if e is None or not e.junk)
    total = sum(words.values())
    titled = {e for e in elements if e.name in ("main", "h1")}
    for e in reversed(elements):
        if e.parent is not None:
            words[e.parent] += words[e]
            if e in titled:
                titled.add(e.parent)
    kept = {e for e in doubt if e.name == "main"}
    for e in doubt:
        if e.wraps and words[e] > MOST_WORDS * total and (e in titled or shown < FEW_WORDS * words[e]):
            e.own = False

    def settle() -> None:
        for e in elements:
            e.junk = e.own or (e not in kept and e.parent is not None and e.parent.junk)

    settle()
    articles = [e for e in elements if e.name in ARTICLE and not e.hidden]
    if articles and all(e.junk for e in articles):
        kept.add(max(articles, key=words.__getitem__))
        settle()


class Block:
    __slots__ = ("element", "parts", "junk", "title")

    def __init__(self, element: Element | None):
        self.element, self.parts = element, []
        self.junk = element is not None and element.junk
        self.title = False

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


def _container(e: Element | None) -> Element | None:
    while e is not None and e.name not in _CONTAINERS:
        e = e.parent
    return e


def _common(elements: list[Element | None]) -> Element | None:
    root = elements[0]
    for e in elements[1:]:
        while root is not None and e is not None and root is not e:
            if e.depth > root.depth:
                e = e.parent
            else:
                root = root.parent
        if e is None:
            return None
    return root


def main_text(page: str | None, weights: Weights) -> str:
    """The page's article as blocks joined by two line feeds; '' for a null, empty or wordless page."""
    blocks: list[Block] = []
    block: Block | None = None
    best = total = 0.0
    start = place = 0
    region = (0, -1)  # tokens first to last
    first_token: list[int] = []  # of each block
    last_token: list[int] = []
    found = list(tokens(page or ""))
    unwrap(found)
    for what, e, text in found:
        if what == "text":
            words = len(text.split())
            score = words * weights.score(e, True)
            if block is None:
                holder = e
                while holder is not None and holder.name not in BLOCK:
                    holder = holder.parent
                block = Block(holder)
                block.junk = e is not None and e.junk
                blocks.append(block)
                first_token.append(place)
                last_token.append(place)
            if e is None or not e.junk or block.junk:
                block.parts.append(text)
            last_token[-1] = place
        else:
            score = weights.score(e, False)
            if what == "break" or e is None or e.name in BLOCK or (e.junk and (e.parent is None or not e.parent.junk)):
                block = None
        total += score
        if total <= 0:
            total, start = 0.0, place + 1
        elif total > best:
            best, region = total, (start, place)
        place += 1
    texts = [b.text() for b in blocks]
    hit = [i for i, b in enumerate(blocks) if texts[i] and not b.junk and first_token[i] <= region[1] and last_token[i] >= region[0]]
    if not hit:
        return ""
    root = _container(_common([_container(blocks[i].element) for i in hit]))
    marked = [e for e in (root.path() if root is not None else ()) if e.name in ARTICLE]
    if marked:
        root = marked[0]  # the nearest around the region
    if root is None or root.name in ("body", "html"):
        chosen = [i for i in range(hit[0], hit[-1] + 1) if texts[i] and not blocks[i].junk]
    else:
        chosen = [i for i, b in enumerate(blocks) if texts[i] and not b.junk and b.element is not None and any(x is root for x in b.element.path())]
    chosen = [i for i in chosen if _shown(blocks[i].element)]
    return "\n\n".join(texts[i] for i in chosen)


def _shown(e: Element | None) -> bool:
    """False for what stands in an article's own header beside its headings."""
    names = [x.name for x in e.path()] if e is not None else []
    return "header" not in names or any(n in HEADINGS for n in names[: names.index("header")])


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Weights:
    """Weights from a hash sample with ``sample_pages`` expected labelled pages
    (all, if there are fewer); at most MAX_KINDS counts reach the driver."""
    labelled = pages.where(F.lower("html").rlike(r"<(article|main)[\s>]")).select("page_id", "html")
    n = pages.count()
    part = in_share("page_id", "html", share=sample_pages / max(n, 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for page in batch["html"]:
                found.update(label_counts(page.as_py()))
            yield pa.RecordBatch.from_pylist([{"kind": k, "word": word, "inside": inside, "c": c} for (k, word, inside), c in found.items()], schema)

    schema = pa.schema([("kind", pa.string()), ("word", pa.bool_()), ("inside", pa.bool_()), ("c", pa.int64())])
    counts = labelled.where(part).select("html").mapInArrow(count, "kind string, word boolean, inside boolean, c long")
    counts = counts.groupBy("kind", "word").agg(F.sum(F.when(F.col("inside"), F.col("c")).otherwise(0)).alias("i"), F.sum("c").alias("c"))
    rows = counts.orderBy(F.desc("c"), "kind", "word").limit(MAX_KINDS).collect()
    return Weights({(r["kind"], r["word"]): [r["i"], r["c"] - r["i"]] for r in rows})


def extract_text(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html, any others).

    Character references are decoded, white space inside a block is one space,
    blocks are joined by two line feeds. A null, empty or wordless page gives
    an empty text. Of regions that score the same, the first wins. Repeated
    rows are returned each; an empty table gives no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(train(pages, sample_pages).counts)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights = Weights(shared.value)
        for batch in batches:
            yield pa.array([main_text(p.as_py(), weights) for p in batch], pa.string())

    out = pages.select("page_id", "url", run("html").alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
