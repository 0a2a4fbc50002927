"""Main text of web pages by minimum-cut labelling.

A page becomes a sequence of text blocks.  A linear classifier weighs each block's surroundings (elements and class
names above it), links and length; its score is the capacity from the source (article) or to the sink (boilerplate).
Neighbouring blocks and blocks of one parent are tied by edges that weaken with their distance in the tree.  The
maximum flow gives the cheapest labelling: what the source still reaches is the article.

Blocks are joined in page order by one line feed; inside a block white space becomes one space and character
references are decoded.  Nothing is shortened.

Defined results: null, empty and text-free pages give an empty text; broken markup is read as far as it goes, an
unclosed tag or comment ends with the page; rows are extracted one by one, repeated or not, with or without an id; an
empty table gives no rows.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("script style template noscript svg math iframe object textarea title head canvas audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split()
)
ENDS_PARAGRAPH = BLOCK - {"button", "label", "option", "optgroup", "select", "caption", "td", "th", "tr", "tbody"}
CONTENT_ROOT = frozenset({"article", "main"})
NEVER_CONTENT = frozenset("nav aside footer form dialog menu button select fieldset search".split())
# Class, id and role words that tell boilerplate: wherever they stand, or only below the article's element.
APART = re.compile(r"(comment|disqus|repl(y|ies)$|respond$|related|recommend|trending|popular$|outbrain|taboola|dialog$|modal)")
ASIDE = re.compile(
    r"(ads?$|adv$|advert|adsense|adbox|adslot|banner|sponsor|promo|cookie|consent|gdpr|notice|notification|alert|newsletter|"
    r"subscri|signup|login|social|shar(e|ing)$|follow$|sidebar|widget|breadcrumb|pagination|pager$|popup|overlay|paywall|"
    r"menu|nav|navbar|navigation|footer|header|masthead|topbar|toolbar|search|copyright|legal$|disclaimer|meta$|byline|"
    r"tags?$|toc$|skip$|hidden$|complementary|contentinfo|form$)"
)
CONTENT = re.compile(r"(articlebody|article|content|post|entry|story|main|text|body)$")

# Weights of the classifier, in hundredths of a nat.
PRIOR, ROOT, CONTENT_NAME = -60, 400, 150
NEVER, APART_NAME, ASIDE_NAME, PAGE_HEADER = -900, -900, -600, -500
PER_WORD, WORDS, LINKS, STOP, TITLE, SIGN = 6, 50, -400, 30, 100, -300
SAME_PARENT, SAME_PARENT_APART = 80, 40

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^>]*)>",
    re.S,
)
NAMED = re.compile(r"(?:^|[\s\"'])(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(eq=False)
class Element:
    """An element and what it inherits, settled when it is made, so that no page costs more for its depth."""

    name: str
    parent: Element | None
    kind: str  # of its names: apart, aside, content or nothing
    depth: int = 0
    apart: bool = False  # it or one around it is never content
    rooted: bool = False  # it or one around it is the article's element
    aside: bool = False  # it or one around it, up to the article's element, is named like boilerplate
    named: bool = False  # or like content
    headers: int = 0  # headers around it that stand outside of any article

    def __post_init__(self) -> None:
        up, root = self.parent, self.name in CONTENT_ROOT
        self.depth = up.depth + 1 if up else 0
        self.apart = self.name in NEVER_CONTENT or self.kind == "apart" or bool(up and up.apart)
        self.rooted = root or bool(up and up.rooted)
        inherits = up is not None and not root
        self.aside = self.kind == "aside" or (inherits and up.aside)
        self.named = self.kind == "content" or (inherits and up.named)
        self.headers = (up.headers if up else 0) + (self.name == "header" and not self.rooted)


@dataclass
class Block:
    element: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


@lru_cache(maxsize=20_000)
def name_kind(attributes: str) -> str:
    """What an element's class, id, role and visibility say of it."""
    kind = ""
    for match in NAMED.finditer(attributes):
        name, value = match[1].lower(), match[2] or match[3] or match[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "apart"
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return "apart"
            continue
        if name in ("hidden", "aria-hidden"):
            continue
        for word in WORD.findall(value):
            word = word.lower()
            if APART.match(word):
                return "apart"
            if ASIDE.match(word):
                kind = "aside"
            elif not kind and CONTENT.match(word):
                kind = "content"
    return kind


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order with the element they stand in."""
    root = Element("html", None, "")
    at, in_link = root, False
    open_: Counter[str] = Counter()  # names of the elements around ``at``, itself included
    blocks: list[Block] = []
    current: Block | None = None

    def say(raw: str) -> None:
        nonlocal current
        if current is None or current.element is not at:
            if not raw.strip():
                return
            current = Block(at)
            blocks.append(current)
        text = references.unescape(raw) if "&" in raw else raw
        current.parts.append(text)
        if in_link:
            current.linked += len(text.strip())

    place, end = 0, len(page)
    while place < end:
        match = TOKEN.search(page, place)
        if match is None:
            say(page[place:])
            break
        if match.start() > place:
            say(page[place : match.start()])
        place = match.end()
        name = match["name"] or match["name2"]
        if not name:
            continue
        name = name.lower()
        closing = match["close"] or match["close2"]
        if name in UNSEEN and not closing:
            if name == "head":
                after = re.compile(r"</head\s*>|<body\b", re.I).search(page, place)
                place = (after.end() if after[0][1] == "/" else after.start()) if after else place
            elif not (match["attributes"] or "").endswith("/"):
                after = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, place)
                place = after.end() if after else end
            continue
        if name == "br":
            if current is not None:
                current.parts.append(" ")
            continue
        if name == "a":
            in_link = not closing
            continue
        if name not in BLOCK or name == "html":
            continue
        current, in_link = None, False
        if closing:
            while open_[name]:
                open_[at.name] -= 1
                closed, at = at.name, at.parent
                if closed == name:
                    break
            continue
        if name in ENDS_PARAGRAPH:
            if at.name == "p" or (at.name[0] == "h" and at.name[1:].isdigit() and name[0] == "h" and name[1:].isdigit()):
                open_[at.name] -= 1
                at = at.parent
        if name == at.name and name in ("li", "option", "tr", "td", "th", "dd", "dt"):
            open_[name] -= 1
            at = at.parent
        if name == "hr":
            continue
        attributes = match["attributes"] or match["attributes2"] or ""
        kind = name_kind(attributes) if attributes.strip(" /") and name not in ("body", "html") else ""
        at = Element(name, at, kind)
        open_[name] += 1
    for block in blocks:
        block.text = " ".join("".join(block.parts).split())
    return [b for b in blocks if b.text]


def block_score(block: Block) -> int:
    """Evidence for article (above 0) or boilerplate (below)."""
    at = block.element
    score = PRIOR + PAGE_HEADER * at.headers + ROOT * at.rooted + CONTENT_NAME * (at.named and not at.rooted)
    score += NEVER * at.apart + ASIDE_NAME * at.aside
    words = block.text.count(" ") + 1
    score += PER_WORD * min(words, WORDS) + int(LINKS * min(1.0, block.linked / len(block.text)))
    score += STOP * (block.text[-1] in ".!?:;\"'”»") + TITLE * (block.element.name == "h1")
    return score + SIGN * (block.text[0] == "©")


def tie(a: Element, b: Element) -> int:
    """Strength of the edge between two blocks: full for one parent, less with every step between their elements."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
        if (steps - 1) ** 2 > SAME_PARENT:
            return 0
    return SAME_PARENT // max(1, steps - 1) ** 2


def source_side(scores: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labels of the minimum cut: True for nodes that the source reaches after a maximum flow (Dinic's algorithm)."""
    n = len(scores)
    supply, demand = [max(s, 0) for s in scores], [max(-s, 0) for s in scores]
    near: list[list[int]] = [[] for _ in range(n)]
    to, room = [], []
    for a, b, weight in edges:
        if weight > 0:
            near[a].append(len(to))
            near[b].append(len(to) + 1)
            to += [b, a]
            room += [weight, weight]
    while True:
        level = [0 if s else -1 for s in supply]
        queue = deque(i for i in range(n) if supply[i])
        met = False
        while queue:
            i = queue.popleft()
            met |= demand[i] > 0
            for e in near[i]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not met:
            return [depth >= 0 for depth in level]
        following = [0] * n
        for start in range(n):
            while supply[start]:
                path, i = [], start
                while not demand[i]:
                    while following[i] < len(near[i]):
                        e = near[i][following[i]]
                        if room[e] and level[to[e]] == level[i] + 1:
                            break
                        following[i] += 1
                    else:
                        level[i] = -2  # a dead end in this phase
                        if not path:
                            break
                        i = to[path.pop() ^ 1]
                        following[i] += 1
                        continue
                    path.append(e)
                    i = to[e]
                if not demand[i]:
                    break
                flow = min([supply[start], demand[i], *[room[e] for e in path]])
                supply[start] -= flow
                demand[i] -= flow
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow


def main_text(page: str | None) -> str:
    """The article of one page."""
    blocks = blocks_of(page or "")
    edges, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            edges.append((i - 1, i, tie(blocks[i - 1].element, block.element)))
        parent = id(block.element.parent)
        if last.get(parent, i - 1) != i - 1:
            edges.append((last[parent], i, SAME_PARENT_APART))
        last[parent] = i
    kept = source_side([block_score(b) for b in blocks], edges)
    return "\n".join(b.text for b, keep in zip(blocks, kept) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return pages.select("page_id", "url", F.col("html").cast("string").alias("html")).mapInArrow(
        per_batch, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
