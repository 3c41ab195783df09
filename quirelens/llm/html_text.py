"""Main text of web pages by tag-path ratios.

Every text node has a root-to-leaf tag path.  Text length and punctuation are summed per path and
divided by the path's nodes; both ratios are smoothed along the page and fused.  The threshold is the
spread of the page's fused ratios (0.8 of the unmarked nodes' mean, if less).  A path's score is its fused ratio
times `IN_ARTICLE` inside an article or main element, and times the level of its marks: 0 under
elements and roles for something else (menus, page headers, footers, sidebars, forms), `STRONG` under
class or id words for adverts, notices, comments and the like, `WEAK` under words that articles use of
themselves too.  Nodes that reach the threshold are content; marked nodes must reach it alone, without
their neighbours.

Marks are evidence, not verdicts: `no-sidebar` or `comments-open` is no mark; nor is an element marked
that holds most of the page's article or, on pages without article or main, most of its text (of
adverts, notices, comments and elements for something else: only if it holds all of the article).

The container is the smallest element with all content and the titles before it.  The result is the
container's content and its unmarked nodes; on pages with an article or main, what stands beside them
must be content or a heading, too.  Short titles and paragraphs thus come with the container that the
scores choose, though their own paths have low ratios.  Blocks of links are no content unless an
article is around them.  Text that a page hides is text.

Null and empty pages, and those with marked text alone: the empty text.  Pages without markup: their text.  Broken markup (tags left
open, closed twice, cut off) is read to its end.  Very long or deeply nested pages: time and memory
grow with the page's length alone.  Ties of scores need no rule.  Repeated rows: each is returned.
An empty table: no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import record

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[/a-zA-Z][^<>]*+\Z|[^<]++|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?。，、！？…»«\"]")

# Fixed by the language of the pages: elements by kind.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "thead": {"tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPES = {"table", "ul", "ol", "dl", "div", "section", "article", "main", "aside", "nav", "header", "footer", "body", "html", "form", "td", "th", "blockquote", "figure", "select"}
CLOSE_P = BLOCKS - {"br", "body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "title"}
# No text of a page: its head, parts of forms, embedded things.
NO_TEXT = {"head", "title", "button", "select", "option", "label", "legend", "svg", "object", "canvas", "audio", "video", "map"}
OUT = {"nav", "footer", "aside", "form", "menu", "dialog", "search"}
OUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "form", "menu", "menubar", "toolbar", "status"}
OUT_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promoted cookie cookies consent gdpr notice notices popup newsletter subscribe subscription signup login menu menus nav navbar navigation navigations breadcrumb breadcrumbs sidebar sidebars aside footer foot footers comment comments commentlist reply replies disqus related recommended recommendations pagination pager copyright paywall".split()
)
MAYBE_WORDS = set("banner discussion disclaimer modal overlay promotion rail share sharing skip social toolbar widget widgets".split())
# In one name with them, a word says how the page is laid out.
LAYOUT_WORDS = set("closed disabled enabled has have hide no not off on open show with without".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# No containers: their siblings belong with them.
PIECES = HEADINGS | {"p", "li", "dt", "dd", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "figcaption"}
HEADERS = {"header", "masthead", "topbar"}
REPLIES = {"comment", "comments", "reply", "replies"}
#: Factor of scores inside an article or main element, and of paths under marked names.
IN_ARTICLE, STRONG, WEAK = 20.0, 0.0001, 0.05


class Node:
    """An element.  path: number of its root-to-leaf path, the same for all nodes of that path.

    own: level of its own mark (1: none); level: the least of its own and those around it; by_word: marked by a name."""

    __slots__ = ("tag", "parent", "own", "level", "by_word", "path", "number", "key", "depth", "linked", "heading", "top", "article")

    def __init__(self, tag: str, parent: Node | None, number: int, paths: dict, names: tuple[str, ...] = (), own: float = 1.0, by_word: bool = False) -> None:
        self.tag, self.parent, self.own, self.by_word, self.number = tag, parent, own, by_word, number
        self.key = tag + ("." + names[0] if names else "")
        self.path = paths.setdefault((parent.path if parent else -1, self.key), len(paths))
        self.depth = parent.depth + 1 if parent else 0
        self.linked = tag == "a" or bool(parent and parent.linked)
        self.heading = tag if tag in HEADINGS else parent.heading if parent else ""
        self.article = bool(parent and parent.article) or tag in ("article", "main") and own == 1
        self.settle()

    def settle(self) -> None:
        """Takes the level from the parent's; top: the outermost article or main around it that nothing marked is around."""
        up = self.parent
        self.level = min(self.own, up.level) if up else self.own
        self.top: Node | None = (up.top if up else None) or (self if self.tag in ("article", "main") and self.level == 1 else None)

    @property
    def factor(self) -> float:
        return self.level * (IN_ARTICLE if self.top is not None else 1.0)


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)} if raw and "=" in raw else {}


def _mark(tag: str, at: dict[str, str], inside: bool) -> tuple[float, bool, tuple[str, ...]]:
    """Level of an element's own mark, whether a name gives it, and the words of its names."""
    each = [[w.lower() for w in _NAME_WORDS.findall(name)] for k in ("class", "id") for name in at.get(k, "").split()] if at else []
    names = tuple(w for words in each for w in words)
    if tag in NO_TEXT or tag in OUT or tag == "header" and not inside:
        return 0.0, False, names
    if not at:
        return 1.0, False, names
    role = at.get("role", "").lower()
    if role in OUT_ROLES and not (inside and role == "banner"):
        return 0.0, False, names
    found = {w for words in each if LAYOUT_WORDS.isdisjoint(words) for w in words}
    if tag in ("article", "main", "body", "html"):
        return STRONG if tag == "article" and found & REPLIES else 1.0, True, names
    if found & OUT_WORDS or not inside and found & HEADERS:
        return STRONG, True, names
    return WEAK if found & MAYBE_WORDS else 1.0, True, names


def relieve(nodes: list[Node], texts: list[tuple[Node, str, int]]) -> None:
    """Takes back the marks of elements that hold most of the page's article, or of its text where it has no article.

    Text counts without headings, a fifth of links.  Elements are judged by what they hold, most first, against all
    unmarked text outside of them; an element in a marked one stays marked."""
    held = [[0.0, 0.0] for _ in nodes]  # of an article, of all
    near = [[0.0, 0.0] for _ in nodes]  # the same, of the text whose nearest marked element this is
    nearest: list[Node | None] = [None] * len(nodes)
    barred = [False] * len(nodes)
    for x in nodes:
        nearest[x.number] = x if x.own < 1 else nearest[x.parent.number] if x.parent else None
        barred[x.number] = x.tag in NO_TEXT or x.parent is not None and barred[x.parent.number]
    free = [0.0, 0.0]
    for node, text, _ in texts:
        n = len(text.strip()) * (0.2 if node.linked else 1.0)
        if not n or node.heading or barred[node.number]:
            continue
        mark = nearest[node.number]
        for sums in (held[node.number], free if mark is None else near[mark.number]):
            sums[0] += n * node.article
            sums[1] += n
    for x in reversed(nodes):
        if x.parent is not None:
            for k in (0, 1):
                held[x.parent.number][k] += held[x.number][k]
    no_article = not any(x.article for x in nodes)
    for x in sorted((x for x in nodes if x.own < 1 and x.tag not in NO_TEXT), key=lambda x: (-held[x.number][0], -held[x.number][1], x.number)):
        around = nearest[x.parent.number] if x.parent is not None else None
        if around is not None and around.own < 1:
            continue
        article, text = held[x.number]
        # what it holds may be counted as free only once marks around it are gone, so nothing of it is in `free` yet
        if x.own == WEAK or x.tag == "form":
            goes = article > free[0] or no_article and text > free[1]
        else:
            goes = article > 0 and free[0] == 0
        if goes:
            x.own = 1.0
            free[0] += near[x.number][0]
            free[1] += near[x.number][1]
    for x in nodes:
        x.settle()


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str, int]]]:
    """Elements, and text nodes as (element, decoded text, block number) in page order."""
    paths: dict = {}
    root = Node("", None, 0, paths)
    nodes, texts, stack = [root], [], [root]
    open_: dict[str, int] = {}  # elements on the stack, so that it is searched only for what is there
    block, inside, at = 0, 0, 0
    size = len(page)

    def pop(to: int) -> None:
        nonlocal inside
        for x in stack[to:]:
            inside -= x.tag in ("article", "main")
            open_[x.tag] -= 1
        del stack[to:]

    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            raw = m[0]
            if raw[0] != "<" or raw == "<":
                texts.append((stack[-1], html_entities.unescape(raw) if "&" in raw else raw, block))
            elif raw.startswith("<![CDATA["):
                texts.append((stack[-1], raw[9:].removesuffix("]]>"), block))
            continue
        tag = tag.lower()
        block += tag in BLOCKS
        if m[1] or m[4]:
            for i in () if not open_.get(tag) else range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    pop(i)
                    break
                if stack[i].tag in SCOPES and tag not in SCOPES and tag not in BLOCKS:
                    break
            continue
        if open_.get("p") and (tag == "p" or tag in CLOSE_P):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    pop(i)
                    break
                if stack[i].tag in SCOPES or stack[i].tag in ("li", "dd", "dt"):
                    break
        if tag in CLOSES and any(open_.get(t) for t in CLOSES[tag]):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in CLOSES[tag]:
                    pop(i)
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
                elif stack[i].tag in SCOPES:
                    break
        attributes = m[3] or m[6] or ""
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = close.start() if close else size
            end = page.find(">", at) if close else -1
            at = end + 1 if end >= 0 else size
            continue
        parent = stack[-1]
        own, by_word, names = _mark(tag, _attributes(attributes), inside > 0)
        node = Node(tag, parent, len(nodes), paths, names, own, by_word)
        nodes.append(node)
        if not attributes.endswith("/") or tag in BLOCKS:
            stack.append(node)
            open_[tag] = open_.get(tag, 0) + 1
            inside += tag in ("article", "main")
    relieve(nodes, texts)
    return nodes, texts


def path_ratios(texts: list[tuple[Node, str, int]]) -> list[tuple[float, float]]:
    """Text and punctuation ratio of the path of each text node."""
    length: dict[int, float] = {}
    marks: dict[int, float] = {}
    count: dict[int, int] = {}
    for node, text, _ in texts:
        n = len(text.strip())
        if n:
            p = node.path
            length[p] = length.get(p, 0) + n * (0.2 if node.linked else 1)
            marks[p] = marks.get(p, 0) + len(_PUNCTUATION.findall(text))
            count[p] = count.get(p, 0) + 1
    return [(length[n.path] / count[n.path], marks[n.path] / count[n.path]) if n.path in count else (0.0, 0.0) for n, _, _ in texts]


def path_scores(texts: list[tuple[Node, str, int]], raw: list[tuple[float, float]], radius: int = 2) -> list[tuple[float, float]]:
    """Fused path ratios of each text node times its path's factor: smoothed along the page, and of the path alone.

    Nodes weigh in the smoothing what their levels leave of them."""
    weights = [2.0 ** -abs(k) for k in range(-radius, radius + 1)]
    levels = [node.level for node, _, _ in texts]
    out = []
    for i, (node, _, _) in enumerate(texts):
        t = p = w = 0.0
        for k in range(max(0, i - radius), min(len(raw), i + radius + 1)):
            x = weights[k - i + radius] * levels[k]
            t, p, w = t + x * raw[k][0], p + x * raw[k][1], w + x
        out.append((node.factor * (t / w) * (1 + p / w) if w else 0.0, node.factor * raw[i][0] * (1 + raw[i][1])))
    return out


def threshold(texts: list[tuple[Node, str, int]], raw: list[tuple[float, float]]) -> float:
    """Spread of the fused ratios of all text nodes, at most 0.8 of the mean of unmarked nodes without links (with links, if there are no others)."""
    fused = [(node, t * (1 + p)) for (node, text, _), (t, p) in zip(texts, raw, strict=True) if text.strip()]
    plain = [(node.linked, x) for node, x in fused if node.level == 1]
    if not plain:
        return float("inf")
    own = [x for linked, x in plain if not linked] or [x for _, x in plain]
    mean = sum(x for _, x in fused) / len(fused)
    spread = (sum((x - mean) ** 2 for _, x in fused) / len(fused)) ** 0.5
    return min(spread, 0.8 * sum(own) / len(own))


def _common(found: list[Node]) -> Node:
    """The lowest element that all of `found` are or are in: that of the first and the last, as nodes are numbered in page order."""
    a, b = min(found, key=lambda x: x.number), max(found, key=lambda x: x.number)
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return a


def main_text(page: str | None) -> str:
    if not page:
        return ""
    nodes, texts = parse(page)
    raw = path_ratios(texts)
    scores = path_scores(texts, raw)
    least = threshold(texts, raw)
    shown = [bool(text.strip()) and node.level > 0 for node, text, _ in texts]
    marked = any(node.top is not None for (node, _, _), x in zip(texts, shown, strict=True) if x)
    links: dict[int, list[int]] = {}
    for node, text, block in texts:
        if node.top is None:
            n = links.setdefault(block, [0, 0])
            n[node.linked] += len(text.strip())
    menu = {block for block, n in links.items() if n[1] > 2 * n[0]}  # without an article around them, blocks of links alone are menus

    anchors: list[Node] = []
    content: set[int] = set()  # blocks
    chosen = [False] * len(texts)
    follows = False  # content comes next
    for i in range(len(texts) - 1, -1, -1):
        (node, _, block), (score, alone) = texts[i], scores[i]
        if not shown[i] or node.top is None and block in menu:
            continue
        # of marked nodes, and beside an article, the path's own ratios count too, not its neighbours' alone
        chosen[i] = score >= least and (node.level == 1 and not (marked and node.top is None) or alone >= least)
        title = node.level == 1 and bool(node.heading) and (follows or node.heading == "h1" and bool(anchors))
        if chosen[i] or title:
            anchors.append(node.top or node)
            content.add(block)
        if node.level == 1:
            follows = chosen[i] or title
    if not anchors:
        return ""
    box = _common(anchors)
    while box.parent is not None and box.top is None and (box.tag in PIECES or box.tag not in BLOCKS):
        box = box.parent

    inside = [False] * len(nodes)
    for x in nodes:
        inside[x.number] = x is box or x.parent is not None and inside[x.parent.number]
    parts: list[list[str]] = []
    last = None
    for (node, text, block), own in zip(texts, chosen, strict=True):
        if not inside[node.number] or not node.level or node.level < 1 and text.strip() and not own:
            continue
        if node.top is None and (block in menu or marked and block not in content and not node.heading):
            continue
        if block != last:
            parts.append([])
            last = block
        parts[-1].append(text)
    return " ".join(x for x in (" ".join("".join(p).split()) for p in parts) if x)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = [main_text(x) for x in part.column(2).to_pylist()]
            yield record(schema, [part.column(0), part.column(1), texts, [len(t) for t in texts]])


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
