"""Main text of web pages by scoring the element tree."""

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TOKENS = re.compile(r"[a-z0-9]+")

# Element kinds and names of page furniture.
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset((
    "html body main article section div p pre blockquote ul ol li dl dt dd table thead tbody tfoot tr caption h1 h2 h3 h4 h5 h6 "
    "figure figcaption address details summary fieldset header footer nav aside form center hgroup search"
).split())
DROPPED = frozenset("head nav footer aside button select option input dialog menu svg canvas object audio video map datalist search".split()) | RAW
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())
DROPPED_NAMES = frozenset((
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal "
    "overlay newsletter subscribe subscription signup login sidebar widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead "
    "comment comments commentlist disqus respond replies reply share sharing social related recommended recommendations pagination pager toolbar skip"
).split())
HEADER_NAMES = frozenset("header topbar".split())
#: Those of the names that also stand on wrappers of whole pages.
LAYOUT_NAMES = frozenset("sidebar widget widgets menu menus navbar toolbar overlay modal popup social share sharing notice notices skip login subscription".split()) | HEADER_NAMES
GOOD_NAMES = frozenset("article content main post entry body text story page hentry".split())
KEPT_WHOLE = frozenset("html body article main".split())
#: Elements that end an open paragraph, and siblings that end each other.
_ENDS_P = BLOCKS | {"hr"}
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_BOUNDS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr")}

#: Shortest paragraph that scores; a character of a script that writes a word with one or two counts for ``WIDE`` others.
PARAGRAPH, WIDE = 25, 3
_WIDE = re.compile("[\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Doubts about an element that only its text can settle: a word of furniture in a longer name, a name of furniture alone, a form.
PARTLY, WHOLLY, FORM = 1, 2, 3
#: What the score of an element counts for in and below such a name.
_WEIGHTS = {PARTLY: 0.5, WHOLLY: 0.1}


class Node:
    __slots__ = ("tag", "names", "parent", "start", "end", "drop", "block", "own", "commas", "linked", "score", "size", "links", "doubt", "paragraphs", "prose", "wide", "weight", "inside", "anchor")

    def __init__(self, tag, names, parent, start, drop, doubt=0):
        self.tag, self.names, self.parent, self.start, self.end, self.drop, self.doubt = tag, names, parent, start, start, drop, doubt
        self.block = self if tag in BLOCKS or tag == "" else parent.block
        #: Whether an article or main element is around or is the element, and whether a link is, up to its block.
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.anchor = tag == "a" or self.block is not self and parent.anchor
        self.weight = 1.0
        self.clear()

    def clear(self):
        self.own = self.commas = self.linked = self.size = self.links = self.paragraphs = self.prose = self.wide = 0
        self.score = 0.0

    def above(self):
        """The element and all around it."""
        node = self
        while node is not None:
            yield node
            node = node.parent


def _doubt(words, furniture) -> int:
    """What class and id words say; a word is a whole name if all its parts, numbers aside, are names of furniture."""
    parts = [[t for t in _TOKENS.findall(w) if not t.isdigit()] for w in words]
    if any(found and furniture.issuperset(found) for found in parts):
        return PARTLY if any(GOOD_NAMES.issuperset(found) for found in parts if found) else WHOLLY
    return PARTLY if any(furniture.intersection(found) for found in parts) else 0


def _furniture(tag, attrs, parent) -> tuple[frozenset, bool, int]:
    """The names of an element, whether it is page furniture or hidden whatever it holds, and the doubt about it otherwise."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if attrs.strip() else {}
    names = frozenset(_TOKENS.findall(f"{found.get('class', '')} {found.get('id', '')}".lower()))
    role = found.get("role", "").lower()
    if tag in DROPPED or role in DROPPED_ROLES:
        return names, True, 0
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        return names, True, 0
    if (tag in ("article", "main") and not names & {"comment", "comments", "reply"}) or tag in ("html", "body"):
        return names, False, 0
    words = found.get("class", "").lower().split()
    if tag not in HEADINGS:
        words += found.get("id", "").lower().split()
    doubt = _doubt(words, DROPPED_NAMES if parent.inside else DROPPED_NAMES | HEADER_NAMES)
    if tag == "header" and not parent.inside:
        doubt = WHOLLY
    return names, False, doubt or (FORM if tag == "form" or role == "form" else 0)


def parse(page: str) -> tuple[list, list[Node]]:
    """Events ``(node, text)`` in page order, text None where a node opens or closes, and the nodes in that order."""
    root = Node("", frozenset(), None, 0, False)
    events, nodes, at, here = [], [root], 0, root
    open_tags: Counter[str] = Counter()  # what is not open is not looked for

    def close(node):
        nonlocal here
        while True:
            here.end = len(events)
            events.append((here, None))
            gone, here = here, here.parent
            open_tags[gone.tag] -= 1
            if gone is node:
                return

    def find(tags, bounds):
        if not any(open_tags[tag] for tag in tags):
            return None
        node = here
        while node is not root and node.tag not in bounds:
            if node.tag in tags:
                return node
            node = node.parent
        return None

    while True:
        m = _TAG.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            events.append((here, text))
        if not m:
            break
        at = m.end()
        closing, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            node = find((tag,), ())
            if node is not None:
                close(node)
            continue
        if tag in ("br", "hr"):
            events.append((here, " "))
        if tag in _ENDS_P and (node := find(("p",), ("table", "td", "th", "button"))) is not None:
            close(node)
        if tag in _ENDS and (node := find(_ENDS[tag], _BOUNDS.get(tag, ()))) is not None:
            close(node)
        if tag in VOID:
            continue
        names, drop, doubt = _furniture(tag, attrs, here)
        node = Node(tag, names, here, len(events), drop or here.drop, doubt)
        nodes.append(node)
        events.append((node, None))
        open_tags[tag] += 1
        here = node
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            close(node)
    while here is not root:
        close(here)
    root.end = len(events)
    return events, nodes


def score(events, nodes) -> None:
    """Paragraph points for length and commas to the containers above, and text and link lengths of every element."""
    for node, text in events:
        if text is None or node.drop:
            continue
        n = len(text.strip())
        block = node.block
        block.own += n
        if not text.isascii():
            block.wide += len(_WIDE.findall(text))
        block.commas += text.count(",") + text.count("，") + text.count("、")
        if node.anchor:
            block.linked += n
    for node in reversed(nodes):
        if node.block is not node or node.drop:
            continue
        node.size += node.own
        node.links += node.linked
        up = node.parent.block if node.parent else None
        if up is not None:
            up.size += node.size
            up.links += node.links
        if node.own + (WIDE - 1) * node.wide >= PARAGRAPH and 2 * node.linked < node.own:
            points = (1 + node.commas + min(node.own // 100, 3)) * (1 - node.linked / node.own)
            level, to = 0, node if node.tag not in ("p", "pre", "li", "h1", "h2", "h3", "h4", "h5", "h6") else up
            while to is not None:
                to.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
                level, to = level + 1, to.parent.block if to.parent else None
            node.paragraphs += 1
            node.prose += node.own
        if up is not None:
            up.paragraphs += node.paragraphs
            up.prose += node.prose


def _leading(nodes) -> Node | None:
    """The article or main element that holds most text, or the one in it that holds at least half of that."""
    found = [n for n in nodes if n.tag in ("article", "main") and not n.drop and not n.doubt and n.size]
    lead = max(found, key=lambda n: n.size, default=None)
    while lead is not None:
        inner = max((n for n in found if n is not lead and lead in n.above()), key=lambda n: n.size, default=None)
        if inner is None or 2 * inner.size < lead.size:
            break
        lead = inner
    return lead


def _plain(nodes, best) -> int:
    """Characters outside a container that no name casts doubt on."""
    return sum(n.own for n in nodes if n.block is n and not n.drop and n.weight == 1 and best not in n.above())


def settle_doubts(events, nodes) -> None:
    """Drops the doubtful elements that their text does not clear, from scored nodes, and scores the rest anew.

    What is around the leading article or the best container stays; a layout name around most of the page does not count. A name of furniture alone drops an element, a word in a
    longer name only one whose text is mostly links, and a form goes if it holds no paragraph that scores.
    """
    if not any(n.doubt and not n.drop for n in nodes):
        return
    lead = _leading(nodes)
    around = set(lead.above()) if lead else set()
    for n in nodes[1:]:
        n.weight = n.parent.weight * (1 if n in around or n.names & LAYOUT_NAMES and 4 * n.size > 3 * nodes[0].size else _WEIGHTS.get(n.doubt, 1))
    best = max((n for n in nodes if n.block is n and not n.drop and n.paragraphs), key=_weighed, default=None)
    if best is not None and (best.weight == 1 or best.size * best.weight >= _plain(nodes, best)):
        around = set(best.above()) | (around if best in around else set())
    for n in nodes[1:]:
        linked = n.block is n and 2 * n.links > n.size
        gone = n.doubt == WHOLLY or n.doubt == PARTLY and linked or n.doubt == FORM and (linked or not n.paragraphs)
        n.drop = n.drop or n.parent.drop or gone and n not in around
    for n in nodes:
        n.clear()
    score(events, nodes)


def _weighed(node) -> float:
    value = node.score
    if value:
        value += 25 * bool(node.names & GOOD_NAMES) + {"article": 20, "main": 10, "div": 5, "blockquote": 3, "pre": 3}.get(node.tag, 0)
        value -= 5 * (node.tag in ("ul", "ol", "li", "dl", "dd", "dt", "th", "h1", "h2", "h3", "h4", "h5", "h6"))
    return value * node.weight * (1 - node.links / node.size) if node.size else 0.0


def _widened(best) -> Node:
    """The container of the whole article where the best one holds a part of it: an element around it that adds as much as a third more
    in paragraphs that score, and hardly anything else or any links."""
    node, around = best, best.parent.block
    while around.parent is not None and around.tag not in ("html", "body"):
        more, prose = around.size - node.size, around.prose - node.prose
        if 3 * prose >= node.prose > 0 and 4 * prose >= 3 * more and 5 * (around.links - node.links) <= more and not around.drop:
            node = around
        around = around.parent.block
    return node


def main_parts(events, nodes) -> list[Node]:
    """The best container, widened to the whole article, and the siblings that belong to it, in page order."""
    live = [n for n in nodes if n.block is n and not n.drop and n.size]
    if not live:
        return []
    best = max(live, key=_weighed)
    top = _weighed(best)
    if not top:
        whole = [n for n in live if n.tag == "article"] or [n for n in live if n.tag == "main"] or [n for n in live if n.tag == "body"] or [nodes[0]]
        best = max(whole, key=lambda n: n.size)
    node = best
    while node is not None:
        if node.tag in ("article", "main") and not node.drop:
            best = node
            if node.tag == "article":
                break
        node = node.parent
    if best.parent is None or best.tag == "body":
        return [best]
    if best.tag not in ("article", "main"):
        best = _widened(best)
    parts, least = [], max(10.0, 0.2 * top)
    for other in live:
        if other is best:
            parts.append(other)
        elif other.parent is best.parent and other.size:
            density = other.links / other.size
            same = 0.2 * top if other.names and other.names == best.names else 0.0
            heading = other.tag in ("h1", "h2") and other.start < best.start and density == 0
            text = other.tag == "p" and (other.own > 80 and density < 0.25 or 0 < other.own <= 80 and density == 0)
            if heading or text or _weighed(other) + same >= least and density < 0.5:
                parts.append(other)
    return parts


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in page order with a blank line between, white space turned into single spaces.

    A null or empty page, or one without text, gives an empty text. Broken and cut markup is read as browsers mostly do.
    """
    if not page:
        return ""
    events, nodes = parse(page)
    hidden = [n.drop for n in nodes]
    score(events, nodes)
    settle_doubts(events, nodes)
    text = _joined(events, nodes)
    if not text and [n.drop for n in nodes] != hidden:
        for n, drop in zip(nodes, hidden):
            n.drop = drop
            n.clear()
        score(events, nodes)
        text = _joined(events, nodes)
    return text


def _joined(events, nodes) -> str:
    """The text of the main parts."""
    blocks: list[str] = []
    run: list[str] = []

    def flush():
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            blocks.append(text)

    for part in main_parts(events, nodes):
        for node, text in events[part.start : part.end + 1]:
            if text is None:
                if node.block is node:
                    flush()
                elif node.tag in ("td", "th"):
                    run.append(" ")
            elif not node.drop:
                run.append(text)
        flush()
    return "\n\n".join(blocks)


def extract(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """``(id, url, text, n_chars)`` of every page; each page is read on its own, so nothing is shuffled."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(c.as_py()) for c in part.column(2)]
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col), F.col(url_col).cast("string"), F.col(html_col)).mapInArrow(run, f"id {kind}, url string, text string, n_chars long")
    return rows.withColumnsRenamed({"id": id_col, "url": url_col})
