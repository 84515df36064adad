"""Main text of web pages by minimum cut.

A page is cut into blocks at block-level tags. A linear classifier gives each
block the log-odds of being content (its place in the tag tree, class and id
words, length, link share, punctuation); their positive parts become
capacities from the source, their negative parts capacities to the sink.
Neighbours in page order and neighbours under one parent are joined by edges
whose capacity falls with the distance in the tag tree. The minimum cut
labels the blocks: those on the source's side are the text.

Pages are independent rows, so the work needs no shuffle; a page's graph has
a few edges a block.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sub_batches

# Element names of HTML.
BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW_TAGS = "script|style|template|noscript|textarea|title|iframe|object|svg|canvas|audio|video|noframes|xmp"
BOILERPLATE_TAGS = frozenset("nav footer aside form menu select button dialog fieldset search optgroup option legend".split())
CONTENT_TAGS = frozenset("article main".split())
# Words in class, id, role and aria-label that name a region.
BOILERPLATE_WORDS = frozenset("ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs byline-links complementary contentinfo comment comments commentlist consent cookie cookies copyright disclaimer discussion disqus dropdown footer form gdpr header hidden legal links login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager paging pagination popup popups promo promos promoted promotion recommended related replies reply respond responses rail search share sharing sidebar side signup skip social sponsor sponsored sponsors subscribe subscription tagcloud teaser toc toolbar tooltip topbar trending upsell warning widget widgets".split())
CONTENT_WORDS = frozenset("article articlebody body content entry main maintext post story text".split())
COMMENT_WORDS = frozenset("comment comments commentlist discussion disqus replies reply respond responses".split())

#: Elements that hold running text themselves; a boilerplate word counts there only if it stands alone.
TEXT_TAGS = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_RAW = r"<!--.*?(?:--!?>|\Z)" rf"|<(?P<raw>{RAW_TAGS})(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
_QUOTED = r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
_PLAIN = r"|<(?P<close2>/?)(?P<name2>[a-z][^\s/>]*+)(?P<attrs2>[^>]*+)>" r"|<[!?/][^>]*+>"
_TAG = re.compile(_RAW + _QUOTED + _PLAIN, re.S | re.I)
#: The same without quoted attribute values, for pages whose quotes are left open.
_PLAIN_TAG = re.compile(_RAW + _PLAIN, re.S | re.I)
#: Tags with an open quote after which quotes are not followed any more.
OPEN_QUOTES = 64
_HINT = re.compile(r"(?:^|\s)(class|id|role|aria-label|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PARTS = re.compile(r"[a-z]+", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[^\W\d_]+")
_END_MARK = re.compile(r"[.!?。！？…][\"'”’)\]]*\Z")
#: Elements that end an open paragraph, or a sibling of their kind, in HTML's optional end tags.
_ENDS_OWN = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
_SCOPE = frozenset("table td th ul ol dl div section article main aside nav header footer form body html blockquote".split())


class Node:
    __slots__ = ("bad", "comments", "depth", "good", "name", "order", "parent")

    def __init__(self, name: str, parent: Node | None, order: int, attrs: str):
        self.name, self.parent, self.order = name, parent, order
        self.depth = parent.depth + 1 if parent else 0
        bad, good, comments = name in BOILERPLATE_TAGS, name in CONTENT_TAGS, False
        if name == "header" or name == "hgroup":
            bad = True
        if attrs and name not in ("html", "body"):
            for key, a, b, c in _HINT.findall(attrs):
                key, value = key.lower(), a or b or c
                if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
                    bad = comments = True
                elif key in ("class", "id", "role", "aria-label"):
                    for token in value.split():
                        parts = [p.lower() for p in _PARTS.findall(_CAMEL.sub("-", token))]
                        if not parts or parts[0] in ("has", "with", "no", "is"):
                            continue
                        other = not all(p in BOILERPLATE_WORDS for p in parts)
                        if other and name in TEXT_TAGS:
                            continue  # "related-work" on a heading, "share-price" on a paragraph
                        if any(p in COMMENT_WORDS for p in parts):
                            bad = comments = True
                        elif other and {p for p in parts if p in BOILERPLATE_WORDS} == {"header"} and any(p in CONTENT_WORDS for p in parts):
                            continue  # the head of the article
                        elif any(p in BOILERPLATE_WORDS for p in parts):
                            bad = True
                        elif any(p in CONTENT_WORDS for p in parts):
                            good = True
        self.bad, self.good, self.comments = bad, good and not bad, comments


class Block:
    __slots__ = ("link", "node", "text")

    def __init__(self, text: str, link: int, node: Node):
        self.text, self.link, self.node = text, link, node


def _tags(page: str) -> Iterator[re.Match]:
    """The page's tags in order, in time that grows with its length: nothing is looked for behind the last ``>``,
    and after some tags with an open quote, whose search ran to the end, quotes are no longer followed."""
    end, at, open_quotes = page.rfind(">") + 1, 0, 0
    while at < end:
        pattern = _TAG if open_quotes < OPEN_QUOTES else _PLAIN_TAG
        m = pattern.search(page, at, end)
        if m is None:
            return
        if m.end() == end:  # what is not closed goes on to the end of the page
            m = pattern.match(page, m.start())
        open_quotes += bool(m["name2"])
        yield m
        at = m.end()


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order: white space folded, character references decoded, empty ones left out."""
    out: list[Block] = []
    root = Node("", None, 0, "")
    node, order, at = root, 0, 0
    pieces: list[str] = []
    in_link, link = 0, 0

    def flush() -> None:
        nonlocal link
        if pieces:
            text = "".join(pieces)
            pieces.clear()
            if "&" in text:
                text = unescape(text)
            text = " ".join(text.split())
            if text:
                out.append(Block(text, min(link, len(text)), node))
        link = 0

    for m in _tags(page):
        begin = m.start()
        if begin > at:
            piece = page[at:begin]
            pieces.append(piece)
            if in_link:
                link += len(piece.strip())
        at = m.end()
        found = m.groupdict()
        name = found.get("name") or found["name2"]
        close = found.get("close") or found["close2"]
        if not name:
            continue  # comments, declarations and raw elements leave nothing
        name = name.lower()
        if name == "a":
            in_link = 0 if close else 1
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name not in BLOCK_TAGS and name != "button":
            continue
        flush()
        in_link = 0
        if close:
            up = node
            while up is not None and up.name != name:
                up = up.parent
            if up is not None and up.parent is not None and not (name not in _SCOPE and _crosses(node, up)):
                node = up.parent
            continue
        if name == "hr":
            continue
        for closes in _ENDS_OWN.get(name, ()) + (("p",) if name not in _ENDS_OWN or name in ("li", "dt", "dd", "tr", "td", "th") else ()):
            up = node
            while up is not None and up.name != closes and up.name not in _SCOPE:
                up = up.parent
            if up is not None and up.name == closes and up.parent is not None:
                node = up.parent
        order += 1
        node = Node(name, node, order, found.get("attrs") or found["attrs2"] or "")
        if node.name in CONTENT_TAGS and not node.comments:
            # what holds the article is no boilerplate, whatever its class says
            up = node.parent
            while up is not None and not up.comments:
                up.bad = False
                up = up.parent
    if at < len(page):
        pieces.append(page[at:])
    flush()
    return out


def _crosses(node: Node, up: Node) -> bool:
    """Whether a closing tag of ``up`` would leave an element that bounds its scope."""
    while node is not up:
        if node.name in _SCOPE:
            return True
        node = node.parent
    return False


def log_odds(b: Block) -> float:
    """The classifier: a linear function of the block's features."""
    words = len(_WORD.findall(b.text))
    z = -1.0 + 0.12 * min(words, 25)
    z -= 3.5 * b.link / max(1, len(b.text))
    if _END_MARK.search(b.text):
        z += 0.7
    if not words:
        z -= 0.5
    inside, bad, good = b.node, False, False
    while inside is not None:
        if inside.comments:
            return z - 12.0
        if inside.bad and not (inside.name in ("header", "hgroup") and _in_content(inside, b.node.name in HEADINGS)):
            bad = True
        good = good or inside.good or inside.name in CONTENT_TAGS
        inside = inside.parent
    if bad:
        z -= 8.0
    elif good:
        z += 4.0
    name = b.node.name
    if name == "p" or name in ("blockquote", "pre", "figcaption"):
        z += 0.8
    elif name in ("h1", "h2", "h3", "h4", "h5", "h6"):
        z += 0.6
    elif name in ("td", "th", "option", "label"):
        z -= 0.6
    if b.text[0] == "©" or (words <= 25 and "all rights reserved" in b.text.lower()):
        z -= 4.0
    return z


def _in_content(node: Node, heading: bool = False) -> bool:
    """Whether the node stands in an article; for a heading, an element that is only named so counts too."""
    up = node.parent
    while up is not None:
        if (up.name in CONTENT_TAGS or (heading and up.good)) and not up.comments:
            return True
        up = up.parent
    return False


def _distance(a: Node, b: Node) -> int:
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


ADJACENT, SIBLING = 1.2, 0.6


def edges(found: list[Block]) -> list[dict[int, float]]:
    """Smoothness edges by block: to the next block, and to the next one under the same parent."""
    near: list[dict[int, float]] = [{} for _ in found]

    def join(i: int, j: int, c: float) -> None:
        near[i][j] = near[i].get(j, 0.0) + c
        near[j][i] = near[j].get(i, 0.0) + c

    last: dict[Node | None, int] = {}
    for i, b in enumerate(found):
        if i:
            join(i - 1, i, ADJACENT / (1 + _distance(found[i - 1].node, b.node)))
        parent = b.node.parent
        if parent is not None and parent in last:
            join(last[parent], i, SIBLING)
        last[parent] = i
    return near


def minimum_cut(source: list[float], near: list[dict[int, float]]) -> list[bool]:
    """Which nodes lie on the source's side of the minimum cut.

    ``source``: capacity from the source (positive) or to the sink (negative);
    ``near``: undirected capacities, which are consumed. A node whose terminal
    capacity is no less than all its edges lies on that terminal's side in
    some minimum cut; it is fixed and its edges become terminal capacity of
    its neighbours. The rest is labelled by augmenting paths.
    """
    net = list(source)
    side: list[bool | None] = [None] * len(net)
    queue = deque(range(len(net)))
    while queue:
        i = queue.popleft()
        if side[i] is not None or abs(net[i]) < sum(near[i].values()):
            continue
        side[i] = net[i] > 0
        for j, c in near[i].items():
            net[j] += c if side[i] else -c
            del near[j][i]
            queue.append(j)
        near[i] = {}
    rest = [i for i, s in enumerate(side) if s is None]
    if not rest:
        return [bool(s) for s in side]
    residual = {i: dict(near[i]) for i in rest}
    supply = {i: net[i] for i in rest}
    while True:  # breadth-first from what the source still feeds
        parent: dict[int, int] = {i: -1 for i in rest if supply[i] > 1e-9}
        line, end = deque(parent), -1
        while line:
            i = line.popleft()
            if supply[i] < -1e-9:
                end = i
                break
            for j, c in residual[i].items():
                if c > 1e-9 and j not in parent:
                    parent[j] = i
                    line.append(j)
        if end < 0:
            for i in rest:
                side[i] = i in parent
            return [bool(s) for s in side]
        path, i = [], end
        while parent[i] >= 0:
            path.append((parent[i], i))
            i = parent[i]
        flow = min(supply[i], -supply[end], *(residual[a][b] for a, b in path)) if path else 0.0
        supply[i] -= flow
        supply[end] += flow
        for a, b in path:
            residual[a][b] -= flow
            residual[b][a] = residual[b].get(a, 0.0) + flow


def main_text(page: str) -> str:
    """The article's blocks joined by two line ends; empty if the page has none."""
    found = blocks(page)
    if not found:
        return ""
    keep = minimum_cut([log_odds(b) for b in found], edges(found))
    return "\n\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(df: DataFrame, html: str, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Add ``text`` and ``n_chars`` (code points) and leave out ``html``; columns of these names are replaced.

    Null or empty html gives empty text. Repeated rows stay. Malformed markup
    never fails: what no tag pattern matches is text.
    """
    own = {html, text.lower(), n_chars.lower()}  # names are compared as Spark does
    rest = [c for c in df.columns if c not in own and c.lower() not in own]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest), f"`{text}` string", f"`{n_chars}` long"])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, raw, off in sub_batches(b.column("__html")):
                data = raw.tobytes()
                found = [main_text(data[off[i] : off[i + 1]].decode("utf-8", "replace")) for i in range(hi - lo)]
                own = [b.column(i).slice(lo, hi - lo) for i in range(len(rest))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(found, pa.string()), pa.array(np.array([len(t) for t in found], np.int64))], [*rest, text, n_chars])

    return df.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{html}`").alias("__html")).mapInArrow(part, schema)
