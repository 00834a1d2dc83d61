"""Main text of HTML pages by tag-path ratios.

Each text node belongs to the path of block elements from the root to it.  Per
path the text length and the punctuation count are aggregated and divided by the
number of its nodes; both ratios are smoothed over the nodes in page order with a
Gaussian window and fused by their product; paths whose fused ratio reaches a
share of the standard deviation hold content.

The nodes of content paths are selected.  Two weaker signals complete them.  Names of
class, id and role may announce a subtree as a menu, comments, an advert and the like:
it goes, unless it holds most of the selected text.  And short blocks that belong to
the text by their place (headings, captions, list items between paragraphs, what else
an article or main holds) stay, unless they are mostly links.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
NAMES = re.compile(r"""(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I | re.S)
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var br wbr img button select svg math canvas audio video object".split()
)
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
DROP = frozenset(
    "head script style title textarea iframe noembed noframes noscript template nav footer aside form button select "
    "option svg math canvas audio video object dialog menu datalist fieldset".split()
)
#: Elements that may wrap a whole page although they are in DROP.
WRAPPERS = frozenset("form fieldset".split())
#: Share of the selected text that a subtree with a furniture name must hold to stay, and one that is named after readers' comments.
LEAST_SHARE, LEAST_COMMENT_SHARE = 0.6, 0.95
#: An article or main beside a subtree with a furniture name, of this share of its text, says that the name is right.
RIVAL = 0.25
#: Share of linked characters from which a block is mostly links and not prose.
LINKED = 0.5
#: Words of class, id and role that announce something besides the article.
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc "
    "footer foot copyright legal masthead topbar toolbar "
    "sidebar aside rail related recommended recommendations widget complementary contentinfo search searchbox "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login paywall "
    "share sharing social follow "
    "comment comments commentlist respond reply replies disqus discussion "
    "skip skiplink hidden invisible sr dialog disclaimer adbox adslot adunit adwrap adwrapper adcontainer adspace".split()
)
COMMENTS = ("comment", "respond", "repl", "disqus", "discussion")
#: Beginnings of such words.
FURNITURE_STARTS = ("advert", "breadcrumb", "comment", "cookie", "navbar", "newsletter", "notice", "popup", "promo", "sidebar", "sponsor")
#: An element named header is the page's unless it is named after the text as well.
OWN_HEADER = frozenset("article post entry content story title".split())
#: What may carry a furniture word and is the page itself.
NEVER_FURNITURE = frozenset("html body article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Short blocks of these elements begin or end a text beside its paragraphs.
ENDS = frozenset("p blockquote pre li dd figcaption".split())
#: An open p ends where one of these begins.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre section summary table ul li dt dd".split()
)
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table article section main body html div nav aside footer header form td th blockquote".split())
#: A line of rights at the end of a page.
NOTICE = re.compile(r"\W*(?:©|\(c\)|copyright\b|all rights reserved)", re.I)
PUNCT = re.compile(r"[.,;:!?。，；：！？、…\"'()«»“”¿¡-]")


def _furniture(tag: str, attrs: str) -> tuple[bool, float, str]:
    """Is the element hidden; the share of selected text that its names ask of it, 0 if none do; its signature in a path."""
    if not attrs or "=" not in attrs and "hidden" not in attrs.lower():
        return False, 0.0, tag
    share, sign, hidden = 0.0, tag, False
    for key, value in NAMES.findall(attrs):
        key, value = key.lower(), unescape(value.strip("\"'"))
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif key == "style":
            flat = value.replace(" ", "").lower()
            hidden |= "display:none" in flat or "visibility:hidden" in flat
        elif value:
            for name in value.split():
                words = WORDS.findall(CAMEL.sub(" ", name).lower())
                if any(w.startswith(COMMENTS) for w in words):
                    share = LEAST_COMMENT_SHARE
                elif any(w in FURNITURE or w.startswith(FURNITURE_STARTS) for w in words) or "header" in words and not OWN_HEADER.intersection(words):
                    share = max(share, LEAST_SHARE)
            if key == "class":
                sign = f"{tag}.{value}"
    return hidden, 0.0 if tag in NEVER_FURNITURE else share, sign


class _Node:
    __slots__ = ("tag", "parent", "path", "dropped", "depth", "asks", "mass", "size")

    def __init__(self, tag: str, parent: _Node | None, sign: str, dropped: bool, asks: float = 0.0) -> None:
        self.tag, self.parent, self.dropped, self.asks, self.mass, self.size = tag, parent, dropped, asks, 0, 0
        self.path = f"{parent.path}/{sign}" if parent else sign
        self.depth = parent.depth + 1 if parent else 0


@dataclass(slots=True)
class _Block:
    node: _Node
    text: str
    linked: int  # characters inside links


def _blocks(html: str) -> list[_Block]:
    """Blocks outside dropped elements in page order; white space is one space, no block is empty."""
    at = _Node("", None, "", False)
    out: list[_Block] = []
    held: list[str] = []
    linked = 0
    inline: list[tuple[str, bool]] = []  # open inline elements of the block, with what was dropped outside
    hush, links = False, 0  # inside a dropped inline element; open links
    pos, end = 0, len(html)

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            # text that stands right in an article's header is a byline, not a heading
            if text and at.tag != "header":
                out.append(_Block(at, text, linked))
        linked = 0

    while pos < end:
        m = TOKEN.search(html, pos)
        stop = m.start() if m else end
        if stop > pos and not at.dropped and not hush:
            piece = unescape(html[pos:stop])
            held.append(piece)
            if links:
                linked += len(piece.strip())
        if not m:
            break
        pos = m.end()
        cdata, shut, tag, attrs, shut2, tag2, attrs2 = m.groups()
        tag = tag or tag2
        if tag is None:
            if cdata and not at.dropped and not hush:
                held.append(cdata)
            continue
        shut, attrs, tag = shut or shut2, attrs or attrs2 or "", tag.lower()
        if shut:
            if tag in INLINE:
                for k in range(len(inline) - 1, -1, -1):
                    if inline[k][0] == tag:
                        hush = inline[k][1]
                        del inline[k:]
                        links = sum(x[0] == "a" for x in inline)
                        break
                continue
            node = at
            while node.parent is not None and node.tag != tag and not (tag not in SCOPE and node.tag in SCOPE):
                node = node.parent
            if node.parent is not None and node.tag == tag:
                flush()
                at = node.parent
                inline.clear()
                hush, links = False, 0
            elif tag == "p":
                flush()
            continue
        if tag in INLINE:
            if tag == "br":
                held.append(" ")
            elif tag not in VOID:
                hidden, asks, _ = _furniture(tag, attrs)
                if not attrs.endswith("/"):
                    inline.append((tag, hush))
                    hush = hush or hidden or asks > 0 or tag in DROP
                    links += tag == "a"
            continue
        if tag in RAW and not attrs.endswith("/"):
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, pos)
            pos = close.end() if close else end
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        flush()
        inline.clear()
        hush, links = False, 0
        if tag in CLOSES_P:
            node = at
            while node.parent is not None and node.tag != "p" and node.tag not in SCOPE:
                node = node.parent
            if node.tag == "p":
                at = node.parent
        for gone in SIBLINGS.get(tag, ()):
            node = at
            while node.parent is not None and node.tag != gone and node.tag not in ("ul", "ol", "dl", "table"):
                node = node.parent
            if node.tag == gone:
                at = node.parent
        if tag == "body":  # a head without end tag ends here
            while at.parent is not None and at.tag != "html":
                at = at.parent
        hidden, asks, sign = _furniture(tag, attrs)
        if tag in WRAPPERS:
            asks = max(asks, LEAST_SHARE)
        bad = hidden or tag in DROP - WRAPPERS
        if tag == "header" or at.tag == "header" and tag not in HEADINGS:
            inside = at
            while inside is not None and inside.tag not in ("article", "main"):
                inside = inside.parent
            bad = bad or inside is None or tag != "header"
        at = _Node(tag, at, sign, at.dropped or bad, asks)
    flush()
    return out


def _smooth(values: list[float], radius: int = 2, sigma: float = 1.0) -> list[float]:
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-radius, radius + 1)]
    out = []
    for i in range(len(values)):
        num = den = 0.0
        for k, w in zip(range(i - radius, i + radius + 1), kernel):
            if 0 <= k < len(values):
                num += w * values[k]
                den += w
        out.append(num / den)
    return out


def content_paths(blocks: list[_Block], share: float = 0.5) -> set[str]:
    """Paths whose smoothed, fused length and punctuation ratios reach ``share`` standard deviations."""
    if not blocks:
        return set()
    sums: dict[str, list[float]] = {}
    for b in blocks:
        s = sums.setdefault(b.node.path, [0, 0, 0])
        s[0] += 1
        s[1] += max(0, len(b.text) - 2 * b.linked)  # linked text speaks against a path
        s[2] += len(PUNCT.findall(b.text))
    lengths = [sums[b.node.path][1] / sums[b.node.path][0] for b in blocks]
    marks = [1 + sums[b.node.path][2] / sums[b.node.path][0] for b in blocks]
    # a path counts by itself and by where it stands: the mean of own and smoothed ratio, multiplied over both kinds
    fused = [math.sqrt(x * sx * y * sy) for x, sx, y, sy in zip(lengths, _smooth(lengths), marks, _smooth(marks))]
    per: dict[str, list[float]] = {}
    for b, x in zip(blocks, fused):
        per.setdefault(b.node.path, []).append(x)
    score = {p: sum(x) / len(x) for p, x in per.items()}
    mean = sum(fused) / len(fused)
    level = share * math.sqrt(sum((x - mean) ** 2 for x in fused) / len(fused))
    best = max(score.values())
    return {p for p, x in score.items() if x >= min(level, best)}


def _ancestors(node: _Node | None) -> Iterator[_Node]:
    while node is not None:
        yield node
        node = node.parent


def _weigh(blocks: list[_Block], paths: set[str]) -> int:
    """Characters of selected blocks, in all and below every element (``mass``); ``size`` has those of all blocks."""
    total = 0
    for b in blocks:
        for up in _ancestors(b.node):
            up.mass = up.size = 0
    for b in blocks:
        for up in _ancestors(b.node):
            up.size += len(b.text)
        if b.node.path in paths:
            total += len(b.text)
            for up in _ancestors(b.node):
                up.mass += len(b.text)
    return total


def main_text(html: str | None, share: float = 0.5, mass: float = 0.8) -> str:
    """The article's blocks joined by an empty line; empty without any text."""
    if not html:
        return ""
    blocks = [b for b in _blocks(html) if not b.node.dropped]
    # furniture by name, judged by the selected text of the page as a whole
    total = _weigh(blocks, content_paths(blocks, share))
    texts = {up for b in blocks for up in _ancestors(b.node) if up.tag in ("article", "main")}
    refused: dict[_Node, bool] = {}

    def furniture(node: _Node) -> bool:
        if not node.asks:
            return False
        above = set(_ancestors(node))
        rivals = (t for t in texts if t not in above and node not in _ancestors(t))
        return not total or node.mass < node.asks * total or any(t.size >= RIVAL * node.size for t in rivals)

    def refuses(node: _Node | None) -> bool:
        if node is None:
            return False
        if node not in refused:
            refused[node] = refuses(node.parent) or furniture(node)
        return refused[node]

    blocks = [b for b in blocks if not refuses(b.node)]
    if not blocks:
        return ""
    paths = content_paths(blocks, share)
    total = _weigh(blocks, paths)
    picked = [b.node.path in paths for b in blocks]
    # the smallest element that holds most of the selected text, or the article or main around it
    holder = None
    for b in blocks:
        for up in _ancestors(b.node):
            if up.mass >= mass * total and up.tag not in CLOSES_P - SCOPE and (holder is None or up.depth > holder.depth):
                holder = up
    holder = next((up for up in _ancestors(holder) if up.tag in ("article", "main")), None)
    if holder is not None:
        return "\n\n".join(b.text for b in blocks if holder in _ancestors(b.node))
    # without either: what is selected, headings before it, and what is prose by its place
    first, last = picked.index(True), len(picked) - 1 - picked[::-1].index(True)
    around = {up for b, p in zip(blocks, picked) if p for up in _ancestors(b.node.parent) if up.tag not in ("", "html", "body")}
    prose = lambda b: b.linked < LINKED * len(b.text)
    # a short block of a kind that texts consist of, in an element with selected text or beside one in it
    near = lambda b: b.node.tag in ENDS and not NOTICE.match(b.text) and (b.node.parent in around or b.node.parent.parent in around)
    kept = [p or first < k < last and prose(b) for k, (b, p) in enumerate(zip(blocks, picked))]
    for k in range(first - 1, -1, -1):
        if not (prose(blocks[k]) and (blocks[k].node.tag in HEADINGS or near(blocks[k]))):
            break
        kept[k] = True
    for k in range(last + 1, len(blocks)):
        if not (prose(blocks[k]) and near(blocks[k])):
            break
        kept[k] = True
    return "\n\n".join(b.text for b, k in zip(blocks, kept) if k)


def extract_main_text(pages: DataFrame, share: float = 0.5, mass: float = 0.8) -> DataFrame:
    """(page_id, url, html) -> (page_id, url, text, n_chars).

    Null or empty html gives an empty text and 0; nulls in page_id and url stay;
    repeated rows each keep a row; other columns are ignored.  Malformed markup is
    read as browsers do in the common cases; a page without tags is one block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py(), share, mass) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    )
