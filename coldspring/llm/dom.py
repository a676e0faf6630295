"""A small document tree from html of any quality, and the features of its nodes."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Fixed by the html standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math object xmp noembed noframes select".split())
UNSEEN = RAW | {"head"}
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label map mark meter nobr output picture "
             "progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr button".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
               "hgroup hr main menu nav ol p pre section table ul".split())
SIBLING_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
               "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
          "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}

TOKEN_BUCKETS = 1 << 14   # attribute words are hashed; what a bucket speaks for is learned
TAGS = ["article", "main", "section", "div", "p", "h", "li", "list", "nav", "aside", "footer", "header", "form", "table", "cell", "quote", "figure", "body", "other"]
_TAG_KIND = {"article": "article", "main": "main", "section": "section", "div": "div", "p": "p", "li": "li", "ul": "list", "ol": "list", "dl": "list",
             "dt": "li", "dd": "li", "nav": "nav", "menu": "nav", "aside": "aside", "footer": "footer", "header": "header", "form": "form", "fieldset": "form",
             "table": "table", "tbody": "table", "thead": "table", "tr": "table", "td": "cell", "th": "cell", "blockquote": "quote", "pre": "quote",
             "figure": "figure", "figcaption": "figure", "body": "body", "html": "body", "dialog": "aside", "details": "section"} | {f"h{i}": "h" for i in range(1, 7)}
_KIND = {name: i for i, name in enumerate(TAGS)}


LOOSE = "#text"   # stands for a unit of text directly in the page


class Node:
    __slots__ = ("tag", "tokens", "parent", "children", "units", "order", "depth", "chars", "linked", "tags", "words", "marks", "blocks", "titles", "truth")

    def __init__(self, tag: str, tokens: frozenset, parent: "Node | None", order: int):
        self.tag, self.tokens, self.parent, self.order = tag, tokens, parent, order
        self.children: list[Node] = []
        self.units: list[tuple[int, str, int]] = []   # place in the page, text, characters inside links
        self.depth = parent.depth + 1 if parent else 0
        self.truth = None


def _tokens(attributes: str) -> tuple[frozenset, bool]:
    """Lower-cased words of class, id and role; whether the element is hidden."""
    words, hidden = [], False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value = a or b or c
        if name.lower() in ("class", "id", "role", "itemprop", "aria-label"):
            words += [w.lower() for w in PARTS.findall(value)]
            words += value.lower().split()
        elif name.lower() == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
    return frozenset(words), hidden or bool(re.search(r"(?:^|\s)hidden(?:\s|$|=)", attributes))


def parse(page: str) -> list[Node]:
    """The block elements of a page in page order; the first is the root. Text belongs to the innermost open block, cut into
    units by the blocks in between; each unit directly in the page is a node of its own. Elements that never show text are left
    out."""
    root = Node("body", frozenset(), None, 0)
    nodes, stack = [root], [root]
    inline: list[str] = []
    links = place = 0
    pending: list[tuple[str, bool]] = []
    at, size = 0, len(page)

    def flush():
        nonlocal place
        if pending:
            text = " ".join(html.unescape("".join(t for t, _ in pending)).split())
            if text:
                linked = sum(len(" ".join(html.unescape(t).split())) for t, in_link in pending if in_link)
                holder = stack[-1]
                if holder is root:
                    holder = Node(LOOSE, frozenset(), root, len(nodes))
                    root.children.append(holder)
                    nodes.append(holder)
                holder.units.append((place, text, min(linked, len(text))))
                place += 1
            pending.clear()

    while at < size:
        found = TOKEN.search(page, at)
        if not found:
            pending.append((page[at:], links > 0))
            break
        if found.start() > at:
            pending.append((page[at:found.start()], links > 0))
        at = found.end()
        tag = found.group(2) or found.group(5)
        if not tag:
            continue
        tag = tag.lower()
        closing = bool(found.group(1) or found.group(4))
        if found.group(0)[-1] != ">":   # cut off inside a tag
            break
        attributes = found.group(3) or found.group(6) or ""
        if closing:
            if tag == "a":
                links = max(links - 1, 0)
            elif tag not in INLINE and tag not in VOID:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        flush()
                        del stack[depth:]
                        links = 0
                        break
            continue
        if tag in UNSEEN:
            if tag == "head":
                end = re.compile(r"</head\s*>|<body[\s>]", re.I).search(page, at)
                if end:
                    at = end.end() if end.group(0)[1] == "/" else end.start()
                continue
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                if tag == "hr":
                    flush()
                else:
                    pending.append((" ", False))
            continue
        if tag in INLINE:
            if tag == "a" and not attributes.endswith("/"):
                links = 1
            continue
        if tag in ("html", "body"):
            words, _ = _tokens(attributes)
            root.tokens |= words
            continue
        flush()
        links = 0
        if tag in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    del stack[depth:]
                    break
                if stack[depth].tag not in ("p",):
                    break
        ends = SIBLING_END.get(tag)
        if ends:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in SCOPES[tag] and stack[depth].tag not in ends:
                    break
                if stack[depth].tag in ends:
                    del stack[depth:]
                    break
        words, hidden = _tokens(attributes)
        if hidden:
            words |= {"hidden"}
        node = Node(tag, words, stack[-1], len(nodes))
        stack[-1].children.append(node)
        nodes.append(node)
        if not attributes.endswith("/"):
            stack.append(node)
    flush()
    return nodes


@lru_cache(maxsize=1 << 16)
def bucket(token: str) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % TOKEN_BUCKETS


N_OWN = len(TAGS) + 2       # kind of tag, hidden, loose
N_TOKENS = 6                # of the evidence of attribute words: lowest, highest and sum, on the node and above it
N_ABOVE = 8
N_TREE = 22
N_PAGE = 9
AT_TOKENS = N_OWN
AT_TREE = N_OWN + N_TOKENS + N_ABOVE
FEATURES = AT_TREE + N_TREE + N_PAGE
NO_EVIDENCE = np.zeros(TOKEN_BUCKETS)


def _largest_core(nodes: list[Node]) -> Node | None:
    """The article or main element with the most text; the outermost at equal length."""
    cores = [n for n in nodes if n.tag in ("article", "main") and n.chars]
    return max(cores, key=lambda n: (n.chars, -n.order)) if cores else None


def features(nodes: list[Node], evidence: np.ndarray = NO_EVIDENCE) -> np.ndarray:
    """One row per node: kind of tag, evidence of the hashed words of its attributes (``evidence``: log odds by bucket, 0 for
    words never seen), what stands above, subtree densities, depth and siblings, place on the page."""
    for node in reversed(nodes):
        node.chars = sum(len(t) for _, t, _ in node.units)
        node.linked = sum(n for _, _, n in node.units)
        node.words = sum(t.count(" ") + 1 for _, t, _ in node.units)
        node.marks = sum(t.count(".") + t.count(",") + t.count("!") + t.count("?") for _, t, _ in node.units)
        node.tags, node.blocks = 1, len(node.units)
        node.titles = int(node.tag == "h1")
        for child in node.children:
            node.chars += child.chars
            node.linked += child.linked
            node.words += child.words
            node.marks += child.marks
            node.tags += child.tags
            node.blocks += child.blocks
            node.titles += child.titles
    around = {}   # of the children of each node: their number, characters, longest, and how many have each tag or each set of words
    spots = [0] * len(nodes)
    for node in nodes:
        if node.children:
            sizes = [c.chars for c in node.children]
            around[node.order] = (len(sizes), sum(sizes), max(sizes), Counter(c.tag for c in node.children),
                                  Counter(c.tokens for c in node.children if c.tokens))
            for spot, child in enumerate(node.children):
                spots[child.order] = spot
    core = _largest_core(nodes)
    holders = set()   # elements around the core
    up = core.parent if core else None
    while up is not None:
        holders.add(up.order)
        up = up.parent
    inside = [False] * len(nodes)
    whole = max(nodes[0].chars, 1)
    out = np.zeros((len(nodes), FEATURES))
    before = titles = 0
    for i, node in enumerate(nodes):
        row = out[i]
        kind = _KIND[_TAG_KIND.get(node.tag, "other")]
        row[kind] = 1
        row[N_OWN - 2] = "hidden" in node.tokens
        row[N_OWN - 1] = node.tag == LOOSE
        parent = node.parent
        at = AT_TOKENS
        if node.tokens:
            own_words = evidence[[bucket(t) for t in node.tokens]]
            row[at:at + 3] = min(own_words.min(), 0), max(own_words.max(), 0), own_words.sum()
        if parent is not None:
            above = out[parent.order]
            row[at + 3] = min(above[at + 3], above[at])
            row[at + 4] = max(above[at + 4], above[at + 1])
            row[at + 5] = above[at + 5] + above[at + 2]
            at += N_TOKENS
            for k, name in enumerate(("article", "main", "nav", "aside", "footer", "header", "form", "list")):
                row[at + k] = max(above[at + k], above[_KIND[name]])
            inside[i] = inside[parent.order] or parent is core
        at = AT_TREE
        own = sum(len(t) for _, t, _ in node.units)
        chars = max(node.chars, 1)
        siblings, total, longest, tags, alike = around[parent.order] if parent else (1, node.chars, node.chars, {node.tag: 1}, {})
        below, kinds = (around[node.order][3]["p"], around[node.order][4]) if node.children else (0, {})
        row[at:at + N_TREE] = (
            np.log1p(node.chars), np.log1p(own), node.linked / chars, node.tags / chars * 50, node.chars / whole, node.words / max(node.blocks, 1) / 20,
            node.marks / max(node.words, 1), node.depth, len(node.children), node.blocks, siblings, spots[i] / siblings,
            np.log1p(total / siblings), node.chars / max(longest, 1), tags[node.tag] / siblings,
            before / whole, out[parent.order][at + 2] if parent else 0, len(node.tokens), node.chars == 0, below,
            out[parent.order][at + 4] if parent else 1, parent.chars / whole if parent else 1)
        at += N_TREE
        row[at:at + N_PAGE] = (
            core is not None, inside[i] or node is core, node.order in holders, node.titles > 0, parent is not None and parent.titles > 0, titles > 0,
            alike.get(node.tokens, 0) / siblings if alike else 0, max(kinds.values()) / len(node.children) if kinds else 0,
            out[parent.order][at + 7] if parent else 0)
        before += own
        titles += node.tag == "h1"
    return out


def decode(nodes: list[Node], score: np.ndarray) -> list[bool]:
    """The best consistent choice: a dropped node drops all below it, so a kept node stands in kept nodes only. Each node
    counts with its score (log odds of being content), the more the more text it holds itself."""
    weight = [s * (1 + np.log1p(sum(len(t) for _, t, _ in n.units))) for n, s in zip(nodes, score.tolist())]
    keep_sum, drop_sum, best = [0.0] * len(nodes), [0.0] * len(nodes), [0.0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        keep_sum[i] = weight[i] + sum(best[c.order] for c in node.children)
        drop_sum[i] = -weight[i] + sum(drop_sum[c.order] for c in node.children)
        best[i] = max(keep_sum[i], drop_sum[i])
    kept = [False] * len(nodes)
    for i, node in enumerate(nodes):
        if node.parent is None:
            kept[i] = True       # the page itself is only dropped by dropping all in it
        elif kept[node.parent.order]:
            kept[i] = keep_sum[i] > drop_sum[i]
    return kept


def kept_text(nodes: list[Node], kept: list[bool]) -> str:
    units = [u for node, yes in zip(nodes, kept) if yes for u in node.units]
    return "\n".join(text for _, text, _ in sorted(units))
