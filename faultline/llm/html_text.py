"""Main text of web pages by composite text density.

A page is parsed to a tree. Each node has its characters, link characters, tags and link
tags. Its composite density is its characters per tag, lowered the more of them are links;
a node's sum is that of its children's densities, and the node of the largest sum leads the
article. The smallest density on the way from it to the body is the threshold: branches
beside that way join the text if they reach it and are not mostly links, and link lists
inside the article that stay under it are left out. Menus, headers, footers, sidebars,
forms, scripts and styles, told by tag, role or a hidden state, are cut before anything is measured.
A class or id name that sounds like a menu, notice, advert or comment lowers the densities of the node and all in it,
unless it holds an article, a main or most of the text. Where an article or main element holds the leading
node, the text stays within the outermost one and the articles beside it that reach the threshold.

Cases: null and empty pages have an empty text; broken markup (unclosed or stray tags, a
page cut off) is read as browsers do for paragraphs, lists and tables; a page of very many
nodes or depth needs memory in proportion only; repeated rows give equal results; an empty
table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import as_bytes

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+|[^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\bhidden\b")
_RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CUT = frozenset("head script style noscript template iframe nav footer aside form button select textarea svg math canvas object audio video dialog menu noembed noframes".split())
_BLOCK = frozenset("html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre address figure figcaption header footer nav aside form fieldset hr details summary center".split())
_SCOPE = frozenset("html body article main section div td th table ul ol dl blockquote header footer nav aside form figure".split())
_KEEP = frozenset("html body article main".split())
#: an opening tag ends the open tags named here, up to the scope they live in
_ENDS = {t: ({"li"}, {"ul", "ol"}) for t in ("li",)} | {t: ({"dt", "dd"}, {"dl"}) for t in ("dt", "dd")} | {
    t: ({"td", "th"}, {"tr", "table"}) for t in ("td", "th")} | {"tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}), "option": ({"option"}, {"select"})}
_NOISE = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices
alert newsletter subscribe subscription signup popup modal overlay sidebar rail nav navbar navigation menu breadcrumb breadcrumbs toc footer masthead
comment comments commentlist reply replies respond disqus discussion related recommended recommendations share sharing social widget toolbar pagination
pager login search skip""".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar note".split())
CUT, NAMED = 1, 2
_NAME_PARTS = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


#: what a class or id name that sounds like no article leaves of a node's density
PRIOR = 1 / 32


def _is_noise(tag: str, attributes: str, in_article: bool) -> int:
    """CUT: no part of the page's text. NAMED: its class or id only sounds so."""
    if tag in _CUT:
        return CUT
    if tag in _KEEP:
        return 0
    if tag == "header" and not in_article:
        return CUT
    if not attributes:
        return 0
    named = 0
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if not name:
            return CUT  # hidden
        if name in ("class", "id"):
            parts = _NAME_PARTS.findall(_CAMEL.sub(" ", value).lower())
            if not _NOISE.isdisjoint(parts) or "header" in parts and not in_article:
                named = NAMED
        elif name == "role" and value.lower() in _NOISE_ROLES or name == "aria-hidden" and value.lower() == "true":
            return CUT
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            return CUT
    return named


class _Tree:
    """Nodes in page order (a parent before its children) and the page's pieces of text."""

    def __init__(self, page: str):
        self.parent, self.tag = [-1], ["#root"]
        self.chars, self.link_chars, self.tags, self.link_tags = [0], [0], [0], [0]
        self.pieces: list = []  # (node, text), or (node, None) at the edge of a block
        self.noise = [False]
        self._read(page)
        self._clear_holders()
        for i in range(len(self.parent) - 1, 0, -1):
            if self.noise[i]:  # measured for itself
                continue
            p = self.parent[i]
            self.chars[p] += self.chars[i]
            self.link_chars[p] += self.link_chars[i]
            self.tags[p] += self.tags[i] + 1
            self.link_tags[p] += self.link_tags[i] + (self.tag[i] == "a")

    def _clear_holders(self) -> None:
        """A name counts for nothing on a node that holds an article, a main or over three fifths
        of the body's characters outside links."""
        if True not in self.noise:
            return
        plain, holds = [c - lc for c, lc in zip(self.chars, self.link_chars)], [t in ("article", "main") for t in self.tag]
        for i in range(len(self.parent) - 1, 0, -1):
            plain[self.parent[i]] += plain[i]
            holds[self.parent[i]] |= holds[i]
        body = plain[self.tag.index("body") if "body" in self.tag else 0]
        self.noise = [n and not holds[i] and 5 * plain[i] <= 3 * body for i, n in enumerate(self.noise)]

    def _read(self, page: str) -> None:
        stack, cut, links, articles, at = [0], 0, 0, 0, 0  # cut: depth in the stack where noise began

        def pop(down_to: int) -> None:
            nonlocal cut, links, articles
            while len(stack) > down_to:
                node = stack.pop()
                tag = self.tag[node]
                links -= tag == "a"
                articles -= tag in ("article", "main")
                if cut > len(stack):
                    cut = 0
                if tag in _BLOCK:
                    self.pieces.append((node, None))

        def text(raw: str) -> None:
            if cut or not raw:
                return
            found = html.unescape(raw) if "&" in raw else raw
            node = stack[-1]
            self.pieces.append((node, found))
            n = len("".join(found.split()))
            self.chars[node] += n
            if links:
                self.link_chars[node] += n

        find = _TOKEN.search
        while m := find(page, at):
            text(page[at:m.start()])
            at = m.end()
            data, slash, tag, attributes = m.groups()
            if data:
                text(data)
            if tag is None:
                continue
            tag = tag.lower()
            if slash:
                for i in range(len(stack) - 1, 0, -1):
                    own = self.tag[stack[i]]
                    if own == tag:
                        pop(i)
                        break
                    if tag not in _BLOCK and tag not in _RAW and own in _SCOPE:
                        break  # a stray end of something inside a block
                continue
            if tag in _BLOCK:
                # a block ends an open paragraph, and list items and cells end their like
                ends, scope = _ENDS.get(tag, (set(), set()))
                for i in range(len(stack) - 1, 0, -1):
                    own = self.tag[stack[i]]
                    if own == "p" or own in ends:
                        pop(i)
                        if own == "p" and not ends:
                            break
                    elif own in scope or own in _SCOPE and not ends:
                        break
            if tag == "body" and "body" in self.tag:
                continue
            if tag == "br":
                if not cut:
                    self.pieces.append((stack[-1], " "))
                continue
            node = len(self.parent)
            kind = 0 if cut else _is_noise(tag, attributes, articles > 0)
            if kind == CUT:
                cut = len(stack) + 1
                self.pieces.append((stack[-1], None if tag in _BLOCK else " "))
            if not cut:
                self.parent.append(stack[-1])
                self.tag.append(tag)
                self.noise.append(kind == NAMED)
                for counts in (self.chars, self.link_chars, self.tags, self.link_tags):
                    counts.append(0)
                if tag in _BLOCK:
                    self.pieces.append((node, None))
            if tag in _VOID or attributes.endswith("/") and tag not in _BLOCK:
                cut = 0 if cut == len(stack) + 1 else cut
            elif tag in _RAW:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
                cut = 0 if cut == len(stack) + 1 else cut
            else:
                if cut:  # only the nesting matters in there
                    self.parent.append(stack[-1])
                    self.tag.append(tag)
                    self.noise.append(False)
                    for counts in (self.chars, self.link_chars, self.tags, self.link_tags):
                        counts.append(0)
                stack.append(node)
                links += tag == "a"
                articles += tag in ("article", "main")
        text(page[at:])
        pop(1)

    def densities(self) -> list:
        """The composite density of every node."""
        body = self.tag.index("body") if "body" in self.tag else 0
        ratio = self.link_chars[body] / max(1, self.chars[body])
        out = []
        for c, lc, t, lt in zip(self.chars, self.link_chars, self.tags, self.link_tags):
            t, lc1, lt1 = max(1, t), max(1, lc), max(1, lt)
            if not c:
                out.append(0.0)
                continue
            plain = max(1, c - lc)
            base = math.log(c / plain * lc + ratio * c + math.e)
            weight = math.log(max(c / lc1 * t / lt1, 1.0) + 1) / max(1e-9, math.log(base + 1))
            out.append(c / t * weight)
        lowered = [False] * len(out)
        for i in range(1, len(out)):
            lowered[i] = self.noise[i] or lowered[self.parent[i]]
            if lowered[i]:
                out[i] *= PRIOR
        return out


def main_text(page: str) -> str:
    """The page's article: blocks in page order, one line each."""
    if not page:
        return ""
    tree = _Tree(page)
    density = tree.densities()
    sums = [0.0] * len(density)
    for i in range(1, len(density)):
        sums[tree.parent[i]] += density[i]
    best = max(range(len(sums)), key=lambda i: (sums[i], -i))
    if not sums[best] and not tree.chars[best]:
        best = 0
    way, node = [], best
    while node >= 0:
        way.append(node)
        node = tree.parent[node]
    frame = max((i for i, n in enumerate(way) if tree.tag[n] in ("article", "main")), default=None)
    threshold = min((density[n] for n in way if density[n] and tree.tag[n] not in ("#root", "html")), default=0.0)
    top = way[frame] if frame is not None else 0
    on_way, inside, take = set(way), [False] * len(density), [False] * len(density)
    for i in range(len(density)):
        p = tree.parent[i]
        links = 2 * tree.link_chars[i] > tree.chars[i]
        if i == top or frame is not None and p == tree.parent[top] and tree.tag[i] == "article" and density[i] >= threshold and not links:
            take[i] = True
        elif p < 0 or not take[p]:
            continue
        elif i in on_way:
            take[i] = True
        elif tree.noise[i]:
            take[i] = not links and tree.chars[i] > 0 and density[i] >= threshold
        elif inside[p]:
            # a lone link in a sentence belongs to it; blocks of links don't
            take[i] = not (links and density[i] < threshold and tree.tag[i] in _BLOCK and tree.link_tags[i] > 1)
        else:
            take[i] = tree.tag[i] not in _BLOCK or not links and (density[i] >= threshold or not tree.chars[i])
        inside[i] = take[i] and (i == best or p >= 0 and inside[p])
    blocks, now = [], []
    for node, piece in [*tree.pieces, (0, None)]:
        if piece is None:
            line = " ".join("".join(now).split())
            if line:
                blocks.append(line)
            now = []
        elif take[node]:
            now.append(piece)
    return "\n".join(blocks)


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""

    def read(batches):
        for batch in batches:
            texts = [main_text(x.decode("utf-8", "replace")) for x in as_bytes(batch.column("html"))]
            # lone surrogates from character references are no text
            texts = [t.encode("utf-8", "replace").decode() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=_OUT)

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(read, "page_id long, url string, text string, n_chars long")
