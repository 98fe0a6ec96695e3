"""Main text of web pages: boosted trees over DOM-node features and hierarchical decoding.

A page is scanned into a tree of block elements (inline elements belong to their block; void, implied and unclosed end tags, raw-text
elements and character references are handled).  Each block has features of its subtree (text length, text per tag, share of link
text, punctuation), its attribute words, tag, depth, position and size among its siblings, and its ancestors.  Boosted trees give
each block's probability of being main text; the decoder then finds the most probable labelling of the whole tree in
which nothing under a dropped block is kept, so ancestors and descendants never contradict each other.

The trees are fitted on seeded synthetic pages with known labels (``train_pages`` of them; see html_pages).

Defined results: null or empty html, and pages without main text, give the empty text; scripts, styles, titles, comments, drawings and form controls never
give text, and one that is not closed hides nothing after its tag (but for scripts and styles, as in browsers); text outside of all blocks is kept; an
unfinished tag at the end is dropped; white space (as str.split sees it) in a block becomes one space; blocks as probable to be kept as to be dropped are
dropped; copies are each extracted alike, columns other than page_id, url and html are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.gbdt import BoostedTrees, fit_boosted
from lodestone.llm.html_pages import PageMaker
from lodestone.llm.shared import small_batches, trimmed

#: A comment, a tag with balanced quotes, a tag up to the next ">", an unfinished tag at the end, a declaration.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)(?:((?:[^>\"'<]++|\"[^\"]*+\"|'[^']*+')*+)>|([^>]*+)(?:>|\Z))|<[!?/][^>]*+(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z][-\w:]*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Raw text up to the end tag; never main text.  Without an end tag, CODE goes on to the end of the page, of the others the tag alone is skipped.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
CODE = frozenset("script style".split())
#: Ordinary markup whose whole subtree is never main text; without an end tag of its own the tag alone is skipped.
MUTED = frozenset("noscript template svg math select option optgroup datalist button object canvas audio video".split())
FLAT = frozenset("noscript select datalist button".split())  # not nested in themselves
OPTIONS = frozenset("option optgroup".split())  # end tags are optional
BLOCKS = frozenset(
    "html body article main section nav header footer aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption form fieldset figure figcaption blockquote pre address details summary dialog center hgroup search".split()
)
CLOSES_P = BLOCKS - {"html", "body", "td", "th", "tr", "thead", "tbody", "tfoot", "caption", "figcaption", "summary"}
#: A start tag of the key ends an open element of these, unless one of the stops is open inside.
IMPLIED = {"option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}), "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"})}
TAG_GROUPS = (("article", "main"), ("nav", "search"), ("header", "hgroup"), ("footer",), ("aside",), ("section",), ("div", "center"), ("p",), ("h1",), ("h2", "h3", "h4", "h5", "h6"), ("ul", "ol", "dl"), ("li", "dt", "dd"), ("form", "fieldset", "dialog"), ("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"), ("figure", "figcaption"), ("blockquote", "pre"))
TAG_GROUP = {t: i for i, group in enumerate(TAG_GROUPS) for t in group}
#: Attribute words (of class, id and role) by group.
WORD_GROUPS = (
    "article content main post entry story text body paragraph".split(),
    "nav navigation navbar menu breadcrumb breadcrumbs pagination pager topbar tabs".split(),
    "header masthead banner logo branding".split(),
    "footer foot copyright legal colophon contentinfo bottom".split(),
    "sidebar side widget rail related recommended popular complementary aside also".split(),
    "ad ads advert advertisement advertising sponsored sponsor promo promotion".split(),
    "cookie cookies consent gdpr notice alert popup modal newsletter dialog overlay subscribe".split(),
    "comment comments commentlist disqus discussion reply replies responses respond".split(),
    "form search login signup contact register".split(),
    "share social follow sharing".split(),
    "wrapper container page row layout col wide box".split(),
)
WORD_GROUP = {w: i for i, group in enumerate(WORD_GROUPS) for w in group}
LOWER = {c: c + 32 for c in range(65, 91)}
N_TAGS, N_WORDS = len(TAG_GROUPS), len(WORD_GROUPS)
N_FEATURES = 2 * (N_TAGS + N_WORDS) + 18


class Block:
    __slots__ = ("tag", "parent", "depth", "index", "children", "word_bits", "keep", "text", "link", "marks", "words", "links", "tags")

    def __init__(self, tag: str, parent: int, depth: int, index: int):
        self.tag, self.parent, self.depth, self.index = tag, parent, depth, index
        self.children = self.word_bits = self.text = self.link = self.marks = self.words = self.links = self.tags = 0
        self.keep = None


def attribute_bits(raw: str, block: Block, labelled: bool) -> None:
    for name, value in ATTRIBUTE.findall(raw):
        name = name.lower()
        value = value.strip("\"'")
        if name in ("class", "id", "role"):
            for word in WORD.findall(value):
                group = WORD_GROUP.get(word.lower())
                if group is not None:
                    block.word_bits |= 1 << group
        elif labelled and name == "data-keep":
            block.keep = int(value)


class Parser:
    """One page: its blocks in page order, the root first, and its text segments with the number of their block.  ``labelled`` pages are the trainer's own."""

    def __init__(self, page: str, labelled: bool):
        self.page, self.labelled = page, labelled
        self.blocks = [Block("#root", -1, 0, 0)]
        self.stack: list[tuple[str, int]] = [("#root", 0)]  # open elements and their blocks
        self.open: Counter = Counter()  # tags on the stack
        self.segments: list[tuple[int, str]] = []
        self.buffer: list[str] = []
        self.links = self.muted = self.current = 0
        self.ends: dict[str, int] = {}
        self.lower: str | None = None

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            self.buffer.clear()
            if text:
                self.segments.append((self.current, text))

    def say(self, raw: str) -> None:
        if self.muted:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        self.buffer.append(text)
        b = self.blocks[self.current]
        size = len(text)
        b.text += size
        b.words += text.count(" ") + (1 if size else 0)
        b.marks += text.count(".") + text.count(",")
        if self.links:
            b.link += size

    def push(self, tag: str) -> None:
        self.stack.append((tag, self.current))
        self.open[tag] += 1
        self.links += tag == "a"
        self.muted += tag in MUTED

    def close(self, to: int) -> None:
        for tag, _ in self.stack[to:]:
            self.open[tag] -= 1
            self.links -= tag == "a"
            self.muted -= tag in MUTED
            if tag in BLOCKS:
                self.flush()
        del self.stack[to:]
        self.current = self.stack[-1][1]

    def close_last(self, wanted: set[str] | frozenset[str], stops: set[str] | frozenset[str]) -> None:
        """Ends the innermost open element of ``wanted``, unless one of ``stops`` is open inside it."""
        if any(self.open[t] for t in wanted):
            for i in range(len(self.stack) - 1, 0, -1):
                tag = self.stack[i][0]
                if tag in wanted:
                    return self.close(i)
                if tag in stops:
                    return None
        return None

    def ends_after(self, tag: str, at: int) -> bool:
        """Whether the page has an end tag of this kind after ``at``; for FLAT elements, before another one starts."""
        if tag not in self.ends:
            self.lower = self.lower if self.lower is not None else ascii_lower(self.page)
            self.ends[tag] = self.lower.rfind("</" + tag)
        if self.ends[tag] < at:
            return False
        return tag not in FLAT or self.lower.find("</" + tag, at) < (self.lower.find("<" + tag, at) + 1 or len(self.lower) + 1)

    def start(self, tag: str, raw: str, at: int) -> int:
        """Takes a start tag; the place after it, or after the raw text it begins."""
        here = self.blocks[self.current]
        if tag in RAW:
            here.tags += not self.muted
            if self.ends_after(tag, at):
                found = self.lower.find("</" + tag, at)
                stop = self.page.find(">", found)
                return stop + 1 if stop >= 0 else len(self.page)
            return len(self.page) if tag in CODE else at
        if tag == "br":
            self.say(" ")
            return at
        if tag in IMPLIED:
            self.close_last(*IMPLIED[tag])
        if tag in MUTED:
            self.blocks[self.current].tags += not self.muted
            inside = self.open["select"] or self.open["datalist"]
            if not raw.endswith("/") and (inside if tag in OPTIONS else self.ends_after(tag, at)):
                self.push(tag)
            return at
        if self.muted:
            if tag not in VOID and not raw.endswith("/"):
                self.push(tag)
            return at
        if tag in VOID:
            here.tags += 1
            if tag == "hr":
                self.flush()
            return at
        if tag not in BLOCKS:
            here.tags += 1
            here.links += tag == "a"
            if not raw.endswith("/"):
                self.push(tag)
            return at
        if tag in CLOSES_P:
            self.close_last({"p"}, BLOCKS)
        self.flush()
        parent = self.blocks[self.current]
        block = Block(tag, self.current, parent.depth + 1, parent.children)
        parent.children += 1
        if "=" in raw:
            attribute_bits(raw, block, self.labelled)
        self.blocks.append(block)
        self.current = len(self.blocks) - 1
        self.push(tag)
        return at

    def run(self) -> tuple[list[Block], list[tuple[int, str]]]:
        page, at = self.page, 0
        while found := TOKEN.search(page, at):
            if found.start() > at:
                self.say(page[at : found.start()])
            at = found.end()
            tag = found.group(2)
            if not tag:
                continue
            tag = tag.lower()
            if found.group(1):
                self.close_last({tag}, frozenset())
            else:
                at = self.start(tag, found.group(3) or found.group(4) or "", at)
        if at < len(page):
            self.say(page[at:])
        self.flush()
        return self.blocks, self.segments


def ascii_lower(text: str) -> str:
    """A-Z in lower case, and every place where it was."""
    return text.translate(LOWER)


def parse(page: str, labelled: bool = False) -> tuple[list[Block], list[tuple[int, str]]]:
    """(blocks in page order, the root first; text segments with the number of their block).  Time is in proportion to the page for any text."""
    return Parser(page, labelled).run()


def node_features(blocks: list[Block]) -> list[list[float]]:
    n = len(blocks)
    text, link, marks, words, links, tags = ([getattr(b, k) for b in blocks] for k in ("text", "link", "marks", "words", "links", "tags"))
    paragraphs = [1 if b.tag == "p" else 0 for b in blocks]
    nodes = [1] * n
    for i in range(n - 1, 0, -1):
        p = blocks[i].parent
        for column in (text, link, marks, words, links, tags, paragraphs, nodes):
            column[p] += column[i]
    total = max(1, text[0])
    above_tags, above_words = [0] * n, [0] * n
    out = []
    log = math.log1p
    seen = 0
    for i, b in enumerate(blocks):
        group = TAG_GROUP.get(b.tag, -1)
        if i:
            up = blocks[b.parent]
            above_tags[i] = above_tags[b.parent] | (1 << TAG_GROUP[up.tag] if up.tag in TAG_GROUP else 0)
            above_words[i] = above_words[b.parent] | up.word_bits
            siblings, share = up.children, text[i] / max(1, text[b.parent])
        else:
            siblings, share = 1, 1.0
        row = [0.0] * N_FEATURES
        if group >= 0:
            row[group] = 1.0
        for k in range(N_TAGS):
            if above_tags[i] >> k & 1:
                row[N_TAGS + k] = 1.0
        base = 2 * N_TAGS
        for k in range(N_WORDS):
            if b.word_bits >> k & 1:
                row[base + k] = 1.0
            if above_words[i] >> k & 1:
                row[base + N_WORDS + k] = 1.0
        size = text[i]
        row[base + 2 * N_WORDS :] = [
            b.depth,
            b.children,
            b.index,
            siblings,
            b.index / siblings,
            log(size),
            size / (nodes[i] + tags[i]),
            link[i] / max(1, size),
            marks[i] / max(1, words[i]),
            log(words[i]),
            links[i],
            paragraphs[i],
            nodes[i],
            share,
            size / total,
            seen / total,
            log(b.text),
            1.0 if i == 0 or b.tag in ("html", "body") else 0.0,
        ]
        seen += b.text
        out.append(row)
    return out


def decode(blocks: list[Block], raw: np.ndarray) -> list[bool]:
    """The most probable labelling of the tree in which all ancestors of a kept block are kept; the root and the body are."""
    keep = (-np.logaddexp(0, -raw)).tolist()
    drop = (-np.logaddexp(0, raw)).tolist()
    n = len(blocks)
    for i in range(n - 1, 0, -1):
        p = blocks[i].parent
        fixed = blocks[i].tag in ("html", "body")
        keep[p] += keep[i] if fixed else max(keep[i], drop[i])
        drop[p] += drop[i]
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[blocks[i].parent] and (blocks[i].tag in ("html", "body") or keep[i] > drop[i])
    return kept


def train_model(train_pages: int = 1000, seed: int = 11) -> BoostedTrees:
    maker = PageMaker(seed)
    x, y = [], []
    for _ in range(train_pages):
        blocks, _ = parse(maker.page(), labelled=True)
        x += node_features(blocks)
        kept = [True] * len(blocks)
        for i in range(1, len(blocks)):
            kept[i] = kept[blocks[i].parent] and blocks[i].keep != 0
        y += kept
    return fit_boosted(np.array(x), np.array(y, float))


@lru_cache(maxsize=1)
def default_model() -> BoostedTrees:
    return train_model()


def extract_batch(pages: list[str | None], model: BoostedTrees) -> list[str]:
    parsed = [parse(p) if p else None for p in pages]
    rows = [r for x in parsed if x for r in node_features(x[0])]
    raw = model.raw(np.array(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for x in parsed:
        if x is None:
            out.append("")
            continue
        blocks, segments = x
        kept = decode(blocks, raw[at : at + len(blocks)])
        at += len(blocks)
        out.append("\n".join(text for i, text in segments if kept[i]))
    return out


def extract_pages(pages: DataFrame, model: BoostedTrees | None = None, pages_at_once: int = 512) -> DataFrame:
    """page_id, url and the main text of every page.  One narrow pass."""
    shared = pages.sparkSession.sparkContext.broadcast(model or default_model())

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, pages_at_once):
                part = batch.slice(lo, pages_at_once)
                texts = extract_batch(part.column("html").to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return small_batches(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")).mapInArrow(run, "page_id long, url string, text string")
