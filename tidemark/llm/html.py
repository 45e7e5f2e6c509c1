"""Main text of web pages: flat blocks, classified by a decision tree.

A page is cut at block-level tags into a flat list of text blocks. A block is described by its word
count and the share of its words inside links, by the same two numbers of the blocks before and behind
it (beside other text, blocks of an aside are no neighbours), and by what encloses it: an article, or an
element that says by its tag, class, id or role that it is not part of the main text. A class or id says so by its last
word (``site-footer``), or by any if its other words are of layout only (``ad-box``): ``related-work`` and ``form-page``
do not. Words that name page-wide wrappers as well (``form``, ``notice``) are forgotten inside of an article. A decision tree, grown from a small labelled table, keeps or drops the block.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed and
joined in page order by one newline. Comments, scripts, styles, form fields and markup are no text; what
is never closed ends with the page. Null and empty pages, and pages without main text, give an empty text.
Pages are read whole, row by row; repeated rows give repeated results, an empty table an empty result.
Other columns are kept; an input column named like the result is replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, parts_of, texts_of

# HTML's element names by kind.
RAW = frozenset(
    "script style noscript template textarea select option svg iframe object canvas audio video button datalist annotation annotation-xml".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr math semantics mrow mi mo mn ms mtext mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd mstyle".split()
)
ASIDE_TAGS = frozenset("nav footer aside form fieldset dialog menu head title".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion banner banners cookie "
    "cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login breadcrumb "
    "breadcrumbs menu menus nav navbar navigation sidebar sidebars widget widgets related recommended recommendations share sharing "
    "social comment comments commentlist reply replies respond respondent disqus footer header masthead topbar toolbar pagination pager copyright "
    "legal disclaimer skip search form banner complementary contentinfo dialog teaser teasers outbrain taboola hidden feedback reactions".split()
)
# Words of wrappers around whole pages too: an article or main element inside is no aside.
WRAPPERS = frozenset(
    "form search legal notice notices alert alerts header share sharing social signup login subscribe subscription newsletter widget "
    "widgets banner consent skip copyright disclaimer feedback reactions hidden respond".split()
)
# Words that may be an article's subject when they name its sections.
SUBJECTS = frozenset("header legal disclaimer copyright search form feedback reactions login subscription".split())
LAYOUT = frozenset(
    "box block bar list lists item items wrap wrapper container content inner outer area section slot unit group panel row col column "
    "columns grid card cards link links text title top bottom left right site global inline mobile desktop sticky fixed main primary "
    "secondary post posts article articles story stories button buttons icon icons trail widget js ui the".split()
)
NOT_ITSELF = frozenset("has have with without no not non is hide show toggle after before".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SIBLINGS = frozenset("p li dt dd td th tr".split())
COMMENTS = frozenset("comment comments reply replies".split())
ARTICLE_TAGS = frozenset("article main".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")

FEATURES = ("words", "links", "words_before", "links_before", "words_behind", "links_behind", "article", "aside")


# What an element says of its content: main text; an aside around blocks, but not around an article; an aside.
TEXT, WRAPPER, ASIDE = range(3)


def _named(name: str, aside: frozenset[str]) -> int:
    """What one class, id or role says."""
    words = [w.lower() for w in WORDS.split(name) if w and not w.isdigit()]
    hits = aside.intersection(words)
    if not hits or (len(words) > 1 and words[0] in NOT_ITSELF):
        return TEXT
    if words[-1] not in hits and not all(w in hits or w in LAYOUT for w in words):
        return TEXT
    return WRAPPER if hits <= WRAPPERS else ASIDE


def _says(tag: str, attributes: str, in_article: bool) -> int:
    """What an element says of its content."""
    says = TEXT
    if tag in ASIDE_TAGS or (tag == "header" and not in_article):
        says = WRAPPER if tag == "form" else ASIDE
    if says == ASIDE or not attributes.strip() or tag in {"html", "body", "main"}:
        return says
    aside = COMMENTS if tag == "article" else ASIDE_WORDS - SUBJECTS if in_article else ASIDE_WORDS
    for found in ATTRIBUTE.finditer(attributes):
        name, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return ASIDE
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return ASIDE
        if name in {"class", "id", "role"} and tag not in HEADINGS:
            says = max([says, *(_named(n, aside) for n in value.split())])
    return says


def blocks(page: str) -> list[tuple[str, int, int, bool, bool]]:
    """Text, words, words in links, in an article, in an aside: of each block that has text."""
    out: list[tuple[str, int, int, bool, bool]] = []
    parts: list[tuple[str, bool]] = []
    stack: list[tuple[str, bool, int]] = []  # tag, in an article, what its elements say
    links = at = 0

    def close() -> None:
        text = " ".join(html.unescape("".join(t for t, _ in parts)).split())
        if text:
            linked = sum(len(html.unescape(t).split()) for t, inside in parts if inside)
            article, says = inside_of()
            out.append((text, len(text.split()), linked, article, says > TEXT))
        parts.clear()

    def inside_of() -> tuple[bool, int]:
        return stack[-1][1:] if stack else (False, TEXT)

    def leave(tag: str) -> None:
        if any(s[0] == tag for s in stack):
            while stack.pop()[0] != tag:
                pass

    while token := TOKEN.search(page, at):
        if token.start() > at:
            parts.append((page[at : token.start()], links > 0))
        at = token.end()
        tag, attributes = (token[1] or "").lower(), token[2] or ""
        if not tag:
            continue
        closing = page.startswith("</", token.start())
        if tag in RAW:
            if not closing and not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in INLINE:
            if tag == "a":
                links = max(0, links + (-1 if closing else 1))
            elif tag in VOID:
                parts.append((" ", links > 0))
            own = any(s[0] == tag for s in stack) if closing else tag not in VOID and _says(tag, attributes, True)
            if not own:
                continue
        else:
            links = 0
        close()
        if tag == "body" and not closing:
            stack.clear()
        if closing:
            leave(tag)
        elif tag not in VOID:
            if tag in SIBLINGS and stack and stack[-1][0] == tag:
                stack.pop()  # closed by the next of its kind
            article, says = inside_of()
            if tag in ARTICLE_TAGS and says == WRAPPER:
                says = TEXT
            stack.append((tag, article or tag in ARTICLE_TAGS, max(says, _says(tag, attributes, article))))
    if at < len(page):
        parts.append((page[at:], links > 0))
    close()
    return out


def described(found: list[tuple[str, int, int, bool, bool]]) -> np.ndarray:
    """The features of a page's blocks, a row each."""
    own = np.array([(w, min(1.0, k / w), a, s) for _, w, k, a, s in found], float).reshape(len(found), 4)
    edge = np.zeros((1, 2))
    before = np.concatenate([edge, own[:-1, :2]])
    behind = np.concatenate([own[1:, :2], edge])
    text, apart = own[:, 3] == 0, own[:, 3] == 1
    before[1:][text[1:] & apart[:-1]] = 0
    behind[:-1][text[:-1] & apart[1:]] = 0
    return np.concatenate([own[:, :2], before, behind, own[:, 2:]], axis=1)


# The labelled table. Columns as FEATURES, then 1 for main text.
LABELLED = (
    # menus, breadcrumbs, link lists
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0), (2, 1.0, 1, 1.0, 3, 1.0, 0, 0, 0),
    (3, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0), (1, 1.0, 1, 1.0, 12, 0.0, 0, 1, 0), (6, 1.0, 5, 1.0, 7, 1.0, 0, 0, 0),
    (12, 0.9, 3, 1.0, 9, 1.0, 0, 0, 0), (25, 0.8, 20, 0.9, 30, 0.7, 0, 0, 0), (4, 1.0, 90, 0.0, 5, 1.0, 0, 0, 0),
    (9, 0.8, 60, 0.0, 8, 0.9, 1, 0, 0), (5, 1.0, 4, 1.0, 6, 1.0, 1, 0, 0), (14, 0.7, 11, 0.8, 3, 1.0, 1, 0, 0),
    # adverts, notices, forms, comments, footers: long or short, in an article or not
    (9, 0.0, 1, 1.0, 8, 0.0, 0, 1, 0), (40, 0.0, 2, 1.0, 120, 0.0, 0, 1, 0), (12, 0.0, 80, 0.0, 70, 0.0, 1, 1, 0),
    (35, 0.0, 90, 0.0, 50, 0.0, 1, 1, 0), (6, 0.2, 70, 0.0, 0, 0.0, 0, 1, 0), (18, 0.1, 45, 0.0, 0, 0.0, 0, 1, 0),
    (60, 0.0, 30, 0.0, 25, 0.0, 0, 1, 0), (3, 0.0, 5, 0.0, 4, 0.0, 0, 1, 0), (22, 0.0, 15, 0.0, 28, 0.0, 1, 1, 0),
    (2, 0.5, 14, 0.0, 3, 0.3, 0, 1, 0), (100, 0.0, 70, 0.0, 80, 0.0, 0, 1, 0), (7, 0.0, 2, 0.0, 140, 0.0, 0, 1, 0),
    # stray lines outside of an article, among links or short lines
    (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0), (6, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0), (3, 0.0, 4, 0.0, 2, 0.0, 0, 0, 0),
    (5, 0.0, 0, 0.0, 3, 1.0, 0, 0, 0), (8, 0.3, 4, 0.0, 5, 0.5, 0, 0, 0), (2, 0.0, 3, 1.0, 0, 0.0, 0, 0, 0),
    # articles: headings, one-word paragraphs, long paragraphs, a few links
    (6, 0.0, 9, 0.0, 60, 0.0, 1, 0, 1), (10, 0.0, 1, 1.0, 45, 0.0, 1, 0, 1), (1, 0.0, 40, 0.0, 30, 0.0, 1, 0, 1),
    (1, 0.0, 1, 0.0, 1, 0.0, 1, 0, 1), (3, 0.0, 2, 0.0, 80, 0.0, 1, 0, 1), (90, 0.0, 8, 0.0, 75, 0.0, 1, 0, 1),
    (150, 0.1, 60, 0.0, 40, 0.0, 1, 0, 1), (55, 0.3, 70, 0.0, 12, 0.0, 1, 0, 1), (20, 0.0, 30, 0.0, 5, 0.1, 1, 0, 1),
    (400, 0.0, 6, 0.0, 7, 0.1, 1, 0, 1), (2, 0.0, 12, 0.0, 0, 0.0, 1, 0, 1), (8, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1),
    (7, 0.4, 25, 0.0, 30, 0.0, 1, 0, 1), (4, 0.0, 3, 1.0, 4, 0.0, 1, 0, 1), (30, 0.5, 20, 0.0, 25, 0.0, 1, 0, 1),
    *(
        (words, 0.0, *before, *behind, 1, aside, 1 - aside)
        for words in (1, 4, 12, 70)
        for before in ((0, 0.0), (3, 0.0), (2, 1.0), (50, 0.0))
        for behind in ((0, 0.0), (5, 0.0), (40, 0.0), (1, 1.0))
        for aside in (0, 1)
    ),
    # mostly linked blocks are main text between plain blocks only, outside of an article between paragraphs only;
    # others are main text in an article, as paragraphs, and as short lines beside a paragraph and not beside links;
    # nothing in an aside is
    *(
        (
            words, links, *before, *behind, article, aside,
            0 if aside else int(plain and (article or min(before[0], behind[0]) >= 30) if links > 0.6 else article or words > 8 or (plain and max(before[0], behind[0]) > 8)),
        )
        for words in (1, 4, 8, 9, 12, 40, 70)
        for links in (0.0, 0.5, 0.7, 1.0)
        for before in ((0, 0.0), (3, 0.0), (8, 0.5), (9, 0.0), (25, 0.0), (30, 0.2), (90, 0.0), (2, 1.0), (10, 0.7), (40, 0.8))
        for behind in ((0, 0.0), (4, 0.0), (8, 0.5), (9, 0.0), (25, 0.0), (30, 0.2), (90, 0.0), (3, 1.0), (12, 0.7), (40, 0.8))
        for article in (0, 1)
        for aside in (0, 1)
        for plain in (max(before[1], behind[1]) <= 0.6,)
    ),
    # pages without an article element: paragraphs by length and neighbours
    (80, 0.0, 6, 0.0, 70, 0.0, 0, 0, 1), (45, 0.1, 60, 0.0, 50, 0.1, 0, 0, 1), (120, 0.2, 3, 1.0, 4, 1.0, 0, 0, 1),
    (25, 0.0, 40, 0.0, 30, 0.0, 0, 0, 1), (30, 0.0, 2, 1.0, 60, 0.0, 0, 0, 1), (60, 0.0, 80, 0.0, 1, 1.0, 0, 0, 1),
    (6, 0.0, 70, 0.0, 90, 0.0, 0, 0, 1), (3, 0.0, 50, 0.0, 45, 0.0, 0, 0, 1), (9, 0.0, 35, 0.0, 110, 0.0, 0, 0, 1),
    (300, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1), (18, 0.0, 60, 0.0, 40, 0.0, 0, 0, 1), (40, 0.0, 4, 1.0, 20, 0.0, 0, 0, 1),
)


@dataclass(frozen=True)
class Node:
    """A split (``feature <= most`` goes left), or a leaf with its label."""

    label: bool
    feature: int = -1
    most: float = 0.0
    left: Node | None = None
    right: Node | None = None


def grow(table: np.ndarray, labels: np.ndarray, *, depth: int = 8) -> Node:
    """A decision tree by Gini impurity; of equal splits the first feature and the smallest value."""
    share = labels.mean() if len(labels) else 0.0
    if depth == 0 or share in (0.0, 1.0):
        return Node(bool(share >= 0.5))
    best = None
    for k in range(table.shape[1]):
        values = np.unique(table[:, k])
        for most in (values[:-1] + values[1:]) / 2:
            low = table[:, k] <= most
            impurity = sum(len(p) * p.mean() * (1 - p.mean()) for p in (labels[low], labels[~low]))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, k, most)
    if best is None:
        return Node(bool(share >= 0.5))
    _, k, most = best
    low = table[:, k] <= most
    return Node(
        bool(share >= 0.5), k, float(most),
        grow(table[low], labels[low], depth=depth - 1), grow(table[~low], labels[~low], depth=depth - 1),
    )


def trained() -> Node:
    table = np.array(LABELLED, float)
    return grow(table[:, :-1], table[:, -1])


def classify(tree: Node, table: np.ndarray) -> np.ndarray:
    out = np.zeros(len(table), bool)

    def fill(node: Node, rows: np.ndarray) -> None:
        if node.left is None:
            out[rows] = node.label
        else:
            low = table[rows, node.feature] <= node.most
            fill(node.left, rows[low])
            fill(node.right, rows[~low])

    fill(tree, np.arange(len(table)))
    return out


def main_text(page: str, tree: Node) -> str:
    found = blocks(page)
    if not found:
        return ""
    return "\n".join(f[0] for f, keep in zip(found, classify(tree, described(found)), strict=True) if keep)


def extract(df: DataFrame, page: str, *, result: str = "text", tree: Node | None = None, slice_bytes: int = 4 << 20) -> DataFrame:
    """``df`` without the page, with its main text."""
    tree = tree or trained()
    kept = [f for f in df.schema.fields if f.name not in {page, result}]
    new = T.StructType([*kept, T.StructField(result, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, page, slice_bytes):
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            columns.append(pa.array([main_text(p, tree) for p in texts_of(batch, page)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=new.names)

    return bounded_batches(df).mapInArrow(run, new)
