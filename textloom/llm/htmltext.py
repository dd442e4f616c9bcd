"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: runs of text between block-level tags.  Each block has features of
its ancestors (tags, and words of their class and id) and of its text (length, share of linked text,
punctuation).  The chain decides for all blocks of a page together, by Viterbi decoding, which belong
to the article; their texts are joined by line ends.

The model is trained here, on ``TRAIN_PAGES`` labelled pages of many layouts that are generated from a
seed, so that fitting does not depend on the input.

Defined results: null and empty pages, and pages without an article, have an empty text; unclosed and
stray tags are tolerated; a button, option, drawing or the like without an end tag ends at the next
sibling or with its parent; rows with the same id or page are handled one by one; only ``keep`` and the
html are read.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRAIN_PAGES = 400
SEED = 7
STEPS, RATE, RIDGE = 200, 0.3, 1e-3

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[a-z]+")
SPACES = re.compile(r"\s+")
ENDING = re.compile(r"[.!?…。][\"'”’»)\]]*$")

# Element names.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is text up to their end tag, whatever it holds.
RAW = frozenset("script style textarea title iframe xmp".split())
# Elements that are never part of an article, but may have lost their end tag.
HIDDEN = frozenset("noscript template svg select option button".split())
HIDDEN_TAG = re.compile(rf"<(?:{'|'.join(sorted(HIDDEN))})\b", re.I)
SVG = frozenset(
    "g path rect circle ellipse line polyline polygon text tspan textpath defs use symbol mask clippath "
    "lineargradient radialgradient stop filter pattern marker desc metadata image animate foreignobject".split()
)
CLOSES_ITSELF = frozenset("p li td th tr dt dd option".split())

# Words of class, id and role by what they tell.
NAMES = {
    "advert": "ad ads advert advertisement advertising promo promotion sponsor sponsored banner adsense",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager tabs toolbar toc",
    "side": "sidebar aside widget related recommended share sharing social rail secondary more",
    "foot": "footer foot copyright legal colophon bottom",
    "head": "header masthead logo topbar top site branding",
    "comment": "comment comments reply replies respond disqus discussion",
    "notice": "cookie cookies consent gdpr notice alert popup modal newsletter subscribe signup banner overlay warning",
    "form": "form search login signin",
    "content": "content article post entry main story text body page",
}
NAME_OF: dict[str, list[int]] = {}
for _at, _words in enumerate(NAMES.values()):
    for _word in _words.split():
        NAME_OF.setdefault(_word, []).append(_at)
TAGS = (
    "nav header footer aside article main form section ul ol li p h1 h2 h3 h4 h5 h6 td blockquote pre "
    "figcaption address dd table"
).split()
TAG_AT = {t: i for i, t in enumerate(TAGS)}
PARENTS = len(TAGS) + len(NAMES)
FEATURES = 2 * PARENTS + 14  # the last ones: see features_of


@dataclass
class Block:
    text: str
    above: frozenset[int]
    nearest: frozenset[int]
    linked: int


def _told(tag: str, attributes: str) -> frozenset[int]:
    """Features that an element passes on to what it holds."""
    found = {TAG_AT[tag]} if tag in TAG_AT else set()
    if "=" in attributes:
        for match in NAMED.finditer(attributes):
            for word in WORD.findall((match[1] or match[2] or match[3] or "").lower()):
                found.update(len(TAGS) + k for k in NAME_OF.get(word, ()))
    return frozenset(found)


def _tag(match: re.Match) -> tuple[str, bool, str]:
    """Name, whether it is an end tag, and attributes; no name if it is not a tag."""
    return (match[2] or match[5] or "").lower(), bool(match[1] or match[4]), match[3] or match[6] or ""


def _after_raw(page: str, name: str, at: int) -> int:
    end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
    return end.end() if end else len(page)


def hidden_ends(page: str) -> dict[int, int]:
    """Where the hidden elements that have an end tag of their own begin and end.

    An end tag ends the innermost open element of its name, and all that are open inside it: those
    have lost their own.  Only its own end tag, not one of a parent, ends a template.
    """
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    opened: dict[str, int] = {}
    templates: list[dict[str, int]] = []
    at = 0
    while match := TOKEN.search(page, at):
        at = match.end()
        name, closing, attributes = _tag(match)
        if not name or name in VOID or name in INLINE:
            continue
        if name in RAW:
            if not closing and not attributes.endswith("/"):
                at = _after_raw(page, name, at)
        elif not closing:
            if not (attributes.endswith("/") and (name in HIDDEN or name in SVG)):
                stack.append((name, match.start()))
                if name == "template":
                    templates.append(opened)
                    opened = {"template": 1}
                else:
                    opened[name] = opened.get(name, 0) + 1
        elif opened.get(name):
            while True:
                top, start = stack.pop()
                if top == "template":
                    opened = templates.pop()
                else:
                    opened[top] -= 1
                if top == name:
                    break
            if name in HIDDEN:
                ends[start] = at
    return ends


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks in page order, with white space made plain and references decoded."""
    found: list[Block] = []
    empty: frozenset[int] = frozenset()
    stack: list[tuple[str, frozenset[int], frozenset[int]]] = []
    parts: list[str] = []
    linked, in_link, at = 0, 0, 0
    ends = hidden_ends(page) if HIDDEN_TAG.search(page) else {}
    hidden = False  # within a hidden element without an end tag

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not hidden:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                above = stack[-1][1] if stack else empty
                found.append(Block(text, above, stack[-1][2] if stack else empty, linked))
            parts.clear()
            linked = 0

    def close(name: str) -> None:
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] == name:
                del stack[depth:]
                return

    size = len(page)
    while at < size:
        match = TOKEN.search(page, at)
        if not match:
            add(page[at:])
            break
        add(page[at : match.start()])
        at = match.end()
        name, closing, attributes = _tag(match)
        if not name:
            if match[0].startswith("<![CDATA["):
                add(html.escape(match[0][9:].removesuffix("]]>"), quote=False))
            continue
        if name in RAW:
            if not closing and not attributes.endswith("/"):
                at = _after_raw(page, name, at)
            continue
        if name in HIDDEN:
            if not closing and not attributes.endswith("/"):
                if match.start() in ends:
                    at = ends[match.start()]
                else:
                    hidden = True
            continue
        if hidden and name in SVG:
            continue
        if name in INLINE:
            if name == "br":
                parts.append(" ")
            elif name == "a":
                in_link = 0 if closing else 1
            continue
        flush()
        in_link, hidden = 0, False
        if closing:
            close(name)
        elif name not in VOID:
            if name in CLOSES_ITSELF and stack and stack[-1][0] == name:
                stack.pop()
            elif stack and stack[-1][0] == "p":
                stack.pop()
            told = _told(name, attributes)
            above = stack[-1][1] | told if stack else told
            stack.append((name, above, told))
    flush()
    return found


def features_of(blocks: list[Block]) -> list[list[int]]:
    """Indices of the features that hold for each block; the first always does."""
    rows = []
    for at, block in enumerate(blocks):
        size = len(block.text)
        words = block.text.count(" ") + 1
        row = [0, *(1 + k for k in block.above), *(1 + PARENTS + k for k in block.nearest)]
        base = 1 + 2 * PARENTS
        row.append(base + (0 if words < 4 else 1 if words < 10 else 2 if words < 25 else 3))
        if 2 * block.linked > size:
            row.append(base + 4)
        elif block.linked:
            row.append(base + 5)
        if ENDING.search(block.text[-8:]):
            row.append(base + 6)
        if "©" in block.text:
            row.append(base + 7)
        if at == 0:
            row.append(base + 9)
        if at == len(blocks) - 1:
            row.append(base + 10)
        if size > 300:
            row.append(base + 11)
        if not block.above:
            row.append(base + 12)
        rows.append(row)
    return rows


@dataclass
class ChainModel:
    """Weights of the label "article" against "other", and scores of neighbouring labels."""

    weights: np.ndarray
    pairs: np.ndarray

    def scores(self, rows: list[list[int]]) -> list[float]:
        weights = self.weights.tolist()
        return [sum([weights[k] for k in row]) for row in rows]

    def decode(self, rows: list[list[int]]) -> list[bool]:
        """Viterbi: the best labels of a page together."""
        (oo, oa), (ao, aa) = self.pairs.tolist()
        other, article, back = 0.0, 0.0, []
        for at, score in enumerate(self.scores(rows)):
            if at == 0:
                other, article = 0.0, score
                continue
            from_other = (other >= article + ao - oo, other + oa >= article + aa)
            other, article = (
                max(other + oo, article + ao),
                max(other + oa, article + aa) + score,
            )
            back.append(from_other)
        if not rows:
            return []
        label = article > other
        out = [label]
        for came_other, came_article in reversed(back):
            label = not (came_article if label else came_other)
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[list[list[int]], list[bool]]]) -> ChainModel:
    """Maximum likelihood with forward and backward sums over all pages at once."""
    weights, pairs = np.zeros(FEATURES), np.zeros((2, 2))
    seen_w, seen_p = np.full(FEATURES, 1e-6), np.full((2, 2), 1e-6)
    sizes = np.array([len(rows) for rows, _ in pages])
    shape = (len(pages), int(sizes.max(initial=0)))
    place = np.flatnonzero(np.arange(shape[1])[None, :] < sizes[:, None])
    flat_rows = [row for rows, _ in pages for row in rows]
    feature = np.array([k for row in flat_rows for k in row], dtype=np.int64)
    owner = np.repeat(place, [len(row) for row in flat_rows])
    truth = np.zeros(shape, dtype=np.int64)
    truth.ravel()[place] = [label for _, gold in pages for label in gold]
    inside = np.zeros(shape, dtype=bool)
    inside.ravel()[place] = True
    seen_pairs = np.zeros((2, 2))
    linked = inside[:, 1:]
    np.add.at(seen_pairs, (truth[:, :-1][linked], truth[:, 1:][linked]), 1)
    for _ in range(STEPS):
        score = np.bincount(owner, weights[feature], minlength=truth.size).reshape(shape)
        single, double = _marginals(score, inside, pairs)
        error = np.where(inside, single - truth, 0).ravel()
        slope_w = np.bincount(feature, error[owner], minlength=FEATURES) / len(pages) + RIDGE * weights
        slope_p = (double - seen_pairs) / len(pages) + RIDGE * pairs
        seen_w += slope_w**2
        seen_p += slope_p**2
        weights = weights - RATE * slope_w / np.sqrt(seen_w)
        pairs = pairs - RATE * slope_p / np.sqrt(seen_p)
    return ChainModel(weights, pairs)


def _marginals(score: np.ndarray, inside: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of "article" for each block, and expected counts of neighbouring labels."""
    pages, n = score.shape
    unary = np.stack((np.zeros_like(score), score), axis=2)
    ahead, behind = np.zeros((pages, n, 2)), np.zeros((pages, n, 2))
    ahead[:, 0] = unary[:, 0]
    for k in range(1, n):
        step = np.logaddexp(*np.moveaxis(ahead[:, k - 1, :, None] + pairs, 1, 0)) + unary[:, k]
        ahead[:, k] = np.where(inside[:, k, None], step, ahead[:, k - 1])
    for k in range(n - 2, -1, -1):
        step = np.logaddexp(*np.moveaxis(pairs + (unary[:, k + 1] + behind[:, k + 1])[:, None, :], 2, 0))
        behind[:, k] = np.where(inside[:, k + 1, None], step, 0)
    whole = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])[:, None]
    single = np.exp(ahead[:, :, 1] + behind[:, :, 1] - whole)
    joint = ahead[:, :-1, :, None] + pairs + (unary[:, 1:] + behind[:, 1:])[:, :, None, :]
    joint = np.exp(joint - whole[:, :, None, None])
    return single, joint[inside[:, 1:]].sum(axis=0)


# ---- labelled pages ----------------------------------------------------------------------------


class _Maker:
    """Generates pages of varied layout, and the texts of the blocks that belong to the article."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def words(self, low: int, high: int, end: str = "") -> str:
        rng = self.rng
        made = ["".join(rng.choice(("ta", "ri", "no", "sel", "ma", "ku", "en", "or")) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
        made[0] = made[0].capitalize()
        return " ".join(made) + end

    def links(self, low: int, high: int) -> str:
        rng = self.rng
        items = [f'<a href="/x">{self.words(1, 4)}</a>' for _ in range(rng.randint(low, high))]
        if rng.random() < 0.6:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return rng.choice((" | ", " ", " &middot; ")).join(items)

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(3, 18, self.rng.choice("...?!")) for _ in range(self.rng.randint(low, high)))

    def box(self, choices: Sequence[tuple[str, str]], inner: str) -> str:
        tag, name = self.rng.choice(choices)
        attribute = f' {self.rng.choice(("class", "id"))}="{name}"' if name else ""
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def other(self) -> str:
        """One piece of a page that is no article."""
        rng = self.rng
        text = self.sentences(1, 3) if rng.random() < 0.7 else self.words(2, 8)
        pieces = (
            lambda: self.box((("nav", ""), ("div", "menu"), ("div", "navbar"), ("ul", "nav"), ("div", "breadcrumbs")), self.links(2, 8)),
            lambda: self.box((("div", "ad"), ("div", "ads"), ("div", "advert"), ("aside", "sponsored"), ("div", "promo-banner"), ("section", "advertisement")), rng.choice((text, f"<p>{text}</p>"))),
            lambda: self.box((("aside", ""), ("div", "sidebar"), ("section", "related"), ("div", "widget"), ("div", "share")), rng.choice((self.links(1, 5), f"<p>{text}</p>", f"<h3>{self.words(1, 4)}</h3>{self.links(2, 4)}"))),
            lambda: self.box((("div", "cookie-notice"), ("div", "notice"), ("div", "consent"), ("div", "newsletter"), ("div", "popup"), ("section", "alert")), rng.choice((text, f"<p>{text}</p>"))),
            lambda: self.box((("form", ""), ("form", "search"), ("div", "login-form")), f"<label>{self.words(1, 5)}</label><input type='text'><p>{text}</p>"),
            lambda: self.box(
                (("div", "comments"), ("section", "comments"), ("ol", "comment-list"), ("div", "disqus")),
                "".join(rng.choice((f"<p>{self.sentences(1, 4)}</p>", f'<div class="comment"><p>{self.sentences(1, 3)}</p></div>', f"<li>{self.sentences(1, 2)}</li>")) for _ in range(rng.randint(1, 4))),
            ),
        )
        return rng.choice(pieces)()

    def article(self) -> tuple[str, list[str]]:
        """Markup of an article and the texts of its blocks; other pieces may stand inside."""
        rng, out, gold = self.rng, [], []

        def block(tag: str, text: str, closed: bool = True) -> None:
            gold.append(text)
            inner = text
            chance = rng.random()
            if chance < 0.04 and tag != "h1":
                inner = f'<a href="/y">{text}</a>'
            elif chance < 0.15:
                head, _, tail = text.partition(" ")
                inner = f'<a href="/y">{head}</a> {tail}' if tail else text
            elif rng.random() < 0.2:
                inner = f"<b>{text}" + ("</b>" if closed else "")
            out.append(f"<{tag}>{inner}" + (f"</{tag}>" if closed else "<br>"))

        # Some layouts have neither paragraphs nor headings, but divisions.
        bare = rng.random() < 0.15
        title = rng.random()
        if title < 0.7:
            block("h1", self.words(2, 12, rng.choice(("", ".", "?"))))
        elif title < 0.8:
            gold.append(self.words(2, 12))
            name = rng.choice(("title", "entry-title", "post-title", "headline"))
            out.append(f'<div class="{name}">{gold[-1]}</div>')
        elif title < 0.88:
            gold.append(self.words(2, 12))
            out.append(f"<header><h1>{gold[-1]}</h1></header>")
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            if kind < 0.66:
                text = self.words(1, 3, ".") if rng.random() < 0.15 else self.sentences(1, 7)
                block("div" if bare else "p", text, closed=bare or rng.random() < 0.85)
            elif kind < 0.76:
                block(rng.choice(("h2", "h3", "h4")), self.words(1, 7))
            elif kind < 0.84:
                out.append("<ul>")
                for _ in range(rng.randint(1, 4)):
                    block("li", self.words(2, 15, rng.choice(("", "."))))
                out.append("</ul>")
            elif kind < 0.9:
                block(rng.choice(("blockquote", "pre", "figcaption", "div", "dd")), self.sentences(1, 3))
            elif kind < 0.92:
                out.append("<table><tr>")
                for _ in range(rng.randint(1, 4)):
                    block("td", self.words(1, 5))
                out.append("</tr></table>")
            elif gold:
                out.append(self.other())
        return "".join(out), gold

    def page(self) -> tuple[str, list[str]]:
        rng = self.rng
        inner, gold = self.article()
        if rng.random() < 0.04:
            inner, gold = "", []
        before = [self.other() for _ in range(rng.randint(0, 3))]
        after = [self.other() for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.6:
            before.insert(0, self.box((("header", ""), ("div", "header"), ("div", "masthead"), ("header", "site-header")), rng.choice((self.words(1, 4), f"<h1>{self.words(1, 4)}</h1>", f"<p>{self.words(1, 6)}</p>{self.links(2, 5)}"))))
        if rng.random() < 0.8:
            after.append(self.box((("footer", ""), ("div", "footer"), ("div", "copyright")), rng.choice(("&copy; ", "")) + self.words(1, 5) + rng.choice((" &middot; ", " ")) + self.sentences(1, 2)))
        if rng.random() < 0.2:
            # An article alone, without anything around it.
            before, after = [], []
        body = self.box((("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article-body"), ("section", "entry"), ("div", "story"), ("div", "")), inner) if rng.random() < 0.93 else inner
        if rng.random() < 0.3:
            body = self.box((("main", ""), ("div", "page"), ("div", "wrapper"), ("div", "container")), body)
        return "<html><head><title>x</title></head><body>" + "".join(before) + body + "".join(after) + "</body></html>", gold


def labelled_pages(count: int = TRAIN_PAGES, seed: int = SEED) -> list[tuple[str, list[str]]]:
    """Generated pages with the texts of their article blocks."""
    maker = _Maker(seed)
    return [maker.page() for _ in range(count)]


def fit(pages: list[tuple[str, list[str]]] | None = None) -> ChainModel:
    """Train on pages with the texts of their article blocks, in page order."""
    examples = []
    for page, gold in labelled_pages() if pages is None else pages:
        blocks, labels, at = blocks_of(page), [], 0
        for block in blocks:
            hit = at < len(gold) and SPACES.sub(" ", gold[at]).strip() == block.text
            labels.append(hit)
            at += hit
        if blocks:
            examples.append((features_of(blocks), labels))
    return train(examples)


def main_text(page: str, model: ChainModel) -> str:
    blocks = blocks_of(page)
    kept = model.decode(features_of(blocks))
    return "\n".join(b.text for b, k in zip(blocks, kept, strict=True) if k)


def extract(
    df: DataFrame, model: ChainModel, page: str = "html", keep: Sequence[str] = ("page_id", "url")
) -> DataFrame:
    """``keep, text, n_chars`` for every row."""
    inner = [f"_k{i}" for i in range(len(keep))]
    schema = T.StructType(
        [T.StructField(k, df.schema[c].dataType) for c, k in zip(keep, inner, strict=True)]
        + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py() or "", model) for p in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(keep)],
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=schema.names,
            )

    rows = df.select(*[F.col(c).alias(k) for c, k in zip(keep, inner, strict=True)], F.col(page).alias("_read"))
    return rows.mapInArrow(run, schema).select(
        *[F.col(k).alias(c) for c, k in zip(keep, inner, strict=True)], "text", "n_chars"
    )
