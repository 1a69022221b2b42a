"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element with text and every text leaf is a variable: content or not. Its own potential is
log-linear in its tag, what its class, id and role hint at, and the length, links and place of its
text; a potential between parent and child, per kind of child, says how far they agree. Sum-product
message passing, upward from the leaves and downward from the root, gives each variable's exact marginal,
and the leaves whose marginal is at least one half are the text. All pages of a batch are one forest,
passed level by level.

The weights maximise the penalised likelihood of labelled pages: ``labelled_pages`` lays out articles
and everything else a page can hold in many ways (with and without telling tags and names, comments and
adverts inside the article) and marks the article. They are made from a seed, so training is the same
everywhere and needs nothing of the tables; ``TRAINING_PAGES`` bounds it. What a page of the caller's own
says in an attribute ``data-main`` (1 or 0, which holds for all below it) trains as well.

Pages are handled whole, each by itself: rows only flow through and nothing is shuffled.

Defined cases: a null or empty page has an empty text of length 0; ids and urls may be null or
repeated, each row is judged by itself; an empty table gives an empty result. Other columns pass
through; a column that has the name of an added one stops the call with an error.
"""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm import dom
from tripmill.llm.common import for_python

# --- parameters -------------------------------------------------------------------------------------
TRAINING_PAGES = 400
SEED = 42
STEPS = 250
RATE = 0.1
PENALTY = 1e-3
LEAST_MARGINAL = 0.5

ADDED = ("text", "n_chars")
FOUND = "text string, n_chars long"

#: What parts of names hint at.
HINTS = {
    "content": "article content entry post story main body text page prose copy",
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs pagination pager toc tabs links sitemap "
            "skip topnav subnav",
    "header": "header masthead topbar banner logo branding head",
    "footer": "footer foot bottom colophon copyright legal imprint credits",
    "side": "sidebar aside side widget widgets related recommended recommendations more teaser "
            "trending popular rail complementary archive tags meta share sharing social byline",
    "notice": "notice notices cookie cookies consent gdpr alert warning message newsletter subscribe "
              "subscription popup modal overlay paywall toast noscript dialog announcement disclaimer",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion "
              "banner-ad adsense adslot commercial",
    "form": "form search login signup register contact input field fieldset button control",
    "comment": "comment comments commentlist reply replies respond discussion disqus reader readers "
               "feedback responses",
    "hidden": "hidden",
}
_GROUP = {word: i for i, words in enumerate(HINTS.values()) for word in words.split()}
_PART = re.compile(r"[a-z]+")


@functools.lru_cache(maxsize=50_000)
def hinted(names: str) -> tuple[int, ...]:
    """Groups of hints in class, id and role names."""
    return tuple(sorted({_GROUP[p] for p in _PART.findall(names) if p in _GROUP}))


# ---- pages as a forest -------------------------------------------------------------------------------

N_TAGS, N_HINTS = len(dom.TAGS) + 1, len(HINTS)
LENGTHS = (15, 40, 100, 300)       # of a leaf's characters
SHARES = (0.02, 0.1, 0.3, 0.6, 0.9)   # of a page's characters below an element
LINKED = (0.01, 0.3, 0.7)          # of the characters that are links


def _steps(first: int, bounds: Sequence[float]) -> int:
    return first + len(bounds) + 1


_AT_HINTS = N_TAGS
_AT_INLINE = _AT_HINTS + N_HINTS
_AT_LENGTH = _AT_INLINE + N_HINTS
_AT_SHARE = _steps(_AT_LENGTH, LENGTHS)
_AT_LINKED = _steps(_AT_SHARE, SHARES)
_AT_LINKED_LEAF = _steps(_AT_LINKED, LINKED)
_AT_SENTENCE = _steps(_AT_LINKED_LEAF, LINKED)
_AT_SIGN = _AT_SENTENCE + 2
N_FEATURES = _AT_SIGN + 1


@dataclass
class Forest:
    """Variables of some pages: parents stand before children; roots have parent -1."""

    parents: np.ndarray
    kinds: np.ndarray                       # number of the tag, which chooses the edge's potential
    rows: np.ndarray                        # features: (variable, feature) entries
    columns: np.ndarray
    levels: list[np.ndarray]                # variables by distance from their root
    leaves: list[tuple[int, int, str]]      # (page, variable, text) in page order
    labels: np.ndarray                      # 1, 0, or -1 if unknown; only where pages have marks
    shares: np.ndarray                      # of a variable in its page, so that pages weigh alike


def forest(pages: Sequence[dom.Page]) -> Forest:
    """The elements that hold text, and their features."""
    tags = np.fromiter((t for p in pages for t in p.tags), np.int64)
    sizes = np.array([len(p.tags) for p in pages], np.int64)
    starts = np.cumsum(sizes) - sizes
    parents = np.fromiter((q for p in pages for q in p.parents), np.int64)
    roots = parents < 0
    parents = np.where(roots, -1, parents + np.repeat(starts, sizes))
    n = len(tags)
    chars, links = np.zeros(n), np.zeros(n)
    leaves, labels = [], {}
    rows, columns = [], []
    for page, (p, start) in enumerate(zip(pages, starts.tolist())):
        for node, (text, n_links, inline) in p.texts.items():
            at = start + node
            chars[at] = size = len(text) - text.count(" ")
            links[at] = min(n_links, size)
            leaves.append((page, at, text))
            for names, held in inline.items():
                if 2 * held >= size:
                    for group in hinted(names):
                        rows.append(at)
                        columns.append(_AT_INLINE + group)
            rows.append(at)
            columns.append(_AT_SENTENCE + (text[-1] in ".!?…:;»”\""))
            if "©" in text:
                rows.append(at)
                columns.append(_AT_SIGN)
        for node, names in enumerate(p.hints):
            if names:
                for group in hinted(names):
                    rows.append(start + node)
                    columns.append(_AT_HINTS + group)
        for node, label in p.labels.items():
            labels[start + node] = int(label == "1")
    # Characters and links below every element, from the lowest level up.
    below, linked = chars.copy(), links.copy()
    depth = np.zeros(n, np.int64)
    levels = _levels(parents, depth)
    for level in reversed(levels[1:]):
        np.add.at(below, parents[level], below[level])
        np.add.at(linked, parents[level], linked[level])
    whole = below[starts][np.repeat(np.arange(len(pages)), sizes)] if n else below
    # Only what holds text is a variable; numbers are given anew.
    is_leaf = tags == dom.TEXT
    held = (below > 0) | roots
    number = np.cumsum(held) - 1
    some = np.maximum(below, 1)
    here = np.arange(n)
    extra = [(here, tags), (here, _AT_SHARE + np.searchsorted(SHARES, below / np.maximum(whole, 1))),
             (here[is_leaf], _AT_LENGTH + np.searchsorted(LENGTHS, chars[is_leaf])),
             (here[~is_leaf], _AT_LINKED + np.searchsorted(LINKED, (linked / some)[~is_leaf])),
             (here[is_leaf], _AT_LINKED_LEAF + np.searchsorted(LINKED, (linked / some)[is_leaf]))]
    rows = np.concatenate([np.array(rows, np.int64), *[r for r, _ in extra]])
    columns = np.concatenate([np.array(columns, np.int64), *[c for _, c in extra]])
    kept = held[rows]
    known = np.full(n, -1)
    if labels:
        known = _spread(labels, parents, levels, chars, is_leaf)
    return Forest(
        np.where(parents < 0, -1, number[parents])[held], tags[held], number[rows[kept]],
        columns[kept], [number[level[held[level]]] for level in levels if held[level].any()],
        [(page, int(number[i]), text) for page, i, text in leaves], known[held],
        (1 / np.repeat(np.add.reduceat(held, starts), sizes))[held])


def _levels(parents: np.ndarray, depth: np.ndarray) -> list[np.ndarray]:
    """Elements by depth."""
    for i, parent in enumerate(parents.tolist()):
        if parent >= 0:
            depth[i] = depth[parent] + 1
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.cumsum(np.bincount(depth))[:-1]) if len(depth) else []


def _spread(labels: dict[int, int], parents: np.ndarray, levels: list[np.ndarray],
            chars: np.ndarray, is_leaf: np.ndarray) -> np.ndarray:
    """Marks hold for all below them; what holds no mark goes by most characters below it."""
    known = np.full(len(parents), -1)
    known[list(labels)] = list(labels.values())
    for level in levels[1:]:
        unmarked = level[known[level] < 0]
        known[unmarked] = known[parents[unmarked]]
    own = known.copy()
    content = np.where(is_leaf & (own == 1), chars, 0.0)
    total = np.where(is_leaf, chars, 0.0)
    for level in reversed(levels[1:]):
        np.add.at(content, parents[level], content[level])
        np.add.at(total, parents[level], total[level])
    return np.where(is_leaf, np.maximum(own, 0), 2 * content >= np.maximum(total, 1)).astype(int)


# ---- the model ---------------------------------------------------------------------------------------

@dataclass
class Model:
    """Weights of the features (towards content) and potentials (kind, state of parent, of child),
    which an edge has from the kind of its child and, behind those, from the kind of its parent."""

    weights: np.ndarray
    edges: np.ndarray


def _own(model: Model, trees: Forest) -> np.ndarray:
    """Own potentials of the variables: not content, content."""
    score = np.bincount(trees.rows, model.weights[trees.columns], len(trees.parents))
    return np.stack([np.zeros_like(score), score], axis=1)


def marginals(model: Model, trees: Forest) -> tuple[np.ndarray, np.ndarray]:
    """Chance that a variable is content, and of (parent, child) states, by sum-product."""
    inner = _own(model, trees)                     # own potential and what came from below
    n = len(inner)
    upward, outer = np.zeros((n, 2)), np.zeros((n, 2))
    edge = model.edges[trees.kinds] + model.edges[N_TAGS + trees.kinds[trees.parents]]
    for level in reversed(trees.levels[1:]):
        parent = trees.parents[level]
        upward[level] = np.logaddexp(edge[level, :, 0] + inner[level, None, 0],
                                     edge[level, :, 1] + inner[level, None, 1])
        np.add.at(inner, parent, upward[level])
    whole, pairs = inner.copy(), np.zeros((n, 2, 2))
    for level in trees.levels[1:]:
        rest = whole[trees.parents[level]] - upward[level]
        outer[level] = np.logaddexp(rest[:, 0, None] + edge[level, 0], rest[:, 1, None] + edge[level, 1])
        whole[level] = inner[level] + outer[level]
        joint = rest[:, :, None] + edge[level] + inner[level][:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        pairs[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
    return 1 / (1 + np.exp(np.clip(whole[:, 0] - whole[:, 1], -500, 500))), pairs


def train(pages: Iterable[str], steps: int = STEPS, rate: float = RATE,
          penalty: float = PENALTY) -> Model:
    """Weights under which the marks of labelled pages are most likely, by gradient steps."""
    trees = forest([dom.parse(page) for page in pages])
    y = trees.labels.astype(float)
    if not len(y) or y.min() < 0:
        raise ValueError("every page needs a mark of its main text")
    child = np.flatnonzero(trees.parents >= 0)
    seen = np.zeros((len(y), 2, 2))
    seen[child, trees.labels[trees.parents[child]], trees.labels[child]] = 1
    shares, total = trees.shares, trees.shares.sum()
    model = Model(np.zeros(N_FEATURES), np.zeros((2 * N_TAGS, 2, 2)))
    state = [(np.zeros_like(v), np.zeros_like(v)) for v in (model.weights, model.edges)]
    for step in range(1, steps + 1):
        chance, pairs = marginals(model, trees)
        by_feature = np.bincount(trees.columns, (shares * (y - chance))[trees.rows], N_FEATURES)
        by_edge = np.zeros_like(model.edges)
        missed = (shares[:, None, None] * (seen - pairs))[child]
        np.add.at(by_edge, trees.kinds[child], missed)
        np.add.at(by_edge, N_TAGS + trees.kinds[trees.parents[child]], missed)
        for value, slope, (mean, square) in zip(
                (model.weights, model.edges), (by_feature, by_edge), state):
            slope = slope / total - penalty * value
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            value += rate * (mean / (1 - 0.9 ** step)) / (
                np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return model


def extract(model: Model, pages: Sequence[str | None]) -> list[str]:
    """The main text of each page: its blocks of content in page order, a line each."""
    trees = forest([dom.parse(page or "") for page in pages])
    chance, _ = marginals(model, trees)
    lines = [[] for _ in pages]
    for page, variable, text in trees.leaves:
        if chance[variable] >= LEAST_MARGINAL:
            lines[page].append(text)
    return ["\n".join(blocks) for blocks in lines]


def with_main_text(pages: DataFrame, model: Model | None = None, html: str = "html") -> DataFrame:
    """The rows with the main text of their page and its code points."""
    clash = [c for c in pages.columns if c.lower() in (*ADDED, "_found")]
    if clash:
        raise ValueError(f"columns {clash} have names of added ones")
    for_python(pages.sparkSession)
    model = model or standard_model()

    @F.pandas_udf(FOUND)
    def find(column: pd.Series) -> pd.DataFrame:
        texts = []
        for begin in range(0, len(column), 64):
            texts += extract(model, column.iloc[begin:begin + 64].tolist())
        return pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})

    return pages.select("*", find(F.col(f"`{html}`")).alias("_found")).select(
        *[F.col(f"`{c}`") for c in pages.columns], "_found.text", "_found.n_chars")


# ---- labelled pages ----------------------------------------------------------------------------------

_SYLLABLES = "ba ne ti ro lu se ka mi do fa re un on an er ist ent que ous ção für ñad été".split()


class _Writer:
    """Pages of every kind from one source of chance."""

    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        return " ".join("".join(self.r.choices(_SYLLABLES, k=self.r.randint(1, 4)))
                        for _ in range(self.r.randint(low, high)))

    def sentence(self, low: int = 3, high: int = 25) -> str:
        return self.words(low, high).capitalize() + self.r.choice("....!?")

    def prose(self, most: int = 6) -> str:
        text = " ".join(self.sentence() for _ in range(self.r.randint(1, most)))
        kind = self.r.random()
        if kind < 0.25:    # lists, code, cut and damaged text are content as well
            joint = self.r.choice((" ", " | ", "### ", ", ", " = "))
            text = joint.join(self.words(1, 2) for _ in range(self.r.randint(1, 60)))
        elif kind < 0.4:
            text = text[:self.r.randint(1, len(text))].rstrip(".!? ")
        if self.r.random() < 0.2:
            text = f"{text} <a href='/x'>{self.words(1, 4)}</a> {self.sentence()}"
        if self.r.random() < 0.15:
            text = f"<b>{text}<br>" if self.r.random() < 0.5 else f"<em>{text}</em>"
        return text

    def named(self, tag: str, names: str, inner: str, mark: int | None = None) -> str:
        """An element, with or without a telling name."""
        given = self.r.choice(names.split())
        kind = self.r.random()
        name = (f' class="{given}"' if kind < 0.5 else f' id="{given}-{self.r.randint(1, 9)}"'
                if kind < 0.7 else f' class="x{self.r.randint(1, 99)} {given}"' if kind < 0.85 else "")
        label = "" if mark is None else f' data-main="{mark}"'
        return f"<{tag}{name}{label}>{inner}</{tag}>"

    def links(self) -> str:
        item = self.r.choice(("<li><a href='/{0}'>{0}</a></li>", "<a href='/{0}'>{0}</a> | ",
                              "<li><a href='/{0}'>{0}</a>"))
        inside = "".join(item.format(self.words(1, 3)) for _ in range(self.r.randint(2, 12)))
        return f"<ul>{inside}</ul>" if item.startswith("<li>") else inside

    def plain(self, low: int, high: int) -> str:
        tag = self.r.choice(("p", "p", "div", "span", ""))
        text = " ".join(self.sentence() for _ in range(self.r.randint(low, high)))
        return f"<{tag}>{text}</{tag}>" if tag else text

    def menu(self) -> str:
        return self.named(self.r.choice(("nav", "nav", "div", "ul")),
                          "nav menu navbar breadcrumb pagination toc", self.links(), 0)

    def header(self) -> str:
        inside = f"<h2>{self.words(1, 4)}</h2>" + self.r.choice((self.plain(1, 1), self.links(), ""))
        return self.named(self.r.choice(("header", "div")), "header masthead topbar logo", inside, 0)

    def footer(self) -> str:
        sign = self.r.choice(("&copy; ", "&copy; ", ""))
        inside = f"{sign}{self.words(1, 3)} &middot; {self.sentence()}" + self.r.choice(
            (self.links(), "", "", self.plain(1, 2)))
        return self.named(self.r.choice(("footer", "footer", "div")), "footer bottom copyright legal",
                          inside, 0)

    def side(self) -> str:
        inside = f"<h3>{self.words(1, 4)}</h3>" + self.r.choice((self.links(), self.plain(1, 4)))
        return self.named(self.r.choice(("aside", "aside", "div", "section")),
                          "sidebar widget related recommended share tags", inside, 0)

    def notice(self) -> str:
        inside = self.plain(1, 3) + self.r.choice(("", "<button>Ok</button>"))
        tag = self.r.choice(("div", "section", "dialog", "noscript", "p"))
        return self.named(tag, "notice cookie-notice consent alert newsletter paywall", inside, 0) \
            if tag in ("dialog", "noscript") or self.r.random() < 0.5 else \
            f'<{tag} class="{self.r.choice(("notice", "cookies", "alert"))}" data-main="0">{inside}</{tag}>'

    def advert(self) -> str:
        tag = self.r.choice(("div", "div", "aside", "section", "p"))
        name = self.r.choice(("ad", "ad", "ads", "advert", "sponsored", "promo", "ad-slot"))
        inside = self.r.choice((self.sentence(), self.plain(1, 3), f"<a href='/b'>{self.sentence()}</a>"))
        return f'<{tag} class="{name}" data-main="0">{inside}</{tag}>'

    def form(self) -> str:
        inside = (f"<label>{self.words(1, 3)}</label><input name=q>"
                  f"<select><option>{self.words(1, 2)}<option>{self.words(1, 2)}</select>"
                  f"<button>{self.words(1, 2)}</button>{self.r.choice(('', self.plain(1, 1)))}")
        return self.named("form", "search login signup contact", inside, 0)

    def comments(self) -> str:
        one = self.r.choice(("<div class='comment'>{}</div>", "<li>{}</li>", "<p>{}</p>", "<blockquote>{}</blockquote>",
                             "<article class='comment'>{}</article>"))
        inside = "".join(one.format(f"<b>{self.words(1, 2)}</b> {self.plain(1, 5)}")
                         for _ in range(self.r.randint(1, 8)))
        tag = self.r.choice(("section", "div", "ol" if one.startswith("<li>") else "div"))
        name = self.r.choice(("comments", "comment-list", "reader-comments", "replies", "discussion"))
        how = self.r.choice(("class", "id"))
        return f'<{tag} {how}="{name}" data-main="0"><h3>{self.words(1, 2)}</h3>{inside}</{tag}>' \
            if tag != "ol" else f'<{tag} {how}="{name}" data-main="0">{inside}</{tag}>'

    def block(self) -> str:
        kind = self.r.random()
        if kind < 0.72:
            return f"<p>{self.prose()}" + self.r.choice(("</p>", "</p>", "</p>", ""))
        if kind < 0.80:
            return f"<p>{self.words(1, 3)}.</p>"
        if kind < 0.86:
            return f"<h{(k := self.r.randint(2, 4))}>{self.words(1, 6)}</h{k}>"
        if kind < 0.91:
            items = "".join(f"<li>{self.sentence(2, 12)}</li>" for _ in range(self.r.randint(2, 5)))
            return f"<ul>{items}</ul>"
        if kind < 0.94:
            return f"<blockquote><p>{self.prose(2)}</p></blockquote>"
        if kind < 0.97:
            rows = "".join(f"<tr><td>{self.words(1, 3)}<td>{self.words(1, 3)}</tr>"
                           for _ in range(self.r.randint(1, 4)))
            return f"<table>{rows}</table>"
        return f"<figure><img src=a><figcaption>{self.sentence()}</figcaption></figure>"

    def article(self) -> str:
        blocks = [self.block() for _ in range(self.r.choice((0, 1, 1, 2, 3, 5, 8, 13)))]
        if self.r.random() < 0.15:     # a poem, a log, the same line again and again
            most = self.r.choice((3, 20, 60))
            line, same = self.words(1, most), self.r.random() < 0.5
            blocks += [f"<p>{line if same else self.words(1, most)}</p>"
                       for _ in range(self.r.randint(5, 50))]
        if self.r.random() < 0.8 or not blocks:
            blocks.insert(0, f"<h1>{self.words(1, 10)}</h1>")
        inside = [(self.advert, 0.25), (self.comments, 0.15), (self.side, 0.15), (self.notice, 0.1),
                  (self.menu, 0.1), (self.form, 0.08)]
        for make, chance in inside:
            if self.r.random() < chance:
                blocks.insert(self.r.randint(1, len(blocks)), make())
        text = "".join(blocks)
        kind = self.r.random()
        if kind < 0.6:
            return f'<article data-main="1">{text}</article>'
        if kind < 0.75:
            return self.named(self.r.choice(("div", "section")), "content post entry story article-body",
                              text, 1)
        if kind < 0.85:
            return f'<main data-main="1">{text}</main>'
        return f'<div data-main="1">{text}</div>'

    def page(self) -> str:
        before = [(self.menu, 0.7), (self.header, 0.5), (self.advert, 0.4), (self.notice, 0.3),
                  (self.form, 0.2), (self.side, 0.2)]
        after = [(self.comments, 0.3), (self.side, 0.35), (self.advert, 0.2), (self.form, 0.15),
                 (self.notice, 0.2), (self.menu, 0.1), (self.footer, 0.8)]
        parts = [make() for make, chance in before if self.r.random() < chance]
        parts.append(self.article())
        parts += [make() for make, chance in after if self.r.random() < chance]
        text = "".join(parts)
        if self.r.random() < 0.3:
            text = f'<div class="{self.r.choice(("wrap", "page", "container", "site"))}">{text}</div>'
        return f"<html><head><title>{self.words(1, 5)}</title></head><body>{text}</body></html>"


def labelled_pages(n: int = TRAINING_PAGES, seed: int = SEED) -> list[str]:
    """Pages with marks (``data-main``) of what is the article and what is not."""
    writer = _Writer(seed)
    return [writer.page() for _ in range(n)]


@functools.lru_cache(maxsize=1)
def standard_model() -> Model:
    """The model of the laid-out pages, trained once per driver."""
    return train(labelled_pages())
