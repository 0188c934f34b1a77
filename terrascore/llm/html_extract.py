"""Main text of web pages: a linear-chain conditional random field over the
DOM's leaf blocks (op 2).

Each block has the label "main text" or "other". Its features are the tags
and the class, id and role words above it, and the shape of its text (length,
sentence marks, share of link text). Neighbouring labels are tied by learned
transitions; decoding is Viterbi. The model is trained, by gradient ascent on
the conditional likelihood, on labelled pages that ``labelled_pages`` lays out
in many ways, seeded.

Main text is the article: no menus, headers, footers, sidebars, notices,
adverts, forms or reader comments. Blocks are joined in page order by a space.

Defined results: a null or empty page, or one without main text, has the empty
text and 0 characters; equal pages get equal results; rows sharing an id are
treated one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrascore.llm.common import ship_code
from terrascore.llm.html_blocks import Block, blocks

TRAINING_PAGES = 500
EPOCHS = 12
SEED = 11


#: Without one of these above it, a text stands bare in its container.
_TEXT_TAGS = frozenset("p li h1 h2 h3 td blockquote pre".split())


def features(b: Block) -> list[str]:
    out = [f"in:{t}" for t in b.tags if t not in ("html", "body")]
    out += [f"name:{n}" for n in b.names] + [f"own:{n}" for n in b.own]
    out.append("leaf:" + b.leaf)
    out.append("near:" + b.near)
    n = b.text.count(" ") + 1
    out.append(f"words:{min(int(math.log2(n)), 6)}")
    share = min(1.0, b.linked / len(b.text))
    out.append(f"links:{int(share * 3)}")
    out.append("ends:" + ("stop" if b.text[-1] in ".!?…\"'" else "open"))
    marks = b.text.count(".") + b.text.count(",")
    out.append(f"marks:{min(marks, 3)}")
    if any(c in b.text for c in "©|·"):
        out.append("sign")
    if not b.tags & _TEXT_TAGS:
        out.append("bare")
    return out


class Field:
    """Two-label linear-chain CRF. ``weights``: score of "main text" against
    "other" by feature; ``trans[i][j]``: score of label j after label i (the
    row 2 is the start)."""

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}
        self.trans = [[0.0, 0.0], [0.0, 0.0], [0.0, 0.0]]

    def _scores(self, feats: list[list[str]]) -> np.ndarray:
        w = self.weights
        return np.array([sum(w.get(f, 0.0) for f in fs) for fs in feats])

    def viterbi(self, feats: list[list[str]]) -> list[int]:
        t = self.trans
        a, b = t[2]
        back = []
        for k, s in enumerate(self._scores(feats).tolist()):
            if k:
                from_a = 0 if a + t[0][0] >= b + t[1][0] else 1
                from_b = 0 if a + t[0][1] >= b + t[1][1] else 1
                a, b = (a, b)[from_a] + t[from_a][0], (a, b)[from_b] + t[from_b][1]
                back.append((from_a, from_b))
            b += s
        labels = [0 if a >= b else 1] if feats else []
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]

    def gradient(self, feats: list[list[str]], y: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(observed - expected) label 1 per block, and transitions (3, 2)."""
        n, t = len(feats), np.array(self.trans)
        e = np.zeros((n, 2))
        e[:, 1] = self._scores(feats)
        fwd, bwd = np.empty((n, 2)), np.zeros((n, 2))
        fwd[0] = t[2] + e[0]
        for k in range(1, n):
            fwd[k] = np.logaddexp.reduce(fwd[k - 1][:, None] + t[:2], axis=0) + e[k]
        for k in range(n - 2, -1, -1):
            bwd[k] = np.logaddexp.reduce(t[:2] + e[k + 1] + bwd[k + 1], axis=1)
        z = np.logaddexp.reduce(fwd[-1])
        p = np.exp(fwd + bwd - z)
        gt = np.zeros((3, 2))
        gt[2] -= p[0]
        gt[2, y[0]] += 1
        for k in range(1, n):
            gt[:2] -= np.exp(fwd[k - 1][:, None] + t[:2] + e[k] + bwd[k] - z)
            gt[y[k - 1], y[k]] += 1
        return np.array(y) - p[:, 1], gt

    def fit(self, pages: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS, rate: float = 0.3,
            decay: float = 1e-4, seed: int = SEED) -> None:
        """Stochastic gradient ascent, page by page, with adaptive rates."""
        data = [([features(b) for b in bs], ys) for bs, ys in pages if bs]
        rng = random.Random(seed)
        power: dict[str, float] = {}
        trans, tpower = np.zeros((3, 2)), np.full((3, 2), 1e-6)
        for _ in range(epochs):
            rng.shuffle(data)
            for feats, y in data:
                gy, gt = self.gradient(feats, y)
                total: dict[str, float] = {}
                for fs, g in zip(feats, gy.tolist()):
                    for f in fs:
                        total[f] = total.get(f, 0.0) + g
                for f, g in total.items():
                    w = self.weights.get(f, 0.0)
                    g -= decay * w
                    power[f] = power.get(f, 1e-6) + g * g
                    self.weights[f] = w + rate * g / math.sqrt(power[f])
                tpower += gt * gt
                trans += rate * gt / np.sqrt(tpower)
                self.trans = trans.tolist()


#: Words that class and id attributes are made of, by part of a page (fixed values).
PARTS = {
    "menu": ("nav menu navbar navigation breadcrumb breadcrumbs topnav links tabs toc pagination pager", "nav ul div"),
    "header": ("header masthead banner top site branding logo topbar", "header div"),
    "footer": ("footer foot bottom copyright legal colophon", "footer div"),
    "sidebar": ("sidebar aside widget related side rail recommended popular trending more archive tags", "aside div section"),
    "notice": ("notice cookie consent gdpr alert popup modal newsletter subscribe signup paywall disclaimer", "div section"),
    "advert": ("ad ads advert advertisement sponsor sponsored promo promoted adsense banner", "div aside ins section"),
    "form": ("form search login contact signup poll survey", "form div"),
    "comments": ("comments comment replies reply discussion respond disqus thread reader", "section div ol ul"),
    "share": ("share social sharing buttons follow", "div ul"),
}
MAIN = "content article post entry main body text story page story single primary"
_VOWELS = "aeiouaeioué"
_CONS = "bcdfghklmnprstvwz"


def _words(rng: random.Random, n: int) -> str:
    out = []
    for _ in range(n):
        w = "".join(rng.choice(_CONS) + rng.choice(_VOWELS) for _ in range(rng.randint(1, 4)))
        out.append(w + rng.choice(("", "", "", "", "", ",", ".")) if rng.random() < 0.9 else w + rng.choice(("***", "%%%", "$$$")))
    s = " ".join(out)
    return s[:1].upper() + s[1:]


def _attr(rng: random.Random, names: str) -> str:
    pool = names.split()
    if rng.random() < 0.25:
        return ""
    name = rng.choice(pool)
    if rng.random() < 0.3:
        name += rng.choice(("-", "_", " ")) + rng.choice(("box", "area", "wrap", "list", "block", "inner", "container"))
    return f' {rng.choice(("class", "class", "id"))}="{name}"'


def labelled_pages(n: int = TRAINING_PAGES, seed: int = SEED) -> list[tuple[list[Block], list[int]]]:
    """Pages of random words in varied layouts, with a label per block (1: main
    text). Every text is unique, so that blocks find their labels again."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        labels: dict[str, int] = {}

        def text(label: int, size: int, stop: bool, labels=labels) -> str:
            while True:
                s = _words(rng, size)
                if rng.random() < 0.08:
                    s = s.replace(" ", rng.choice((" | ", "*** ", " · ")))
                if stop:
                    s = s.rstrip(",.") + "."
                if s not in labels:
                    labels[s] = label
                    return s

        def part(kind: str) -> str:
            names, tags = PARTS[kind]
            tag = rng.choice(tags.split())
            at = _attr(rng, names)
            if not at and tag in ("div", "section", "ul", "ol", "ins"):
                at = f' class="{rng.choice(names.split())}"'
            size = {"menu": (1, 2), "header": (1, 6), "footer": (3, 12), "share": (1, 2)}.get(kind, (2, 30))
            count = rng.randint(2, 8) if kind in ("menu", "sidebar", "comments", "share") else rng.randint(1, 2)
            items = [text(0, rng.randint(*size), rng.random() < 0.5) for _ in range(count)]
            if tag in ("ul", "ol") or kind == "menu":
                inner = "".join(f'<li><a href="/{k}">{s}</a></li>' if rng.random() < 0.8 else f"<li>{s}</li>" for k, s in enumerate(items))
                inner = inner if tag in ("ul", "ol") else f"<ul>{inner}</ul>"
            elif kind == "form":
                inner = "".join(f"<label>{s}</label><input name=x><br>" for s in items) + f"<button>{text(0, 1, False)}</button>"
            elif kind == "footer" and rng.random() < 0.5:
                return f"<{tag}{at}>{rng.choice(('&copy; ', '', ''))}{items[0]}</{tag}>"
            else:
                inner = items[0] if len(items) == 1 and rng.random() < 0.6 else "".join(
                    f"<p>{s}</p>" if rng.random() < 0.7 else f"<div>{s}</div>" for s in items)
            return f"<{tag}{at}>{inner}</{tag}>"

        def article() -> str:
            body = []
            if rng.random() < 0.8:
                body.append(f"<h1>{text(1, rng.randint(2, 10), rng.random() < 0.3)}</h1>")
            for k in range(rng.randint(1, 9)):
                s = text(1, rng.choice((1, 2, 4, 8, 15, 30, 60, 120)), rng.random() < 0.7)
                r = rng.random()
                body.append(f"<h2>{s}</h2>" if r < 0.08 else f"<p><b>{s}<br>" if r < 0.16 else f"<ul><li>{s}</li></ul>" if r < 0.22
                            else f"<blockquote>{s}</blockquote>" if r < 0.26 else f"<p>{s}" if r < 0.4 else f"<p>{s}</p>")
                if rng.random() < 0.2:
                    body.append(part(rng.choice(("advert", "sidebar", "share", "notice", "form"))))
            tag = rng.choice(("article", "article", "main", "div", "section"))
            at = _attr(rng, MAIN)
            if not at and tag in ("div", "section"):
                at = ' class="content"'
            s = f"<{tag}{at}>{''.join(body)}</{tag}>"
            return f"<main>{s}</main>" if rng.random() < 0.2 else s

        before = [part(k) for k in ("header", "menu", "notice", "advert", "form", "sidebar") if rng.random() < 0.45]
        after = [part(k) for k in ("comments", "share", "sidebar", "advert", "form", "menu", "notice") if rng.random() < 0.4]
        if rng.random() < 0.85:
            after.append(part("footer"))
        inner = "".join(before) + article() + "".join(after)
        if rng.random() < 0.3:
            inner = f'<div class="{rng.choice(("wrapper", "container", "page", "layout"))}">{inner}</div>'
        bs = blocks(f"<!DOCTYPE html><html><head><title>{_words(rng, 4)}</title><style>p{{}}</style></head><body>{inner}</body></html>")
        out.append((bs, [labels.get(b.text.removeprefix("© "), 0) for b in bs]))
    return out


def train(n: int = TRAINING_PAGES, epochs: int = EPOCHS) -> Field:
    model = Field()
    model.fit(labelled_pages(n), epochs)
    return model


def known_features(model: Field) -> tuple[frozenset[str], frozenset[str]]:
    """(tags, class words) that the model has weights for, or that features ask for."""
    of = lambda *kinds: frozenset(w for f in model.weights for kind, _, w in (f.partition(":"),) if kind in kinds)
    return of("in") | _TEXT_TAGS, of("name", "own")


def main_text(page: str | None, model: Field, known: tuple[frozenset[str], frozenset[str]] | None = None) -> str:
    """The page's main text. ``known``: ``known_features``; the result is the same
    without, in more memory on deeply nested pages."""
    bs = blocks(page, known)
    labels = model.viterbi([features(b) for b in bs])
    return " ".join(b.text for b, y in zip(bs, labels) if y)


def extract(pages: DataFrame, model: Field | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, ``text``, ``n_chars``."""
    model = model or train()
    ship_code(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast((model.weights, model.trans))  # a few hundred weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field()
        field.weights, field.trans = shared.value
        known = known_features(field)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [main_text(x.as_py(), field, known) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["id", "url", "text", "n_chars"])

    p = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in p.schema.fields}
    out = p.mapInArrow(run, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
