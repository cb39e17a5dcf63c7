"""Main text of HTML pages by a linear-chain conditional random field.

A page is cut into leaf blocks: stretches of text between block-level tags. Each
block has features of its ancestors (tag names, words of class, id and role) and
of its text (length, share of linked text, punctuation, own tag). A linear-chain
CRF labels the sequence of blocks as main text or not; Viterbi finds the best
labelling, and the main blocks are the page's text.

Training pages are of two kinds. `LABELLED` holds whole pages written by hand in
which `data-main` marks the main elements; they show side matter of all kinds.
And at most `TRAIN_PAGES` pages of the table, those with the least hash of their
url and id, that mark their article by an `article` or `main` element; each is
also shown a second time without the features that the label was read from, so
that the text features carry weight on pages without such marks. The fit runs on
the driver over this bounded sample; every page is decoded in Spark tasks, with
no shuffle.

Defined results: null and empty html give empty text; text outside any element
is a block like others; unclosed and stray tags are repaired as browsers do for
paragraphs, list items and table cells, and ignored otherwise; comments and the
elements of `_RAW` and `_HOLDERS` hold no text: with an end tag they reach to it,
without one raw text reaches to the end of the page and any other of them to the
end of the element around it (option and svg at most to the next block-level
tag); a head ends where browsers end it, so its elements hold no text, and text
or another element is of the body; formulas (math) are text without their
annotations; repeated rows repeat; an empty table gives no rows and needs no
table pages to train on; extra columns are ignored.
"""
from __future__ import annotations

import functools
import html
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches

TRAIN_PAGES = 300        # bound of the sample of table pages the model is fitted on
TRAIN_CHARS = 250_000    # longer pages are not sampled for training (all are decoded)
TRAIN_BLOCKS = 400       # pages of more blocks are not sampled for training (all are decoded)
DIMENSIONS = 1 << 13
ROUNDS = 150

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>""", re.S)
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_NAME = re.compile(r"[a-z]+")
#: Elements without text of the page: up to their end tag whatever stands there, or with elements inside.
_RAW = frozenset("script style textarea title iframe".split())
_HOLDERS = frozenset("template noscript select option svg object canvas audio video annotation annotation-xml".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
                   "thead tr ul label button".split())
#: An opening tag ends these open ones, up to the nearest element that contains them.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "optgroup": ("option",)}
_HOLDS = frozenset("ul ol dl table menu".split())
#: Unclosed ones end at any block-level tag.
_SHORT_LIVED = frozenset(("option", "svg"))
_NOSCRIPT = re.compile(r"<(/?)noscript(?=[\s/>])[^>]*>", re.I)


class Node:
    """An open element: its tag and the features of it and all above; silent ones hold no text."""
    __slots__ = ("tag", "features", "score", "linked", "silent")

    def __init__(self, tag, features, score, linked, silent=False):
        self.tag, self.features, self.score, self.linked, self.silent = tag, features, score, linked, silent


def element_features(tag: str, attrs: str) -> tuple[str, ...]:
    out = [f"t:{tag}"]
    if "=" in attrs:
        for name, value in _ATTR.findall(attrs):
            name = name.lower()
            if name in ("class", "id", "role"):
                out += [f"w:{x}" for x in _NAME.findall(value.lower())]
    if attrs == " data-main":
        out.append("data-main")
    return tuple(out)


def text_features(text: str, linked: int, tag: str) -> tuple[str, ...]:
    words = text.count(" ") + 1
    share = linked / max(1, len(text))
    return (f"len:{min(6, words.bit_length())}", f"link:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.7 else 3}",
            f"own:{tag}", f"ends:{text[-1:] in '.!?:;…”»'}", f"comma:{',' in text}", f"mark:{text[:1] in '©@#|›»'}", "bias")


def silent_ends(page: str) -> dict[int, int]:
    """Where each element without text ends that has an end, by the end of its opening tag.

    End tags belong to the nearest open element of their name, so one that was
    left open does not take the end tag of a later one. Within svg and math `/>`
    ends an element. Options are left out: they have no elements inside.
    """
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    foreign = 0      # open svg and math
    at, n = 0, len(page)
    while m := _TAG.search(page, at):
        at = m.end()
        tag = m.group(2)
        if not tag:
            continue
        tag = tag.lower()
        if m.group(1):
            if opened.get(tag):
                ends[opened[tag].pop()] = at
            if tag in ("svg", "math"):
                foreign = max(0, foreign - 1)
            continue
        if tag in _BLOCK:
            foreign = 0
            continue
        if tag in ("svg", "math"):
            foreign += 1
        if foreign and m.group(3).endswith("/"):
            ends[at] = at
            foreign -= tag in ("svg", "math")
        elif tag == "title" and foreign:
            opened.setdefault(tag, []).append(at)
        elif tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            ends[at] = end.end() if end else n
            at = ends[at]
        elif tag == "noscript":
            end = _NOSCRIPT.search(page, at)
            if end and end.group(1):
                ends[at] = at = end.end()
        elif tag in _HOLDERS and tag != "option":
            opened.setdefault(tag, []).append(at)
    return ends


def blocks(page: str, weigh=None) -> list[tuple[str, tuple | float, tuple | float]]:
    """(text, ancestor part, text part) of each leaf block.

    The parts are feature names, or scores where `weigh` (feature names to a
    score) is given; ancestors' scores add up along the path, so depth costs
    nothing.
    """
    zero = () if weigh is None else 0.0
    put = (lambda x: x) if weigh is None else weigh
    stack = [Node("", zero, zero, False)]
    where: dict[str, list[int]] = {}      # places in the stack of each tag,
    block_at = [0]                        # of block-level elements,
    quiet = 0                             # and of the lowest silent one (0: none)
    out: list = []
    parts: list[str] = []
    linked = 0
    at, n = 0, len(page)
    ends_at = silent_ends(page)

    def close() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((text, stack[-1].features if weigh is None else stack[-1].score,
                            put(text_features(text, linked, stack[block_at[-1]].tag))))
            parts, linked = [], 0

    def cut(i: int) -> None:
        """Ends the open element at place i and all in it."""
        nonlocal quiet
        for x in stack[i:]:
            where[x.tag].pop()
        del stack[i:]
        while block_at[-1] >= i:
            block_at.pop()
        if quiet >= i:
            quiet = 0

    def last(tags) -> int:
        return max((where[t][-1] for t in tags if where.get(t)), default=0)

    while at < n:
        m = _TAG.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text and not stack[-1].silent:
            parts.append(text)
            if stack[-1].linked:
                linked += len(text)
        if not m:
            break
        at = m.end()
        tag = m.group(2)
        if not tag:
            continue
        tag = tag.lower()
        if m.group(1):
            if where.get(tag):
                if tag in _BLOCK:
                    close()
                cut(where[tag][-1])
            continue
        if tag == "head":
            close()
            continue
        silent = tag in _RAW or tag in _HOLDERS
        if silent and at in ends_at:
            at = ends_at[at]
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _BLOCK:
            close()
            if quiet and stack[quiet].tag in _SHORT_LIVED:
                cut(quiet)
            if stack[block_at[-1]].tag == "p":
                cut(block_at[-1])
        ends = _ENDS.get(tag)
        if ends and (i := last(ends)) > last(_HOLDS):
            cut(i)
        if tag not in _VOID and (silent or not m.group(3).endswith("/")):
            own = element_features(tag, m.group(3))
            top = stack[-1]
            if silent and not quiet:
                quiet = len(stack)
            where.setdefault(tag, []).append(len(stack))
            if tag in _BLOCK:
                block_at.append(len(stack))
            silent = silent or top.silent
            stack.append(Node(tag, top.features + own, 0.0, top.linked or tag == "a", silent) if weigh is None
                         else Node(tag, None, top.score + weigh(own), top.linked or tag == "a", silent))
    close()
    return out


@functools.lru_cache(1 << 16)
def slot(feature: str) -> int:
    return zlib.crc32(feature.encode()) % DIMENSIONS


class ChainCRF:
    """Two labels, hashed features: weight per feature of label 1 against 0, and transition weights."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray) -> None:
        self.weights, self.steps = weights, steps       # steps[i, j]: from label i to j; steps[2, j]: at the start

    @staticmethod
    def fit(pages: list[tuple[list[list[int]], list[int]]], rounds: int = ROUNDS, rate: float = 0.3, decay: float = 1e-4) -> ChainCRF:
        """Maximum conditional likelihood by AdaGrad over all pages at once; pages: feature slots per block, and labels."""
        pages = [p for p in pages if p[1]]
        n, t = len(pages), max(len(y) for _, y in pages)
        where, slots = [], []
        y = np.zeros((n, t), int)
        real = np.zeros((n, t), bool)
        for i, (x, labels) in enumerate(pages):
            y[i, :len(labels)] = labels
            real[i, :len(labels)] = True
            for k, f in enumerate(x):
                where += [i * t + k] * len(f)
                slots += f
        where, slots = np.array(where), np.array(slots)
        w, s = np.zeros(DIMENSIONS), np.zeros((3, 2))
        gw, gs = np.full(DIMENSIONS, 1e-6), np.full((3, 2), 1e-6)
        both = real[:, 1:] & real[:, :-1]
        pairs = np.stack([y[:, :-1][both], y[:, 1:][both]])
        seen = np.zeros((3, 2))
        np.add.at(seen, (pairs[0], pairs[1]), 1)
        np.add.at(seen, (np.full(n, 2), y[:, 0]), 1)
        for _ in range(rounds):
            e = np.zeros((n, t, 2))
            e[:, :, 1] = np.bincount(where, w[slots], n * t).reshape(n, t)
            f, b = np.zeros((n, t, 2)), np.zeros((n, t, 2))
            f[:, 0] = s[2] + e[:, 0]
            for k in range(1, t):
                f[:, k] = np.where(real[:, k, None], np.logaddexp(f[:, k - 1, 0, None] + s[0], f[:, k - 1, 1, None] + s[1]) + e[:, k], f[:, k - 1])
            for k in range(t - 2, -1, -1):
                x = e[:, k + 1] + b[:, k + 1]
                b[:, k] = np.where(real[:, k + 1, None], np.logaddexp(s[:2, 0] + x[:, 0, None], s[:2, 1] + x[:, 1, None]), 0)
            z = np.logaddexp(f[:, -1, 0], f[:, -1, 1])[:, None]
            p1 = np.where(real, np.exp(f[:, :, 1] + b[:, :, 1] - z), 0)
            dw = np.bincount(slots, (np.where(real, y, 0) - p1).ravel()[where], DIMENSIONS) / n - decay * w
            joint = np.exp(f[:, :-1, :, None] + s[None, None, :2] + (e + b)[:, 1:, None, :] - z[:, :, None, None])
            ds = seen.copy()
            ds[:2] -= np.where(both[:, :, None, None], joint, 0).sum((0, 1))
            first = np.exp(f[:, 0] + b[:, 0] - z)
            ds[2] -= first.sum(0)
            ds = ds / n - decay * s
            gw += dw * dw
            gs += ds * ds
            w += rate * dw / np.sqrt(gw)
            s += rate * ds / np.sqrt(gs)
        return ChainCRF(w, s)

    def weigh(self):
        """A function from feature names to their score, with memory for recurring tuples."""
        w = self.weights.tolist()
        known: dict[tuple, float] = {}

        def score(features: tuple[str, ...]) -> float:
            got = known.get(features)
            if got is None:
                got = sum(w[slot(f)] for f in features)
                if len(known) < 1 << 16:
                    known[features] = got
            return got

        return score

    def viterbi(self, scores: list[float]) -> list[int]:
        """Best labels of a chain whose blocks have these scores for label 1."""
        if not scores:
            return []
        (a00, a01), (a10, a11), (s0, s1) = self.steps.tolist()
        x0, x1 = s0, s1 + scores[0]
        back = []
        for e in scores[1:]:
            f0, f1 = x1 + a10 > x0 + a00, x1 + a11 > x0 + a01
            x0, x1 = (x1 + a10 if f0 else x0 + a00), (x1 + a11 if f1 else x0 + a01) + e
            back.append((f0, f1))
        label = int(x1 > x0)
        out = [label]
        for f0, f1 in reversed(back):
            label = int(f1 if label else f0)
            out.append(label)
        return out[::-1]


def main_text(page: str | None, model: ChainCRF, weigh) -> str:
    found = blocks(page or "", weigh)
    labels = model.viterbi([a + b for _, a, b in found])
    return "\n\n".join(t for (t, _, _), y in zip(found, labels) if y)


# Training.

_SIDE = frozenset("t:nav t:aside t:footer t:form w:comment w:comments w:ad w:ads w:sidebar w:cookie w:menu".split())
_MARKS = frozenset(("t:article", "t:main", "data-main"))


def examples(page: str, by_hand: bool = False) -> list[tuple[list[list[int]], list[int]]]:
    """Training chains of a page: as it is, and without the features that mark its article. None if nothing marks it."""
    found = blocks(page)
    mark = {"data-main"} if by_hand else {"t:article", "t:main"}
    labels = [int(bool(mark & set(a)) and (by_hand or not _SIDE & set(a))) for _, a, _ in found]
    if not any(labels) or len(found) > TRAIN_BLOCKS:
        return []
    plain = [[slot(f) for f in (*a, *b) if f != "data-main"] for _, a, b in found]
    bare = [[slot(f) for f in (*a, *b) if f not in _MARKS] for _, a, b in found]
    return [(plain, labels), (bare, labels)]


_P = ("The council met on Tuesday evening, and after two hours of debate it agreed to repair the old bridge before winter.",
      "Nobody had expected the vote to be so close.", "“We have waited nine years for this,” said the mayor, who lives across the river.",
      "Work begins in May; the road stays open on weekdays, but lorries must take the northern route until autumn.")
_BODY = "<h1 data-main>Bridge to be repaired</h1>" + "".join(f"<p data-main>{p}</p>" for p in _P)
_SHORT = f"<h2 data-main>A short notice</h2><p data-main>{_P[1]}</p><ul><li data-main>Opens at nine,</li><li data-main>closes at five.</li></ul>"
_MENU = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Sport", "Contact us"))
#: Pages labelled by hand.
LABELLED = (
    f"<html><body><header><a href=/>The Daily</a><p>All the news, every day.</p></header><nav><ul>{_MENU}</ul></nav><article>{_BODY}</article>"
    f"<aside><h3>Most read</h3><p>Ten towns to see this summer, if you have the time.</p></aside><footer><p>© The Daily, all rights reserved.</p></footer></body></html>",
    f'<body><div class="cookie-notice"><p>We use cookies, as every site does. By reading on you agree.</p><button>Accept</button></div><div id="menu"><ul>{_MENU}</ul></div>'
    f'<div class="content">{_BODY}</div><div class="comments"><h3>Comments</h3><div class="comment"><p>I doubt it will be done by then, to be honest.</p></div>'
    f'<div class="comment"><p>Great news!</p></div></div><div id="footer">Imprint | Privacy</div></body>',
    f'<body><div class="header">Site name</div><div class="main"><div class="ad">Buy two shoes, get one free. Only today!</div>{_BODY}<div class="ad">Cheap flights, no fees.</div></div>'
    f'<form><label>Your mail address</label><p>Subscribe to our letter, it costs nothing.</p><button>Send</button></form><footer>Terms and conditions</footer></body>',
    f'<body><nav>{_MENU}</nav><main>{_SHORT}<section class="comments"><p>Is this true? I was there last week, and it was shut.</p></section></main>'
    f'<div class="sidebar"><h4>Related</h4><p>Older notices, by date.</p><ul>{_MENU}</ul></div><footer><ul>{_MENU}</ul></footer></body>',
    f'<body><div class="banner">Notice: the site is down on Sunday, from two to four.</div><article>{_BODY}<aside class="related"><p>Read also: why bridges fail, and when.</p></aside>'
    f'<div class="share"><a href=#>Share</a> <a href=#>Print</a></div></article><div class="newsletter"><p>Get the week in five minutes, by mail.</p></div></body>',
    f'<body>{_BODY}<footer>&copy; 2020 example.org &middot; Made with care.</footer></body>',
    f'<body><ul class="breadcrumb">{_MENU}</ul><div><div>{_BODY}{_SHORT}</div></div><div class="popup"><p>Before you go, leave us your address!</p></div></body>',
)


def train(pages: DataFrame, sample: int = TRAIN_PAGES) -> ChainCRF:
    """Fit on `LABELLED` and on at most `sample` marked pages of the table, of at most `TRAIN_CHARS` characters each.

    Two hashes per page choose the sample; only the chosen pages go to the driver, each of them once.
    """
    marked = (pages.where("html is not null").where(F.length("html") <= TRAIN_CHARS).where(F.lower("html").rlike("<(article|main)[ >]"))
              .select("html", F.xxhash64("url", "page_id").alias("h"), F.xxhash64("html").alias("g")))
    chosen = Counter((r.h, r.g) for r in marked.select("h", "g").orderBy("h", "g").limit(sample).collect())
    hs, gs = ([k[i] for k in chosen] for i in (0, 1))
    rows = (marked.where(F.col("h").isin(hs) & F.col("g").isin(gs)).groupBy("h", "g").agg(F.min("html").alias("html")).collect()
            if chosen else [])
    chains = [c for page in LABELLED * 3 for c in examples(page, True)]
    for r in sorted(rows, key=lambda r: (r.h, r.html)):
        for _ in range(chosen[r.h, r.g]):
            chains += examples(r.html)
    return ChainCRF.fit(chains)


def extract(pages: DataFrame, sample: int = TRAIN_PAGES, model: ChainCRF | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    spark = pages.sparkSession
    small_batches(spark)
    model = model or train(pages, sample)
    shared = spark.sparkContext.broadcast((model.weights, model.steps))      # 64 KB

    def rows(batches):
        crf = ChainCRF(*shared.value)
        weigh = crf.weigh()
        for b in batches:
            texts = [main_text(h, crf, weigh) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        rows, "page_id long, url string, text string, n_chars long")
