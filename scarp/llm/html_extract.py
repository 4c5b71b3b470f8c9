"""Main-text extraction with a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, each with the path of its open elements. A
bidirectional LSTM in numpy reads the blocks of a page in order, each as the mean vector of its tag-path tokens (tag names,
words of class, id and role), the mean vector of its hashed words and a few numbers, and labels every block as article or
not, so a decision rests on the whole page. The text of a page is the article blocks, joined by blank lines.

The labeller is trained on the driver on a bounded sample: the ``pages`` first pages in the order of a hash of the html.
Their own elements give labels where the page is marked up semantically (``article`` or ``main`` against ``nav``,
``footer`` and the like). The same blocks are then laid out anew in other page designs, with plain containers named as
sites name them and with the kinds of surroundings the sample may lack (notices, forms, sidebars, reader comments), where the
labels are known by construction. All pages are then labelled whole, however long.

Defined results: null and empty html give the empty text; null ids and urls pass through; repeated rows give one row
each; other columns are ignored; broken markup is read as far as it goes (an unclosed comment or script ends the page).
"""

from __future__ import annotations

import html
import pickle
import random
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, scratch_table

PAGES = 240         # pages in the training sample
MAX_CHARS = 60_000  # of html; longer pages are not trained on
LAYOUTS = 3         # new designs per sampled page
EPOCHS = 6
PATH_BUCKETS, PATH_DIM = 2048, 12
WORD_BUCKETS, WORD_DIM = 4096, 8
NUMBERS = 4
HIDDEN = 16
BATCH_BLOCKS = 20_000  # blocks labelled at once

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
NAME = re.compile(r"[a-z]+")
# elements that do not end a block
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong "
                   "sub sup time tt u var wbr "
                   "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup "
                   "munder mover munderover semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style template noscript svg iframe object textarea select title canvas audio video".split())
# of those, the ones that take the rest of a page if they are never closed; the others are then read through
SWALLOWING = frozenset({"script", "style", "textarea", "title"})
# path features of deeper blocks come from their outermost and innermost elements
OUTERMOST, INNERMOST = 16, 48
# an opening element that ends an open one of the same kind, and what hides an outer one from it
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table article section main div aside nav header footer body form blockquote".split())
ARTICLE = frozenset({"article", "main"})
AROUND = frozenset({"nav", "footer", "aside", "form", "menu", "dialog", "button", "label"})


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # path tokens, outermost first
    link: float            # share of the characters inside links


def path_tokens(tag: str, attributes: str) -> str:
    """One element as a string: tag, then the words of class, id and role."""
    words = [w for _, v in ATTRIBUTE.findall(attributes) for w in NAME.findall(v.lower())] if "=" in attributes else []
    return " ".join([tag, *words])


def blocks_of(page: str) -> list[Block]:
    """The leaf blocks of a page in order, white space folded, character references decoded."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    opened: dict[str, int] = {}                              # open elements by tag
    unclosed: set[str] = set()                               # tags that are never closed from here on
    parts: list[str] = []
    linked = 0
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            path = stack if len(stack) <= OUTERMOST + INNERMOST else stack[:OUTERMOST] + stack[-INNERMOST:]
            out.append(Block(text, tuple(t for _, t in path), min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    def close_from(k: int) -> None:
        for name, _ in stack[k:]:
            opened[name] -= 1
        del stack[k:]

    while at < end:
        m = MARKUP.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            piece = page[at:stop]
            parts.append(piece)
            if opened.get("a"):
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        tag = m.group(2) or m.group(5)
        if not tag:
            continue
        tag, closing = tag.lower(), m.group(1) or m.group(4)
        attributes = m.group(3) or m.group(6) or ""
        if tag == "br":
            parts.append(" ")
            continue
        if tag in UNSEEN and not closing and not (tag in unclosed and tag not in SWALLOWING):
            if attributes.rstrip().endswith("/"):
                continue
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            if close or tag in SWALLOWING:
                at = close.end() if close else end
                continue
            unclosed.add(tag)
        if tag not in INLINE:
            flush()
        if closing:
            if opened.get(tag):
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                close_from(k)
        elif tag not in VOID:
            if tag in CLOSES and any(opened.get(t) for t in CLOSES[tag]):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in CLOSES[tag]:
                        close_from(k)
                        break
                    if stack[k][0] in SCOPE:
                        break
            stack.append((tag, path_tokens(tag, attributes)))
            opened[tag] = opened.get(tag, 0) + 1
    flush()
    return out


# -- features ----------------------------------------------------------------------------------------------------------
def bucket(text: str, n: int) -> int:
    return zlib.crc32(text.encode("utf-8", "replace")) % n


def path_buckets(path: tuple[str, ...]) -> list[int]:
    """Hashed tokens of a tag path: every tag and name, and the innermost element once more."""
    tokens = [w if k else f"<{w}>" for element in path for k, w in enumerate(element.split(" "))]
    last = [f"last {path[-1].split(' ')[0]}"] if path else ["last"]
    return [bucket(t, PATH_BUCKETS) for t in tokens + last]


class Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        b = self[word] = bucket(word, WORD_BUCKETS)
        return b


def numbers(block: Block, n_words: int) -> list[float]:
    return [np.log1p(n_words) / 4, block.link, float(block.text[-1] in ".!?\"”»…"), float(block.text[0].isupper())]


# -- model -------------------------------------------------------------------------------------------------------------
@dataclass
class Labeller:
    """Parameters: embeddings, two LSTMs (input, recurrent, bias) and the output layer."""
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(seed: int = 3) -> Labeller:
        rng, d = np.random.default_rng(seed), PATH_DIM + WORD_DIM + NUMBERS
        p = {"path": rng.normal(0, 0.3, (PATH_BUCKETS, PATH_DIM)), "word": rng.normal(0, 0.05, (WORD_BUCKETS, WORD_DIM)),
             "out": rng.normal(0, 0.2, (2 * HIDDEN, 1)), "out_b": np.zeros(1)}
        for way in "fb":
            p[f"{way}_in"] = rng.normal(0, 1 / np.sqrt(d), (d, 4 * HIDDEN))
            p[f"{way}_rec"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            p[f"{way}_b"] = np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]  # open forget gates
        return Labeller(p)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def lstm(x: np.ndarray, mask: np.ndarray, p: dict, way: str) -> tuple[np.ndarray, list]:
    """Hidden states over ``x`` (batch, step, input); steps outside of the mask leave the state as it is."""
    n, steps, _ = x.shape
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    out, kept = np.zeros((n, steps, HIDDEN)), []
    inputs = x @ p[f"{way}_in"] + p[f"{way}_b"]
    for t in (range(steps) if way == "f" else range(steps - 1, -1, -1)):
        z = inputs[:, t] + h @ p[f"{way}_rec"]
        i, f, o = (sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN:])
        c_new = f * c + i * g
        th = np.tanh(c_new)
        m = mask[:, t:t + 1]
        kept.append((t, h, c, i, f, o, g, th, m))
        h, c = m * (o * th) + (1 - m) * h, m * c_new + (1 - m) * c
        out[:, t] = h
    return out, kept


def lstm_back(d_out: np.ndarray, x: np.ndarray, kept: list, p: dict, way: str, grads: dict) -> np.ndarray:
    """Gradients through :func:`lstm`; returns those of its input."""
    n, steps, _ = x.shape
    dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    dz_all = np.zeros((n, steps, 4 * HIDDEN))
    d_rec = np.zeros_like(p[f"{way}_rec"])
    for t, h, c, i, f, o, g, th, m in reversed(kept):
        dh = dh + d_out[:, t]
        dh_new, dc_new = m * dh, m * dc
        do = dh_new * th
        dcell = dc_new + dh_new * o * (1 - th * th)
        dz = np.concatenate([dcell * g * i * (1 - i), dcell * c * f * (1 - f), do * o * (1 - o), dcell * i * (1 - g * g)], 1)
        dz_all[:, t] = dz
        d_rec += h.T @ dz
        dh = (1 - m) * dh + dz @ p[f"{way}_rec"].T
        dc = (1 - m) * dc + dcell * f
    grads[f"{way}_rec"], grads[f"{way}_b"] = d_rec, dz_all.sum((0, 1))
    grads[f"{way}_in"] = np.einsum("ntd,ntk->dk", x, dz_all)
    return dz_all @ p[f"{way}_in"].T


def train(pages: list[list[Block]], labels: list[list[int]], epochs: int = EPOCHS, seed: int = 3) -> Labeller:
    """Backpropagation through time with Adam, over batches of pages of similar length."""
    model, rng, words = Labeller.fresh(seed), random.Random(seed), Words()
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.p.items()}
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    batches = [order[k:k + 24] for k in range(0, len(order), 24)]
    step = 0
    for _ in range(epochs):
        rng.shuffle(batches)
        for batch in batches:
            step += 1
            p = model.p
            lengths = np.array([len(pages[k]) for k in batch])
            steps = int(lengths.max())
            mask = (np.arange(steps)[None, :] < lengths[:, None]).astype(float)
            flat = [b for k in batch for b in pages[k]]
            x_flat, path_csr, word_csr = features(flat, p, words)
            x = np.zeros((len(batch), steps, x_flat.shape[1]))
            x[mask > 0] = x_flat
            y = np.zeros((len(batch), steps))
            y[mask > 0] = [v for k in batch for v in labels[k]]
            hf, kf = lstm(x, mask, p, "f")
            hb, kb = lstm(x, mask, p, "b")
            both = np.concatenate([hf, hb], 2)
            prob = sigmoid((both @ p["out"])[:, :, 0] + p["out_b"][0])
            d = (prob - y) * mask / mask.sum()
            grads = {"out": np.einsum("nth,nt->h", both, d)[:, None], "out_b": np.array([d.sum()])}
            d_both = d[:, :, None] * p["out"][:, 0]
            dx = lstm_back(d_both[:, :, :HIDDEN], x, kf, p, "f", grads) + lstm_back(d_both[:, :, HIDDEN:], x, kb, p, "b", grads)
            dx = dx[mask > 0]
            for name, (idx, owner, counts), part in (("path", path_csr, dx[:, :PATH_DIM]),
                                                     ("word", word_csr, dx[:, PATH_DIM:PATH_DIM + WORD_DIM])):
                grads[name] = np.zeros_like(p[name])
                np.add.at(grads[name], idx, (part / np.maximum(counts, 1)[:, None])[owner])
            for k, g in grads.items():
                m = moments[k]
                m[0] += 0.1 * (g - m[0])
                m[1] += 0.01 * (g * g - m[1])
                p[k] = p[k] - 0.02 * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.99 ** step)) + 1e-8)
    return model


def features(blocks: list[Block], p: dict, words: Words, paths: dict | None = None) -> tuple[np.ndarray, tuple, tuple]:
    """Input vectors of blocks; also the hashed tokens behind them as (bucket, block number, count per block)."""
    paths = {} if paths is None else paths
    split = [b.text.lower().split() for b in blocks]
    w_count = np.array([len(w) for w in split], np.int64)
    w_idx = np.fromiter((words[w] for ws in split for w in ws), np.int64, int(w_count.sum()))
    lists = []
    for b in blocks:
        if b.path not in paths:
            paths[b.path] = path_buckets(b.path)
        lists.append(paths[b.path])
    p_count = np.array([len(x) for x in lists], np.int64)
    p_idx = np.array([i for x in lists for i in x], np.int64)
    mean = lambda table, idx, count: np.add.reduceat(table[idx], np.cumsum(count) - count, axis=0) / count[:, None]
    x = np.concatenate([mean(p["path"], p_idx, p_count), mean(p["word"], w_idx, w_count),
                        np.array([numbers(b, n) for b, n in zip(blocks, w_count.tolist())])], 1)
    rows = np.arange(len(blocks))
    return x, (p_idx, np.repeat(rows, p_count), p_count), (w_idx, np.repeat(rows, w_count), w_count)


def label(model: Labeller, pages: list[list[Block]], words: Words, paths: dict) -> list[np.ndarray]:
    """Whether each block of each page belongs to the article; pages of similar length are labelled together."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    while order:
        n = max(1, BATCH_BLOCKS // len(pages[order[-1]]))
        batch, order = order[-n:], order[:-n]
        lengths = np.array([len(pages[k]) for k in batch])
        steps = int(lengths.max())
        mask = (np.arange(steps)[None, :] < lengths[:, None]).astype(float)
        x_flat, *_ = features([b for k in batch for b in pages[k]], model.p, words, paths)
        x = np.zeros((len(batch), steps, x_flat.shape[1]))
        x[mask > 0] = x_flat
        both = np.concatenate([lstm(x, mask, model.p, "f")[0], lstm(x, mask, model.p, "b")[0]], 2)
        hit = (both @ model.p["out"])[:, :, 0] + model.p["out_b"][0] > 0
        for row, k in enumerate(batch):
            out[k] = hit[row, :lengths[row]]
    return out


# -- training pages ----------------------------------------------------------------------------------------------------
def own_labels(blocks: list[Block]) -> list[int] | None:
    """Labels from semantic elements, where the page has an article or main element."""
    tags = [[e.split(" ")[0] for e in b.path] for b in blocks]
    if not any(ARTICLE & set(t) for t in tags):
        return None
    return [int(bool(ARTICLE & set(t)) and not AROUND & set(t)) for t in tags]


#: containers as sites name them; each line: opening tags from the outside in
HOLDERS = ["article", "main", "main|article", "div main content|article", "div post content", "div entry content", "section article body",
           "div content|div article text", "div story", "div wrapper|div page content", "article post|div body", "div container|main"]
SURROUNDINGS = {
    "menu": ["nav|ul|li", "div menu|ul|li", "header|nav|a", "div navbar|ul|li", "ul breadcrumb|li", "nav main navigation|div", "div topnav|span"],
    "header": ["header", "header site header|div", "div header|p", "div masthead|h2", "div banner|p", "header|h2"],
    "footer": ["footer", "footer|p", "div footer|p", "div site footer|div", "footer|ul|li", "div copyright"],
    "sidebar": ["aside", "aside|p", "div sidebar|p", "aside sidebar|ul|li", "div widget|h3", "div related posts|ul|li", "section related|h3"],
    "notice": ["div cookie notice", "div cookie banner|p", "div notice", "div alert", "div popup|p", "dialog", "div consent|p", "div newsletter|p"],
    "advert": ["div ad", "div ads|p", "div advert", "div sponsored|p", "aside ad", "ins ad", "section promo|p", "div banner ad"],
    "form": ["form", "form|label", "form search|label", "form|p", "form|button", "div subscribe|form|p", "form login|div"],
    "comments": ["div comments|div comment|p", "section comments|p", "div comments|ul|li comment|p", "ol commentlist|li comment|div",
                 "div reader comments|p", "section comments|article comment|p", "div discussion|p", "div responses|div reply|p", "div comments|h3"],
}
PARAGRAPHS = ["p", "p", "p", "p", "h2", "h3", "blockquote|p", "ul|li", "ol|li", "p|b", "div", "pre", "table|tr|td", "section|p", "figure|figcaption"]
SHORT = ["home", "about us", "contact", "read more", "sign in", "subscribe", "privacy", "share", "next", "search"]


def design(article: list[str], around: list[str], rng: random.Random) -> tuple[list[Block], list[int]]:
    """A page laid out anew: article blocks in one holder, surroundings before, after and inside of it."""
    shell = ("html", "body") if rng.random() < 0.8 else ("html", "body", "div page")
    holder = shell + tuple(rng.choice(HOLDERS).split("|"))
    blocks, labels = [], []

    def surround(kinds: list[str], base: tuple[str, ...]) -> None:
        for kind in kinds:
            path = base + tuple(rng.choice(SURROUNDINGS[kind]).split("|"))
            texts = rng.sample(around, min(len(around), rng.randint(1, 4))) if around else []
            if kind == "comments" or (kind in ("notice", "sidebar", "advert") and rng.random() < 0.4):
                texts = [rng.choice(article) for _ in range(rng.randint(1, 3))]
            elif kind in ("menu", "form", "header") and rng.random() < 0.6:
                texts = [rng.choice(SHORT) if rng.random() < 0.5 else " ".join(rng.choice(article).split()[:rng.randint(1, 3)])
                         for _ in range(rng.randint(1, 6))]
            link = 1.0 if kind == "menu" or rng.random() < 0.2 else 0.0
            for text in texts:
                blocks.append(Block(text, path + (("a",) if link and rng.random() < 0.7 else ()), link))
                labels.append(0)

    kinds = list(SURROUNDINGS)
    surround([k for k in ("header", "menu", "notice", "advert", "form") if rng.random() < 0.5], shell)
    blocks.append(Block(article[0], holder + (rng.choice(["h1", "h1", "h2", "header|h1"]).split("|")[-1],), 0.0))
    labels.append(1)
    for text in article[1:]:
        blocks.append(Block(text, holder + tuple(rng.choice(PARAGRAPHS if rng.random() < 0.4 else ["p"]).split("|")), 0.0))
        labels.append(1)
        if rng.random() < 0.06:
            surround([rng.choice(["advert", "notice", "form", "sidebar"])], holder)
    if rng.random() < 0.4:
        surround(["comments"], holder if rng.random() < 0.4 else shell)
    surround([k for k in kinds if k not in ("header",) and rng.random() < 0.35] + ["footer"] * (rng.random() < 0.8), shell)
    return blocks, labels


def fit(sample: list[str], layouts: int = LAYOUTS, epochs: int = EPOCHS, seed: int = 3) -> Labeller:
    """The labeller from sampled pages: their own markup, and new designs of their blocks."""
    rng = random.Random(seed)
    pages, labels = [], []
    for text in sample:
        blocks = blocks_of(text)
        own = own_labels(blocks)
        if own is not None:
            pages.append(blocks)
            labels.append(own)
            article = [b.text for b, v in zip(blocks, own) if v]
            around = [b.text for b, v in zip(blocks, own) if not v]
        else:
            article = [b.text for b in blocks if len(b.text.split()) >= 12 and b.link < 0.3]
            around = [b.text for b in blocks if len(b.text.split()) < 12 or b.link >= 0.3]
        for _ in range(layouts if article else 0):
            keep = article if len(article) <= 60 else rng.sample(article, 60)
            new, known = design(keep, around, rng)
            pages.append(new)
            labels.append(known)
    return train(pages, labels, epochs, seed)


def fit_on(pages: DataFrame, html_col: str = "html", n: int = PAGES) -> Labeller:
    text = F.col(html_col).cast("string").alias("html")
    short = pages.select(text).where(F.length("html").between(1, MAX_CHARS)).withColumn("key", F.xxhash64("html"))
    picked = scratch_table(short.select("key").distinct().orderBy("key").limit(n), "picked")  # keys first: pages stay put
    sample = short.join(picked, "key").select("key", "html").distinct()  # bounded: n pages of MAX_CHARS characters

    def run(batches):
        rows = sorted((r["key"], r["html"]) for batch in batches for r in batch.to_pylist())
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(fit([t for _, t in rows[:n]]).p)]}, schema=pa.schema([("model", pa.binary())]))

    # fitted in one task; the driver gets the parameters alone
    found = sample.repartition(1).mapInArrow(run, "model binary").first()
    return Labeller(pickle.loads(found["model"])) if found else fit([])


def extract(pages: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row ``page_id, url, text, n_chars``."""
    def make():
        words, paths = Words(), {}

        def work(texts: list[str]):
            parsed = [blocks_of(t) for t in texts]
            hits = label(model, parsed, words, paths)
            found = ["\n\n".join(b.text for b, hit in zip(blocks, mine) if hit) for blocks, mine in zip(parsed, hits)]
            yield pa.array(found, pa.string())
            yield pa.array([len(t) for t in found], pa.int64())
        return work

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    return map_texts(rows, make, "text string, n_chars long", column="html")
