"""Toxicity scores from subword-bag embeddings and a linear softmax.

A word is the average of the vectors of its hashed character n-grams and of the whole word, so an unseen misspelling
shares most of its vectors with the words it resembles. A passage is the average of its words, and a two-class softmax
reads it; embeddings and softmax are trained jointly by gradient descent in numpy. A text is judged by its most toxic
passage (overlapping runs of ``WINDOW`` words), so a few words are not diluted in a long document. Training therefore
alternates: it picks the passage of every toxic text that stands for it (at first by the log-odds of its words, then by
the model) and hard and random passages of the clean texts, and takes gradient steps on those. The logit is calibrated
on texts kept apart, at the share of toxic texts among all labelled ones.

The model is fitted in one task on a bounded sample of labelled rows: at most ``per_class`` rows of each class, in the
order of a hash of the id, among texts of at most ``max_chars`` characters. The bounds do not depend on the corpus.
Every text is then scored whole: the logit of a passage is the mean of one number per word, kept in a table of words
seen, so scoring costs one look-up per word.

Defined results: null and empty texts have no passage and get the score of the bias alone; rows with a null id are
scored (and never trained on); repeated rows get one row each; with no training row of one class every score is 0
(no toxic example) or the share of toxic examples (no clean one).
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, id_text, map_texts, scratch_table

WINDOW = 6         # words in a passage
STRIDE = 3         # words between the beginnings of passages
GRAMS = (3, 4, 5)  # lengths of the character n-grams
BUCKETS = 1 << 16  # hashed vectors
DIM = 8
ROUNDS = 6         # choices of passages
STEPS = 25         # gradient steps between two choices
RATE = 0.8         # step of the most active vector; falls to 0 at the end
RANDOM_PASSAGES = 3  # of a clean text, beside its highest one
PER_CLASS = 1500
MAX_CHARS = 20_000
THRESHOLD = 0.3
CACHE_WORDS = 100_000
WORD = re.compile(r"\w+")


def word_list(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams_of(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed vectors of words, as (bucket, word number): each ``<word>`` whole and its character n-grams."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), lengths)
    first = np.cumsum(lengths) - lengths
    left = np.repeat(first + lengths, lengths) - np.arange(len(codes))  # characters from here to the end of the word
    prime, hashes, owners = np.uint64(1_000_003), [], []
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        h = h * prime
        m = max(0, len(codes) - n + 1)
        h[:m] += codes[n - 1:n - 1 + m]
        if n in GRAMS:
            at = left >= n
            hashes.append(h[at] * np.uint64(2 * n + 1))
            owners.append(word[at])
    power = np.cumprod(np.full(int(lengths.max()), prime)) if len(words) else np.zeros(0, np.uint64)
    if len(words):
        hashes.append(np.add.reduceat(codes * power[np.arange(len(codes)) - np.repeat(first, lengths)], first))
        owners.append(np.arange(len(words)))
    h = np.concatenate(hashes)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(20)).astype(np.int64) % buckets, np.concatenate(owners)


def passages(n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings and ends of the passages of a text of ``n_words`` words; they cover every word."""
    if n_words <= WINDOW:
        return np.zeros(min(n_words, 1), np.int64), np.full(min(n_words, 1), n_words, np.int64)
    starts = np.arange(0, n_words - WINDOW + STRIDE, STRIDE)
    starts[-1] = n_words - WINDOW
    return starts, starts + WINDOW


@dataclass
class Model:
    grams: np.ndarray    # BUCKETS x DIM
    softmax: np.ndarray  # DIM x 2
    bias: np.ndarray     # 2
    constant: float | None = None  # score of every text where a class had no example

    def word_logits(self, words: list[str]) -> np.ndarray:
        """What each word adds to the mean logit of its passage."""
        if not words:
            return np.zeros(0)
        per_gram = self.grams @ (self.softmax[:, 1] - self.softmax[:, 0])
        gram, word = grams_of(words, len(self.grams))
        return np.bincount(word, per_gram[gram], len(words)) / np.bincount(word, minlength=len(words))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(texts: list[str], labels: list[int], share: float | None = None, buckets: int = BUCKETS, seed: int = 7) -> Model:
    """Embeddings and softmax trained jointly on labelled texts; ``share``: of toxic texts where it is applied."""
    y = np.array(labels, np.float64)
    zero = Model(np.zeros((buckets, DIM), np.float32), np.zeros((DIM, 2)), np.zeros(2))
    number: dict[str, int] = {}
    tokens, starts, ends, owner, bases, base = [], [], [], [], [], 0
    for k, text in enumerate(texts):
        words = word_list(text)
        bases.append(base)
        tokens.extend(number.setdefault(w, len(number)) for w in words)
        a, b = passages(len(words))
        starts.append(a + base)
        ends.append(b + base)
        owner.append(np.full(len(a), k))
        base += len(words)
    if base == 0 or y.min() == y.max():
        zero.constant = float(y.mean()) if len(y) else 0.0
        return zero
    token = np.array(tokens, np.int64)
    start, end, owner = (np.concatenate(x) for x in (starts, ends, owner))
    length = (end - start).astype(np.float64)
    gram, gram_word = grams_of(list(number), buckets)
    order = np.argsort(gram_word, kind="stable")
    gram, n_grams = gram[order], np.bincount(gram_word, minlength=len(number))
    first = np.cumsum(n_grams) - n_grams
    apart = np.arange(len(y)) % 5 == 4  # for calibration
    learn = ~apart if len(set(y[~apart])) == 2 else np.ones(len(y), bool)

    # log-odds of the texts that hold a word, to choose the first passages
    text_of = np.repeat(np.arange(len(y)), [int(b[-1]) - base_ if len(b) else 0 for b, base_ in zip(ends, bases)])
    once = np.unique(text_of * len(number) + token)
    who, once = once // len(number), once % len(number)
    hits = [np.bincount(once[learn[who] & (y[who] == c)], minlength=len(number)) for c in (0, 1)]
    totals = [(y[learn] == c).sum() for c in (0, 1)]
    word_score = np.log((hits[1] + 0.2) / (totals[1] + 0.4)) - np.log((hits[0] + 0.2) / (totals[0] + 0.4))
    word_score = np.where(hits[0] + hits[1] > 1, np.maximum(word_score, 0) ** 2, 0)

    rng = np.random.default_rng(seed)
    grams, soft, bias = rng.normal(0, 0.01, (buckets, DIM)), rng.normal(0, 0.3, (DIM, 2)), np.zeros(2)
    speed = [np.zeros_like(x) for x in (grams, soft, bias)]
    text_first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    text_size = np.diff(np.r_[text_first, len(owner)])

    def passage_scores() -> np.ndarray:
        run = np.r_[0.0, np.cumsum(word_score[token])]
        return (run[end] - run[start]) / length

    def highest(score: np.ndarray) -> np.ndarray:
        """The passage of each text with the highest score (the first of equals)."""
        top = np.repeat(np.maximum.reduceat(score, text_first), text_size)
        at = np.flatnonzero(score == top)
        return at[np.unique(owner[at], return_index=True)[1]]

    for round_ in range(ROUNDS):
        top = highest(passage_scores())
        other = text_first[:, None] + (rng.random((len(text_first), RANDOM_PASSAGES)) * text_size[:, None]).astype(np.int64)
        other = other[y[owner[text_first]] == 0].ravel()
        at = np.concatenate([top, other])
        at = at[learn[owner[at]]]
        target, size = y[owner[at]], length[at].astype(np.int64)
        weight = np.where(target == 1, 0.5 / max(1, (target == 1).sum()), 0.5 / max(1, (target == 0).sum()))
        # only the words of the chosen passages take part
        of = np.repeat(np.arange(len(at)), size)
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start[at], size)
        used, local = np.unique(token[place], return_inverse=True)
        per_word = n_grams[used]
        pick = np.arange(per_word.sum()) - np.repeat(np.cumsum(per_word) - per_word, per_word) + np.repeat(first[used], per_word)
        mine, mine_first = gram[pick], np.cumsum(per_word) - per_word
        mine_word = np.repeat(np.arange(len(used)), per_word)
        for step in range(STEPS):
            vectors = np.add.reduceat(grams[mine], mine_first, axis=0) / per_word[:, None]
            logit = vectors @ soft
            diff = (logit[:, 1] - logit[:, 0])[local]
            p = sigmoid(np.bincount(of, diff, len(at)) / size + bias[1] - bias[0])
            g = (p - target) * weight                                        # d loss / d (logit 1 - logit 0)
            of_word = np.bincount(local, (g / size)[of], len(used))
            d_logit = np.column_stack([-of_word, of_word])
            d_word = (d_logit @ soft.T) / per_word[:, None]
            d_grams = np.column_stack([np.bincount(mine, d_word[mine_word, d], buckets) for d in range(DIM)])
            rate = RATE * (1 - (round_ * STEPS + step) / (ROUNDS * STEPS))
            for x, d, v in zip((grams, soft, bias), (d_grams, vectors.T @ d_logit, np.array([-g.sum(), g.sum()])), speed):
                v *= 0.8
                v += d
                # one scale for a whole matrix: what few passages share moves little
                x -= rate * min(1.0, 4 * np.abs(g).sum()) * v / (np.abs(v).max() + 1e-12)
        word_score = np.add.reduceat((grams @ (soft[:, 1] - soft[:, 0]))[gram], first) / n_grams
    model = Model(grams.astype(np.float32), soft, bias)

    # calibration: a slope and an offset for the highest logit of the texts kept apart
    z = np.full(len(y), bias[1] - bias[0])
    z[owner[text_first]] += np.maximum.reduceat(passage_scores(), text_first)
    use = apart if len(set(y[apart])) == 2 else np.ones(len(y), bool)
    share = y.mean() if share is None else share
    weight = np.where(y == 1, share / max(1, y[use].sum()), (1 - share) / max(1, (1 - y[use]).sum()))[use]
    scale, shift = calibrate(z[use], y[use], weight)
    return Model(model.grams, soft * scale, bias * scale + np.array([0.0, shift]))


def calibrate(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic fit (Newton steps with a little shrinkage towards slope 1)."""
    x, w = np.column_stack([z, np.ones(len(z))]), np.array([1.0, 0.0])
    for _ in range(60):
        p = sigmoid(x @ w)
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([2e-3, 1e-5])
        grad = x.T @ (weight * (p - y)) + np.array([2e-3 * (w[0] - 1), 1e-5 * w[1]])
        move = np.linalg.solve(hess, grad)
        w = w - np.clip(move, -2, 2)
        w[0] = max(w[0], 0.05)
    return float(w[0]), float(w[1])


def held_out(id_col: str = "doc_id"):
    """The fold that is never trained on; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> DataFrame:
    """The bounded sample: per class the ``per_class`` first rows in the order of a hash of the id."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    ids = docs.where(F.length("text") <= max_chars).where(~held_out()).select("doc_id").distinct().join(marks, "doc_id")
    key = F.xxhash64("doc_id")
    picked = None
    for label in (0, 1):
        part = ids.where(F.col("toxic") == label).orderBy(key, "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    # at most 2 * per_class ids whatever the corpus; written, so that Spark knows their size and broadcasts them
    picked = scratch_table(picked, "sample")
    texts = docs.where(F.length("text") <= max_chars).join(picked, "doc_id")
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Model:
    """The model of the bounded sample, fitted in one task (at most ``2 * per_class`` texts of ``max_chars``
    characters); the driver gets the parameters alone."""
    sample = training_rows(id_text(docs), labels, per_class, max_chars)
    share = labels.where(F.col("toxic").isin(0, 1)).where(~held_out()).agg(F.avg(F.col("toxic").cast("double"))).first()[0]

    def run(batches):
        rows = sorted((zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"], r["text"], r["toxic"])
                      for batch in batches for r in batch.to_pylist())
        if rows:
            m = fit([r[2] for r in rows], [r[3] for r in rows], share)
            parts = [m.grams.astype("<f4").tobytes(), m.softmax.astype("<f8").tobytes(), m.bias.astype("<f8").tobytes()]
            yield pa.RecordBatch.from_arrays([*[pa.array([x], pa.binary()) for x in parts], pa.array([m.constant], pa.float64())],
                                             names=["grams", "softmax", "bias", "constant"])

    found = sample.repartition(1).mapInArrow(run, "grams binary, softmax binary, bias binary, constant double").collect()
    if not found:
        return fit([], [])
    r = found[0]
    return Model(np.frombuffer(r.grams, "<f4").reshape(-1, DIM), np.frombuffer(r.softmax, "<f8").reshape(DIM, 2),
                 np.frombuffer(r.bias, "<f8"), r.constant)


def scorer(model: Model):
    """Factory of the function from texts to scores, for :func:`map_texts`."""
    bias = float(model.bias[1] - model.bias[0])

    def make():
        known: dict[str, float] = {}

        def logit(text: str) -> float:
            words = word_list(text)
            if not words:
                return bias
            new = [w for w in dict.fromkeys(words) if w not in known]
            if new:
                if len(known) > CACHE_WORDS:
                    known.clear()
                    new = list(dict.fromkeys(words))
                known.update(zip(new, model.word_logits(new).tolist()))
            run = np.r_[0.0, np.cumsum(np.fromiter(map(known.__getitem__, words), np.float64, len(words)))]
            a, b = passages(len(words))
            return float(((run[b] - run[a]) / (b - a)).max()) + bias

        def work(texts: list[str]):
            if model.constant is not None:
                yield pa.array([model.constant] * len(texts), pa.float64())
            else:
                yield pa.array(sigmoid(np.array([logit(t) for t in texts])), pa.float64())
        return work

    return make


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, held_out, score, predicted``."""
    scored = map_texts(id_text(docs, id_col, text_col), scorer(model), "score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows below the threshold, with their columns (no join: the score is computed beside the row)."""
    text, score_of = fresh(docs, "text_scored"), fresh(docs, "score_of_text")
    scored = map_texts(docs.withColumn(text, F.col(text_col).cast("string")), scorer(model), f"{score_of} double", column=text)
    return scored.where(F.col(score_of) < threshold).select(*docs.columns)
