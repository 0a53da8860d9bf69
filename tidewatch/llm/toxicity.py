"""Toxicity from subword bags: character n-gram vectors averaged into a linear softmax.

A word is the mean of the vectors of its character n-grams, a window of words the mean of its words, and a
linear softmax over that mean gives the probability of label 1.  Vectors and softmax are trained jointly.  A
misspelt word shares most n-grams, so it lands near the word it comes from.  A document counts as its most
toxic window, since a few words make a long text toxic; in training only the likeliest windows of a toxic
document stand for it.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.shipping import ship_by_value

ship_by_value(__name__)

WINDOW = 24
BUCKETS = 1 << 17
DIMENSIONS = 8
GRAMS = (3, 4, 5)
THRESHOLD = 0.7
DECAY = 2e-6
SOFT = 5.0
# The share of toxic documents that probabilities are fitted for.
TOXIC_SHARE = 0.3
# Bounds of the sample the model is fitted on: documents of each label, and the characters of each of them.
SAMPLE_EACH = 1500
SAMPLE_CHARS = 20_000
MEMO_WORDS = 300_000
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def grams_of(word: str) -> list[int]:
    """Buckets of the whole word and of its character n-grams, its borders marked."""
    marked = f"<{word}>"
    # Slices of bytes are slices of characters where every character is one byte.
    text = marked.encode() if marked.isascii() else marked
    grams = [text, *(text[i : i + n] for n in GRAMS for i in range(len(text) - n + 1))]
    if text is marked:
        grams = [g.encode("utf-8", "surrogatepass") for g in grams]
    return [zlib.crc32(g) % BUCKETS for g in grams]


@dataclass
class Classifier:
    """What scoring needs: after training, softmax and averages are linear, so a bucket is one number."""

    bucket_weights: np.ndarray
    bias: float


class _WordWeights(dict):
    def __init__(self, model: Classifier):
        self.weights = model.bucket_weights.tolist()

    def __missing__(self, word: str) -> float:
        if len(self) >= MEMO_WORDS:
            self.clear()
        grams = grams_of(word)
        value = self[word] = sum(map(self.weights.__getitem__, grams)) / len(grams)
        return value


def window_logits(values: np.ndarray, bias: float) -> np.ndarray:
    """Mean word weight plus bias of every window, at each quarter window and at the end of the text.

    A shorter text is filled up with words of weight zero, so that a few odd words don't decide alone, and a
    word that comes again within a window's length counts once (words are told apart by their weights).
    """
    n = len(values)
    order = np.argsort(values, kind="stable")
    again = (np.diff(values[order]) == 0) & (np.diff(order) < WINDOW)
    values = values.copy()
    values[order[1:][again]] = 0.0
    if n <= WINDOW:
        return np.array([values.sum() / WINDOW + bias])
    sums = np.concatenate([[0.0], np.cumsum(values)])
    starts = np.arange(0, n - WINDOW + 1, WINDOW // 4)
    starts = np.append(starts, n - WINDOW)
    return (sums[starts + WINDOW] - sums[starts]) / WINDOW + bias


def score(text: str | None, model: Classifier, weights: dict | None = None) -> float:
    """0 to 1; a text without words gets what the bias alone says."""
    weights = _WordWeights(model) if weights is None else weights
    words = words_of(text)
    values = np.fromiter(map(weights.__getitem__, words), np.float64, len(words))
    return float(1 / (1 + np.exp(-np.clip(window_logits(values, model.bias).max(), -50, 50))))


class _Bags:
    """Words of the sample as flat lists of buckets, windows as flat lists of words."""

    def __init__(self, texts: list[str | None]):
        ids: dict[str, int] = {}
        windows, owner = [], []
        for d, text in enumerate(texts):
            found = [ids.setdefault(w, len(ids)) for w in words_of(text)]
            for at in range(0, max(1, len(found)), WINDOW):
                windows.append(np.unique(np.array(found[at : at + WINDOW], np.int64)))
                owner.append(d)
        grams = [grams_of(w) for w in ids]
        self.gram = np.array([g for gs in grams for g in gs], np.int64)
        self.gram_n = np.array([len(gs) for gs in grams], np.int64)
        self.gram_at = np.concatenate([[0], np.cumsum(self.gram_n)[:-1]]).astype(np.int64)
        self.windows, self.owner = windows, np.array(owner, np.int64)

    def word_values(self, bucket_values: np.ndarray) -> np.ndarray:
        if not len(self.gram):
            return np.zeros((0, *bucket_values.shape[1:]))
        sums = np.add.reduceat(bucket_values[self.gram], self.gram_at, axis=0)
        return sums / (self.gram_n if sums.ndim == 1 else self.gram_n[:, None])

    def batch(self, chosen: np.ndarray):
        """(distinct words, for each word of a window its row among them, its window, its weight)."""
        lists = [self.windows[i] for i in chosen]
        sizes = np.array([len(x) for x in lists], np.int64)
        flat = np.concatenate(lists) if len(lists) else np.empty(0, np.int64)
        words, row = np.unique(flat, return_inverse=True)
        window = np.repeat(np.arange(len(chosen)), sizes)
        return words, row, window, np.full(len(flat), 1.0 / WINDOW)

    def buckets(self, words: np.ndarray):
        n = self.gram_n[words]
        at = np.repeat(self.gram_at[words] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return self.gram[at], np.repeat(np.arange(len(words)), n), np.repeat(1.0 / n, n)


def _scatter(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(rows, values[:, k], size) for k in range(values.shape[1])], axis=1)


def train(texts: list[str | None], labels: list[int], rounds: int = 3, epochs: int = 3, steps: int = 120, seed: int = 7) -> Classifier:
    """Joint training of n-gram vectors and softmax by Adagrad; both labels weigh the same.

    In the first round every window has its document's label.  After each round the windows that speak for toxic
    documents are chosen anew: those over one half, so that wrong labels lose their say.  A round has ``epochs`` passes
    over the windows, and of a small sample as many as make ``steps`` steps.
    """
    rng = np.random.default_rng(seed)
    bags = _Bags(texts)
    wanted = np.array(labels, np.int64)[bags.owner] if len(labels) else np.empty(0, np.int64)
    vectors = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    softmax, bias = rng.normal(0, SOFT, (DIMENSIONS, 2)), np.zeros(2)
    seen = [np.full(x.shape, 1e-6) for x in (vectors, softmax, bias)]
    active = np.ones(len(wanted), bool)

    def step(parameter, squares, gradient, rate, rows=slice(None)):
        squares[rows] += gradient**2
        parameter[rows] -= rate * gradient / np.sqrt(squares[rows])

    for _ in range(rounds if len(set(wanted.tolist())) == 2 else 0):
        share = np.array([(wanted[active] == k).sum() for k in (0, 1)])
        weight = len(wanted[active]) / (2 * share)
        parts = max(1, int(active.sum()) // 512, min(8, int(active.sum()) // 64))
        for _ in range(max(epochs, -(-steps // parts))):
            for chosen in np.array_split(rng.permutation(np.flatnonzero(active)), parts):
                words, row, window, part = bags.batch(chosen)
                if not len(words):
                    continue
                grams, of_word, gram_part = bags.buckets(words)
                touched, at = np.unique(grams, return_inverse=True)
                word_vectors = _scatter(of_word, vectors[grams] * gram_part[:, None], len(words))
                means = _scatter(window, word_vectors[row] * part[:, None], len(chosen))
                logits = means @ softmax + bias
                p = np.exp(logits - logits.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(chosen)), wanted[chosen]] -= 1
                error = p * weight[wanted[chosen]][:, None] / len(chosen)
                word_error = _scatter(row, (error @ softmax.T)[window] * part[:, None], len(words))
                step(vectors, seen[0], _scatter(at, word_error[of_word] * gram_part[:, None], len(touched)) + DECAY * vectors[touched], 0.3, touched)
                step(softmax, seen[1], means.T @ error, 0.1)
                step(bias, seen[2], error.sum(axis=0), 0.1)
        word_logits = bags.word_values(vectors @ (softmax[:, 1] - softmax[:, 0]))
        logits = np.array([word_logits[w].sum() / WINDOW for w in bags.windows]) + bias[1] - bias[0]
        active = (wanted == 0) | (logits > 0)
        if not (wanted[active] == 1).any():
            break
    return _calibrated(Classifier(vectors @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0])), texts, labels)


def _calibrated(model: Classifier, texts, labels) -> Classifier:
    """The same model with scale and bias such that whole documents, not windows, get fitting probabilities."""
    if len(set(labels)) < 2:
        share = np.mean(labels) if len(labels) else 0.0
        return Classifier(np.zeros(BUCKETS), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    weights = _WordWeights(model)
    top = np.empty(len(texts))
    for i, text in enumerate(texts):
        words = words_of(text)
        top[i] = window_logits(np.fromiter(map(weights.__getitem__, words), np.float64, len(words)), model.bias).max()
    y = np.array(labels, float)
    mean, spread = top.mean(), top.std() + 1e-9
    x, a, b = (top - mean) / spread, 1.0, 0.0
    weight = np.where(y == 1, TOXIC_SHARE / y.mean(), (1 - TOXIC_SHARE) / (1 - y.mean()))
    for _ in range(2000):
        error = (1 / (1 + np.exp(-(a * x + b))) - y) * weight
        a, b = a - 0.5 * (error * x).mean() - 1e-4 * a, b - 0.5 * error.mean()
    scale = max(a, 1e-3) / spread
    return Classifier(model.bucket_weights * scale, float(scale * (model.bias - mean) + b))


def held_out(doc_id="doc_id"):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, each: int = SAMPLE_EACH, max_chars: int = SAMPLE_CHARS) -> Classifier:
    """Train on a sample of at most ``each`` documents of either label, at most ``max_chars`` characters long.

    The sample is the first by a hash of doc_id, so it is the same in every run.  Conflicting labels of one
    doc_id: the larger counts.  Held-out rows, null ids and null labels are left out.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.max("toxic") == 1).cast("int").alias("toxic"))
    short = docs.where(F.char_length("text") <= max_chars).select(F.col("doc_id").cast("bigint").alias("doc_id"))
    eligible = known.join(short.distinct(), "doc_id", "left_semi")
    first = [eligible.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(each) for k in (0, 1)]
    chosen = first[0].unionByName(first[1])  # at most 2 * each rows
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.char_length("text") <= max_chars)
    one = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    rows = sorted(one.collect())
    return train([r.text for r in rows], [r.toxic for r in rows])


def _shared(docs: DataFrame, model: Classifier):
    # Plain values, so that workers need no copy of this package to read them; their size is fixed by BUCKETS.
    return docs.sparkSession.sparkContext.broadcast((model.bucket_weights, model.bias))


def _scored(shared):
    def run(batches):
        model = Classifier(*shared.value)
        weights = _WordWeights(model)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            found = [score(t.as_py(), model, weights) for t in batch.column(at)]
            rest = [batch.column(i) for i in range(batch.num_columns) if i != at]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(found, pa.float64())], [*names, "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, model: Classifier | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from ``threshold`` on).

    A null text counts as empty; a text without words gets the score of the bias.  A null doc_id is scored and not
    held out.  Without labels of both kinds every score is the share of label 1.  Repeated rows get equal scores;
    an empty table gives no rows.  Only text and doc_id are read, and doc_id decides nothing but held_out.
    """
    shared = _shared(docs, model or fitted(docs, labels))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(_scored(shared), "doc_id bigint, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score stays under ``threshold``, with all their columns."""
    shared = _shared(docs, fitted(docs, labels))

    @F.pandas_udf("double")
    def scores(texts):
        model = Classifier(*shared.value)
        weights = _WordWeights(model)
        return texts.map(lambda t: score(t if isinstance(t, str) else "", model, weights)).astype("float64")

    return docs.where(scores(F.col("text").cast("string")) < threshold)
