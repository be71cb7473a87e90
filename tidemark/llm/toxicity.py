"""Toxicity by a convolutional text classifier in numpy.

Words (runs of letters, A-Z lowered) get the sum of four hashed embeddings:
the word, its first 4 and 7 bytes and its last 4.  Filters of several widths
slide over the words, each filter's maximum over the whole text goes through
a linear layer.  Training is Adagrad on a bounded sample of labelled rows.
Thresholds are then calibrated by the language that the text's own function
words show, and moved to 0.5: a fifth of all labelled rows, by their key's
crc, is held back from training and scored in Spark, and the counts of scores
by language and label set the best F1.  A language's counts are joined by
``PRIOR`` rows' worth of all languages' counts, at every size.

Scores depend on the text alone.  Null and empty texts have no words; they
get the score of the bare biases.  Without toxic or without clean labelled
rows every score is the share of toxic rows (0 without labels).  Repeated
labels of a document count as toxic if one of them is; repeated rows get equal
scores; a score of exactly 0.5 counts as toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Hasher, blocks, crc_mod, map_arrow, words_of

BUCKETS = (1 << 16) - 1  # the row after them, of zeros, pads the ends of texts: rows fit 16 bits
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS)

#: Function words that show a language.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it was with as be by on are this from or an",
    "de": "der die und das ist von mit nicht ein eine den auf für sich im zu dem auch als des",
    "fr": "le les des et est un une du que dans pour pas qui sur avec au par plus ce il",
    "es": "el los las y que por con para una se del no su lo como más es un al pero",
}


def _hash_words(words: str) -> np.ndarray:
    data, s, e, _ = words_of([words.encode()], letters=True)
    return np.sort(Hasher(data).hash(s, e))


_FUNCTION = [_hash_words(w) for w in FUNCTION_WORDS.values()]
LANGUAGES = [*FUNCTION_WORDS, ""]


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ids, first, language)``: bucket rows (four a word, texts padded), each text's first row, and its language's index."""
    data, s, e, counts = words_of(texts, letters=True)
    if len(s):
        h = Hasher(data)
        whole = h.hash(s, e)
        salts = (np.uint64(0), np.uint64(0x1111), np.uint64(0x2222), np.uint64(0x3333))
        parts = (whole, h.hash(s, np.minimum(e, s + 4)), h.hash(s, np.minimum(e, s + 7)), h.hash(np.maximum(s, e - 4), e))
        got = np.stack([((p + salt) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48) for p, salt in zip(parts, salts, strict=True)], axis=1).astype(np.uint16)
        got[got == BUCKETS] = 0
    else:
        whole, got = np.empty(0, np.uint64), np.empty((0, 4), np.uint16)
    text = np.repeat(np.arange(len(texts)), counts)
    rows = np.arange(len(whole)) + PAD * text
    ids = np.full((len(whole) + PAD * len(texts), 4), BUCKETS, np.uint16)
    ids[rows] = got
    first = np.cumsum(counts) - counts + PAD * np.arange(len(texts))
    votes = np.zeros((len(texts), len(_FUNCTION) + 1))
    votes[:, -1] = 0.5  # no function words: no language
    for i, words in enumerate(_FUNCTION):
        at = np.minimum(np.searchsorted(words, whole), len(words) - 1)
        votes[:, i] = np.bincount(text[words[at] == whole], minlength=len(texts))
    return ids, first, votes.argmax(axis=1)


@dataclass
class Model:
    """Projected embeddings (one table for all filters and offsets), biases, the linear layer and a shift by language."""

    table: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    offset: float
    shift: np.ndarray
    share: float | None = None  # a constant score, where nothing could be learnt

    def logits(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        filters = len(self.bias) // len(WIDTHS)
        y = self.table[ids[:, 0]]
        for j in (1, 2, 3):
            y += self.table[ids[:, j]]
        pooled, col = np.empty((len(first), len(self.bias)), np.float32), 0
        # windows begin at each word and at the first pad; from later pads they would reach into the next text
        ends = np.append(first[1:], len(y))
        outside = np.concatenate([ends - j for j in range(1, PAD)])
        for w, width in enumerate(WIDTHS):
            z = y[:, col : col + filters].copy()
            for j in range(1, width):
                z[: len(y) - j] += y[j:, col + j * filters : col + (j + 1) * filters]
            col += width * filters
            z[outside] = -np.inf
            pooled[:, w * filters : (w + 1) * filters] = np.maximum.reduceat(z, first, axis=0)
        return np.maximum(pooled + self.bias, 0) @ self.weight + self.offset

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.share is not None:
            return np.full(len(texts), self.share)
        ids, first, language = encode(texts)
        z = self.logits(ids, first)
        return 1 / (1 + np.exp(-np.clip(z - self.shift[language], -40, 40)))


class Trainer:
    def __init__(self, dim: int = 16, filters: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.rng, self.filters = rng, filters
        self.e = rng.normal(0, 0.1, (BUCKETS + 1, dim)).astype(np.float32)
        self.e[-1] = 0
        self.w = [rng.normal(0, 0.3, (k, dim, filters)).astype(np.float32) for k in WIDTHS]
        self.bias = np.zeros(filters * len(WIDTHS), np.float32)
        self.v = rng.normal(0, 0.3, filters * len(WIDTHS)).astype(np.float32)
        self.c = np.zeros(1, np.float32)
        self.seen = {name: np.full(a.shape, 0.01, np.float32) for name, a in (("v", self.v), ("c", self.c), ("bias", self.bias), *((f"w{i}", w) for i, w in enumerate(self.w)))}
        self.seen_e = np.full(BUCKETS + 1, 0.01, np.float32)

    def _adagrad(self, name: str, a: np.ndarray, g: np.ndarray, rate: float) -> None:
        self.seen[name] += g * g
        a -= rate * g / np.sqrt(self.seen[name])

    def step(self, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rate: float, decay: float = 1e-4) -> None:
        ids = np.concatenate(docs)
        first = np.cumsum([0, *(len(d) for d in docs)])
        keep = (self.rng.random(len(ids)) > 0.1)[:, None]  # whole words drop out
        x = self.e[ids].sum(axis=1) * keep
        n, f = len(docs), self.filters
        pooled, where = np.empty((n, f * len(WIDTHS)), np.float32), np.empty((n, f * len(WIDTHS)), np.int64)
        for w, width in enumerate(WIDTHS):
            z = np.zeros((len(x), f), np.float32)
            for j in range(width):
                z[: len(x) - j] += x[j:] @ self.w[w][j]
            for i in range(n):
                at = z[first[i] : first[i + 1] - PAD + 1].argmax(axis=0) + first[i]
                where[i, w * f : (w + 1) * f] = at
                pooled[i, w * f : (w + 1) * f] = z[at, np.arange(f)]
        a = np.maximum(pooled + self.bias, 0)
        p = 1 / (1 + np.exp(-np.clip(a @ self.v + self.c, -30, 30)))
        d = ((p - y) * weight / n).astype(np.float32)
        da = d[:, None] * self.v * (a > 0)
        touched, grads = [], []
        for w, width in enumerate(WIDTHS):
            at, g = where[:, w * f : (w + 1) * f], da[:, w * f : (w + 1) * f]
            gw = np.empty_like(self.w[w])
            for j in range(width):
                rows = x[at + j]  # n, f, dim
                gw[j] = np.einsum("nfd,nf->df", rows, g)
                gx = g[:, :, None] * self.w[w][j].T[None]
                gx *= keep[at + j]
                touched.append(ids[at + j].reshape(-1, 4))
                grads.append(gx.reshape(-1, gx.shape[-1]))
            self._adagrad(f"w{w}", self.w[w], gw + decay * self.w[w], rate)
        self._adagrad("v", self.v, a.T @ d + decay * self.v, rate)
        self._adagrad("c", self.c, np.array([d.sum()], np.float32), rate)
        self._adagrad("bias", self.bias, da.sum(axis=0), rate)
        rows, grad = np.concatenate(touched), np.concatenate(grads)
        rows, grad = rows.T.ravel(), np.tile(grad, (4, 1))
        unique, inverse = np.unique(rows, return_inverse=True)
        total = np.zeros((len(unique), grad.shape[1]), np.float32)
        np.add.at(total, inverse, grad)
        total[unique == BUCKETS] = 0
        total += decay * self.e[unique]
        self.seen_e[unique] += (total * total).mean(axis=1)
        self.e[unique] -= rate * total / np.sqrt(self.seen_e[unique])[:, None]
        self.e[-1] = 0

    def model(self) -> Model:
        table = np.concatenate([self.e @ self.w[w][j] for w, width in enumerate(WIDTHS) for j in range(width)], axis=1)
        return Model(table.astype(np.float32), self.bias.copy(), self.v.copy(), float(self.c[0]), np.zeros(len(LANGUAGES)))


#: Logits are counted in bins of this width, up to LIMIT either way.
BIN, LIMIT = 1 / 64, 40
PRIOR = 40.0


def _threshold(z: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> float:
    """The logit with the best F1, in the middle of its gap; ties go to the one nearest 0.
    ``y`` of ``n`` rows (one each by default) at each of ``z`` are toxic."""
    order = np.argsort(-z, kind="stable")
    zs, ys = z[order], y[order]
    hit = np.cumsum(ys)
    f1 = 2 * hit / ((np.arange(1, len(z) + 1) if n is None else np.cumsum(n[order])) + y.sum())
    cut = np.append((zs[:-1] + zs[1:]) / 2, zs[-1] - 1)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(cut[best[np.abs(cut[best]).argmin()]])


def calibrate(m: Model, counts: np.ndarray) -> None:
    """Shifts from ``counts (language, label, bin)`` of held-back rows; too few toxic or no clean rows leave them."""
    total = counts.sum(axis=0)
    if total[1].sum() < 5 or not total[0].sum():
        return
    for k in range(len(LANGUAGES)):
        clean, toxic = counts[k] + PRIOR * total / total.sum()
        at = np.flatnonzero(clean + toxic)
        m.shift[k] = _threshold((at + 0.5) * BIN - LIMIT, toxic[at], clean[at] + toxic[at])


def train(texts: list[bytes], y: np.ndarray, **settings) -> Model:
    """A model from labelled whole texts."""
    return train_encoded([encode([t]) for t in texts], np.asarray(y, np.float64), **settings)


def train_encoded(encoded: list, y: np.ndarray, epochs: int = 8, steps: int = 500, batch: int = 32, rate: float = 0.15, held: int = 5, seed: int = 7) -> Model:
    """A model from encoded texts: ``epochs`` passes and ``steps`` updates at least; every ``held``-th row only calibrates (0: none)."""
    if not len(y) or y.min() == y.max():
        return Model(np.zeros((1, 1)), np.zeros(3), np.zeros(3), 0.0, np.zeros(len(LANGUAGES)), float(y.mean()) if len(y) else 0.0)
    docs = [x[0] for x in encoded]
    languages = np.array([int(x[2][0]) for x in encoded])
    t = Trainer(seed=seed)
    order = t.rng.permutation(len(docs))
    back = np.arange(len(order)) % held == 0 if held else np.zeros(len(order), bool)
    fit, check = order[~back], order[back]
    balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    passes = max(epochs, -(-steps * batch // max(len(fit), 1)))
    for epoch in range(passes):
        t.rng.shuffle(fit)
        for at in range(0, len(fit), batch):
            i = fit[at : at + batch]
            t.step([docs[j] for j in i], y[i], balance[i], rate / (1 + 2.4 * epoch / passes))
    m = t.model()
    z, language = np.empty(len(check)), languages[check]
    for at in range(0, len(check), 64):
        some = [docs[i] for i in check[at : at + 64]]
        z[at : at + 64] = m.logits(np.concatenate(some), np.cumsum([0, *map(len, some[:-1])]))
    target = y[check]
    if target.sum() >= 5 and target.sum() < len(target):
        m.shift[:] = _threshold(z, target)
        for k in range(len(LANGUAGES)):
            mine = language == k
            if target[mine].sum() >= 20 and (1 - target[mine]).sum() >= 20:
                m.shift[k] = _threshold(z[mine], target[mine])
    return m


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", where: Column | None = None, max_toxic: int = 2500, max_clean: int = 5000, held: int = 5) -> Model:
    """A model from at most ``max_toxic`` toxic and ``max_clean`` clean labelled rows (the smallest by the key's hash),
    its thresholds from all labelled rows held back: every ``held``-th of the key's crc, beside the remainder modulo 5.

    Only the sample is bounded; its texts are whole.  Of the texts of a repeated key the smallest counts.
    """
    known = labels.select(F.col(key).alias("_key"), F.col(label).alias("_y"))
    known = known.where("_y IS NOT NULL AND _key IS NOT NULL").groupBy("_key").agg(F.max("_y").alias("_y"))
    if where is not None:
        known = known.where(where)
    back = F.floor(F.crc32(F.col("_key").cast("string").cast("binary")) / 5) % held == 0
    src = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    encoded, y = _sample(src, known.where(~back), max_toxic, max_clean)
    if len(set(y)) < 2:  # nothing to hold back from
        encoded, y = _sample(src, known, max_toxic, max_clean)
        return train_encoded(encoded, np.array(y, np.float64), held=0)
    model = train_encoded(encoded, np.array(y, np.float64), held=0)
    calibrate(model, _counts(src.where(back & F.col("_key").isNotNull()), known, model))
    return model


def _sample(src: DataFrame, known: DataFrame, max_toxic: int, max_clean: int) -> tuple[list, list[float]]:
    by = F.xxhash64("_key")
    parts = [known.where(F.col("_y") == v).orderBy(by, "_key").limit(n) for v, n in ((1, max_toxic), (0, max_clean))]
    sample = parts[0].unionByName(parts[1])
    rows = src.join(F.broadcast(sample), "_key").groupBy("_key", "_y").agg(F.min("_text").alias("_text")).orderBy(by, "_key")
    encoded, y = [], []
    for r in rows.select("_text", "_y").toLocalIterator():  # word rows of 8 bytes stay, texts go
        encoded.append(encode([(r._text or "").encode("utf-8", "surrogatepass")]))
        y.append(float(r._y))
    return encoded, y


def _counts(src: DataFrame, known: DataFrame, model: Model) -> np.ndarray:
    """``(language, label, bin)`` counts of the labelled rows among ``src``, scored in Spark; at most as many rows come back as there are bins."""
    shared = src.sparkSession.sparkContext.broadcast(model)
    n_bins = int(2 * LIMIT / BIN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b, at, to, texts in blocks(batches, 1):
            ids, first, language = encode(texts)
            bins = np.clip(np.floor((m.logits(ids, first) + LIMIT) / BIN), 0, n_bins - 1)
            yield pa.RecordBatch.from_arrays([b.column(0).slice(at, to - at), pa.array(language.astype(np.int32)), pa.array(bins.astype(np.int32))], ["_key", "language", "bin"])

    kind = src.schema["_key"].dataType.simpleString()
    scored = map_arrow(src, run, f"_key {kind}, language int, bin int").groupBy("_key").agg(F.min(F.struct("language", "bin")).alias("m")).select("_key", "m.*")
    counts = np.zeros((len(LANGUAGES), 2, n_bins))
    for r in scored.join(known.where("_y IN (0, 1)"), "_key").groupBy("language", "_y", "bin").count().collect():
        counts[r.language, int(r._y), r.bin] = r["count"]
    return counts


def held_in(column: str = "_key", modulus: int = 5, out: int = 0) -> Column:
    """Rows that may be learnt from: crc32 of the key as text leaves another remainder than ``out``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus != out


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, held_out, score, predicted`` for every row."""
    src = df.select(F.col(key).alias(key), F.col(text).alias("_text"))
    shared = df.sparkSession.sparkContext.broadcast(model)  # a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b, at, to, texts in blocks(batches, 1):
            s = m.scores(texts)
            keys = b.column(0).slice(at, to - at)
            out = [crc_mod(k.as_py(), 5) == 0 for k in keys]
            yield pa.RecordBatch.from_arrays([keys, pa.array(out, pa.bool_()), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], [key, "held_out", "score", "predicted"])

    kind = src.schema[key].dataType.simpleString()
    return map_arrow(src, run, f"`{key}` {kind}, held_out boolean, score double, predicted int")
