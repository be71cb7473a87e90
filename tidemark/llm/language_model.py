"""Scoring by a gated recurrent language model with a class-factored output.

``p(word | history) = p(class | history) * p(word | class)``.  Classes are the
most frequent words (a class each), the end of a text, and hashed word endings
for all other words.  A GRU in numpy predicts the class; its state is carried
from window to window, so a document's log-likelihood covers the whole text.
``p(word | class)`` comes from counts over all training documents, with 0.5
for every known word and for the unknown ones together.

Counting: a chunk of documents (a bounded number of tokens of one task) keeps
its documents as word numbers and its distinct words once; the distinct words
are dealt out by ranges of their hash, summed, and returned to their chunk
with the corpus counts.  A word with a third of all tokens is thus one row per
chunk.  Training: a warm start on the driver from a bounded sample, then one
pass of truncated backpropagation over every training document in each task,
averaged with the tokens as weights.

Null and empty texts are one end token.  A null id counts as an empty text
for the fold; repeated rows are scored (and counted) each.  Without training
documents every count is 0 and the network keeps its first state.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hasher, blocks, crc_mod, hash_sample, map_arrow, words_of, written

TOP = 31  # frequent words with a class of their own
ENDINGS = 64  # hashed endings
END = TOP  # the class of the end of a text, also the start symbol
MERGES = 256  # rows of merged figures that the driver reads
CLASSES = TOP + 1 + ENDINGS
HIDDEN = 16
WINDOW = 24  # steps of one truncated backpropagation
BATCH = 256
CHUNK_TOKENS = 2_000_000
_ONE = np.float32(1)


# ----------------------------------------------------------------- network
class Gru:
    """Parameters in one vector, so that they can be averaged."""

    SHAPES = (("e", (CLASSES, 3 * HIDDEN)), ("u", (HIDDEN, 3 * HIDDEN)), ("b", (3 * HIDDEN,)), ("o", (HIDDEN, CLASSES)), ("c", (CLASSES,)))
    SIZE = sum(int(np.prod(s)) for _, s in SHAPES)

    def __init__(self, flat: np.ndarray | None = None, seed: int = 5):
        self.flat = np.random.default_rng(seed).normal(0, 0.2, self.SIZE).astype(np.float32) if flat is None else np.array(flat, np.float32)
        self.views(self, self.flat)
        if flat is None:
            self.b[:] = 0
            self.c[:] = 0
        self.grad = np.zeros_like(self.flat)
        self.g = type("Grads", (), {})()
        self.views(self.g, self.grad)
        self.m1, self.m2, self.steps = np.zeros_like(self.flat), np.zeros_like(self.flat), 0

    @classmethod
    def views(cls, to, flat: np.ndarray) -> None:
        at = 0
        for name, shape in cls.SHAPES:
            n = int(np.prod(shape))
            setattr(to, name, flat[at : at + n].reshape(shape))
            at += n

    def window(self, x: np.ndarray, h: np.ndarray, keep: bool = False):
        """States after each of the inputs ``x`` (steps, texts); what backpropagation needs if ``keep``."""
        steps, n = x.shape
        states = np.empty((steps, n, HIDDEN), np.float32)
        kept = []
        a_all = self.e[x] + self.b
        for t in range(steps):
            a, g = a_all[t], h @ self.u
            rz = _ONE / (_ONE + np.exp(-(a[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])))
            r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
            new = np.tanh(a[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
            if keep:
                kept.append((h, r, z, new, g[:, 2 * HIDDEN :]))
            h = new + z * (h - new)
            states[t] = h
        return states, kept

    def log_probs(self, states: np.ndarray, y: np.ndarray):
        """Natural log-probability of each target class, and the class probabilities."""
        flat = states.reshape(-1, HIDDEN)
        p = flat @ self.o
        p += self.c
        np.clip(p, -30, 30, out=p)
        chosen = p[np.arange(len(flat)), y.ravel()]
        np.exp(p, out=p)
        total = p.sum(axis=1)
        return (chosen - np.log(total)).reshape(y.shape), p, total

    def learn(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray, h: np.ndarray, rate: float) -> np.ndarray:
        """One update from one window; the state after it."""
        states, kept = self.window(x, h, True)
        _, p, total = self.log_probs(states, y)
        n = max(int(mask.sum()), 1)
        p /= total[:, None]
        p[np.arange(len(p)), y.ravel()] -= 1
        p *= (mask.ravel() / np.float32(n))[:, None]
        flat = states.reshape(-1, HIDDEN)
        self.g.o[:] = flat.T @ p
        self.g.c[:] = p.sum(axis=0)
        d_states = (p @ self.o.T).reshape(states.shape)
        steps = len(x)
        d_in = np.empty((steps, x.shape[1], 3 * HIDDEN), np.float32)
        d_rec = np.empty_like(d_in)
        dh = np.zeros_like(h)
        for t in range(steps - 1, -1, -1):
            before, r, z, new, g = kept[t]
            dh = dh + d_states[t]
            dn = dh * (_ONE - z) * (_ONE - new * new)
            dr = dn * g
            dr *= r * (_ONE - r)
            dz = dh * (before - new) * z * (_ONE - z)
            d_in[t, :, :HIDDEN] = d_rec[t, :, :HIDDEN] = dr
            d_in[t, :, HIDDEN : 2 * HIDDEN] = d_rec[t, :, HIDDEN : 2 * HIDDEN] = dz
            d_in[t, :, 2 * HIDDEN :] = dn
            d_rec[t, :, 2 * HIDDEN :] = dn * r
            dh = dh * z + d_rec[t] @ self.u.T
        befores = np.concatenate([k[0] for k in kept])
        self.g.u[:] = befores.T @ d_rec.reshape(-1, 3 * HIDDEN)
        rows = d_in.reshape(-1, 3 * HIDDEN)
        self.g.b[:] = rows.sum(axis=0)
        ids = x.ravel()
        order = np.argsort(ids, kind="stable")
        edges = np.flatnonzero(np.diff(ids[order], prepend=-1))
        self.g.e[:] = 0
        self.g.e[ids[order][edges]] = np.add.reduceat(rows[order], edges, axis=0)
        norm = float(np.sqrt(np.square(self.grad).sum()))
        if norm > 1:
            self.grad /= np.float32(norm)
        self.steps += 1
        self.m1 += np.float32(0.1) * (self.grad - self.m1)
        self.m2 += np.float32(0.01) * (self.grad * self.grad - self.m2)
        step = rate * (1 - 0.99**self.steps) ** 0.5 / (1 - 0.9**self.steps)
        self.flat -= np.float32(step) * self.m1 / (np.sqrt(self.m2) + np.float32(1e-6))
        return states[-1]


def batches_of(seqs: list[np.ndarray]) -> Iterator[list[int]]:
    """Texts of like length together, longest first."""
    order = np.argsort([-len(s) for s in seqs], kind="stable").tolist()
    for at in range(0, len(order), BATCH):
        yield order[at : at + BATCH]


def _windows(seqs: list[np.ndarray], ids: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(texts still open, inputs, targets, mask)`` per window; steps first.  Texts come longest first."""
    lengths = np.array([len(seqs[i]) for i in ids])
    for at in range(0, int(lengths[0]), WINDOW):
        n = int((lengths > at).sum())
        steps = min(WINDOW, int(lengths[0]) - at)
        y = np.full((n, steps), END, np.int64)
        x = np.full((n, steps), END, np.int64)
        for row, i in enumerate(ids[:n]):
            piece = seqs[i][at : at + steps]
            y[row, : len(piece)] = piece
            x[row, 1 : len(piece)] = piece[:-1]
            if at:
                x[row, 0] = seqs[i][at - 1]
        mask = np.arange(at, at + steps)[:, None] < lengths[None, :n]
        yield n, x.T, y.T, mask


def train_on(net: Gru, seqs: list[np.ndarray], rate: float) -> int:
    """One pass of truncated backpropagation over whole texts; the number of tokens."""
    for ids in batches_of(seqs):
        h = np.zeros((len(ids), HIDDEN), np.float32)
        for n, x, y, mask in _windows(seqs, ids):
            h = net.learn(x, y, mask, h[:n], rate)
    return sum(map(len, seqs))


def class_scores(net: Gru, seqs: list[np.ndarray]) -> np.ndarray:
    """log10-probability of each whole class sequence."""
    out = np.zeros(len(seqs))
    for ids in batches_of(seqs):
        h = np.zeros((len(ids), HIDDEN), np.float32)
        for n, x, y, mask in _windows(seqs, ids):
            states, _ = net.window(x, h[:n])
            logs, _, _ = net.log_probs(states, y)
            out[ids[:n]] += (logs * mask).sum(axis=0)
            h = states[-1]
    return out / np.log(10)


# ---------------------------------------------------------------- counting
def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, endings, words per text)``."""
    data, s, e, counts = words_of(texts)
    if not len(s):
        return np.empty(0, np.uint64), np.empty(0, np.uint8), counts
    h = Hasher(data)
    return h.hash(s, e), (h.hash(np.maximum(s, e - 3), e) >> np.uint64(58)).astype(np.uint8), counts


def _chunk_rows(parts: int, fold):
    """Documents as word numbers (kind 0) and the chunk's distinct words by range (kind 1)."""
    width = (1 << 64) // parts
    names = ["kind", "chunk", "id", "seq", "part", "words", "endings", "counts"]
    types = [pa.int32(), pa.int64(), None, pa.list_(pa.int32()), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = 0
        key_type = None

        def close():
            chunk = int(np.random.default_rng().integers(1, 1 << 62))
            h = np.concatenate([x[1] for x in held])
            words, at, seq = np.unique(h, return_index=True, return_inverse=True)
            endings = np.concatenate([x[2] for x in held])[at]
            counts = np.concatenate([x[3] for x in held])
            keys = [k for x in held for k in x[0]]
            learnt = np.repeat(np.array([fold(k) for k in keys], bool), counts)
            trained = np.bincount(seq[learnt], minlength=len(words)).astype(np.uint32)
            seqs = np.split(seq.astype(np.int32), np.cumsum(counts)[:-1])
            n = len(keys)
            none = lambda t, m=n: pa.nulls(m, t)
            for a in range(0, n, 2000):
                m = len(keys[a : a + 2000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0] * m, pa.int32()), pa.array([chunk] * m, pa.int64()), pa.array(keys[a : a + m], key_type), pa.array(seqs[a : a + m], types[3]), none(pa.int32(), m), *[none(pa.binary(), m)] * 3],
                    names,
                )
            edges = np.searchsorted((words // np.uint64(width)).astype(np.int64), np.arange(parts + 1))
            used = np.flatnonzero(np.diff(edges)).tolist()
            cut = lambda a: pa.array([a[edges[r] : edges[r + 1]].tobytes() for r in used], pa.binary())
            m = len(used)
            yield pa.RecordBatch.from_arrays(
                [pa.array([1] * m, pa.int32()), pa.array([chunk] * m, pa.int64()), none(key_type, m), none(types[3], m), pa.array(used, pa.int32()), cut(words), cut(endings), cut(trained)],
                names,
            )

        for b, at, to, texts in blocks(batches, 1):
            key_type = b.column(0).type
            h, endings, counts = word_hashes(texts)
            held.append((b.column(0).slice(at, to - at).to_pylist(), h, endings, counts))
            size += len(h) + len(texts)
            if size >= CHUNK_TOKENS:
                yield from close()
                held, size = [], 0
        if held:
            yield from close()

    return run


def _sum_part(table: pa.Table) -> pa.Table:
    """Corpus counts of the words of one range, returned to each chunk, and the range's own figures (chunk 0)."""
    get = lambda name, t: [np.frombuffer(x.as_buffer(), t) for x in table.column(name)]
    words, endings, counts = get("words", np.uint64), get("endings", np.uint8), get("counts", np.uint32)
    every, first, place = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
    total = np.bincount(place, np.concatenate(counts), len(every)).astype(np.int64)
    ending = np.concatenate(endings)[first]
    back = np.split(total[place], np.cumsum([len(w) for w in words])[:-1])
    known = total > 0
    top = np.lexsort((every, -total))[:TOP]
    top = top[known[top]]
    figures = np.concatenate([np.bincount(ending, total, ENDINGS), np.bincount(ending[known], minlength=ENDINGS)]).astype(np.int64)
    n = len(words)
    return pa.table({
        "chunk": pa.array([*table.column("chunk").to_pylist(), 0], pa.int64()),
        "words": pa.array([*[w.tobytes() for w in words], every[top].tobytes()], pa.binary()),
        "endings": pa.array([*[w.tobytes() for w in endings], ending[top].tobytes()], pa.binary()),
        "totals": pa.array([*[b.astype(np.int64).tobytes() for b in back], total[top].tobytes()], pa.binary()),
        "figures": pa.array([None] * n + [figures.tobytes()], pa.binary()),
    })


def _merge_figures(t: pa.Table) -> pa.Table:
    """Several ranges' figures as one row: sums, and the ``TOP`` words of largest totals."""
    get = lambda c, kind: np.concatenate([np.empty(0, kind), *[np.frombuffer(x.as_buffer(), kind) for x in t.column(c)]])
    words, endings, totals = get("words", np.uint64), get("endings", np.uint8), get("totals", np.int64)
    pick = np.lexsort((words, -totals))[:TOP]
    figures = get("figures", np.int64).reshape(t.num_rows, -1).sum(0)
    return pa.table([pa.array([a.tobytes()], pa.binary()) for a in (words[pick], endings[pick], totals[pick], figures)], t.column_names[-4:])


@dataclass
class Corpus:
    """Counts over all training documents: tokens, distinct tokens, end tokens, and per class."""

    tokens: int
    distinct: int
    ends: int
    top: np.ndarray  # hashes of the frequent words, sorted
    class_tokens: np.ndarray
    class_words: np.ndarray

    @classmethod
    def of(cls, rows, ends: int) -> Corpus:
        """From the ranges' figures (a bounded row each)."""
        figures = np.zeros((2, ENDINGS), np.int64)
        words, totals, endings = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.uint8)]
        for r in rows:
            figures += np.frombuffer(r.figures, np.int64).reshape(2, ENDINGS)
            words.append(np.frombuffer(r.words, np.uint64))
            totals.append(np.frombuffer(r.totals, np.int64))
            endings.append(np.frombuffer(r.endings, np.uint8))
        w, t, e = np.concatenate(words), np.concatenate(totals), np.concatenate(endings)
        pick = np.lexsort((w, -t))[:TOP]
        tokens, distinct = int(figures[0].sum()) + ends, int(figures[1].sum()) + (ends > 0)
        figures[0] -= np.bincount(e[pick], t[pick], ENDINGS).astype(np.int64)
        figures[1] -= np.bincount(e[pick], minlength=ENDINGS)
        return cls(tokens, distinct, ends, np.sort(w[pick]), figures[0], figures[1])

    def classes(self, words: np.ndarray, endings: np.ndarray) -> np.ndarray:
        out = endings.astype(np.int16) + (TOP + 1)
        if len(self.top) and len(words):
            at = np.minimum(np.searchsorted(self.top, words), len(self.top) - 1)
            out = np.where(self.top[at] == words, at.astype(np.int16), out)
        return out

    def base(self, count) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def in_class(self, count: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 p(word | class)."""
        e = np.maximum(classes.astype(np.int64) - TOP - 1, 0)
        p = (count + 0.5) / (self.class_tokens[e] + 0.5 * (self.class_words[e] + 1))
        return np.where(classes < TOP, 0.0, np.log10(p))


def _sequences(corpus: Corpus, texts: list[bytes]) -> list[np.ndarray]:
    h, endings, counts = word_hashes(texts)
    classes = corpus.classes(h, endings)
    end = np.array([END], np.int16)
    return [np.concatenate([s, end]) for s in np.split(classes, np.cumsum(counts)[:-1])]


def train(docs: DataFrame, corpus: Corpus, fold, key: str, text: str, warm_rows: int = 600, warm_bytes: int = 16 << 20, warm_passes: int = 4, rate: float = 0.01) -> Gru:
    """Warm start on the driver, one pass in every task over all its training documents, then the weighted average."""
    src = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    learn = src.where(F.crc32(F.coalesce(F.col("k").cast("string"), F.lit("")).cast("binary")) % fold.modulus != fold.out)
    warm = hash_sample(learn, corpus.ends, warm_rows, warm_bytes, ["k", "t"], "t").collect()
    net = Gru()
    if not warm:
        return net
    seqs = _sequences(corpus, [(r.t or "").encode("utf-8", "surrogatepass") for r in warm])
    for _ in range(warm_passes):
        train_on(net, seqs, rate)
    start = docs.sparkSession.sparkContext.broadcast((net.flat, corpus))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, known = start.value
        local, tokens, held, size = Gru(flat), 0, [], 0
        for _, _, _, texts in blocks(batches, 1):
            held += _sequences(known, texts)
            size += sum(map(len, texts))
            if size >= 8 << 20:
                tokens += train_on(local, held, rate / 4)
                held, size = [], 0
        if held:
            tokens += train_on(local, held, rate / 4)
        if tokens:
            yield pa.RecordBatch.from_arrays([pa.array([float(tokens)]), pa.array([local.flat], pa.list_(pa.float32()))], ["tokens", "flat"])

    each = map_arrow(learn, run, "tokens double, flat array<float>").select("tokens", F.posexplode("flat").alias("i", "v"))
    mean = each.groupBy("i").agg((F.sum(F.col("v") * F.col("tokens")) / F.sum("tokens")).alias("v")).collect()  # one row per parameter
    flat = np.zeros(Gru.SIZE, np.float32)
    for r in mean:
        flat[r.i] = r.v
    return Gru(flat)


class Fold:
    """Training documents are those whose crc32 of the id as text leaves another remainder than ``out``."""

    def __init__(self, modulus: int = 5, out: int = 1):
        self.modulus, self.out = modulus, out

    def __call__(self, key) -> bool:
        return crc_mod(key, self.modulus) != self.out


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", fold: Fold | None = None, tag: str = "language-model") -> DataFrame:
    """Per row: ``key, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    fold = fold or Fold()
    spark = docs.sparkSession
    src = docs.select(F.col(key).alias("id"), F.col(text).alias("t"))
    kind = src.schema["id"].dataType.simpleString()
    size, ends = src.agg(F.sum(F.octet_length("t")), F.sum((F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")) % fold.modulus != fold.out).cast("long"))).first()
    parts = 1 << max(6, ((size or 0) >> 25).bit_length())  # ranges grow with the text
    rows = written(map_arrow(src, _chunk_rows(parts, fold), f"kind int, chunk bigint, id {kind}, seq array<int>, part int, words binary, endings binary, counts binary"), tag)
    pieces = rows.where("kind = 1").select("chunk", "part", "words", "endings", "counts")
    sums = written(pieces.groupBy("part").applyInArrow(_sum_part, "chunk bigint, words binary, endings binary, totals binary, figures binary"), tag)
    each = sums.where("chunk = 0").select("words", "endings", "totals", "figures")
    merged = each.groupBy(F.pmod(F.xxhash64("words", "figures"), F.lit(MERGES)).alias("g")).applyInArrow(_merge_figures, "words binary, endings binary, totals binary, figures binary")
    corpus = Corpus.of(merged.collect(), int(ends or 0))  # at most MERGES rows of bounded size
    net = train(docs, corpus, fold, key, text)
    shared = spark.sparkContext.broadcast((net.flat, corpus))
    names = [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        flat, known = shared.value
        model = Gru(flat)
        get = lambda name, t: np.concatenate([np.empty(0, t), *[np.frombuffer(x.as_buffer(), t) for x in right.column(name)]])
        words = get("words", np.uint64)
        order = np.argsort(words)  # word numbers of a chunk follow its sorted words
        words, endings, totals = words[order], get("endings", np.uint8)[order], get("totals", np.int64)[order]
        classes = known.classes(words, endings)
        base, inside, seen = known.base(totals), known.in_class(totals, classes), totals > 0
        keys = left.column("id").to_pylist()
        out = {n: [] for n in names}
        end = np.array([END], np.int16)
        end_base = float(known.base(known.ends))
        seqs = [s.values.to_numpy() for s in left.column("seq")]
        net_scores = class_scores(model, [np.concatenate([classes[s], end]) for s in seqs])
        for k, s, by_net in zip(keys, seqs, net_scores, strict=True):
            out[key].append(k)
            out["held_out"].append(not fold(k))
            out["n_tokens"].append(len(s) + 1)
            out["n_known"].append(int(seen[s].sum()) + (known.ends > 0))
            out["train_tokens"].append(known.tokens)
            out["base_score"].append(float(base[s].sum()) + end_base)
            out["score"].append(float(by_net + inside[s].sum()))
        types = [left.schema.field("id").type, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(out[n], t) for n, t in zip(names, types, strict=True)], names)

    texts = rows.where("kind = 0").select("chunk", "id", "seq")
    counts = sums.where("chunk <> 0").select("chunk", "words", "endings", "totals")
    schema = f"`{key}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return texts.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(finish, schema)
