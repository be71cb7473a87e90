"""Toxicity, language model, decontamination and the pipeline."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontam, language_model, secret_scan, toxicity
from tidemark.llm.common import table, written
from tests.llm.helpers import all_texts, words

SCHEMA = "doc_id long, text string, lang string, score double, k string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 0.5, "clash") for i, t in rows], SCHEMA).repartition(3)


# ------------------------------------------------------------------ toxicity
@pytest.fixture(scope="module")
def model(spark, sf_small):
    d = sf_small.replace("0.001", "0.1")
    return toxicity.fit(table(spark, d, "documents"), table(spark, d, "labels"), where=toxicity.held_in())


def test_held_out_accuracy(spark, model, sf_small):
    d = sf_small.replace("0.001", "0.1")
    rows = toxicity.score(table(spark, d, "documents"), model).join(table(spark, d, "labels"), "doc_id").where("held_out").select("score", "toxic").collect()
    y, s = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    order = s.argsort().argsort()
    auc = (order[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (1 - y).sum())
    assert auc > 0.95
    assert ((s >= 0.5) & (y == 1)).sum() > 0.8 * y.sum()
    assert ((s >= 0.5) & (y == 0)).sum() < 0.03 * (y == 0).sum()


def test_scores_are_of_the_text_alone(spark, model):
    texts = all_texts(100)
    rows = toxicity.score(frame(spark, [*enumerate(texts), (3, texts[3]), (None, "x")]), model).collect()
    by = {}
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0)
        if r.doc_id is not None:
            by.setdefault(texts[r.doc_id] or "", set()).add(round(r.score, 6))
    assert len(rows) == len(texts) + 2 and all(len(v) == 1 for v in by.values())


def test_batching_does_not_change_scores(model):
    texts = [(t or "").encode() for t in all_texts(80)]
    together = model.scores(texts)
    assert np.allclose(together, np.concatenate([model.scores([t]) for t in texts]), atol=1e-5)


def test_training_learns_words_and_prefixes():
    rng = random.Random(1)
    clean = [f"w{i}" for i in range(500)]
    texts, y = [], []
    for i in range(600):
        w = [rng.choice(clean).replace("0", "a").replace("1", "b") + rng.choice("xyz") for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            w[rng.randrange(40)] = rng.choice(["awful", "zzkappa" + rng.choice("abcdef")])
        texts.append(" ".join(w).encode())
        y.append(float(bad))
    m = toxicity.train(texts[:450], np.array(y[:450]))
    s = m.scores(texts[450:])
    assert ((s >= 0.5) == (np.array(y[450:]) == 1)).mean() > 0.95


def test_thresholds_cover_all_held_back_labels(spark, monkeypatch):
    """A small sample for fitting leaves the thresholds to all other labelled rows."""
    docs = frame(spark, [(i, ("awful " if i % 10 == 0 else "") + f"plain words here of {'abcdefgh'[i % 8] * 3}") for i in range(1500)])
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1500)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "calibrate", lambda m, counts: seen.append(counts))
    toxicity.fit(docs, labels, where=toxicity.held_in(), max_toxic=10, max_clean=20)
    mine = [i for i in range(1500) if zlib.crc32(str(i).encode()) % 5 and zlib.crc32(str(i).encode()) // 5 % 5 == 0]
    assert seen[0].sum(axis=(0, 2)).tolist() == [sum(i % 10 > 0 for i in mine), sum(i % 10 == 0 for i in mine)]


def test_no_labels(spark):
    docs = frame(spark, [(1, "a"), (2, None)])
    for rows, share in (([], 0.0), ([(1, 1), (1, 0), (2, 1)], 1.0), ([(1, None), (None, 1)], 0.0)):
        m = toxicity.fit(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert {r.score for r in toxicity.score(docs, m).collect()} == {share}
    assert toxicity.score(docs.limit(0), m).count() == 0


# ------------------------------------------------------------ language model
def brute_base(rows):
    counts, n = Counter(), 0
    toks = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    for (i, _), w in zip(rows, toks, strict=True):
        if zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1:
            counts.update(w)
            n += len(w)
    v = len(counts)
    return sorted(
        ((str(i), len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)) for (i, _), w in zip(rows, toks, strict=True)),
    )


def test_language_model_base_scores(spark):
    rows = [*enumerate(all_texts(80)), (5, "again a row"), (5, "again a row"), (None, "the of"), (9999, "the " * 3000)]
    got = language_model.score(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == brute_base(rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_state_is_carried_over_windows():
    """Scores of a batch equal a token-by-token run of each text."""
    rng = np.random.default_rng(2)
    net = language_model.Gru()
    seqs = [rng.integers(0, language_model.CLASSES, n) for n in (1, 3, 24, 25, 100, 7)]
    got = language_model.class_scores(net, seqs)
    for s, g in zip(seqs, got, strict=True):
        h, last, total = np.zeros(language_model.HIDDEN), language_model.END, 0.0
        H = language_model.HIDDEN
        for c in s:
            a, r = net.e[last] + net.b, h @ net.u
            rz = 1 / (1 + np.exp(-(a[: 2 * H] + r[: 2 * H])))
            new = np.tanh(a[2 * H :] + rz[:H] * r[2 * H :])
            h = (1 - rz[H:]) * new + rz[H:] * h
            z = h @ net.o + net.c
            total += z[c] - np.log(np.exp(z).sum())
            last = c
        assert abs(total / np.log(10) - g) < 1e-3 * max(1, abs(g))


def test_gradients():
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, language_model.CLASSES, (2, 5, 3))
    mask = np.ones((5, 3), bool)
    net = language_model.Gru()
    h = np.zeros((3, language_model.HIDDEN), np.float32)

    def loss(flat):
        n = language_model.Gru(flat)
        states, _ = n.window(x, h)
        return -float(n.log_probs(states, y)[0].mean())

    start = net.flat.copy()
    net.learn(x, y, mask, h, 0.0)
    grad = net.grad.copy()
    size = float(np.sqrt(np.square(grad).sum()))
    direction = rng.normal(size=len(start)).astype(np.float32)
    eps = 1e-2
    slope = (loss(start + eps * direction) - loss(start - eps * direction)) / (2 * eps)
    along = float(grad @ direction)
    assert size <= 1.0001 and (abs(along - slope) < 0.05 * abs(slope) + 1e-2 or size > 0.999)


def test_training_helps_on_held_out_text():
    rng = np.random.default_rng(6)
    step = rng.permutation(language_model.CLASSES)
    seqs = [np.array(_walk(rng, step)) for _ in range(600)]
    net = language_model.Gru()
    before = language_model.class_scores(net, seqs[500:]).sum()
    for _ in range(30):
        language_model.train_on(net, seqs[:500], 0.02)
    assert language_model.class_scores(net, seqs[500:]).sum() > 0.8 * before


def _walk(rng, step):
    out = [int(rng.integers(0, language_model.CLASSES))]
    while len(out) < 60:
        out.append(int(step[out[-1]]) if rng.random() < 0.9 else int(rng.integers(0, language_model.CLASSES)))
    return out


def test_merged_figures(spark):
    """Figures merged in groups, then on the driver, equal those of all ranges at once."""
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(40):
        n = int(rng.integers(0, language_model.TOP + 1))
        w, e, t, f = rng.integers(1, 2**62, n).astype(np.uint64), rng.integers(0, 64, n).astype(np.uint8), rng.integers(1, 9, n).astype(np.int64), rng.integers(500, 999, (2, language_model.ENDINGS)).astype(np.int64)
        rows.append(tuple(x.tobytes() for x in (w, e, t, f)))
    df = spark.createDataFrame(rows, "words binary, endings binary, totals binary, figures binary")
    merged = df.groupBy(F.pmod(F.xxhash64("words", "figures"), F.lit(3)).alias("g")).applyInArrow(language_model._merge_figures, "words binary, endings binary, totals binary, figures binary").collect()
    a, b = language_model.Corpus.of(merged, 7), language_model.Corpus.of(df.collect(), 7)
    assert len(merged) <= 3 and (a.tokens, a.distinct) == (b.tokens, b.distinct)
    assert all(np.array_equal(getattr(a, x), getattr(b, x)) for x in ("top", "class_tokens", "class_words"))


def test_language_model_empty(spark):
    assert language_model.score(frame(spark, []).limit(0)).count() == 0
    (r,) = language_model.score(frame(spark, [(1, None)])).collect()
    assert (r.n_tokens, r.held_out) == (1, zlib.crc32(b"1") % 5 == 1)


# ---------------------------------------------------------- decontamination
ITEMS = [
    (1, "If Alice buys 12 apples and Bob eats 5 apples how many apples does Alice still have left in the old basket after lunch today"),
    (2, "the quick brown fox jumps over the lazy dog while seven tired wizards watch from behind a crooked fence near town"),
    (3, "short item of six words"), (4, None), (5, ""), (6, "two words"), (2, "the quick brown fox jumps over the lazy dog while seven tired wizards watch from behind a crooked fence near town"),
]
FILL = "plain filler text that goes on about nothing in particular and never ends "


def test_leaks(spark):
    a, b = ITEMS[0][1], ITEMS[1][1]
    swap = a.replace("Alice", "Carol").replace("Bob", "David").replace("12", "37").replace("5 ", "21 ")
    torn = a.replace("If Alice", "If Carol").replace("does Alice", "does Erin")
    docs = [
        (10, FILL + a + " " + FILL), (11, FILL + swap + "\n" + FILL), (12, FILL + torn + FILL), (13, FILL * 5), (14, b.upper().lower()), (15, FILL + " | ".join(b.split()) + FILL),
        (16, "x " + " ".join(b.split()[:9]) + " " + FILL), (17, "here: short item of six words, yes"), (18, None), (19, ""), (20, "word " * 30_000 + a), (None, a), (10, FILL), (21, a + " " + b),
    ]
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in ITEMS], "item_id long, text string, slots string, hash long")
    got = {(r.doc_id, r.item_id): r.kind for r in decontam.leaks(frame(spark, docs), bench).collect()}
    assert got == {
        (10, 1): "exact", (11, 1): "reparameterised", (14, 2): "exact", (15, 2): "exact", (17, 3): "exact",
        (20, 1): "exact", (None, 1): "exact", (21, 1): "exact", (21, 2): "exact",
    }
    assert decontam.leaks(frame(spark, docs), bench.limit(0)).count() == 0
    assert decontam.leaks(frame(spark, docs).limit(0), bench).count() == 0


def test_leaks_without_the_bitmap(spark, monkeypatch):
    bench = spark.createDataFrame([(1, ITEMS[0][1])], "item_id long, text string")
    docs = frame(spark, [(1, FILL + ITEMS[0][1]), (2, FILL)])
    monkeypatch.setattr(decontam, "BITMAP_WINDOWS", 0)
    assert [r.doc_id for r in decontam.leaks(docs, bench).collect()] == [1]


def test_leaks_equal_brute_force(spark, sf_small):
    docs, bench = table(spark, sf_small, "documents"), table(spark, sf_small, "benchmark")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, bench).collect()}
    low = lambda t: [w for w in ("".join(c for c in x if c.isalnum()) for x in words(t.lower())) if w]
    texts = [(r.doc_id, " " + " ".join(low(r.text)) + " ") for r in docs.collect()]
    want = {(i, r.item_id) for r in bench.collect() for i, t in texts if " " + " ".join(low(r.text)) + " " in t}
    assert want and want <= got and len(got) <= 1.05 * len(want) + 1


def test_case_changed_copies_leak(spark):
    """Names and sentence starts that are literal words in the copy."""
    item = "The river Danube flows past Vienna. Many old towns lie on its banks and Roman ships went down to the Black Sea. Linz is one"
    names = "Anna Berta Clara Dora Emil Fritz Georg Hans Ida Julius"  # no template window
    bench = spark.createDataFrame([(1, item), (2, names)], "item_id long, text string")
    docs = [(10, FILL + item.lower() + " " + FILL), (11, FILL + item.upper()), (12, item.title()), (13, names.lower()), (14, FILL + names), (15, FILL)]
    got = {(r.doc_id, r.item_id): (r.kind, r.n_windows == r.n_item_windows) for r in decontam.leaks(frame(spark, docs), bench).collect()}
    assert got == {(10, 1): ("exact", True), (11, 1): ("exact", True), (12, 1): ("exact", True), (13, 2): ("exact", True), (14, 2): ("exact", True)}


def test_one_edited_slot_keeps_the_alignment(spark):
    words_ = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(10)]
    for at in (0, 20, 40):
        words_[at] = "Alice"
    item = " ".join(words_)
    edited = item.replace("Alice wordcb", "Carol wordcb")
    renamed = item.replace("Alice", "Erin").replace("Erin wordcb", "Carol wordcb")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: (r.kind, r.n_windows) for r in decontam.leaks(frame(spark, [(1, edited), (2, renamed), (3, FILL)]), bench).collect()}
    assert got == {1: ("exact", 45), 2: ("reparameterised", 45)}  # 53 windows, 8 of them over the edited place


def test_a_long_passage_of_a_longer_item_leaks(spark):
    item = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(10)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    part = lambda a, b: FILL + " ".join(item[a:b]) + " " + FILL
    docs = [(1, part(0, 60)), (2, part(187, 200)), (3, part(187, 199)), (4, part(0, 12) + part(50, 62)), (5, part(40, 52).replace("wordei", "other"))]
    got = {r.doc_id: (r.kind, r.n_windows, r.n_item_windows) for r in decontam.leaks(frame(spark, docs), bench).collect()}
    assert got == {1: ("exact", 53, 193), 2: ("exact", 6, 193)}


# ----------------------------------------------------------------- pipeline
def test_masking(spark):
    live, copied = "q8Rk2LmZ0pXcVbN", "Zx81kQpLm20aBvC"
    rows = [(i, f"a token = {copied} b", "en", 1.0, f"o{i}") for i in range(4)] + [(9, f"é token = {live} and token: {copied}", "en", 1.0, "o1"), (10, None, "en", 1.0, "o1"), (None, f"token = {live}", "en", 1.0, "o1")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.doc_id: r.text for r in secret_scan.redact(df, owner=F.col("k"), repo=F.col("k")).collect()}
    assert out[9] == f"é [assign] and token: {copied}" and out[0] == rows[0][1] and out[10] is None and out[None] == "[assign]"


def test_stages_take_effect(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    extra = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).unionByName(docs.limit(2).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 10**6))
    docs = written(docs.unionByName(extra), "t-pipe")
    seen = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf_small), "t-pipe")
        n = out.count()
        assert 0 < n <= seen, name
        if name == "near_duplicates":
            from tidemark.llm import jaccard

            again = jaccard.similarity_classes(out)
            assert again.where("n_shingles > 0").groupBy("component_id").count().where("count > 1").where("component_id IS NOT NULL").count() == 0
        if name == "decontamination":
            assert decontam.leaks(out, table(spark, sf_small, "benchmark")).count() == 0
        if name == "secrets":
            assert n == seen
            left = secret_scan.secret_scan(out, repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
            assert left.agg(F.sum("n_live")).first()[0] == 0
        if name != "bpe":
            assert out.columns == list(corpus_pipeline.COLUMNS)
        docs, seen = out, n
    assert docs.where("size(ids) <> n_tokens").count() == 0


W, V, U = (" ".join(f"{c}{i}" for i in range(40)) for c in "wvu")


def _stage_rows(spark, stage, rows, sf_dir):
    docs = spark.createDataFrame([(i, t, "en", "web", n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    out = sorted(r.n_chars for r in dict(corpus_pipeline.STAGES)[stage](spark, docs, sf_dir).collect())
    again = dict(corpus_pipeline.STAGES)[stage](spark, written(docs, "t-rows"), sf_dir)  # read from files
    assert sorted(r.n_chars for r in again.collect()) == out
    return out


def test_near_duplicates_by_row(spark, sf_small):
    """Null and repeated ids: one row of each class, against all pairs; the smallest id stays, null last."""
    rows = [(1, W), (1, W), (2, W), (None, V), (None, W), (None, U), (3, U + " more"), (4, None), (4, ""), (None, None), (5, W.upper()), (1, V + " tail")]
    sets = [{tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if (w := words((t or "").lower())) else set() for _, t in rows]
    kept = _stage_rows(spark, "near_duplicates", rows, sf_small)
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    by_group = {}
    for n in kept:
        by_group.setdefault(group[n], []).append(n)
    assert sorted(by_group) == sorted(set(group)) and all(len(v) == 1 for v in by_group.values())
    smallest = {g: min((rows[n][0] is None, rows[n][0] or 0) for n in range(len(rows)) if group[n] == g) for g in set(group)}
    assert all((rows[v[0]][0] is None, rows[v[0]][0] or 0) == smallest[g] for g, v in by_group.items())


def test_decontamination_by_row(spark, sf_small):
    """Only rows that hold the item go; halves of it in rows of one id are no leak."""
    item = table(spark, sf_small, "benchmark").orderBy(F.length("text").desc()).first().text
    half = item.split()
    rows = [(None, item), (None, W), (None, U), (7, V), (7, f"{V} {item}"), (8, " ".join(half[: len(half) // 3])), (8, " ".join(half[-(len(half) // 3) :])), (9, None), (9, "")]
    alone = [bool(decontam.leaks(spark.createDataFrame([(1, t)], "doc_id long, text string"), table(spark, sf_small, "benchmark")).count()) for _, t in rows]
    assert alone[0] and alone[4] and not any(alone[1:4])
    assert _stage_rows(spark, "decontamination", rows, sf_small) == [n for n, bad in enumerate(alone) if not bad]


def test_toxicity_and_masking_by_row(spark, sf_small, monkeypatch):
    """One text's rejection or credential touches no other row of its id."""
    docs = table(spark, sf_small, "documents")
    model = toxicity.fit(docs, table(spark, sf_small, "labels"), where=toxicity.held_in())
    monkeypatch.setattr(toxicity, "fit", lambda *a, **k: model)
    shared = docs.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id") % 4))  # null or one of two ids
    out = corpus_pipeline.drop_toxic(spark, shared, sf_small)
    clean = toxicity.score(docs, model).where("predicted = 0").select("doc_id")
    want = docs.join(clean, "doc_id", "left_semi")
    assert Counter(r.text for r in out.collect()) == Counter(r.text for r in want.collect()) and 0 < want.count() < docs.count()
    secret = "token = q8Rk2LmZ0pXcVbN"
    docs = spark.createDataFrame([(None, secret), (None, W), (1, secret), (1, V)], "doc_id long, text string").selectExpr("*", "'en' AS lang", "'web' AS source", "0L AS n_chars")
    masked = corpus_pipeline.mask_secrets(spark, docs, sf_small).collect()
    assert sorted(r.text for r in masked) == sorted(["[assign]", "[assign]", V, W])


def test_empty_pipeline(spark, sf_small):
    docs = table(spark, sf_small, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_small), "t-pipe-empty")
        assert docs.count() == 0
