"""Token files against the tokenizer itself, and their layout as pyarrow sees it."""

import glob
import os
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from tests.llm.helpers import all_texts
from tidemark.llm import token_files
from tidemark.session import scratch_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPACED = ["a  b", "a \n b", "a\n \nb", "a\n ", " a", "  ", " \n ", "a <|endoftext|> b", "a  <|endoftext|>", "x  y", "x   y", "don't  stop", "tab\t tab", "\x1c \x1f ", "\x85 a"]


def _library(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_words_give_the_librarys_ids():
    texts = [t or "" for t in all_texts(600)] + SPACED
    enc = token_files.WordEncoder(PATH)
    for size in (1, 7, len(texts)):
        got = []
        for i in range(0, len(texts), size):
            ids, lengths = enc.encode(texts[i:i + size])
            ends = np.cumsum(lengths)
            got += [ids[e - n:e].tolist() for e, n in zip(ends, lengths)]
        assert got == _library(texts)


def test_every_character_between_words():
    """Pieces agree around every character of the first plane."""
    enc = token_files.WordEncoder(PATH)
    texts = [f"a{chr(c)} b {chr(c)} 1{chr(c)}" for c in range(0, 0x10000, 1) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(texts), 8000):
        some = texts[i:i + 8000]
        ids, lengths = enc.encode(some)
        ends = np.cumsum(lengths)
        want = [e.ids for e in enc.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        assert [ids[e - n:e].tolist() for e, n in zip(ends, lengths)] == want


def test_words_that_come_again_are_kept(monkeypatch):
    """A worker that has used up its room forgets the words that came once, not those that it needs again."""
    monkeypatch.setattr(token_files, "_KEPT_CHARS", 400)
    enc, sent, library = token_files.WordEncoder(PATH), [], token_files.WordEncoder._library
    monkeypatch.setattr(enc, "_library", lambda texts: sent.extend(texts) or library(enc, texts))
    texts = [f"x common words, come again {i}once{i} {i}only{i}" for i in range(200)]
    got = [enc.encode([t])[0].tolist() for t in texts]
    assert got == _library(texts)
    assert sum(" common" in t for t in sent) == 1
    assert enc.chars < 450
    few = [" ".join(f"w{j}" for j in range(i % 4 * 60, i % 4 * 60 + 120)) for i in range(20)]  # more that come again than there is room for
    assert [enc.encode([t])[0].tolist() for t in few] == _library(few)
    assert enc.chars < 1000


def test_texts_are_cut_where_the_pattern_cuts():
    """Every place at which a text is cut begins a piece of the pre-tokenizer, whatever stands around it."""
    enc, rng = token_files.WordEncoder(PATH), np.random.default_rng(5)
    signs = np.array(list("aaZ09 .,;:!?'\n\n\t\r\x0b\x1c\x85\u00a0\u2028\u3000-$\u00d7\u00f7\u00e9\u00df\u017f\u0180\u00b2\u0301\u4e2d\U0001f600") + ["'s", "'re", "\u00e9, ", "e. "])
    texts = ["".join(rng.choice(signs, n)) for n in rng.integers(0, 12, 4000)] + [".", "", "\n", ",\n", "", "\u00e9.", "x", ".", "\nx"]
    for some in (texts, *([t] for t in texts[:300] + texts[-9:])):
        some = [t for t in some if not enc.whole(t)]
        data = [t.encode() for t in some]
        starts = np.cumsum([0, *map(len, data)])
        begins = set(token_files.cuts(np.frombuffer(b"".join(data), np.uint8), starts[:-1]).tolist())
        for t, at, end in zip(some, starts.tolist(), starts[1:].tolist()):
            pieces = {len(t[:a].encode()) for _, (a, _) in enc.tokenizer.pre_tokenizer.pre_tokenize_str(t)}
            assert {x - at for x in begins if at <= x < end} <= pieces, repr(t)
        ids, lengths = enc.encode(some)
        ends = np.cumsum(lengths)
        assert [ids[e - n:e].tolist() for e, n in zip(ends, lengths)] == [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in some]


def test_a_word_is_encoded_once_whatever_marks_follow(monkeypatch):
    enc, sent, library = token_files.WordEncoder(PATH), [], token_files.WordEncoder._library
    monkeypatch.setattr(enc, "_library", lambda texts: sent.extend(texts) or library(enc, texts))
    texts = ["the zebrawood, a zebrawood. zebrawood", "so zebrawood!\nno zebrawood; \u00e9t\u00e9, \u00e9t\u00e9", "in \u00e9t\u00e9."]
    assert enc.encode(texts)[0].tolist() == [x for ids in _library(texts) for x in ids]
    assert sum(t.count(" zebrawood") for t in sent) == 1
    assert sum(t.count(" \u00e9t\u00e9") for t in sent) == 1
    assert " zebrawood" in enc.slot and not [w for w in enc.slot if len(w) > 1 and w[-1] in ".,;!"]  # no room for the same word with marks


def test_words_of_letters_need_no_pattern(monkeypatch):
    """Words of Latin letters have the tokenizer's ids without its pattern."""
    enc = token_files.WordEncoder(PATH)
    letters = [chr(c) for c in range(0x250) if token_files._LETTERS.fullmatch(" " + chr(c))]
    assert len(letters) == 52 + 0x250 - 0xC0 - 2
    words = [f" {a}{c}{b}" for c in letters for a in ("", "s", "\u00e9") for b in ("", "t", "\u00fc")]
    texts = words + ["".join(words[i:i + 50]) for i in range(0, len(words), 50)]
    want = [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(enc, "tokenizer", None)  # not needed
    assert enc._library(texts) == want


def test_a_normalizer_is_kept(tmp_path):
    from tokenizers import Tokenizer, normalizers

    t = Tokenizer.from_file(PATH)
    t.normalizer = normalizers.Lowercase()
    t.save(str(tmp_path / "lower.json"))
    enc, texts = token_files.WordEncoder(str(tmp_path / "lower.json")), ["Some Words, and \u00c9t\u00e9. Some", "MORE OF THEM"]
    assert enc.encode(texts)[0].tolist() == [x for s in texts for x in t.encode(s, add_special_tokens=False).ids]


def test_a_task_starts_no_threads(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    token_files._encoder(PATH)
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")  # as the user has set it
    token_files._encoder(PATH)
    assert os.environ["TOKENIZERS_PARALLELISM"] == "true"


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, part string, ids int, start string")


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_round_trip_against_brute_force(spark, encoding):
    texts = all_texts(150) + SPACED
    rows = [((i * 7919) % 1000, t, "p", 1, None) for i, t in enumerate(texts)]
    rows += [(None, "no id", None, None, None), (None, None, None, None, None), (5, "same id", "x", 2, "y"), (5, "same id", "x", 2, "y")] + [(77, f"hot {i}", None, None, None) for i in range(60)]
    path = scratch_dir(spark, "t-tokens")
    token_files.write(_frame(spark, rows).repartition(5), path, PATH, layout=token_files.Layout(encoding, row_group=4096, page=1024))
    got = token_files.digests(spark, path).collect()
    by_id = sorted((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in got)
    assert len(got) == len(rows)
    at = 0
    for known, _, start, n, _ in sorted(by_id, key=lambda r: r[2]):  # no gap, ascending ids
        assert start == at
        at += n
    assert by_id == sorted(by_id, key=lambda r: r[2])
    want = sorted((r[0] is not None, r[0] or 0, len(ids) + 1, zlib.crc32(np.array(ids + [0], "<u4").tobytes())) for r, ids in zip(rows, _library([r[1] for r in rows])))
    assert sorted((k, d, n, c) for k, d, _, n, c in by_id) == want


def test_selective_reads_and_layout(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    path = scratch_dir(spark, "t-tokens")
    token_files.write(docs, path, PATH, layout=token_files.Layout("delta", row_group=64 << 10, page=8 << 10))
    plan = token_files.metadata(spark, path)._jdf.queryExecution().toString()
    assert "ids:array" not in plan.split("== Physical Plan ==")[1]
    ids = {r.doc_id: r.ids for r in spark.read.parquet(f"{path}/tokens").collect()}
    stream = [x for d in sorted(ids) for x in ids[d]]
    for a, b in ((0, 10), (1234, 9876), (len(stream) - 5, len(stream) + 100), (500, 500)):
        rows = sorted(token_files.token_range(spark, path, a, b).collect(), key=lambda r: r.start)
        assert [x for r in rows for x in r.ids] == stream[a:b]
    some = token_files.documents(spark, path, 10, 19)
    assert {r.doc_id: r.ids for r in some.collect()} == {d: v for d, v in ids.items() if 10 <= d <= 19}
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,10)" in some._jdf.queryExecution().toString()
    files = sorted(glob.glob(f"{path}/tokens/*.parquet"))
    groups, last = 0, -1
    for f in files:
        meta = pq.ParquetFile(f).metadata
        groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            col = {meta.row_group(g).column(i).path_in_schema: meta.row_group(g).column(i) for i in range(meta.num_columns)}
            assert "DELTA_BINARY_PACKED" in col["ids.list.element"].encodings and "DELTA_BINARY_PACKED" in col["doc_id"].encodings
            assert col["doc_id"].has_offset_index and col["doc_id"].has_column_index
            assert col["doc_id"].statistics.min > last  # row groups are ranges of ids
            last = col["doc_id"].statistics.max
    assert groups > 2 * len(files)


def test_dictionary_layout_and_empty_table(spark):
    path = scratch_dir(spark, "t-tokens")
    token_files.write(_frame(spark, [(1, "a b c " * 50, None, None, None)]), path, PATH)
    f = [x for x in glob.glob(f"{path}/tokens/*.parquet") if pq.ParquetFile(x).metadata.num_rows][0]
    meta = pq.ParquetFile(f).metadata.row_group(0)
    assert {meta.column(i).path_in_schema: meta.column(i).encodings for i in range(meta.num_columns)}["ids.list.element"].__contains__("RLE_DICTIONARY")
    assert token_files.round_trip(_frame(spark, []), PATH).count() == 0
    with pytest.raises(ValueError):
        token_files.Layout("plain").options()
    one = token_files.round_trip(_frame(spark, [(3, None, "p", 1, "s")]).withColumn("n_tokens", F.lit("x")), PATH).collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in one] == [(3, 0, 1, zlib.crc32(bytes(4)))]
