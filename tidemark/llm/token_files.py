"""Token ids as Parquet list columns that can be read in parts.

``write`` encodes every whole text, appends the end id and writes one row a
document in ascending id order: ``doc_id``, ``part`` (the file's number),
``start`` (ids of the file's documents before it), ``n_tokens`` and ``ids``,
a list column.  The layout is set through the Parquet writer's own settings
(``Layout``): dictionary or delta encoding of the ids, delta encoding of the
ascending columns, row groups and pages of a chosen size, and the page index
(column and offset index), so that a reader of a few documents or of a token
range decodes only the pages that hold them, and a reader of lengths and
places never touches the ids.

Documents are dealt to files by ranges of ``doc_id`` (ties keep their input
order, so one id with a third of all rows is spread over many files); each
file numbers its own ids, and a table of one row a file holds the totals that
turn them into places in the whole corpus.  Files are written by Spark's
committer, so a lost executor leaves no partial file behind.

Encoding is the tokenizer's own.  Its pre-tokenizer never joins a word with
the one before it across a single space, nor with the marks or the single line
break behind it, so the texts are cut there and each different word with its
leading space is encoded once per worker and then
looked up (where a worker's room is used up, words that came once only go); texts in which a
space stands between other white space, or that hold an added token, are
encoded whole.  Words of Latin letters alone reach the tokenizer's model without
its pattern, which would find the same words again.

A null text is empty (the end id alone); null ids come first; repeated ids are
documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import map_arrow

#: A space whose neighbours may join it: after white space and before white space or the end.
_JOINED = re.compile(r" (?=\s|\Z)(?<=\s )")  # begins with the space, which is found faster
#: How the vocabulary writes a space.
_SPACE = "\u0120"
#: Marks that are split from the end of a word; not the apostrophe, which may start a contraction.
_MARKS = ".,;:!?"
#: Words of Latin letters, each with its space: the pattern cuts them before the spaces and nowhere else.
_LETTERS = re.compile("(?: [A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)+")
#: How the vocabulary writes each byte: itself if it is a visible Latin-1 character, else the next one from U+0100 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = "".join(chr(b if b in _VISIBLE else 256 + sum(x not in _VISIBLE for x in range(b))) for b in range(256))
#: Characters of encoded words that a worker keeps.
_KEPT_CHARS = 4_000_000


@dataclass(frozen=True)
class Layout:
    """How the ids are laid out: ``encoding`` is ``dictionary`` or ``delta``; sizes in bytes."""

    encoding: str = "dictionary"
    row_group: int = 8 << 20
    page: int = 128 << 10
    compression: str = "snappy"

    def options(self) -> dict[str, str]:
        if self.encoding not in ("dictionary", "delta"):
            raise ValueError(f"unknown encoding {self.encoding!r}; dictionary or delta is needed")
        return {
            "compression": self.compression,
            "parquet.writer.version": "v2",  # its integers without a dictionary are delta-encoded
            "parquet.block.size": str(self.row_group),
            "parquet.page.size": str(self.page),
            "parquet.block.size.row.check.min": "1",
            "parquet.page.size.row.check.min": "1",
            "parquet.enable.dictionary": "false",
            "parquet.enable.dictionary#ids.list.element": str(self.encoding == "dictionary").lower(),
            "parquet.enable.dictionary#part": "true",
        }


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of the runs ``starts[i] .. starts[i] + sizes[i]``, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _byte_set(some) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(some)] = True
    return out


_IS_MARK = _byte_set(_MARKS.encode())
_IS_ALNUM = _byte_set(b for b in range(128) if chr(b).isalnum())
_IS_SEEN = _byte_set(range(33, 127))


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the words of these texts begin: at spaces, at closing marks, and at and after line breaks that stand alone.

    ``data`` holds the UTF-8 of texts that begin at ``starts``.  The pre-tokenizer
    begins a piece at each of these places, whatever follows (texts that are to
    be encoded whole aside).  A byte of the text before or behind changes
    nothing: a text's own begin is a cut.
    """
    begins = data == 32
    marks = np.flatnonzero(_IS_MARK[data])
    last, lead = data[marks - 1], data[np.maximum(marks - 2, 0)]
    latin = (lead >= 0xC3) & (lead <= 0xC5) & (last != 0x97) & (last != 0xB7)  # U+00C0 to U+017F, all letters but two
    begins[marks[_IS_ALNUM[last] | latin]] = True
    lines = np.flatnonzero(data == 10)
    lines = lines[(lines > 0) & (lines < len(data) - 1)]
    lines = lines[_IS_SEEN[data[lines - 1]] & _IS_SEEN[data[lines + 1]]]
    begins[lines] = True
    begins[lines + 1] = True
    begins[starts[starts < len(data)]] = True
    return np.flatnonzero(begins)


def word_parts(word: str) -> list[str]:
    """Parts of a word (with its leading space, if any) whose ids follow each other: lines and closing marks stand alone.

    A single line break between other characters and a run of marks after a
    letter or digit are pieces of their own for the pre-tokenizer.
    """
    lines = word.split("\n")
    if len(lines) > 1 and any(not x or x[-1].isspace() or i and x[0].isspace() for i, x in enumerate(lines)):
        return [word]
    out = []
    for i, x in enumerate(lines):
        if i:
            out.append("\n")
        stem = x.rstrip(_MARKS)
        if stem and len(stem) < len(x) and stem[-1].isalnum():
            out += [stem, x[len(stem):]]
        else:
            out.append(x)
    return out


class WordEncoder:
    """A tokenizer with the ids of the words seen so far."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)  # the same one, for words that are cut and spelt as in the vocabulary
        self.model.pre_tokenizer = Split(_SPACE, "merged_with_next")
        self.as_written = self.tokenizer.normalizer is None  # else the model gets other letters than the text's
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that begin with a space
        self.spaced[[i for t, i in vocabulary.items() if t[0] == _SPACE]] = True
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids, self.ends, self.chars = array("i"), array("q", [0]), 0
        self.again = bytearray()  # by slot: whether the word came in a later call, too

    def trim(self) -> None:
        """Forget the words that came in one call only; all of them if the others take more than half of the room."""
        seen = [(w, i) for w, i in self.slot.items() if self.again[i]]
        ids, sizes = self._ids_at(np.array([i for _, i in seen], np.int64))
        self.clear()
        if 2 * sum(len(w) for w, _ in seen) <= _KEPT_CHARS:
            self._add([w for w, _ in seen], ids, sizes)

    def _library(self, texts: list[str]) -> list[list[int]]:
        if self.as_written and texts and all(map(_LETTERS.fullmatch, texts)):
            spelt = [codecs.charmap_decode(t.encode(), "strict", _BYTES)[0] for t in texts]
            return [e.ids for e in self.model.encode_batch_fast(spelt, add_special_tokens=False)]
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        at, base = len(self.ends) - 1, len(self.ids)
        self.ids.frombytes(ids.astype(np.int32).tobytes())
        self.ends.frombytes((np.cumsum(sizes) + base).astype(np.int64).tobytes())
        self.slot.update(zip(words, range(at, at + len(words))))
        self.again.extend(bytes(len(words)))
        self.chars += sum(map(len, words))

    def _learn(self, words: list[str]) -> None:
        """Give every new word its ids, put together from those of its parts."""
        plain, mixed, parts, counts = [], [], [], []
        slot, letters, lead, single = self.slot, [], [], []
        for w in words:
            if _LETTERS.fullmatch(w):  # most words
                letters.append(w)
            elif w[0] == " " and w[1:].isalnum():
                lead.append(w)
            elif len(p := word_parts(w)) == 1:
                plain.append(w)
            else:
                mixed.append(w)
                parts += p
                counts.append(len(p))
        had = {*letters, *lead}
        for w in dict.fromkeys(plain + parts):
            if w not in slot and w not in had:
                (lead if w[:1] == " " and len(w) > 1 and w[1:2].strip() and w[-1:].strip() else single).append(w)
        # words with a space in front go many at a time: each begins at a token with a space, and no other of its tokens has one
        for some in (letters, lead):
            joined = ["".join(some[i:i + 100]) for i in range(0, len(some), 100)]
            ids = np.concatenate([np.zeros(0, np.int32), *(np.array(e, np.int32) for e in self._library(joined))])
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) != len(some):
                raise AssertionError("a word's ids don't begin at its space")
            self._add(some, ids, np.diff(np.append(starts, len(ids))))
        apart = self._library(single)
        self._add(single, np.array([x for e in apart for x in e], np.int32), np.array([len(e) for e in apart], np.int64))
        if mixed:
            at = np.fromiter(map(slot.__getitem__, parts), np.int64, len(parts))
            ids, sizes = self._ids_at(at)
            self._add(mixed, ids, np.diff(np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))]))

    def _ids_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, sizes)`` of the words at these slots."""
        ends = np.frombuffer(self.ends, np.int64)
        sizes = ends[at + 1] - ends[at]
        return np.frombuffer(self.ids, np.int32)[_ragged(ends[at], sizes)], sizes

    def whole(self, text: str) -> bool:
        """Whether the text has to be encoded in one piece."""
        return _JOINED.search(text) is not None or any(a in text for a in self.added)

    def _by_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, lengths)``: each different word of the texts is looked up, or encoded, once."""
        column = pa.array(texts, pa.large_string())
        _, places, buffer = column.buffers()
        starts = np.frombuffer(places, np.int64, len(texts) + 1)
        data = np.frombuffer(buffer or b"", np.uint8, int(starts[-1]))
        begins = cuts(data, starts[:-1])
        words = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(np.append(begins, len(data))), pa.py_buffer(data)).dictionary_encode()
        codes = np.asarray(words.indices)
        kinds = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        before = len(self.again)
        known = list(map(self.slot.get, kinds))
        new = [i for i, k in enumerate(known) if k is None]
        if new:
            self._learn([kinds[i] for i in new])
            for i in new:
                known[i] = self.slot[kinds[i]]
        at = np.array(known, np.int64)
        np.frombuffer(self.again, bool)[at[at < before]] = True
        flat, sizes = self._ids_at(at[codes])
        return flat, np.diff(np.append(0, np.cumsum(sizes))[np.searchsorted(begins, starts)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, lengths)`` of the texts, one after the other."""
        if self.chars > _KEPT_CHARS:
            self.trim()
        odd = [i for i, t in enumerate(texts) if self.whole(t)]
        if not odd and texts:
            return self._by_words(texts)
        out = [np.zeros(0, np.int32)] * len(texts)
        for i, ids in zip(odd, self._library([texts[i] for i in odd])):
            out[i] = np.array(ids, np.int32)
        rest = sorted(set(range(len(texts))) - set(odd))
        if rest:
            flat, lengths = self._by_words([texts[i] for i in rest])
            for i, ids in zip(rest, np.split(flat, np.cumsum(lengths)[:-1])):
                out[i] = ids
        return np.concatenate([np.zeros(0, np.int32), *out]), np.array([len(x) for x in out], np.int64)


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; threads of the library's own take more time and memory
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _pieces(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """Runs of rows with about ``limit`` bytes of text (a longer text alone): ``(first row, texts)``."""
    lengths = np.array(pc.fill_null(pc.binary_length(column), 0)) if len(column) else np.zeros(0, int)
    at = 0
    while at < len(column):
        to = at + max(1, int(np.searchsorted(np.cumsum(lengths[at:]), limit, "right")))
        yield at, [t or "" for t in column[at:to].to_pylist()]
        at = to


def encoded(df: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0) -> DataFrame:
    """``(doc_id, part, start, n_tokens, ids)`` in ascending id order within each part, parts in ascending order."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("tie"))
    dealt = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("tie"))
    dealt = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie").select("doc_id", "text")

    def encode(batches):
        part, start, enc = TaskContext.get().partitionId(), 0, _encoder(tokenizer)
        for b in batches:
            for at, texts in _pieces(b.column(1)):
                ids, sizes = enc.encode(texts)
                ends = np.cumsum(sizes + 1)
                full = np.full(int(ends[-1]), end_id, np.int32)
                keep = np.ones(len(full), bool)
                keep[ends - 1] = False
                full[keep] = ids
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(full))
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[at:at + n], pa.array(np.full(n, part, np.int32)), pa.array(start + ends - sizes - 1), pa.array(sizes + 1), lists],
                    ["doc_id", "part", "start", "n_tokens", "ids"])
                start += int(ends[-1])

    kind = dealt.schema["doc_id"].dataType.simpleString()
    return map_arrow(dealt, encode, f"doc_id {kind}, part int, start long, n_tokens long, ids array<int>")


def write(df: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, layout: Layout = Layout()) -> None:
    """Write the token files of ``df`` under ``path``: ``tokens`` and, one row a file, ``parts``."""
    spark = df.sparkSession
    encoded(df, tokenizer, doc_id, text, end_id).write.options(**layout.options()).parquet(f"{path}/tokens")
    totals = spark.read.parquet(f"{path}/tokens").groupBy("part").agg(
        F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row a file
    totals.withColumn("part_start", F.coalesce(before, F.lit(0))).write.parquet(f"{path}/parts")


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens)`` of every document; the ids are not read."""
    return placed(spark, path, spark.read.parquet(f"{path}/tokens").select("doc_id", "part", "start", "n_tokens"))


def placed(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``rows`` (with ``part`` and the file's own ``start``) with the place in the whole corpus as ``start``."""
    parts = spark.read.parquet(f"{path}/parts").select("part", "part_start")
    others = [c for c in rows.columns if c not in ("part", "start")]
    return rows.join(parts, "part").select(*others, (F.col("part_start") + F.col("start")).alias("start"))


def documents(spark: SparkSession, path: str, first, last) -> DataFrame:
    """The ids of the documents with ``first <= doc_id <= last``: row groups and pages of other ids are skipped."""
    return spark.read.parquet(f"{path}/tokens").where(F.col("doc_id").between(first, last)).select("doc_id", "n_tokens", "ids")


def token_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """The ids at the places ``start`` to ``stop`` of the corpus: ``(doc_id, start, ids)``, cut to the range.

    The files are chosen by their totals, the rows in them by their own starts.
    """
    end = F.col("part_start") + F.col("n_tokens")
    files = spark.read.parquet(f"{path}/parts").where((F.col("part_start") < stop) & (end > start)).select("part", "part_start").collect()
    tokens, spans = spark.read.parquet(f"{path}/tokens"), F.lit(False)
    for f in files:  # only files that hold a part of the range
        own = F.col("start") + F.lit(f.part_start)
        spans = spans | ((F.col("part") == f.part) & (F.col("start") < stop - f.part_start) & (own + F.col("n_tokens") > start))
    rows = placed(spark, path, tokens.where(spans).select("doc_id", "part", "start", "n_tokens", "ids"))
    skip = F.greatest(F.lit(start) - F.col("start"), F.lit(0))
    left = F.least(F.col("n_tokens"), F.lit(stop) - F.col("start")) - skip
    return rows.where((F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > start)).select(
        "doc_id", (F.col("start") + skip).alias("start"), F.slice("ids", (skip + 1).cast("int"), left.cast("int")).alias("ids"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the ids in the files."""
    rows = spark.read.parquet(f"{path}/tokens").select("doc_id", "part", "start", "ids")

    def digest(batches):
        for b in batches:
            lists = b.column(3)
            ends = np.asarray(lists.offsets)
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False))).cast("B")
            crc = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
                ["doc_id", "part", "start", "n_tokens", "ids_crc32"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    slim = map_arrow(rows, digest, f"doc_id {kind}, part int, start long, n_tokens long, ids_crc32 long")
    return placed(spark, path, slim).select("doc_id", "start", "n_tokens", "ids_crc32")


def round_trip(df: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, layout: Layout = Layout()) -> DataFrame:
    """Write the token files into the shared folder and read them back (``digests``)."""
    path = scratch_dir(df.sparkSession, "token-files")
    write(df, path, tokenizer, doc_id, text, end_id, layout)
    return digests(df.sparkSession, path)
