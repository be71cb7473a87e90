"""Secret scan with corpus-wide ownership frequency.

Each text is scanned once for candidates.  The candidates' hashes are then
counted over the whole corpus: occurrences, distinct repositories and
distinct owners.  A value that is copied widely (by a large part of all
owners, into many repositories, or into very many rows) is an example; one
that stays with few and looks random is a live credential, also when a few
owners mirror it.

Base kinds (exact, see ``scan``): ``assign``, ``access``, ``hex``.  The method
adds ``pem`` (private keys, header to END line, or to the last base64 line of
a cut-off one; the hash is of the body without its line breaks), ``vendor`` (prefixed vendor tokens) and
``jwt`` spans.  Null and empty texts have no candidates; a null repository or
owner counts as one repository or owner of its own (the empty name).
Repeated rows each give their own row and count as occurrences, but not as
further repositories.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, sha256_hex, span_string, written

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "vendor", "jwt")
RANK = {k: i for i, k in enumerate(KINDS)}

_ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of 24 and more
_BREAK = r"""(?:[\s"',>|#]|\\[nrt])"""  # line breaks, also escaped or quoted
_PEM = re.compile(
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
    rf"(?P<body>(?:{_BREAK}*+(?:Proc-Type: ?\d,[A-Z]+|DEK-Info: ?[A-Z0-9-]+(?:,[0-9A-Fa-f]+)?))*+"
    rf"(?:(?P<key>(?:[A-Za-z0-9+/=]|{_BREAK})*+)-----END [A-Z ]*PRIVATE KEY-----"
    rf"|(?P<cut>(?:{_BREAK}*+[A-Za-z0-9+/]{{20,}}+=*+)*+(?:{_BREAK}++(?:[A-Za-z0-9+/]+=+|(?<=\n)[A-Za-z0-9+/]+(?=[^\S\n]*(?:\n|\Z))))?+)))"
)
_BREAKS = re.compile(r"\\[nrt]|[^A-Za-z0-9+/=]")
_VENDOR = re.compile(r"(?:gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+")

_ASSIGN_CUES = (b"passw", b"secret", b"token", b"apikey", b"api_key")
_VENDOR_CUES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "sk_live_", "AIza")


def scan(text: str) -> list[tuple[int, int, int, str, str]]:
    """``(start, rank, end, kind, secret value)`` of one whole text, code points, end exclusive."""
    out = []
    add = lambda k, m, g=0: out.append((m.start(), RANK[k], m.end(), k, m[g]))
    low = text.encode("utf-8", "surrogatepass").lower()  # A-Z only
    if any(c in low for c in _ASSIGN_CUES):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                add("assign", m, 2)
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                add("access", m)
    for m in _HEX.finditer(text):
        add("hex", m)
    if "PRIVATE KEY-----" in text:
        for m in _PEM.finditer(text):
            out.append((m.start(), RANK["pem"], m.end(), "pem", _BREAKS.sub("", m["key"] or m["cut"] or "") or m[0]))
    if any(c in text for c in _VENDOR_CUES):
        for m in _VENDOR.finditer(text):
            add("vendor", m)
    if "eyJ" in text:
        for m in _JWT.finditer(text):
            add("jwt", m)
    return out


def entropy(value: str) -> float:
    """Bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def candidates(df: DataFrame, key: str = "doc_id", text: str = "text", repo: Column | None = None, owner: Column | None = None) -> DataFrame:
    """One row per input row: key, counts, digest, span string and its distinct candidates
    ``found: array<struct<hash, entropy, n>>``, with ``repo`` and ``owner`` as text."""
    empty = F.lit("")
    src = df.select(
        F.col(key).alias(key),
        F.col(text).alias(text),
        F.coalesce((repo if repo is not None else empty).cast("string"), empty).alias("repo"),
        F.coalesce((owner if owner is not None else repo if repo is not None else empty).cast("string"), empty).alias("owner"),
    )
    found_type = pa.list_(pa.struct([("hash", pa.string()), ("entropy", pa.float64()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, shas, strings, found = {k: [] for k in BASE_KINDS}, [], [], []
            for t in b.column(1):
                spans = scan(t.as_py() or "")
                base = [x[:4] for x in spans if x[1] < len(BASE_KINDS)]
                for k in BASE_KINDS:
                    counts[k].append(sum(x[3] == k for x in base) if base else 0)
                joined = span_string(base)
                shas.append(sha256_hex(joined))
                strings.append(joined if len(base) == len(spans) else span_string(x[:4] for x in spans))
                found.append([{"hash": hashlib.sha256(v.encode()).hexdigest(), "entropy": entropy(v), "n": n} for v, n in Counter(x[4] for x in spans).items()])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), *[pa.array(counts[k], pa.int64()) for k in BASE_KINDS], pa.array(shas, pa.string()), pa.array(strings, pa.string()), pa.array(found, found_type)],
                [key, "repo", "owner", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "found"],
            )

    kind = src.schema[key].dataType.simpleString()
    return map_arrow(
        src,
        run,
        f"`{key}` {kind}, repo string, owner string, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, found array<struct<hash:string,entropy:double,n:bigint>>",
    )


def ownership(found: DataFrame) -> DataFrame:
    """Per candidate hash: ``n_seen``, ``n_rows``, ``n_repos``, ``n_owners`` and its entropy, over the whole corpus.

    Two steps (hash, repo, owner) then hash, each pre-aggregated before its
    shuffle, so that a value copied into a third of all rows stays small.
    """
    one = found.select("repo", "owner", F.explode("found").alias("c")).select("repo", "owner", "c.hash", "c.entropy", "c.n")
    per = one.groupBy("hash", "repo", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("rows"), F.max("entropy").alias("entropy"))
    by_repo = per.groupBy("hash", "repo").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"), F.max("entropy").alias("entropy"))
    by_owner = per.groupBy("hash", "owner").agg(F.sum("n").alias("n"))
    repos = by_repo.groupBy("hash").agg(F.sum("n").alias("n_seen"), F.sum("rows").alias("n_rows"), F.count("*").alias("n_repos"), F.max("entropy").alias("entropy"))
    owners = by_owner.groupBy("hash").agg(F.count("*").alias("n_owners"))
    return repos.join(owners, "hash")


def verdict(own: DataFrame, all_owners: int, all_repos: int, min_owners: int = 2, min_entropy: float = 3.0, share: float = 0.5) -> DataFrame:
    """``verdict``: ``example`` (copied widely), ``live`` (random-looking) or ``weak``.

    Copied widely is a share, never a number of rows: a value of ``min_owners``
    owners or more that ``share`` of all owners, or of all repositories, have.  However often
    one owner repeats a value, that makes no example of it.  A value that isn't
    random-looking needs ``min_owners`` owners only.
    """
    shared = F.col("n_owners") >= min_owners
    widely = shared & ((F.col("n_owners") >= share * all_owners) | (F.col("n_repos") >= share * all_repos))
    return own.withColumn("verdict", F.when(widely, "example").when(F.col("entropy") >= min_entropy, "live").when(shared, "example").otherwise("weak"))


def _holders(df: DataFrame, repo: Column | None, owner: Column | None) -> tuple[int, int]:
    """Distinct owners and repositories of all rows, with or without candidates."""
    empty = F.lit("")
    repo_ = F.coalesce((repo if repo is not None else empty).cast("string"), empty)
    owner_ = F.coalesce((owner if owner is not None else repo if repo is not None else empty).cast("string"), empty)
    pairs = df.select(repo_.alias("r"), owner_.alias("o")).distinct()
    owners = pairs.select("o").distinct().count()
    return owners, pairs.select("r").distinct().count()


def secret_scan(
    df: DataFrame, key: str = "doc_id", text: str = "text", repo: Column | None = None, owner: Column | None = None,
    min_owners: int = 2, min_entropy: float = 3.0, tag: str = "secrets",
) -> DataFrame:
    """Every input row with its spans and the numbers of its distinct candidates that are
    ``n_example``, ``n_live`` or ``n_weak`` by their ownership in the whole corpus; ``owned`` has each
    candidate's hash, verdict, ``n_owners``, ``n_repos`` and ``n_seen``."""
    found = written(candidates(df, key, text, repo, owner).withColumn("row", F.monotonically_increasing_id()), tag)  # scanned once, used twice
    verdicts = verdict(ownership(found), *_holders(df, repo, owner), min_owners, min_entropy).select("hash", "verdict", "n_owners", "n_repos", "n_seen")
    per_row = (
        found.where(F.size("found") > 0)
        .select("row", F.col(key).alias(key), "n_assign", "n_access", "n_hex", "base_sha256", "spans", F.explode("found.hash").alias("hash"))
        .join(verdicts, "hash")
        .groupBy("row")
        .agg(
            *[F.first(c).alias(c) for c in (key, "n_assign", "n_access", "n_hex", "base_sha256", "spans")],
            *[F.sum((F.col("verdict") == v).cast("long")).alias(f"n_{v}") for v in ("example", "live", "weak")],
            F.sort_array(F.collect_list(F.struct("hash", "verdict", "n_owners", "n_repos", "n_seen"))).alias("owned"),
        )
        .drop("row")
    )
    zero = F.lit(0).cast("long")
    no_owned = F.array().cast("array<struct<hash:string,verdict:string,n_owners:bigint,n_repos:bigint,n_seen:bigint>>").alias("owned")
    none = found.where(F.size("found") == 0).select(key, "n_assign", "n_access", "n_hex", "base_sha256", "spans", zero.alias("n_example"), zero.alias("n_live"), zero.alias("n_weak"), no_owned)
    return none.unionByName(per_row)


def redact(df: DataFrame, key: str = "doc_id", text: str = "text", repo: Column | None = None, owner: Column | None = None, min_owners: int = 2, min_entropy: float = 3.0, tag: str = "redact") -> DataFrame:
    """``df`` with every live credential in ``text`` replaced by ``[kind]``; examples and all other text stay.

    Rows are matched to their verdicts by key (a null key matches null).
    """
    found = written(candidates(df, key, text, repo, owner).where(F.size("found") > 0), tag)
    live = verdict(ownership(found), *_holders(df, repo, owner), min_owners, min_entropy).where("verdict = 'live'").select("hash")
    taken = {c.lower() for c in df.columns}
    key_, live_ = (next(n for i in range(len(taken) + 1) if (n := f"_{c}{i}") not in taken) for c in ("key", "live"))  # names that ``df`` hasn't
    hits = found.select(F.col(key).alias(key_), F.explode("found.hash").alias("hash")).distinct().join(live, "hash")
    per_key = hits.groupBy(key_).agg(F.collect_set("hash").alias(live_))  # a row's own distinct candidates
    both = df.join(per_key, F.col(key).eqNullSafe(F.col(key_)), "left").drop(key_)
    at, columns = df.columns.index(text), df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = b.column(len(columns))
            if marks.null_count < b.num_rows:
                texts = [_masked(t.as_py(), m.as_py()) if m.is_valid and t.is_valid else t.as_py() for t, m in zip(b.column(at), marks, strict=True)]
                cols = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(len(columns))]
            else:
                cols = [b.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(cols, columns)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return map_arrow(both, run, schema)


def _masked(text: str, live: list[str]) -> str:
    out, at = [], 0
    for start, _, end, kind, value in sorted(scan(text)):
        if hashlib.sha256(value.encode()).hexdigest() in live:
            if start >= at:
                out += [text[at:start], f"[{kind}]"]
            at = max(at, end)
    return "".join([*out, text[at:]])
