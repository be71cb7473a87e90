"""Personal data by anchor expansion.

An Aho-Corasick automaton walks each whole text once and reports anchors:
at-signs, digits, plus-digit pairs, URL schemes and identifier cues.  Around
each anchor a small deterministic parser expands to the left and right,
finds the boundaries and validates (octet range, Luhn, digit counts, mod 97).

Base kinds (exact, see ``scan_base``): ``email``, ``ip``, ``card``, ``phone``.
The method adds: ``url`` (a URL that carries ``user:password@``), ``iban``
(validated by mod 97), ``account`` (number after an account cue, 6 to 17
digits), ``ssn`` (3-2-4 digits after a cue), ``address`` (house number and
street name before a street word).

Null and empty texts give no spans.  Repeated rows each give their own row;
ties cannot arise, spans are ordered by start and then by kind.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, sha256_hex, span_string

#: Kinds in the order of the span strings.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "account", "ssn", "address")
RANK = {k: i for i, k in enumerate(KINDS)}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = "0123456789"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL_USER = re.compile(r"//[A-Za-z0-9._~%-]+:[^\s/@:]+@[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[^\s<>\"']*)?")
_IBAN = re.compile(r"[\x20:#.-]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
_ACCOUNT = re.compile(r"(?:\x20?(?:number|Number|no\.?|No\.?|#))?[\x20:#=]{0,3}([0-9](?:[\x20-]?[0-9]){5,16})(?![0-9])")
_SSN = re.compile(r"[\x20:#=]{0,3}([0-9]{3}[\x20-][0-9]{2}[\x20-][0-9]{4})(?![0-9])")
_STREET_LEFT = re.compile(r"(?:[0-9]{1,5}[A-Za-z]?\x20)((?:[A-Z][\w'.-]*\x20){1,4})$")

_SCHEMES = ("http:", "https:", "ftp:", "ssh:")
_IBAN_CUES = ("IBAN", "iban", "Iban")
_ACCOUNT_CUES = ("account", "Account", "ACCOUNT", "acct", "Acct", "ACCT")
_SSN_CUES = ("SSN", "ssn", "social security", "Social Security")
_STREET_CUES = (" Street", " Avenue", " Road", " Boulevard", " Lane", " Drive")


def automaton() -> ahocorasick.Automaton:
    """The anchors: pattern -> (class, length)."""
    a = ahocorasick.Automaton()
    a.add_word("@", ("@", 1))
    for d in DIGITS:
        a.add_word(d, ("d", 1))
        a.add_word("+" + d, ("+", 2))
    for kind, cues in (("u", _SCHEMES), ("i", _IBAN_CUES), ("a", _ACCOUNT_CUES), ("s", _SSN_CUES), ("r", _STREET_CUES)):
        for c in cues:
            a.add_word(c, (kind, len(c)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i & 1:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _iban_ok(value: str) -> bool:
    v = value.replace(" ", "")
    if not 15 <= len(v) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def _iban_end(value: str) -> int:
    """Length of the longest prefix that validates, else 0: the boundary of the account number."""
    for end in range(len(value), 14, -1):
        if value[end - 1] != " " and _iban_ok(value[:end]):
            return end
    return 0


def scan(text: str, anchors: ahocorasick.Automaton) -> list[tuple[int, int, int, str]]:
    """All spans of one text as ``(start, rank, end, kind)``, code points, end exclusive."""
    out: list[tuple[int, int, int, str]] = []
    add = lambda k, s, e: out.append((s, RANK[k], e, k))
    email_end = ip_end = card_end = phone_end = run_end = 0
    for last, (kind, length) in anchors.iter(text):
        s = last - length + 1
        if kind == "d":
            if s >= run_end:  # a digit run begins here, or goes on after a match ended inside it
                if s >= ip_end:
                    if m := _IP.match(text, s):
                        ip_end = m.end()
                        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
                        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                            add("ip", s, ip_end)
                e = s + 1
                while e < len(text) and text[e] in DIGITS:
                    e += 1
                run_end = e
                if s >= card_end and (m := _CARD.match(text, s)):
                    card_end = m.end()
                    if card_end - s >= 14:
                        digits = m[0].replace(" ", "").replace("-", "")
                        if 14 <= len(digits) <= 19 and luhn(digits):
                            add("card", s, card_end)
        elif kind == "@":
            e = s
            while e > email_end and text[e - 1] in LOCAL:
                e -= 1
            if e < s and (m := _DOMAIN.match(text, s + 1)):
                email_end = m.end()
                add("email", e, email_end)
        elif kind == "+":
            if s >= phone_end and (m := _PHONE.match(text, s)):
                phone_end = m.end()
                if 10 <= sum(c in DIGITS for c in m[0]) <= 15:
                    add("phone", s, phone_end)
        elif kind == "u":
            if m := _URL_USER.match(text, last + 1):
                add("url", s, m.end())
        elif kind == "i":
            if (m := _IBAN.match(text, last + 1)) and (n := _iban_end(m[1])):
                add("iban", m.start(1), m.start(1) + n)
        elif kind == "a":
            if m := _ACCOUNT.match(text, last + 1):
                add("account", m.start(1), m.end(1))
        elif kind == "s":
            if m := _SSN.match(text, last + 1):
                add("ssn", m.start(1), m.end(1))
        elif m := _STREET_LEFT.search(text, max(0, s - 90), s + 1):
            add("address", m.start(), last + 1)
    return out


def find(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key``, a count per base kind, ``n_added``, ``base_sha256``, ``spans``."""
    kinds = [f"n_{k}" for k in BASE_KINDS]
    src = df.select(F.col(key).alias(key), F.col(text).alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for b in batches:
            counts, shas, strings, added = {k: [] for k in BASE_KINDS}, [], [], []
            for t in b.column(1):
                spans = scan(t.as_py() or "", anchors)
                base = [x for x in spans if x[1] < len(BASE_KINDS)]
                for k in BASE_KINDS:
                    counts[k].append(sum(x[3] == k for x in base) if base else 0)
                joined = span_string(base)
                shas.append(sha256_hex(joined))
                strings.append(joined if len(base) == len(spans) else span_string(spans))
                added.append(len(spans) - len(base))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(counts[k], pa.int64()) for k in BASE_KINDS], pa.array(added, pa.int64()), pa.array(shas, pa.string()), pa.array(strings, pa.string())],
                [key, *kinds, "n_added", "base_sha256", "spans"],
            )

    kind = src.schema[key].dataType.simpleString()
    cols = ", ".join(f"{k} bigint" for k in kinds)
    return map_arrow(src, run, f"`{key}` {kind}, {cols}, n_added bigint, base_sha256 string, spans string")
