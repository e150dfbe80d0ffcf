"""Secret scans: fixed patterns plus password guess costs of credential-context values.

Base kinds are pattern matches (assign, access, hex).  The method adds ``guess`` spans: a value
that follows a credential word is split at minimum cost into words (also capital or with digits
and signs for letters), dates, repeats, keyboard walks and brute-force characters, by dynamic
programming over its positions; if an attacker who knows these forms would need at least
10**GUESSES tries, the value is a secret.  The words are the letter pieces of a public vocabulary
in its order, so ordinary prose after a credential word is cheap.  Steps are linear in the value's
length (every form has a bounded or run-length extent) and the tables are flat arrays, so values of
any length are judged whole.

Defined cases: null texts are empty and have no span; repeated rows are scanned each on its own;
overlapping spans of different kinds all stay; extra columns pass by.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks as B
from .common import map_blocks, ref, schema_of
from .token_counts import load_pieces

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32

# Places where a value of at least 6 characters follows a credential word, wider than ``assign``;
# after a sign, a scheme word may stand before the value (Authorization: Basic ...).
CONTEXT = re.compile(
    r"""(?<![a-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api[_-]?key|(?:access|private|secret|auth)[_-]?key|bearer|authorization)"""
    r"""["']?[\x20\t]*(?:[:=]>?[\x20\t]*["']?(?:(?:basic|bearer|negotiate|ntlm|token|apikey)[\x20\t]+)?|(?:\bis\b|(?<=bearer))[\x20\t]*["']?)(?=[!-~]{6})""",
    re.I | re.A)
RUN = re.compile(r"[!-~]+")
# What closes a value: a quote with all signs behind it, or closing punctuation.
TAIL = re.compile(r"""(?:["'`][^A-Za-z0-9]*|[.,;:!?)\]}>]+)$""")
GUESSES = 10.0  # log10 of the tries from which on a value counts as a secret
MIN_GUESS_LEN = 8

# Words an attacker tries first, commonest first, before those of the vocabulary.
WORDS = ("password", "admin", "letmein", "welcome", "secret", "test", "default", "changeme", "example", "token", "user", "login", "master",
         "root", "guest", "dragon", "monkey", "shadow", "sunshine", "princess", "football", "baseball", "superman", "batman", "hello",
         "freedom", "whatever", "trustno", "iloveyou", "love", "pass", "key", "api", "access", "demo", "sample", "dummy", "none", "null",
         "true", "false", "yes", "your", "my", "the", "here", "value", "string", "server", "database", "service", "public", "private",
         "summer", "winter", "spring", "autumn", "january", "monday", "friday", "company", "office", "home", "local", "host", "temp")
SWAPS = str.maketrans("01345789@$!", "oleastbgasi")  # signs written for letters
SHORTEST_WORD = 3
NEAR = 32
KEYBOARD = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz")
_PLACE = {c: (r, i) for r, row in enumerate(KEYBOARD[:4]) for i, c in enumerate(row)}
DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d")


@dataclass(frozen=True)
class Dictionary:
    """Words by rank, 1 being tried first; the log10 of the rank is a word's cost."""

    ranks: dict[str, int]
    longest: int

    @classmethod
    def of(cls, words: Iterable[str]) -> "Dictionary":
        ranks: dict[str, int] = {}
        for w in words:
            if len(w) >= SHORTEST_WORD:
                ranks.setdefault(w.lower(), len(ranks) + 1)
        return cls(ranks, max(map(len, ranks), default=0))


@lru_cache(maxsize=1)
def vocabulary() -> Dictionary:
    """``WORDS``, then the pieces of the default vocabulary that are ASCII letters (with or without the
    space before a word), in its order, which is by frequency.  Its size is the vocabulary's."""
    pieces = (p.removeprefix(b" ") for p in load_pieces())
    return Dictionary.of([*WORDS, *(p.decode("ascii") for p in pieces if p.isalpha())])


def _char_cost(c: str) -> float:
    size = 10 if c.isdigit() else 26 if "a" <= c <= "z" or "A" <= c <= "Z" else 33 if c.isascii() else 100
    return math.log10(size)


def _adjacent(a: str, b: str) -> bool:
    """Neighbours in a keyboard row, above or below each other, or in the alphabet."""
    p, q = _PLACE.get(a), _PLACE.get(b)
    near = p is not None and q is not None and p != q and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1
    return near or (a.isascii() and a.isalpha() and b.isalpha() and abs(ord(a) - ord(b)) == 1)


def _lengths(most: int, least: int) -> list[int]:
    """The lengths of a run that are tried: all up to NEAR, and the whole run."""
    return [*range(least, min(most, NEAR) + 1), *([most] if most > max(NEAR, least - 1) else [])]


def suffix_costs(value: str, words: Dictionary | None = None) -> array:
    """Per position, log10 of the guesses of the cheapest segmentation of ``value`` from there on."""
    words = vocabulary() if words is None else words
    rank, longest = words.ranks, words.longest
    low = "".join(c.lower() if c.isascii() else c for c in value)  # one character for one
    plain = low.translate(SWAPS)
    n = len(value)
    best = array("d", [math.inf]) * n + array("d", [0.0])
    glue = math.log10(2)  # a segment more makes one more choice of form
    chars = array("d", map(_char_cost, value))
    # brute-force characters from a hexadecimal run are drawn from 16
    for m in re.finditer(r"[0-9a-f]{8,}|[0-9A-F]{8,}", value):
        for i in range(*m.span()):
            chars[i] = min(chars[i], math.log10(16))
    zeros = array("q", [0]) * (n + 1)
    same, walk = zeros[:], zeros[:]
    again = {u: zeros[:] for u in (2, 3, 4)}  # a unit of u characters written again and again
    for i in range(n - 2, -1, -1):  # run lengths from i on: equal characters, keyboard neighbours
        same[i] = same[i + 1] + 1 if low[i] == low[i + 1] else 0
        walk[i] = walk[i + 1] + 1 if _adjacent(low[i], low[i + 1]) else 0
        for u, runs in again.items():
            runs[i] = runs[i + 1] + 1 if i + u < n and value[i] == value[i + u] else 0

    def offer(i: int, j: int, cost: float) -> None:
        if cost + best[j] < best[i]:
            best[i] = cost + best[j]

    for i in range(n - 1, -1, -1):
        offer(i, i + 1, chars[i])
        for j in range(i + SHORTEST_WORD, min(n, i + longest) + 1):
            r = rank.get(plain[i:j])
            if r is not None:
                swapped = sum(a != b for a, b in zip(low[i:j], plain[i:j]))
                shout = 0 if value[i:j] == low[i:j] else min(2, j - i)
                offer(i, j, math.log10(r + 1) + math.log10(2) * (shout + swapped) + glue)
        date = DATE.match(value, i)
        if date:
            offer(i, date.end(), math.log10(365 * 120) + glue)
        for more in _lengths(same[i], 2):
            offer(i, i + more + 1, chars[i] + math.log10(more + 1) + glue)
        for more in _lengths(walk[i], 3):
            offer(i, i + more + 1, math.log10(94 * (more + 1)) + 0.2 * more + glue)
        for unit, runs in again.items():
            for times in _lengths((runs[i] + unit) // unit, 3):
                offer(i, i + times * unit, sum(chars[i:i + unit]) + math.log10(times) + glue)
    return best


def guess_cost(value: str, words: Dictionary | None = None) -> float:
    """log10 of the guesses of the cheapest segmentation of ``value``."""
    return suffix_costs(value, words)[0]


def guess_spans(text: str, words: Dictionary | None = None) -> Iterator[tuple[int, str, int]]:
    """The ``guess`` spans.  After a value that is no secret the search goes on at the value's own
    start, as it may be a credential word itself; values of one run share their costs."""
    pos, first, stop, costs = 0, 0, 0, None  # value run text[first:stop] whose costs are known
    while m := CONTEXT.search(text, pos):
        start = pos = m.end()
        if start >= stop:
            first, stop, costs = start, RUN.match(text, start).end(), None
            end = first + len(TAIL.sub("", text[first:stop]))
        if end - start < MIN_GUESS_LEN:
            continue
        costs = suffix_costs(text[first:end], words) if costs is None else costs
        if costs[start - first] >= GUESSES:
            yield start, "guess", end
            pos = stop


def spans_of(text: str, words: Dictionary | None = None) -> list[tuple[int, str, int]]:
    """All (start, kind, end) of a text, by start, then kind as listed (code points)."""
    found = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    found += guess_spans(text, words)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


_HEX_BYTE = B.byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x66)
_LEADS = (b"pass", b"pwd", b"secret", b"token", b"credential", b"key", b"bearer", b"authorization", b"akia")


def suspects(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Texts that can hold a span at all: a lead word (any case) or a hexadecimal run."""
    n = len(offs) - 1
    out = np.zeros(n, dtype=bool)
    raw = B.LOWER[buf].tobytes()
    for lead in _LEADS:
        at = raw.find(lead)
        while at >= 0:
            d = int(np.searchsorted(offs, at, side="right")) - 1
            out[d] = True
            at = raw.find(lead, int(offs[d + 1]))  # next text; a match across an edge only adds a suspect
    breaks = np.flatnonzero(np.concatenate([[True], ~_HEX_BYTE[buf], [True]])) - 1  # bytes between runs
    long_run = np.flatnonzero(np.diff(breaks) > MIN_HEX)
    for at, end in zip(breaks[long_run] + 1, breaks[long_run + 1]):  # a run may go on into later texts
        out[np.searchsorted(offs, at, side="right") - 1:np.searchsorted(offs, end - 1, side="right")] = True
    return out


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", words: Dictionary | None = None) -> DataFrame:
    """``keep`` columns with n_assign, n_access, n_hex, n_guess, base_sha256 and spans."""
    plain = docs.select(*[ref(c) for c in dict.fromkeys([*keep, text])])
    at = {c: i for i, c in enumerate(plain.columns)}
    none = hashlib.sha256(b"").hexdigest()
    words = vocabulary() if words is None else words  # read once, by the driver

    def find(batch, buf, offs):
        n = len(offs) - 1
        counts = {k: np.zeros(n, dtype=np.int64) for k in KINDS}
        digest, joined = [none] * n, [""] * n
        for d in np.flatnonzero(suspects(buf, offs)):
            found = spans_of(buf[offs[d]:offs[d + 1]].tobytes().decode("utf-8", "replace"), words)
            for _, kind, _ in found:
                counts[kind][d] += 1
            written = [(k, f"{k}:{s}:{e}") for s, k, e in found]
            digest[d] = hashlib.sha256(",".join(w for k, w in written if k != "guess").encode()).hexdigest()
            joined[d] = ",".join(w for _, w in written)
        return {c: batch.column(at[c]) for c in keep} | {f"n_{k}": counts[k] for k in KINDS} | {
            "base_sha256": pa.array(digest, pa.string()), "spans": pa.array(joined, pa.string())}

    schema = ", ".join([schema_of(docs, keep), *(f"n_{k} bigint" for k in KINDS), "base_sha256 string, spans string"])
    return map_blocks(plain, schema, find, text=text)


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]", words: Dictionary | None = None) -> DataFrame:
    """The same rows and columns with every span (overlaps merged) replaced by ``mask``.

    Texts without a span stay byte for byte (null stays null).
    """
    i_text = docs.columns.index(text)
    names = docs.columns
    words = vocabulary() if words is None else words

    def clean(batch, buf, offs):
        column, out = batch.column(i_text), None
        for d in np.flatnonzero(suspects(buf, offs)):
            body = buf[offs[d]:offs[d + 1]].tobytes().decode("utf-8", "replace")
            found = spans_of(body, words)
            if not found:
                continue
            out = column.to_pylist() if out is None else out
            parts, last = [], 0
            for s, _, e in found:
                if s >= last:
                    parts += [body[last:s], mask]
                last = max(last, e)
            out[d] = "".join(parts) + body[last:]
        done = column if out is None else pa.array(out, pa.string())
        return {c: done if i == i_text else batch.column(i) for i, c in enumerate(names)}

    schema = schema_of(docs)
    return map_blocks(docs, schema, clean, text=text)
