"""URL filters by a bit-parallel wildcard automaton (multiword Shift-And over all patterns at once).

Every glob is a chain of items; state i of a pattern means "its first i items are read".  The
states of all patterns lie side by side in a row of 64-bit words.  Reading one byte c is

    state = (state << 1) & READS[c]  |  state & STAYS[c]

where READS[c] has a bit for every state whose item accepts c and STAYS[c] one for every state
that a wildcard keeps on c.  So all patterns advance together, whatever their number, and the
URLs of a batch advance together as rows of a matrix.

Glob syntax: ``**`` any bytes, ``*`` any bytes but ``/`` and ``?`` (it stays within a host or a
path segment), ``?`` one character, ``\\`` takes the next character as it is; the rest is literal.
Globs are matched against the whole canonical URL: host with A-Z lower-cased, path, and the
query with its ``?``; scheme and fragment are left out.

A ``Rule`` (verdict, host, path) fits its host and all subdomains if the path starts with the
rule's; it is compiled into two globs of the same automaton.  The longest fitting rule decides.
Where no rule fits, an allow glob, then a block glob, then ``default`` decides.

Defined cases: a null URL or one without ``://`` has empty host and path, fits no rule and is
matched as the empty text; URLs of any length are read whole; repeated rows are judged each on
its own; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .common import freed, ref

U64 = np.uint64
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule(ALLOW, "com", "/"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
)
# Hosts of advertising, gambling, pill, spam and adult sites, and program files.
BLOCK_GLOBS = (
    "*ads-track**", "*doubleclick**", "*casino**", "*-bets**", "*poker**", "*-pills**",
    "*spam-**", "*adult-**", "**/ads/**", "**.exe", "**.apk",
)
ALLOW_GLOBS = ("*.gov/**", "*.edu/**")

ANY = np.ones(256, dtype=bool)
INSIDE = B.byte_table(lambda b: b not in b"/?")
CONTINUED = B.byte_table(lambda b: 0x80 <= b < 0xC0)


def literal(text: str) -> str:
    """A glob that matches ``text`` only."""
    return "".join("\\" + c if c in "*?\\" else c for c in text)


def items_of(glob: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(accepted bytes of every item, bytes that every state stays on)."""
    reads: list[np.ndarray] = []
    stays = [np.zeros(256, dtype=bool)]

    def item(accepted: np.ndarray) -> None:
        reads.append(accepted)
        stays.append(np.zeros(256, dtype=bool))

    at = 0
    while at < len(glob):
        c = glob[at]
        at += 1
        if c == "*":
            wide = glob[at:at + 1] == "*"
            at += wide
            stays[-1] = stays[-1] | (ANY if wide else INSIDE)
        elif c == "?":  # a first byte, then the rest of its character
            item(~CONTINUED)
            stays[-1] = stays[-1] | CONTINUED
        else:
            if c == "\\":
                c = glob[at:at + 1] or "\\"
                at += 1
            for b in c.encode():
                item(np.arange(256) == b)
    return reads, stays


class GlobAutomaton:
    """All patterns as one multiword Shift-And automaton."""

    def __init__(self, globs: Sequence[str]):
        parts = [items_of(g) for g in globs]
        bits = sum(len(stays) for _, stays in parts)
        width = max(1, -(-bits // 64))
        reads, stays = np.zeros((256, width * 64), dtype=bool), np.zeros((256, width * 64), dtype=bool)
        first = np.zeros(width * 64, dtype=bool)
        self.final = np.zeros(len(parts), dtype=np.int64)
        at = 0
        for p, (r, s) in enumerate(parts):
            first[at] = True
            for i, accepted in enumerate(r):
                reads[:, at + 1 + i] = accepted
            for i, kept in enumerate(s):
                stays[:, at + i] = kept
            at += len(s)
            self.final[p] = at - 1
        words = lambda m: np.packbits(m, axis=-1, bitorder="little").view(U64)
        self.reads, self.stays, self.first = words(reads), words(stays), words(first)
        self._ints: tuple[list[int], list[int]] | None = None

    def _finish(self, state: np.ndarray, buf: bytes) -> np.ndarray:
        """Read ``buf`` from one row's state; the words as one Python integer (for the last few long URLs)."""
        whole = lambda row: int.from_bytes(row.tobytes(), "little")
        if self._ints is None:
            self._ints = [whole(r) for r in self.reads], [whole(r) for r in self.stays]
        reads, stays = self._ints
        at = whole(state)
        for c in buf:
            at = (at << 1) & reads[c] | at & stays[c]
            if not at:
                break
        return np.frombuffer(at.to_bytes(state.nbytes, "little"), U64)

    def run(self, buf: np.ndarray, offs: np.ndarray, few: int = 16) -> np.ndarray:
        """Boolean matrix (texts x patterns): which patterns match the whole text."""
        n = len(offs) - 1
        length = np.diff(offs)
        order = np.argsort(-length, kind="stable")  # the texts still being read are a prefix
        start, length = offs[:-1][order], length[order]
        state = np.repeat(self.first[None, :], n, axis=0)
        pos, active = 0, int(np.searchsorted(-length, 0))
        while active > few:
            now = state[:active]
            c = buf[start[:active] + pos]
            moved = now << U64(1)
            moved[:, 1:] |= now[:, :-1] >> U64(63)
            state[:active] = moved & self.reads[c] | now & self.stays[c]
            pos += 1
            active = int(np.searchsorted(-length, -pos))
        for i in range(active):
            state[i] = self._finish(state[i], buf[start[i] + pos:start[i] + length[i]].tobytes())
        hit = (state[:, self.final >> 6] >> (self.final & 63).astype(U64)) & U64(1)
        out = np.empty((n, len(self.final)), dtype=bool)
        out[order] = hit.astype(bool)
        return out


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, query with its ``?``) of a URL; all empty without ``://``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, upper.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)", 1)
    return host, path, query


def filter_urls(pages: DataFrame, key: str = "page_id", url: str = "url", rules: Iterable[Rule] = RULES,
                block: Iterable[str] = BLOCK_GLOBS, allow: Iterable[str] = ALLOW_GLOBS, default: str = ALLOW) -> DataFrame:
    """key, host, path, rule (name or null), glob (the deciding one or null) and verdict of every row.

    One map pass; what is sent to the tasks is the rules' size (256 rows of state bits).
    """
    rules, block, allow = sorted(rules, key=lambda r: (-len(r.name), r.name, r.verdict)), [*block], [*allow]
    if any("?" in r.path or "#" in r.path or not r.path.startswith("/") for r in rules):
        raise ValueError("a rule's path starts with / and has neither ? nor #")
    globs = [*(g for r in rules for g in (literal(r.name) + "**", "*." + literal(r.name) + "**")), *allow, *block]
    marks = np.array([*(i for i in range(len(rules)) for _ in range(2)), *range(len(rules), len(globs) - len(rules))])
    names = [*(r.name for r in rules), *globs[2 * len(rules):]]
    verdicts = [*(r.verdict for r in rules), *([ALLOW] * len(allow)), *([BLOCK] * len(block))]
    sent = pages.sparkSession.sparkContext.broadcast(GlobAutomaton(globs))  # the rules' size

    host, path, query = url_parts(ref(url))
    rows = pages.select(ref(key).alias("key"), host.alias("host"), path.alias("path"), F.concat(host, path, query).alias("canonical"))
    kind = rows.schema["key"].dataType.simpleString()
    none, n_rules = len(names), len(rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule_of = pa.array([*names[:n_rules], *[None] * (len(names) - n_rules + 1)], pa.string())
        glob_of = pa.array([*[None] * n_rules, *names[n_rules:], None], pa.string())
        verdict_of = pa.array([*verdicts, default])
        for batch in batches:
            buf, offs = B.buffers(batch.column(3))
            hit = sent.value.run(buf, offs)
            ranks = np.where(hit, marks[None, :], none) if hit.shape[1] else np.full((len(offs) - 1, 1), none)
            best = pa.array(ranks.min(axis=1) if len(ranks) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), rule_of.take(best), glob_of.take(best), verdict_of.take(best)],
                names=["key", "host", "path", "rule", "glob", "verdict"])

    out = rows.mapInArrow(freed(judge), f"key {kind}, host string, path string, rule string, glob string, verdict string")
    return out.withColumnRenamed("key", key)
