"""Token counts by a linear longest-match automaton.

The automaton is a byte trie of the vocabulary.  A trie node also has a failure link and the
number of pieces that greedy longest-match-first splitting pops on the way along that link:
for a node that is a piece, one piece and the root; for any other node, its parent's popped
pieces and link, followed on until the node's byte can be read.  Reading a word is then one
walk: read the next byte where an edge has it, else add the popped count and follow the link.
No piece is ever built, and the steps are linear in the word's length.

A word is a run of non-blank characters, read with one space before it (the vocabulary marks
word beginnings by that space).  Every single byte is a piece, so every word can be split.
The distinct words of a block walk in lockstep as numpy arrays.

Defined cases: null, empty and blank texts have 0 words and 0 tokens; repeated rows are counted
each on its own; extra columns pass by; words of any length are read whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from . import blocks as B
from .common import map_blocks, ref, schema_of

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
SPACE = 0x20
BLOCK_BYTES = 2 << 20  # larger blocks share more words, smaller ones need less memory


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1 bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_pieces(path: str = VOCABULARY) -> list[bytes]:
    """The byte strings of a byte-level vocabulary file (special tokens left out)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", ())}
    of = _byte_alphabet()
    return [bytes(of[c] for c in p) for p in spec["model"]["vocab"] if p not in special]


@dataclass
class Automaton:
    keys: np.ndarray  # sorted node * 256 + byte of every edge
    targets: np.ndarray
    fail: np.ndarray
    popped: np.ndarray  # pieces popped along the failure link
    final: np.ndarray  # pieces popped when the word ends in this node
    _edges: dict | None = None  # edges and piece marks as plain Python, made where they are used
    _pieces: list | None = None
    remembered: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.uint64), np.empty(0, np.int64))  # word hashes, ascending, and their pieces

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The node after reading ``byte``, or -1 where no edge has it."""
        want = node * 256 + byte
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.targets[at], -1)

    def lengths(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of the words buf[starts:ends], each read with a space before it."""
        n = len(starts)
        count = np.zeros(n, dtype=np.int64)
        node = np.full(n, self.step(np.array([0]), np.array([SPACE]))[0])
        pos, active = starts.copy(), np.arange(n)
        while len(active):
            over = pos[active] >= ends[active]
            done = active[over]
            count[done] += self.final[node[done]]
            active = active[~over]
            at = node[active]
            to = self.step(at, buf[pos[active]].astype(np.int64))
            go = to >= 0
            forward, back = active[go], active[~go]
            node[forward] = to[go]
            pos[forward] += 1
            count[back] += self.popped[node[back]]
            node[back] = self.fail[node[back]]
        return count


    def token_starts(self, word: bytes) -> list[int]:
        """Where the pieces of one word begin (a piece that begins with the space before it: 0)."""
        if self._edges is None:
            self._edges = dict(zip(self.keys.tolist(), self.targets.tolist()))
            self._pieces = (self.fail == 0).tolist()  # only pieces go back to the root
        edges, is_piece = self._edges, self._pieces
        raw, at, out = bytes([SPACE]) + word, 0, []
        while at < len(raw):
            out.append(max(0, at - 1))
            node, stop = 0, at + 1
            for pos in range(at, len(raw)):
                node = edges.get(node * 256 + raw[pos], -1)
                if node < 0:
                    break
                if is_piece[node]:
                    stop = pos + 1
            at = stop
        return out


def build(pieces: Iterable[bytes]) -> Automaton:
    """Trie, failure links and popped counts, breadth first."""
    edges: dict[int, int] = {}
    parent, byte, depth = [0], [0], [0]
    piece = {0: False}
    for p in {*pieces, *(bytes([b]) for b in range(256))}:
        node = 0
        for b in p:
            key = node * 256 + b
            nxt = edges.get(key)
            if nxt is None:
                nxt = edges[key] = len(parent)
                parent.append(node), byte.append(b), depth.append(depth[node] + 1)
            node = nxt
        piece[node] = True
    n = len(parent)
    fail, popped, final = [0] * n, [0] * n, [0] * n
    for v in sorted(range(1, n), key=depth.__getitem__):
        if piece.get(v):
            fail[v], popped[v] = 0, 1
        else:
            z, pops = fail[parent[v]], popped[parent[v]]
            while z * 256 + byte[v] not in edges:
                pops += popped[z]
                z = fail[z]
            fail[v], popped[v] = edges[z * 256 + byte[v]], pops
        final[v] = popped[v] + final[fail[v]]
    keys = np.array(sorted(edges), dtype=np.int64)
    return Automaton(keys, np.array([edges[int(k)] for k in keys], dtype=np.int64), np.array(fail), np.array(popped), np.array(final))


REMEMBERED = 1 << 18  # words whose pieces a worker remembers (16 bytes each)


def tokens_of(automaton: Automaton, words: B.Words) -> np.ndarray:
    """Pieces of every word of a block; equal words are read once, also over the blocks of a worker
    as long as there is room to remember them."""
    hashes, first, of = np.unique(words.hashes(), return_index=True, return_inverse=True)
    known, pieces = automaton.remembered
    at = np.searchsorted(known, hashes)
    old = np.zeros(len(hashes), dtype=bool)
    if len(known):
        old = known[np.minimum(at, len(known) - 1)] == hashes
    out = np.empty(len(hashes), dtype=np.int64)
    out[old] = pieces[at[old]]
    new = np.flatnonzero(~old)
    out[new] = automaton.lengths(words.buf, words.starts[first[new]], words.ends[first[new]])
    keep = new[:max(0, REMEMBERED - len(known))]
    if len(keep):
        automaton.remembered = np.insert(known, at[keep], hashes[keep]), np.insert(pieces, at[keep], out[keep])
    return out[of]


def count_tokens(docs: DataFrame, pieces: Iterable[bytes] | None = None, path: str = VOCABULARY,
                 keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns with n_words and n_tokens of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(build(load_pieces(path) if pieces is None else pieces))  # the vocabulary's size
    plain = docs.select(*[ref(c) for c in dict.fromkeys([*keep, text])])
    at = {c: i for i, c in enumerate(plain.columns)}

    def count(batch, buf, offs):
        words = B.Words(buf, offs, B.NON_BLANK)
        tokens = B.sums_by_doc(tokens_of(sent.value, words), words.ranges)
        return {c: batch.column(at[c]) for c in keep} | {"n_words": words.counts.astype(np.int64), "n_tokens": tokens}

    schema = ", ".join([schema_of(docs, keep), "n_words bigint, n_tokens bigint"])
    return map_blocks(plain, schema, count, text=text, block_bytes=BLOCK_BYTES)
