"""Document statistics, vectorised over blocks: the base counts and the shape of a text."""

from __future__ import annotations

import numpy as np

from . import blocks as B

U64 = np.uint64

_SYMBOL = B.byte_table(lambda b: b in b"#*$%&|<>")
_CLASSES = {  # byte classes whose shares describe a text
    "upper": B.byte_table(lambda b: 0x41 <= b <= 0x5A),
    "digit": B.byte_table(lambda b: 0x30 <= b <= 0x39),
    "bang": B.byte_table(lambda b: b in b"!?"),
    "bar": B.byte_table(lambda b: b in b"|<>"),
    "mark": B.byte_table(lambda b: b in b"#*$%&"),
    "stop": B.byte_table(lambda b: b in b".,;:"),
    "quote": B.byte_table(lambda b: b in b"\"'()[]{}/\\=+_-@~^`"),
    "wide": B.byte_table(lambda b: b >= 0x80),
    "line": B.byte_table(lambda b: b == 0x0A),
}


def dup_lines(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word that equal an earlier line, and lines with a word."""
    raw, n = buf.tobytes(), len(offs) - 1
    dup, lines = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for d in range(n):
        found = [x for x in raw[offs[d]:offs[d + 1]].split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
        lines[d] = len(found)
        dup[d] = len(found) - len(set(found))
    return dup, lines


def repeat_groups(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often every element's key occurs in its document, and one over that (sums to the distinct keys)."""
    mixed = B.mix(keys + doc.astype(U64) * U64(0x9E3779B97F4A7C15))
    _, inverse, counts = np.unique(mixed, return_inverse=True, return_counts=True)
    return counts[inverse], 1.0 / counts[inverse]


def base_counts(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (and n_lines) of every text.

    Words are runs of non-blank characters.  A repeat word lies in a 3-word window found at
    least twice in its text.
    """
    words = B.Words(buf, offs, B.NON_BLANK)
    dup, lines = dup_lines(buf, offs)
    chars = B.NON_BLANK[buf] & ((buf & 0xC0) != 0x80)
    out = {"n_words": words.counts.astype(np.int64), "word_chars": B.sums_by_doc(chars, offs),
           "n_symbols": B.sums_by_doc(_SYMBOL[buf], offs), "n_dup_lines": dup, "n_lines": lines}
    h, doc = words.hashes(), words.doc_of()
    cover = np.zeros(len(words) + 3, dtype=np.int64)
    grams, at = B.ngram_hashes(h, words.ranges, 3)
    if len(grams):
        often, _ = repeat_groups(grams, doc[at])
        hit = at[often >= 2]
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + 3, -1)
    repeated = np.cumsum(cover)[:len(words)] > 0
    out["n_repeat_words"] = B.sums_by_doc(repeated, words.ranges)
    out["_words"], out["_hashes"], out["_doc"] = words, h, doc
    return out


FEATURES = (
    "log_words", "log_bytes", "word_len", "word_len_sd", "word_len_max", "symbol_share", "dup_line_share", "repeat_share",
    "words_per_line", "distinct_share", "top_word_share", "short_share", "long_share", *(f"{c}_share" for c in _CLASSES),
)


def features(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A float32 matrix (texts x FEATURES); texts without words have zeros."""
    s = base_counts(buf, offs)
    words, h, doc = s["_words"], s["_hashes"], s["_doc"]
    n_docs, n = len(offs) - 1, np.maximum(s["n_words"], 1)
    size = np.maximum(np.diff(offs), 1)
    length = words.ends - words.starts
    total = B.sums_by_doc(length, words.ranges)
    mean = total / n
    spread = np.sqrt(np.maximum(B.sums_by_doc(length * length, words.ranges) / n - mean**2, 0))
    longest, top = np.zeros(n_docs), np.zeros(n_docs)
    often, share = repeat_groups(h, doc) if len(h) else (np.zeros(0, np.int64), np.zeros(0))
    full = np.flatnonzero(s["n_words"])
    if len(full):
        longest[full] = np.maximum.reduceat(length, words.ranges[full])
        top[full] = np.maximum.reduceat(often, words.ranges[full])
    distinct = np.bincount(doc, weights=share, minlength=n_docs)
    cols = [
        np.log1p(s["n_words"]), np.log1p(np.diff(offs)), mean, spread, longest, s["n_symbols"] / np.maximum(s["word_chars"], 1),
        s["n_dup_lines"] / np.maximum(s["n_lines"], 1), s["n_repeat_words"] / n, s["n_words"] / np.maximum(s["n_lines"], 1),
        distinct / n, top / n, B.sums_by_doc(length <= 3, words.ranges) / n, B.sums_by_doc(length >= 15, words.ranges) / n,
        *(B.sums_by_doc(t[buf], offs) / size for t in _CLASSES.values()),
    ]
    return np.column_stack(cols).astype(np.float32).reshape(n_docs, len(FEATURES))
