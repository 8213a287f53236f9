"""Texts as numpy arrays: characters, words and shingles as 64-bit hashes, for a batch at a time.

Arithmetic on `uint64` wraps around, as hashing wants it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np

U64 = np.uint64
# An odd base of the polynomial hash, and the constants of the splitmix64 finalizer.
BASE = 0x9E3779B97F4A7C15
MIX_1, MIX_2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
#: Characters worked on at once; a longer text is worked on alone.
RUN_CHARS = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each value over all 64 bits; different values stay different."""
    x = (x ^ (x >> U64(30))) * MIX_1
    x = (x ^ (x >> U64(27))) * MIX_2
    return x ^ (x >> U64(31))


def salt(number: int) -> np.uint64:
    """A fixed hash for a small number."""
    return mix(np.array([(number + 1) * BASE % 2**64], U64))[0]


@lru_cache(maxsize=1)
def word_characters() -> np.ndarray:
    """For each code point, whether it is a letter or a digit."""
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1)
def letter_characters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


_powers = {}


def _power_table(base: int, count: int) -> np.ndarray:
    """1, base, base**2, .. modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        known = np.full(max(count, RUN_CHARS + 1024), base % 2**64, U64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if count <= RUN_CHARS + 1024:
            _powers[base] = known
    return known[:count]


def code_points(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased characters of all texts, a blank after each, and where each text begins."""
    texts = [t.lower() if t else "" for t in texts]
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    joined = (" ".join(texts) + " ").encode("utf-32-le", "replace")
    return np.frombuffer(joined, np.uint32), starts


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words (runs of letters and digits, lower case), and where each text's begin."""
    codes, text_starts = code_points(texts)
    starts, ends = _word_edges(codes)
    terms = np.zeros(len(codes) + 1, U64)
    np.cumsum((codes.astype(U64) + U64(1)) * MIX_1 * _power_table(BASE, len(codes)), out=terms[1:])
    inverse = pow(BASE, -1, 2**64)
    hashes = mix((terms[ends] - terms[starts]) * _power_table(inverse, len(codes) + 1)[starts])
    return hashes, np.searchsorted(starts, text_starts)


def _word_edges(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of lower-cased characters begin and end."""
    inside = word_characters()[codes]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    return edges[::2], edges[1::2]


def word_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where the words that `word_hashes` finds begin and end in the text itself."""
    codes, _ = code_points([text])
    starts, ends = _word_edges(codes)
    if len(codes) == len(text) + 1:
        return starts, ends
    # A few characters are several ones in lower case.
    origin = np.append(np.repeat(np.arange(len(text)), [len(c.lower()) for c in text]), len(text))
    return origin[starts], origin[ends - 1] + 1


def shingles(words: np.ndarray, starts: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all runs of `width` words in each text, in order, and where each text's begin.

    A text with fewer words, but any, is one shingle. `starts` has one entry more than there are texts.
    """
    counts = np.diff(starts)
    held = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    ends = np.cumsum(held)
    first = np.repeat(starts[:-1] - ends + held, held) + np.arange(ends[-1] if len(ends) else 0)
    stop = np.repeat(starts[1:], held)
    out = np.zeros(len(first), U64)
    for k in range(width):
        at = np.minimum(first + k, max(len(words) - 1, 0))
        out += np.where(first + k < stop, words[at] * salt(k) if len(words) else U64(0), U64(0))
        out = mix(out)
    return out, np.concatenate([[0], ends])


def plain_runs(words: np.ndarray, starts: np.ndarray, count: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The hashes that `shingles` gives to texts of `count` words, fewer than `width`, for all runs of
    `count` words in each text, and the text of each."""
    first = np.arange(max(len(words) - count + 1, 0))
    text = np.searchsorted(starts, first, "right") - 1
    inside = first + count <= starts[text + 1]
    first, text = first[inside], text[inside]
    out = np.zeros(len(first), U64)
    for k in range(width):
        out = mix(out + words[first + k] * salt(k)) if k < count else mix(out)
    return out, text


def runs_of_words(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of `width` words, whatever text they are from; empty if there are fewer words."""
    if len(words) < width:
        return np.zeros(0, U64)
    terms = np.zeros(len(words) + 1, U64)
    np.cumsum(words * _power_table(BASE, len(words)), out=terms[1:])
    inverse = pow(BASE, -1, 2**64)
    return mix((terms[width:] - terms[:-width]) * _power_table(inverse, len(words))[: len(words) - width + 1])


def sort_segments(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`values` sorted within each segment, and the segment of each."""
    segment = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((values, segment))
    return values[order], segment


def numbered_repeats(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A multiset as a set: within each segment, sorted, the n-th copy of a value becomes a value of its own."""
    values, segment = sort_segments(values, starts)
    if not len(values):
        return values
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (segment[1:] != segment[:-1])
    at = np.arange(len(values))
    copy = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return np.where(copy > 0, mix(values + copy.astype(U64) * U64(BASE)), values)
