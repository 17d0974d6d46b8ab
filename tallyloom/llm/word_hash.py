"""64-bit hashes of words and of runs of words, without a loop over the words."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
#: A random number per byte and place in the word; places repeat after 64 bytes.
_PLACES = 64
_TABLE = np.random.default_rng(20_240_601).integers(
    0, 1 << 64, (_PLACES, 256), dtype=np.uint64, endpoint=False
).reshape(-1)
_ODD = np.random.default_rng(7).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte after the last, hash of all words of some texts; and words per text.

    Words are runs of bytes other than the blank and 0x09 to 0x0D, hashed with A-Z
    lower-cased. Equal words have equal hashes; a word's hash does not depend on its place.
    Places count from the first byte of the first text.
    """
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~_SPACE[data]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    edges = offsets[:-1]
    before[edges[edges < len(data)]] = False  # a text's first byte begins a word
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    # Each byte's place in its word; bytes between the words add nothing to the sums.
    begins = np.concatenate([[0], starts])
    place = np.arange(len(data)) - np.repeat(begins, np.diff(np.append(begins, len(data))))
    value = _TABLE[((place & (_PLACES - 1)) << 8) | _FOLD[data]]
    long = place >= _PLACES
    if long.any():  # so that parts of long words do not trade places
        value[long] = mix(value[long] + place[long].astype(np.uint64))
    value[~inside] = 0
    hashes = mix(np.add.reduceat(value, starts))
    ends = starts + np.add.reduceat(inside.astype(np.int64), starts)
    return starts, ends, hashes, np.diff(np.searchsorted(starts, offsets)).astype(np.int64)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts and the number of words of each text."""
    return words_of(data, offsets)[2:]


def run_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``size`` words in a row within each text, and their number per text.

    A text with fewer words, but some, has its whole sequence as its one run.
    """
    ends = np.cumsum(counts)
    begin = ends - counts
    whole = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for step in range(size):
        whole += words[step : len(words) - size + 1 + step] * _ODD[step]
    full = np.maximum(counts - size + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < size))
    number = np.where((counts > 0) & (counts < size), 1, full)
    out_end = np.cumsum(number)
    out = np.zeros(int(out_end[-1]) if len(out_end) else 0, np.uint64)
    has = np.flatnonzero(full)
    if len(has):
        at = np.repeat(begin[has] - np.cumsum(full[has]) + full[has], full[has]) + np.arange(int(full[has].sum()))
        to = np.repeat((out_end - number)[has] - np.cumsum(full[has]) + full[has], full[has]) + np.arange(len(at))
        out[to] = mix(whole[at])
    for text in short:
        own = words[begin[text] : ends[text]]
        total = np.sum(own * _ODD[: len(own)], keepdims=True) + np.uint64(len(own)) * _ODD[-1:]
        out[out_end[text] - 1] = mix(total)[0]
    return out, number
