"""Repeated passages: every run of a few consecutive sentences is hashed and joined globally.

A sentence ends with a word that ends in a full stop, question or exclamation mark, or at a
line end. A stretch of many words without an end, as in tables, is cut after some words that
their own hash picks, so that it is cut alike wherever it stands. A run is the fewest sentences from its first one on that make up a number of
sentences and of words. Passages that hold no such run, pasted into the middle of a sentence or
short of two whole ones, are found by runs of a fixed number of words that begin anywhere: of a
few neighbouring ones that of the least hash is picked, so equal passages of ``words + NEAR - 1``
words pick a run in common at any alignment. Of all places of a run the first stays, by document and place; sentences
that any other place covers go. Repeats within a document are found where it is read, so only
one row per document and run is shuffled, of hashes alone; the first document of a run is found
with a combine before the shuffle, and a run that many documents hold meets one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.tables import slabs, text_buffer, tidy, unused
from tallyloom.llm.word_hash import mix, words_of

#: A run has so many sentences and so many words at least: with ``NEAR``, any 50 words in a row are found.
SENTENCES, WORDS = 2, 31

#: Stretches of more words without an end are cut, after one of so many words on average.
LONG, CUT = 32, 16

#: Of so many word runs in a row one is picked at least.
NEAR = 20
#: Odd, so that powers have inverses modulo 2^64.
_BASE = 0x9E3779B97F4A7C15

_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


@dataclass
class Picked:
    """First word and hashes of each picked word run."""

    first: np.ndarray
    low: np.ndarray
    high: np.ndarray
    once: np.ndarray
    """Whether it is the first of its hash in its text."""
    again: np.ndarray
    """Whether an equal run has ended in its text before it begins."""


def _picked_runs(hashes: np.ndarray, text: np.ndarray, size: int, near: int = NEAR) -> Picked:
    """Runs of ``size`` words with the least hash of ``near`` runs in a row of a text."""
    count = len(hashes) - size + 1
    windows = count - near + 1
    if windows < 1:
        none = np.zeros(0, np.int64)
        return Picked(none, none.view(np.uint64), none.view(np.uint64), none.astype(bool), none.astype(bool))
    powers, inverse = np.ones((2, len(hashes)), np.uint64)
    powers[1:], inverse[1:] = _BASE, pow(_BASE, -1, 1 << 64)
    powers, inverse = np.cumprod(powers), np.cumprod(inverse)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers)])
    low = mix((sums[size:] - sums[:count]) * inverse[:count] ^ np.uint64(0x3C6EF372))
    least = low[:windows].copy()
    for step in range(1, near):
        np.minimum(least, low[step : step + windows], out=least)
    least[text[:windows] != text[near + size - 2 :]] = 0  # not within one text
    # A run is picked if it is the least of any of the windows that hold it.
    most = np.zeros(count, np.uint64)
    for step in range(near):
        np.maximum(most[step : step + windows], least, out=most[step : step + windows])
    first = np.flatnonzero((most == low) & (most > 0))
    low, high = low[first], np.zeros(len(first), np.uint64)
    other = mix(hashes ^ np.uint64(0x5A5A5A5A))
    for step in range(size):
        high += other[first + step] * (mix(np.array([step + 1], np.uint64)) | np.uint64(1))
    _, at, of = np.unique(mix(text[first].astype(np.uint64)) + low, return_index=True, return_inverse=True)
    once = np.zeros(len(first), bool)
    once[at] = True
    return Picked(first, low, mix(high), once, first - first[at[of]] >= size)


@dataclass
class Runs:
    """Of some texts: byte where each sentence begins, its text and words; first and last sentence and
    hashes of each run; byte where each word begins and its text; picked word runs."""

    begin: np.ndarray
    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    low: np.ndarray
    high: np.ndarray
    again: np.ndarray
    """Whether the run stands earlier in its text."""
    length: np.ndarray
    word: np.ndarray
    word_text: np.ndarray
    picked: Picked



def find_runs(data: np.ndarray, offsets: np.ndarray, sentences: int = SENTENCES, words: int = WORDS) -> Runs:
    begins, ends, hashes, counts = words_of(data, offsets)
    total = len(begins)
    none = np.zeros(0, np.int64)
    if not total:
        picked = _picked_runs(hashes, none, words)
        hash_none = none.view(np.uint64)
        return Runs(none, none, none, none, hash_none, hash_none, none.astype(bool), none, none, none, picked)
    own = data[offsets[0] : offsets[-1]]
    lines = np.concatenate([[0], np.cumsum(own == 10)])
    following = np.append(begins[1:], len(own))
    closes = _STOP[own[ends - 1]] | (lines[following] > lines[ends])
    text_of_word = np.repeat(np.arange(len(counts)), counts)
    closes[:-1] |= text_of_word[1:] != text_of_word[:-1]
    opens = np.concatenate([[0], np.flatnonzero(closes[:-1]) + 1])
    length = np.diff(np.append(opens, total))
    closes |= np.repeat(length > LONG, length) & (hashes % np.uint64(CUT) == 0)
    opens = np.concatenate([[0], np.flatnonzero(closes[:-1]) + 1])
    length = np.diff(np.append(opens, total))
    place = np.arange(total) - np.repeat(opens, length)
    factor = mix(place.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    low = mix(np.add.reduceat(hashes * factor, opens))
    high = mix(np.add.reduceat(mix(hashes ^ np.uint64(0xA5A5A5A5)) * factor, opens))
    text = text_of_word[opens]
    # The run from each sentence on: up to the first sentence with which it is long enough.
    sums = np.concatenate([[0], np.cumsum(length)])
    last = np.searchsorted(sums, sums[:-1] + words) - 1
    last = np.maximum(last, np.arange(len(opens)) + sentences - 1)
    first = np.flatnonzero(last < len(opens))
    first = first[text[last[first]] == text[first]]
    last = last[first]
    run_low, run_high = np.zeros((2, len(first)), np.uint64)
    span = last - first
    for step in range(int(span.max()) + 1 if len(span) else 0):
        on = np.flatnonzero(span >= step)
        factor = mix(np.array([step + 1], np.uint64)) | np.uint64(1)
        run_low[on] += low[first[on] + step] * factor
        run_high[on] += high[first[on] + step] * factor
    run_low, run_high = (mix(run + span.astype(np.uint64)) for run in (run_low, run_high))
    again = np.ones(len(first), bool)
    within = mix(text[first].astype(np.uint64)) + run_low
    again[np.unique(within, return_index=True)[1]] = False
    picked = _picked_runs(hashes, text_of_word, words)
    return Runs(begins[opens], text, first, last, run_low, run_high, again, length, begins, text_of_word, picked)


def _hashed_runs(docs: DataFrame, key: str, text: str, sentences: int, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for start, stop in slabs(offsets):
                found = find_runs(data, offsets[start : stop + 1], sentences, words)
                once = ~found.again
                picked = found.picked
                texts = np.concatenate([found.text[found.first[once]], found.word_text[picked.first[picked.once]]])
                low = np.concatenate([found.low[once], picked.low[picked.once]])
                high = np.concatenate([found.high[once], picked.high[picked.once]])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(start + texts)),
                        pa.array(low.view(np.int64)),
                        pa.array(high.view(np.int64)),
                    ],
                    ["id", "low", "high"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(
        tidy(run), f"id {kind}, low long, high long"
    )


def _rebuilt(
    data: np.ndarray, offsets: np.ndarray, repeated: list[list[int] | None], sentences: int, words: int
) -> tuple[list[bytes | None], np.ndarray, np.ndarray]:
    """New texts, None where nothing goes; sentences of each text and those that lost words."""
    found = find_runs(data, offsets, sentences, words)
    picked = found.picked
    rows = len(offsets) - 1
    gone, gone_words = found.again.copy(), picked.again.copy()
    for again, low, text in (
        (gone, found.low, found.text[found.first]),
        (gone_words, picked.low, found.word_text[picked.first]),
    ):
        edges = np.searchsorted(text, np.arange(rows + 1))
        for row, hashes in enumerate(repeated):
            if hashes:
                part = slice(edges[row], edges[row + 1])
                again[part] |= np.isin(low[part].view(np.int64), np.array(hashes, np.int64))
    change = np.zeros(len(found.begin) + 1, np.int64)
    np.add.at(change, found.first[gone], 1)
    np.add.at(change, found.last[gone] + 1, -1)
    covered = np.repeat(np.cumsum(change)[:-1] > 0, found.length)
    first = picked.first[gone_words]
    change = np.zeros(len(covered) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + words, -1)
    covered |= np.cumsum(change)[:-1] > 0
    total = np.bincount(found.text, minlength=rows)
    opens = np.cumsum(found.length) - found.length
    lost = np.logical_or.reduceat(covered, opens) if len(opens) else covered
    removed = np.bincount(found.text[lost], minlength=rows)
    texts: list[bytes | None] = [None] * rows
    base = offsets[0]
    of_row = np.searchsorted(found.word_text, np.arange(rows + 1))
    for row in np.flatnonzero(removed):
        own = covered[of_row[row] : of_row[row + 1]]
        begins = np.append(found.word[of_row[row] : of_row[row + 1]] + base, offsets[row + 1])
        edges = np.flatnonzero(np.diff(np.concatenate([[True], own, [True]])))
        parts = [data[offsets[row] : begins[0]].tobytes()]
        parts += [data[begins[i] : begins[j]].tobytes() for i, j in zip(edges[::2], edges[1::2])]
        texts[row] = b"".join(parts)
    return texts, total, removed


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sentences: int = SENTENCES,
    words: int = WORDS,
) -> DataFrame:
    """All columns of ``docs`` with the repeated passages cut from ``text``; n_sentences, n_removed.

    Sentences are compared without regard to the case of A-Z and to white space. The white
    space after a sentence goes with it. Within and beside sentences repeated words go:
    of every ``words + NEAR - 1`` in a row that stand earlier, all but at most ``NEAR - 1`` at
    each end. n_removed counts sentences that lost any word. Rows that repeat a key count as one document for
    the question which is first: what only they share stays, but repeats within a text go. Rows
    without a key are never first and lose only repeats within their text. A null text stays
    null; empty texts, texts shorter than a run, and all texts without a repeat stay as they
    are. No rows give no rows. Columns of ``docs`` called n_sentences or n_removed are
    replaced; other columns stay, whatever their names.
    """
    kept = [c for c in docs.columns if c not in ("n_sentences", "n_removed")]
    of, hashes_of = unused(docs.columns, "of"), unused(docs.columns, "repeated")
    docs = docs.select(*kept)
    runs = _hashed_runs(docs, key, text, sentences, words)
    firsts = runs.groupBy("low", "high").agg(F.min("id").alias("first"), F.max("id").alias("most"))
    repeated = (
        runs.join(firsts.where(F.col("first") < F.col("most")), ["low", "high"])
        .where(F.col("id") > F.col("first"))
        .groupBy("id")
        .agg(F.collect_set("low").alias(hashes_of))
        .withColumnRenamed("id", of)
    )
    at = kept.index(text)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(at)
            data, offsets = text_buffer(old)
            hashes = batch.column(len(kept))
            news, totals, removals = [], [], []
            for start, stop in slabs(offsets):
                part = hashes.slice(start, stop - start).to_pylist()
                texts, total, removed = _rebuilt(data, offsets[start : stop + 1], part, sentences, words)
                news += [
                    old[start + i].as_py() if new is None else new.decode() for i, new in enumerate(texts)
                ]
                totals += total.tolist()
                removals += removed.tolist()
            columns = [batch.column(i) for i in range(len(kept))]
            columns[at] = pa.array(news, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(totals, pa.int64()), pa.array(removals, pa.int64())],
                [*kept, "n_sentences", "n_removed"],
            )

    joined = docs.join(repeated, docs[key] == repeated[of], "left").drop(of)
    return joined.mapInArrow(tidy(run), f"{fields}, n_sentences long, n_removed long")
