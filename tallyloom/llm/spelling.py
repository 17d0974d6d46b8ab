"""Spelling variants: words one edit apart, by dynamic programming over a sorted vocabulary.

The vocabulary is sorted over the cluster into blocks of bounded size. A word is held against a
block by walking its sorted list with a banded edit matrix: the rows of the prefix that a word
shares with the one before it are kept, further rows are computed letter by letter, and once all
of a row is beyond one edit, every word with that prefix is skipped. An edit leaves the first
or the last half of a word as it is. So there are two lists, one of the words and one of the reversed
words, and in each a word only walks the range that begins with its own first half; it visits the
blocks that hold a part of this range, which is mostly its own.

All words of a batch walk at the same time, a step of each being one numpy operation.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log, log2
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.cells import meet_in_cells
from tallyloom.llm.tables import tidy
from tallyloom.sinks.scratch import materialize

#: Letters of a word, and the distinct words that a task counts before it hands them on.
LETTERS = "A-Za-zÀ-ÿ"
COUNTED = 100_000


@dataclass(frozen=True)
class Settings:
    """Words of a block of the sorted list, and of a batch that walks it."""

    block_words: int = 40_000
    batch_words: int = 8_192


def _misspelt(word: str, key: object, rate: int) -> str:
    """The word, or in one of ``rate`` cases, told by a checksum, the word without one letter."""
    drawn = crc32(f"{key}:{word}".encode())
    if drawn % rate:
        return word
    at = drawn % len(word)
    return word[:at] + word[at + 1 :]


def count_words(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = 7,
    misspell: int | None = None,
) -> DataFrame:
    """(word, n): words of at least ``least`` letters and how often a task has seen them; words repeat.

    A word is a longest run of A to Z in either case and of U+00C0 to U+00FF; A to Z are
    lower-cased. With ``misspell``, one in so many of the words of a document, told by the
    checksum of its key and the word, loses a letter before it is counted, so that the detection can be
    measured. Null and empty texts have no words; a null key counts as an empty one. Rows that
    repeat count again. Other columns are not read.
    """
    runs = re.compile(f"[{LETTERS}]{{{least},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            columns = [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())]
            seen.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for row in range(batch.num_rows):
                whole = batch.column(1)[row].as_py() or ""
                own = Counter(runs.findall(whole.encode().lower().decode()))  # bytes lower A to Z alone
                if misspell:
                    of = batch.column(0)[row].as_py()
                    for word, n in own.items():
                        spelt = _misspelt(word, "" if of is None else of, misspell)
                        if len(spelt) >= least:
                            seen[spelt] += n
                else:
                    seen.update(own)
                if len(seen) >= COUNTED:
                    yield counted()
        yield counted()

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        tidy(run), "word string, n long"
    )


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in a row, and the length of each."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return codes, np.array([len(word) for word in words], np.int64)


class SortedList:
    """Distinct words in code-point order; ``shared`` is the prefix that each shares with the one before."""

    def __init__(self, words: list[str], counts: list[int]):
        order = sorted(range(len(words)), key=words.__getitem__)
        self.words = [words[i] for i in order]
        self.counts = [counts[i] for i in order]
        self.codes, self.lengths = _codes(self.words)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.shared = np.zeros(len(words) + 1, np.int64)
        open_, depth = np.arange(1, len(words)), 0
        while len(open_):
            longer = (self.lengths[open_] > depth) & (self.lengths[open_ - 1] > depth)
            open_ = open_[longer]
            same = self.codes[self.starts[open_] + depth] == self.codes[self.starts[open_ - 1] + depth]
            open_ = open_[same]
            depth += 1
            self.shared[open_] = depth
        self.shared[-1] = -1  # after the last word nothing is shared
        # From each place to the next one that shares less with the word before it.
        self.jump = np.full(len(words) + 1, len(words), np.int64)
        waiting: list[int] = []
        for place, prefix in enumerate(self.shared.tolist()):
            while waiting and prefix < self.shared[waiting[-1]]:
                self.jump[waiting.pop()] = place
            waiting.append(place)

    def range_of(self, prefix: str) -> tuple[int, int]:
        """Places of the words that begin with a prefix."""
        first = bisect_left(self.words, prefix)
        beyond = prefix.rstrip(chr(0x10FFFF))
        if not beyond:
            return first, len(self.words)
        return first, bisect_left(self.words, beyond[:-1] + chr(ord(beyond[-1]) + 1))

    def one_edit_apart(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (index in ``words``, place in the list) of words that are exactly one insertion, deletion or
        replacement apart and share the first half (rounded down) of the former."""
        codes, lengths = _codes(words)
        pad = np.full(len(codes) + 3 * len(words) + 1, 0xFFFFFFFF, np.uint32)
        first = np.cumsum(lengths + 3) - lengths - 2  # of each word in the padded letters
        pad[np.arange(len(codes)) + np.repeat(first - np.cumsum(lengths) + lengths, lengths)] = codes
        half = lengths // 2
        ranges = np.array([self.range_of(word[: len(word) // 2]) for word in words], np.int64).reshape(-1, 2)
        base = np.cumsum(lengths + 3) - lengths - 3
        # Row d of a word's band: distances of the list word's first d letters to d-1, d, d+1 letters.
        rows = np.full((len(pad), 3), 2, np.uint8)
        rows[base + half, 0] = np.where(half > 0, 1, 2)
        rows[base + half, 1] = 0
        rows[base + half, 2] = np.where(lengths > half, 1, 2)
        word = np.flatnonzero(ranges[:, 0] < ranges[:, 1])
        place, depth = ranges[word, 0], half[word]
        hits: list[tuple[np.ndarray, np.ndarray]] = []
        while len(word):
            ended = depth == self.lengths[place]
            if ended.any():
                done, at = word[ended], place[ended]
                side = lengths[done] - self.lengths[at] + 1
                within = (side >= 0) & (side <= 2)
                done, at, side = done[within], at[within], side[within]
                one = rows[base[done] + self.lengths[at], side] == 1
                hits.append((done[one], at[one]))
            on = np.flatnonzero(~ended)
            over = ended
            if len(on):
                own, d = word[on], depth[on]
                letter = self.codes[self.starts[place[on]] + d]
                above = rows[base[own] + d]
                new = np.empty_like(above)
                for side in range(3):  # j = d + side letters of the word
                    replaced = above[:, side] + (pad[first[own] + d + side - 1] != letter)
                    replaced[d + side == 0] = 2
                    best = replaced
                    if side < 2:
                        best = np.minimum(best, above[:, side + 1] + 1)
                    if side > 0:
                        best = np.minimum(best, new[:, side - 1] + 1)
                    best[d + side > lengths[own]] = 2
                    new[:, side] = np.minimum(best, 2)
                depth[on] = d + 1
                rows[base[own] + d + 1] = new
                over[on] = new.min(axis=1) > 1
            move = np.flatnonzero(over)
            if len(move):
                # The next word; beyond one edit, the next that does not begin with the same letters.
                to, d = place[move] + 1, depth[move]
                dead = rows[base[word[move]] + d].min(axis=1) > 1
                skip = np.flatnonzero(dead & (self.shared[to] >= d))
                while len(skip):
                    to[skip] = self.jump[to[skip]]
                    skip = skip[self.shared[to[skip]] >= d[skip]]
                place[move] = to
                depth[move] = self.shared[to]
                stay = np.ones(len(word), bool)
                stay[move] = to < ranges[word[move], 1]
                word, place, depth = word[stay], place[stay], depth[stay]
        if not hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])


def _half(word: Column, more: int = 0) -> Column:
    """Letters of the first half of a word that is ``more`` letters longer."""
    return F.greatest(F.floor((F.length(word) + more) / 2), F.lit(0)).cast("int")


def _partners(words: DataFrame, settings: Settings) -> DataFrame:
    """(word, n_near, most, form): partial counts and best partners of the words that have any."""
    total = words.count()
    blocks = max(1, ceil(total / settings.block_words))
    ways = F.explode(
        F.array(
            F.struct(F.lit(0).alias("way"), F.col("word").alias("spelt")),
            F.struct(F.lit(1).alias("way"), F.reverse("word").alias("spelt")),
        )
    )
    listed = materialize(
        words.select(ways.alias("entry"), "n")
        .select("entry.*", "n")
        .repartitionByRange(2 * blocks, "way", "spelt")
        .withColumn("block", F.spark_partition_id()),
        "spelling_list",
    )
    spelt = F.col("spelt")

    def prefix(letters: Column) -> Column:
        return F.substring(spelt, F.lit(1), letters)

    halves = F.array_distinct(F.array(*[prefix(_half(spelt, more)) for more in (-1, 0, 1)]))
    places = listed.select("way", "block", F.explode(halves).alias("prefix")).distinct()
    # A range over several blocks has many words, which visit all of them: they are dealt to as many copies.
    spans = places.groupBy("way", "prefix").agg(F.count("block").alias("span"))
    copies = places.join(spans, ["way", "prefix"]).groupBy("way", "block").agg(F.max("span").cast("int").alias("copies"))
    held = listed.join(copies, ["way", "block"]).select(
        "way", "block", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), "spelt", "n"
    )
    visits = (
        listed.select("way", "spelt", "n", prefix(_half(spelt)).alias("prefix"))
        .join(places, ["way", "prefix"])
        .join(copies, ["way", "block"])
        .select("way", "block", F.pmod(F.xxhash64("spelt"), F.col("copies")).cast("int").alias("copy"), "spelt", "n")
    )

    def build(rows: pa.Table) -> SortedList:
        return SortedList(rows.column("spelt").to_pylist(), rows.column("n").to_pylist())

    def use(sorted_list: SortedList, rows: pa.RecordBatch) -> pa.RecordBatch:
        reversed_ = rows.column("way")[0].as_py() == 1
        asked = rows.column("spelt").to_pylist()
        best: dict[str, list] = {}
        for begin in range(0, len(asked), settings.batch_words):
            batch = asked[begin : begin + settings.batch_words]
            for own, at in zip(*map(np.ndarray.tolist, sorted_list.one_edit_apart(batch))):
                word, other, n = batch[own], sorted_list.words[at], sorted_list.counts[at]
                if reversed_:
                    half = len(word) // 2
                    if not half or word[-half:] == other[-half:]:
                        continue  # they share the first half too, and have met in the other list
                    word, other = word[::-1], other[::-1]
                known = best.setdefault(word, [0, n, other])
                known[0] += 1
                if (-n, other) < (-known[1], known[2]):
                    known[1:] = n, other
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(best), pa.string()),
                pa.array([b[0] for b in best.values()], pa.int64()),
                pa.array([b[1] for b in best.values()], pa.int64()),
                pa.array([b[2] for b in best.values()], pa.string()),
            ],
            ["word", "n_near", "most", "form"],
        )

    return meet_in_cells(
        held, visits, ["way", "block", "copy"], 2 * blocks, build, use, "word string, n_near long, most long, form string"
    )


def _roots(forms: DataFrame, hops: int) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last, twice as far in each round.

    A word has a bounded number of words one edit from it, so no form is that of many words.
    """
    reached = forms.select("word", F.col("form").alias("root"))
    for _ in range(ceil(log2(max(1, hops)))):
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        reached = materialize(
            reached.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
            "spelling_roots",
        )
    return reached


def group_variants(
    counts: DataFrame, least_count: int = 2, ratio: int = 10, settings: Settings = Settings()
) -> DataFrame:
    """word, form, root, n, n_near, form_n for the distinct words of ``counts`` (word, n).

    Rows of one word are added up; words that occur less than ``least_count`` times take no part. Two
    words are near if they are exactly one inserted, deleted or replaced code point apart. The form of a
    word is its near word of the largest n, of these the smallest in code-point order, if that n is at
    least ``ratio`` times the word's own; else null, as is form_n. root follows the forms to the last one
    and is the word itself if it has none. n_near counts the near words, 0 if there are none. Null words and
    counts take no part; an empty word is near all words of one letter. Other columns are not read. No rows give no rows.
    """
    words = materialize(
        counts.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count),
        "spelling_words",
    )
    found = (
        _partners(words, settings)
        .groupBy("word")
        .agg(
            F.sum("n_near").alias("n_near"),
            F.min(F.struct((-F.col("most")).alias("less"), F.col("form").alias("form"))).alias("best"),
        )
        .select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    )
    near = words.join(found, "word", "left")
    enough = F.col("form_n") >= ratio * F.col("n")
    near = materialize(
        near.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("form")).alias("form"),
            F.when(enough, F.col("form_n")).alias("form_n"),
        ),
        "spelling_forms",
    )
    most = words.agg(F.max("n")).first()[0] or 1
    hops = int(log(max(1, most / least_count), ratio)) + 1
    roots = _roots(near.where(F.col("form").isNotNull()), hops)
    return near.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
