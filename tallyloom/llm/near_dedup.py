"""Near-duplicate documents by an inverted join over MinHash coordinates.

Documents with equal shingle sets are one node. A node is posted under each coordinate of
its signature and that coordinate's value. Two sets above the threshold agree in at least
``matches`` coordinates, all but certainly (``miss``), so

- values that only one node has cannot count: a node with fewer than ``matches`` others is
  done;
- of a node's shared values, rarest first, all but the last ``matches - 1`` are its prefix:
  two nodes that agree often enough meet in a list of their prefixes, and long lists are
  skipped wherever rarer values suffice.

Lists are not expanded into pairs. First every list is held against one of its nodes, twice;
what is found to be linked falls into components. Then only nodes outside their list's largest
component are left, and are joined with the others by their rarest shingles: of two sets
above the threshold, each holds one of the other's rarest few.

A candidate pair's collisions are counted over all posted coordinates: its prefixes' lists have made
it a candidate, and the lists that the prefixes skip are probed in the two nodes' own values, not
merged. Pairs of fewer than ``matches`` collisions go; the count then runs on over further coordinates
that are not posted. What stays is confirmed on full sets, so each link in the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.components import components
from tallyloom.llm.tables import slabs, text_buffer, tidy
from tallyloom.llm.word_hash import mix, run_hashes, word_hashes
from tallyloom.sinks.scratch import materialize

COORDINATES = 64
#: Coordinates over which a candidate's count runs on, drawn apart from those that are posted.
FURTHER = 192
#: Chance that two sets at the threshold agree in fewer coordinates than asked for.
MISS = 1e-7
#: Shingles of more left-over nodes than this are common, the others rare.
RARE = 32


def matches_needed(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The largest number that sets at the threshold fall short of with a chance of ``miss`` at most."""
    p, below = percent / 100, 0.0
    for count in range(coordinates + 1):
        below += comb(coordinates, count) * p**count * (1 - p) ** (coordinates - count)
        if below > miss:
            return max(1, count)
    return coordinates


def _coefficients(coordinates: int, seed: int = 20_231) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 1 << 31, coordinates, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return factors, rng.integers(0, 1 << 32, coordinates, dtype=np.uint32)


def _shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct shingle hashes of some rows at a time, and their number per row."""
    data, offsets = text_buffer(column)
    for first, last in slabs(offsets):
        words, counts = word_hashes(data, offsets[first : last + 1])
        runs, number = run_hashes(words, counts, size)
        ends = np.cumsum(number)
        sets = [np.unique(runs[end - n : end]) for n, end in zip(number, ends)]
        yield np.concatenate(sets), np.array([len(own) for own in sets])


def _minima(hashes: np.ndarray, starts: np.ndarray, coefficients: tuple) -> np.ndarray:
    """A row of coordinates for each set: the least value of its shingles under each function."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    pairs = zip(*coefficients)
    return np.stack([np.minimum.reduceat(short * factor + term, starts) for factor, term in pairs], axis=1)


def signatures(docs: DataFrame, key: str, text: str, size: int, coordinates: int = COORDINATES) -> DataFrame:
    """id, n_shingles, two hashes that stand for the whole set, and its MinHash coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coefficients = _coefficients(coordinates)
        for batch in batches:
            all_counts, lows, highs, rows = [], [], [], []
            for hashes, counts in _shingle_sets(batch.column(1), size):
                full = counts > 0
                starts = (np.cumsum(counts) - counts)[full]
                low, high = np.zeros((2, len(counts)), np.uint64)
                own = np.zeros((len(counts), coordinates), np.uint32)
                if len(starts):
                    low[full] = np.add.reduceat(hashes, starts)
                    high[full] = np.add.reduceat(mix(hashes ^ np.uint64(0x5BD1E995)), starts)
                    own[full] = _minima(hashes, starts, coefficients)
                all_counts.append(counts)
                lows.append(low.view(np.int64))
                highs.append(high.view(np.int64))
                rows.append(own.view(np.int32))
            count = np.concatenate(all_counts) if all_counts else np.zeros(0, np.int64)
            values = np.concatenate(rows).reshape(-1) if rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(count, pa.int64()),
                    pa.array(np.concatenate(lows) if lows else count, pa.int64()),
                    pa.array(np.concatenate(highs) if highs else count, pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(count) + 1) * coordinates, pa.int32()), pa.array(values)
                    ),
                ],
                ["id", "n_shingles", "low", "high", "coordinates"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(
        tidy(run), f"id {kind}, n_shingles long, low long, high long, coordinates array<int>"
    )


def _sets(docs: DataFrame, size: int, further: int) -> DataFrame:
    """node, two hashes that stand for a set of it, the set's shingle hashes and its further
    coordinates, from (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coefficients = _coefficients(further, seed=77)
        for batch in batches:
            at = 0
            for hashes, counts in _shingle_sets(batch.column(1), size):
                ends = np.concatenate([[0], np.cumsum(counts)])
                full = counts > 0
                own = np.zeros((len(counts), further), np.uint32)
                low, high = np.zeros((2, len(counts)), np.uint64)
                if full.any():
                    low[full] = np.add.reduceat(hashes, ends[:-1][full])
                    high[full] = np.add.reduceat(mix(hashes ^ np.uint64(0x5BD1E995)), ends[:-1][full])
                    if further:
                        own[full] = _minima(hashes, ends[:-1][full], coefficients)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(counts)),
                        pa.array(low.view(np.int64)),
                        pa.array(high.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes.view(np.int64))),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(counts) + 1) * further, pa.int32()),
                            pa.array(own.reshape(-1).view(np.int32)),
                        ),
                    ],
                    ["node", "low", "high", "shingles", "further"],
                )
                at += len(counts)

    kind = docs.schema["node"].dataType.simpleString()
    return docs.mapInArrow(tidy(run), f"node {kind}, low long, high long, shingles array<bigint>, further array<int>")


def _collide(needed: tuple[int, int]) -> Column:
    """Whether the sides a and b of a pair collide in enough posted coordinates, and then in enough of all.

    Values that a node shares with no other are not among its posts and collide with nothing.
    """
    posted, total = needed
    met = F.size(F.array_intersect("a_posts", "b_posts"))
    same = F.filter(F.zip_with("a_further", "b_further", lambda x, y: x == y), lambda equal: equal)
    return (met >= posted) & (met + F.size(same) >= total)


def _prefixes(classes: DataFrame, matches: int) -> DataFrame:
    """node and its shared coordinate values, rarest first, of nodes that have enough of them."""
    posted = classes.select("node", F.posexplode("coordinates").alias("at", "value")).select(
        F.xxhash64("at", "value").alias("post"), "node"
    )
    often = posted.groupBy("post").agg(F.count("*").alias("often")).where(F.col("often") > 1)
    shared = posted.join(often, "post").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("often", "post"))).alias("posts")
    )
    return shared.where(F.size("posts") >= matches).select(
        "node", F.transform("posts", lambda p: p["post"]).alias("posts")
    )


def _overlap(n: Column, m: Column, percent: int) -> Column:
    """Fewest shingles that sets of these sizes share if they are linked."""
    return F.ceil(F.lit(percent) * (n + m) / (100 + percent) - 1e-9)


def _confirmed(pairs: DataFrame, live: DataFrame, percent: int, needed: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) that collide often enough and whose full sets are above the threshold."""
    one, other = (
        live.select(
            F.col("node").alias(side),
            F.col("posts").alias(f"{side}_posts"),
            F.col("further").alias(f"{side}_further"),
            F.col("shingles").alias(f"{side}_set"),
        )
        for side in ("b", "a")
    )
    common = F.size(F.array_intersect("a_set", "b_set"))
    return (
        pairs.join(one, "b")
        .join(other, "a")
        .where(_collide(needed))
        .where(100 * common >= percent * (F.size("a_set") + F.size("b_set") - common))
        .select("a", "b")
    )


def _pivot_pairs(lists: DataFrame, labels: DataFrame, salt: Column) -> DataFrame:
    """Every node with one node of each of its lists, drawn by ``salt``, if their labels differ."""
    labelled = lists.join(labels, "node")
    drawn = labelled.groupBy("post").agg(F.min(F.struct(salt.alias("salt"), "node", "label")).alias("pivot"))
    return (
        labelled.join(drawn, "post")
        .where(F.col("label") != F.col("pivot.label"))
        .select(F.greatest("node", "pivot.node").alias("a"), F.least("node", "pivot.node").alias("b"))
        .distinct()
    )


def _left_over(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, odd): nodes of lists with several labels; odd ones are outside a list's commonest label."""
    labelled = lists.join(labels, "node")
    groups = labelled.groupBy("post", "label").agg(F.count("*").alias("held"))
    mixed = groups.groupBy("post").agg(
        F.max(F.struct("held", "label"))["label"].alias("common"), F.count("*").alias("labels")
    )
    of = labelled.join(mixed.where(F.col("labels") > 1), "post")
    return of.groupBy("node").agg(F.max(F.col("label") != F.col("common")).alias("odd"))


def _rare_pairs(
    lists: DataFrame, live: DataFrame, labels: DataFrame, percent: int, needed: tuple[int, int]
) -> DataFrame:
    """Pairs of a left-over node and a node of another label that may be linked by their shingles.

    A node with several sets is ranked once for each of them.
    """
    own = ["node", "low", "high"]
    of = materialize(_left_over(lists, labels), "left_over")
    sizes = live.select("node", F.size("shingles").alias("n"))
    least = lists.join(sizes, "node")
    least = least.join(least.groupBy("post").agg(F.min("n").alias("least")), "post")
    least = least.groupBy("node").agg(F.min("least").alias("least"))
    shingles = of.join(live, "node").select(*own, F.explode("shingles").alias("shingle"))
    often = shingles.groupBy("shingle").agg(F.count("*").alias("often"))
    ranked = shingles.join(often, "shingle").groupBy(*own).agg(
        F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("ranked")
    )
    n = F.size("ranked")
    smallest = F.greatest("least", F.ceil(n * percent / 100 - 1e-9))
    width = F.greatest(n - _overlap(n, smallest, percent) + 1, F.lit(0)).cast("int")
    # A pair that meets in a common shingle first has no rarer one in common, since the rarer ones
    # of both come before it: then only their common shingles can be shared.
    rare = (
        ranked.join(least, "node")
        .join(labels, "node")
        .join(of, "node")
        .select(
            *own,
            "label",
            "odd",
            n.alias("n"),
            F.size(F.filter("ranked", lambda r: r["often"] > 1)).alias("shared"),
            F.size(F.filter("ranked", lambda r: r["often"] > RARE)).alias("common"),
            F.filter(F.slice("ranked", F.lit(1), width), lambda r: r["often"] > 1).alias("rarest"),
        )
        .select(
            *own, "label", "odd", "n", "shared", "common",
            F.transform("rarest", lambda r: r["shingle"]).alias("rarest"), F.inline("rarest"),
        )
        .select(
            "shingle", *own, "label", "odd", "n", "rarest",
            F.when(F.col("often") > RARE, F.col("common")).otherwise(F.col("shared")).alias("most"),
        )
    )
    rare = materialize(rare, "rare_shingles")
    counted = live.select(*own, "posts", "further")
    sides = ("node", "label", "n", "most", "rarest", "posts", "further")
    asking = rare.where("odd").join(counted, own)
    left = asking.select("shingle", *(F.col(c).alias(f"a_{c}") for c in sides))
    asked = rare.join(rare.where("odd").select("shingle").distinct(), "shingle", "left_semi")
    right = asked.join(counted, own).select("shingle", *(F.col(c).alias(f"b_{c}") for c in sides))
    return (
        left.join(
            right,
            (left["shingle"] == right["shingle"])
            & (F.col("a_label") != F.col("b_label"))
            & (F.least("a_most", "b_most") >= _overlap(F.col("a_n"), F.col("b_n"), percent))
            # once for a pair: where it first meets
            & (F.get(F.array_intersect("a_rarest", "b_rarest"), F.lit(0)) == left["shingle"])
            & _collide(needed),
        )
        .select(F.greatest("a_node", "b_node").alias("a"), F.least("a_node", "b_node").alias("b"))
        .distinct()
    )


def _labels(nodes: DataFrame, known: DataFrame) -> DataFrame:
    """A label for each node, its own key where none is known."""
    return nodes.join(known, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = 3,
    percent: int = 85,
    coordinates: int = COORDINATES,
    further: int = FURTHER,
) -> DataFrame:
    """``key``, n_shingles, component_id and kept, one row per row of ``docs``.

    A document's set holds its distinct runs of ``size`` words, A-Z lower-cased; with fewer
    words the whole sequence is its one shingle. Documents are linked whose sets share
    ``percent`` of their union or more; ``component_id`` is the smallest key reachable and
    ``kept`` marks the document that has it. A pair at the threshold collides too seldom with a chance of
    ``MISS`` in the posted ``coordinates`` and another in those with the ``further`` ones, of which
    0 leave the posted ones alone to decide what is confirmed. Documents without words, or null, have an empty
    set, no links and stay. Rows that repeat a key are one document with all their texts;
    a row without a key gets no component and stays. Other columns are ignored, whatever their
    names. No rows give no rows; very long texts are hashed whole.
    """
    matches = matches_needed(percent, coordinates)
    needed = matches, matches_needed(percent, coordinates + further)
    found = materialize(signatures(docs, key, text, size, coordinates), "signatures")
    posted = found.where((F.col("n_shingles") > 0) & F.col("id").isNotNull())
    classes = materialize(
        posted.groupBy("low", "high", "n_shingles").agg(
            F.min(F.struct(F.col("id").alias("node"), "coordinates")).alias("first")
        ).select("low", "high", "n_shingles", "first.*"),
        "classes",
    )
    prefixes = materialize(_prefixes(classes, matches), "prefixes")
    texts = docs.select(F.col(key).alias("node"), F.col(text).alias("text")).join(
        prefixes.select("node"), "node", "left_semi"
    )
    # A set that rows of one key repeat is there once.
    short = prefixes.select("node", F.transform("posts", lambda p: p.bitwiseAND(0x7FFFFFFF).cast("int")).alias("posts"))
    live = short.join(_sets(texts, size, further), "node").dropDuplicates(["node", "low", "high"])
    live = materialize(live, "live")
    lists = materialize(
        prefixes.select(
            "node", F.explode(F.slice("posts", F.lit(1), F.size("posts") - matches + 1)).alias("post")
        ),
        "lists",
    )
    # A key with several sets ties their nodes from the start.
    held = posted.join(classes, ["low", "high", "n_shingles"]).groupBy("id").agg(
        F.min("node").alias("least"), F.max("node").alias("most")
    ).where(F.col("least") != F.col("most"))
    links = materialize(
        posted.join(held.select("id"), "id", "left_semi")
        .join(classes, ["low", "high", "n_shingles"])
        .select(F.col("id").alias("a"), F.col("node").alias("b"))
        .distinct(),
        "links",
    )
    nodes = prefixes.select("node").distinct()
    pairs = _pivot_pairs(lists, nodes.withColumn("label", F.col("node")), F.xxhash64("node"))
    found_first = materialize(_confirmed(pairs, live, percent, needed), "links")
    # The smallest confirmed partner will do as a label here: who has the same one is linked.
    ends = found_first.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        found_first.select(F.col("b").alias("node"), F.col("b").alias("label"))
    )
    labels = _labels(nodes, ends.groupBy("node").agg(F.min("label").alias("label")))
    # A node that is linked already is the better one to hold the others against.
    linked_first = F.struct((F.col("label") == F.col("node")).alias("single"), F.xxhash64("node", "post").alias("drawn"))
    pairs = _pivot_pairs(lists, labels, linked_first)
    links = materialize(links.union(found_first).union(_confirmed(pairs, live, percent, needed)), "links")
    tied = components(links)
    labels = _labels(nodes, tied.withColumnRenamed("component", "label"))
    pairs = _rare_pairs(lists, live, labels, percent, needed)
    # Components found so far stand for their links.
    last = _confirmed(pairs, live, percent, needed).union(tied.select("node", "component"))
    tied = components(materialize(last, "links"))
    of_class = classes.join(tied, "node", "left").select(
        "low", "high", "n_shingles", F.coalesce("component", "node").alias("component_id")
    )
    single = found.join(of_class, ["low", "high", "n_shingles"], "left").select(
        F.col("id").alias(key),
        "n_shingles",
        F.when((F.col("n_shingles") == 0) | F.col("id").isNull(), F.col("id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
    )
    return single.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
