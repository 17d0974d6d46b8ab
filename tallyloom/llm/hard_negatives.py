"""Hard negatives: rows of another label that score close to, but not at, an anchor's positives.

Anchors are clustered by direction. Rows are dealt into shards of bounded size. In a shard the rows are
sorted once per cluster, by an upper bound of their score that holds for all of its anchors: the
length of the row times the cosine of the angle to the cluster's centre, less the cluster's widest
angle. Every anchor of the cluster walks this shared list from the top and stops as soon as the bound
certifies that nothing after it can be among its best. A shard's rows are shuffled once, its anchors
stream past them, in order of their clusters; what a shard finds for an anchor is merged over the shards.

Two walks are needed, since the scores of the positives say which negatives fit: the first finds
the positives, the second, with one window of scores per positive, the negatives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil, inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.cells import meet_in_cells
from tallyloom.llm.tables import tidy
from tallyloom.sinks.scratch import materialize

#: Numbers below it are exact as doubles.
_EXACT = 2.0**53
_LONG = 2**63


@dataclass(frozen=True)
class Settings:
    """Clusters of the anchors, the bounded sample of anchors they are fitted on, and rows of a shard.

    ``step_rows`` are taken from a list at first; each step takes twice as many, up to ``most_step_rows``.
    """

    clusters: int = 16
    sample_rows: int = 4_096
    rounds: int = 10
    shard_rows: int = 131_072
    step_rows: int = 256
    most_step_rows: int = 8_192
    seed: int = 13


def _unit(vectors: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, lengths, out=np.zeros_like(vectors), where=lengths > 0)


def fit_directions(vectors: np.ndarray, settings: Settings = Settings()) -> np.ndarray:
    """Unit centres of at most ``clusters`` groups of directions, by k-means."""
    units = _unit(vectors.astype(float))
    rng = np.random.default_rng(settings.seed)
    centres = units[rng.permutation(len(units))[: settings.clusters]]
    for _ in range(settings.rounds):
        of = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, units)
        empty = ~sums.any(axis=1)
        sums[empty] = centres[empty]
        centres = _unit(sums)
    return centres


@dataclass
class Search:
    """What one anchor looks for: in each window of scores, the ``k`` first rows of its own or of other labels.

    ``windows`` are bounds, both included, of 100 times the score. Rows with the anchor's own id are not taken.
    """

    own: int
    label: int
    vector: np.ndarray
    windows: list[tuple[float, float]]
    same: bool
    k: int
    length: float = 0.0
    ids: list[np.ndarray] = field(default_factory=list)
    scores: list[np.ndarray] = field(default_factory=list)
    seen: int = 0

    def __post_init__(self) -> None:
        self.length = float(np.linalg.norm(self.vector.astype(float)))
        self.ids = [np.zeros(0, np.int64) for _ in self.windows]
        self.scores = [np.zeros(0) for _ in self.windows]

    def certified(self, bound: float) -> bool:
        """Whether no row can be among the first if none scores above ``bound``; at it, one of a smaller id could."""
        return all(
            100 * bound < low or (len(found) == self.k and bound < found[-1])
            for (low, _), found in zip(self.windows, self.scores)
        )

    def offer(self, ids: np.ndarray, labels: np.ndarray, scores: np.ndarray) -> None:
        self.seen += len(ids)
        fits = ((labels == self.label) == self.same) & (ids != self.own)
        ids, scores = ids[fits], scores[fits]
        for place, (low, high) in enumerate(self.windows):
            within = (100 * scores >= low) & (100 * scores <= high)
            all_ids = np.concatenate([self.ids[place], ids[within]])
            all_scores = np.concatenate([self.scores[place], scores[within]])
            if len(all_ids) > self.k:  # all that score as the k-th does, before ties are settled
                least = np.partition(all_scores, len(all_scores) - self.k)[len(all_scores) - self.k]
                first = all_scores >= least
                all_ids, all_scores = all_ids[first], all_scores[first]
            order = np.lexsort((all_ids, -all_scores))[: self.k]
            self.ids[place], self.scores[place] = all_ids[order], all_scores[order]


class Shard:
    """Rows with whole-numbered vectors of one size, and the list shared by the cluster met last."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, settings: Settings = Settings()):
        self.ids, self.labels, self.vectors, self.settings = ids, labels, vectors, settings
        self.doubles = vectors.astype(float)
        self.lengths = np.linalg.norm(self.doubles, axis=1)
        self.most = float(np.abs(self.doubles).max(initial=0))
        self.cluster: object = None

    def share(self, cluster: object, centre: np.ndarray | None, reach: float) -> None:
        """Sorts the rows by their bound for anchors within the angle ``reach`` of a centre; without a
        centre by length alone."""
        if cluster == self.cluster:
            return
        bound = self.lengths
        if centre is not None:
            cosine = np.divide(self.doubles @ centre, self.lengths, out=np.ones(len(self.ids)), where=self.lengths > 0)
            angle = np.arccos(np.clip(cosine, -1, 1))
            # Rounding errors of the angles are far below the slack.
            bound = self.lengths * (np.cos(np.maximum(0, angle - reach - 1e-6)) + 1e-9)
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order]
        self.cluster = cluster

    def products(self, rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Inner products, rows by vectors: exact, as doubles where these are, else as whole numbers."""
        most = float(np.abs(vectors.astype(float)).max(initial=0))
        if 100 * vectors.shape[1] * most * self.most < _EXACT:
            return self.doubles[rows] @ vectors.astype(float).T
        return self.vectors[rows].astype(object) @ vectors.astype(object).T

    def walk(self, members: list[Search]) -> None:
        """All members of the cluster go down its list until each is certified to be done."""
        at, width = 0, self.settings.step_rows
        while at < len(self.order):
            members = [m for m in members if not m.certified(m.length * self.bound[at] * (1 + 1e-9))]
            if not members:
                return
            rows = self.order[at : at + width]
            scores = self.products(rows, np.stack([m.vector for m in members]))
            for place, member in enumerate(members):
                member.offer(self.ids[rows], self.labels[rows], scores[:, place])
            at += width
            width = min(2 * width, self.settings.most_step_rows)


def usable(vector: Column) -> Column:
    """Not null, and all components finite numbers."""
    return F.coalesce(
        F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))),
        F.lit(False),
    )


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _clustered(anchors: DataFrame, settings: Settings) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """Anchors with cluster and reach, the widest angle of the cluster; and the centres by vector size."""
    sample = anchors.orderBy(F.xxhash64("id"), "id").limit(settings.sample_rows).select("size", "vector").toArrow()
    sizes = sample.column("size").to_numpy()
    vectors = sample.column("vector").combine_chunks()
    centres = {
        int(size): fit_directions(_matrix(vectors.take(pa.array(np.flatnonzero(sizes == size)))), settings)
        for size in np.unique(sizes)
        if size
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clusters, angles = [], []
            for vector in batch.column("vector").to_pylist():
                middle = centres.get(len(vector))
                if middle is None:  # a size that the sample has not seen: no centre, any angle
                    clusters.append(-1)
                    angles.append(np.pi)
                    continue
                cosines = middle @ _unit(np.array([vector], float))[0]
                clusters.append(int(cosines.argmax()))
                angles.append(float(np.arccos(np.clip(cosines.max(), -1, 1))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(clusters, pa.int32()), pa.array(angles, pa.float64())],
                [*batch.schema.names, "cluster", "angle"],
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema.fields)
    placed = materialize(anchors.mapInArrow(tidy(run), f"{fields}, cluster int, angle double"), "anchors")
    reach = placed.groupBy("size", "cluster").agg(F.max("angle").alias("reach"))
    return placed.drop("angle").join(reach, ["size", "cluster"]), centres


def mine_hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    settings: Settings = Settings(),
) -> DataFrame:
    """anchor_id, positive_id, rank from 1, negative_id, positive_score, negative_score.

    A component x counts as floor(scale * x). A score is the inner product with the anchor, higher ones come first,
    ties by smaller key. The positives of an anchor are its first rows of the same label, its negatives
    for a positive the first rows of other labels whose score lies between the two percentages of
    the positive's, both included; a positive that scores below 0 has none. Rows with the anchor's own key are
    neither. Rows without key or label, and with a vector that is null or has a null or
    non-finite component, take no part; vectors meet only those of as many components. Zero and empty vectors
    score 0. Rows that repeat are candidates each, but a positive is asked for once; an anchor that repeats is asked once, with its
    smallest label and vector. Scores beyond 64 bits are cut there. Other columns are ignored, whatever their
    names. No rows, and anchors without positives, give no rows.
    """
    kind = rows.schema[key].dataType.simpleString()
    whole = rows.select(
        F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("given"), is_anchor.alias("asks")
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("given")))
    whole = whole.select(
        "id", "label", "asks", F.transform("given", lambda x: F.floor(x.cast("double") * scale)).alias("vector")
    ).withColumn("size", F.size("vector"))
    anchors = (
        whole.where("asks")
        .groupBy("id")
        .agg(F.min(F.struct("label", "vector", "size")).alias("row"))
        .select("id", "row.*")
    )
    placed, centres = _clustered(anchors, settings)
    shards = max(1, ceil(whole.count() / settings.shard_rows))
    held = whole.select(
        "size",
        F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"),
        "id",
        "label",
        "vector",
        *[F.lit(None).cast(type_).alias(name) for name, type_ in (
            ("cluster", "int"), ("reach", "double"), ("positive_ids", f"array<{kind}>"), ("positive_scores", "array<long>"),
        )],
    )

    def build(part: pa.Table) -> Shard:
        ids, labels = (part.column(name).to_numpy() for name in ("id", "label"))
        return Shard(ids, labels, _matrix(part.column("vector")), settings)

    def use(shard: Shard, part: pa.RecordBatch) -> pa.RecordBatch:
        vectors = _matrix(part.column("vector"))
        clusters = part.column("cluster").to_numpy()
        size = vectors.shape[1]
        out: list[tuple] = []
        for cluster in np.unique(clusters).tolist():
            at = np.flatnonzero(clusters == cluster).tolist()
            centre = centres[size][cluster] if cluster >= 0 else None
            shard.share(cluster, centre, part.column("reach")[at[0]].as_py())
            searches, firsts = [], []
            for row in at:
                ids, scores = (part.column(name)[row].as_py() for name in ("positive_ids", "positive_scores"))
                first = scores is None
                windows = [(-inf, inf)] if first else [(window[0] * s, window[1] * s) for s in scores]
                own, of = part.column("id")[row].as_py(), part.column("label")[row].as_py()
                searches.append(Search(own, of, vectors[row], windows, first, positives if first else negatives))
                firsts.append([(None, None)] if first else list(zip(ids, scores)))
            shard.walk(searches)
            for search, asked in zip(searches, firsts):
                for place, (positive, score) in enumerate(asked):
                    for other, value in zip(search.ids[place].tolist(), search.scores[place].tolist()):
                        value = max(-_LONG, min(_LONG - 1, int(value)))
                        out.append((search.own, positive, score, other, value))
        columns = list(zip(*out)) or [[]] * 5
        key_type = part.column("id").type
        types = [key_type, key_type, pa.int64(), key_type, pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    names = ["anchor_id", "positive_id", "positive_score", "id", "score"]
    schema = f"anchor_id {kind}, positive_id {kind}, positive_score long, id {kind}, score long"

    def found(asked: DataFrame) -> DataFrame:
        sent = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select(held.columns)
        return meet_in_cells(held, sent, ["size", "shard"], shards, build, use, schema, ("cluster",))

    def ranked(pairs: DataFrame, of: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*of).orderBy(F.desc("score"), "id")
        return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    unasked = placed.withColumns(
        {"positive_ids": F.lit(None).cast(f"array<{kind}>"), "positive_scores": F.lit(None).cast("array<long>")}
    )
    best = ranked(found(unasked), ["anchor_id"], positives)
    # A positive whose row repeats is asked for once.
    of_anchor = best.groupBy(F.col("anchor_id").alias("id")).agg(
        F.array_distinct(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rank", "id", "score"))), lambda x: F.struct(x["id"], x["score"])
            )
        ).alias("best")
    )
    asked = materialize(
        placed.join(of_anchor, "id").select(
            *placed.columns, F.col("best.id").alias("positive_ids"), F.col("best.score").alias("positive_scores")
        ),
        "positives",
    )
    return ranked(found(asked), ["anchor_id", "positive_id", "positive_score"], negatives).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
