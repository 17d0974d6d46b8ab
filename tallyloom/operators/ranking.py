"""Exact NTILE over a whole table without sorting the table.

A window without PARTITION BY moves every row into one task. NTILE(k) however
is decided by k - 1 boundary rows. They are located exactly, by narrowing a
bracket around each of them, and then every row finds its tile by comparing
itself with the boundaries: a projection, with no shuffle of the table.

Locating the boundaries reads only the key and tie columns. Each round samples
the rows still inside the brackets, of all brackets in one pass, to propose
tighter ones and counts the rows below and equal to them, in another. Counts
decide, the sample only proposes, so the outcome is exact. A proposed value is either
the boundary's or leaves the bracket with all rows equal to it, so every round
ends with a smaller bracket. Once a bracket holds at
most ``leaf_rows`` rows these are numbered. What reaches the driver is bounded by
``sample_rows``, k and the number of rankings.

Where a boundary falls inside rows that key and tie do not tell apart, these are
shared out between the tiles by their position in the table, which is stored
with it for this purpose; the position's boundary is located in the same way.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.session import together
from tallyloom.sinks.scratch import materialize


@dataclass(frozen=True)
class Ranking:
    """Order by ``key``, then by ``tie`` ascending.

    NULL keys come first when ascending and last when descending. Rows with equal
    keys and ties, or without a ``tie`` with equal keys, are taken in any order.
    """

    key: str
    tie: str | None = None
    descending: bool = False

    @property
    def columns(self) -> tuple[str, str]:
        return self.key, self.tie or self.key

    def order(self) -> list[Column]:
        key = F.col(self.key)
        first = key.desc_nulls_last() if self.descending else key.asc_nulls_first()
        return [first] if self.tie is None else [first, F.col(self.tie).asc_nulls_first()]

    def sorted(self, rows: list[tuple]) -> list[tuple]:
        """Rows on the driver in the same order: NULL lowest, NaN highest."""

        def place(value) -> tuple:
            if value is None:
                return (0, 0)
            return (2, 0) if value != value else (1, value)

        by_tie = sorted(rows, key=lambda row: place(row[1]))
        return sorted(by_tie, key=lambda row: place(row[0]), reverse=self.descending)

    def equals(self, row: tuple) -> Column:
        return reduce(
            lambda a, b: a & b,
            [F.col(name).eqNullSafe(F.lit(value)) for name, value in zip(self.columns, row)],
        )

    def precedes(self, row: tuple) -> Column:
        """True for the rows strictly before the given (key, tie)."""
        key, tie = row
        before = _before(self.key, key, self.descending)
        if self.tie is None:
            return before
        return before | (F.col(self.key).eqNullSafe(F.lit(key)) & _before(self.tie, tie, False))


def _before(column: str, value, descending: bool) -> Column:
    col = F.col(column)
    if descending:
        return col.isNotNull() if value is None else F.coalesce(col > value, F.lit(False))
    return F.lit(False) if value is None else col.isNull() | (col < value)


@dataclass(frozen=True)
class _Target:
    """A boundary row being searched: position ``rank`` of one ranking.

    It lies after all rows equal to ``low`` and before row ``high`` (None is open);
    ``below`` rows precede the bracket and ``size`` rows are in it.
    """

    ranking: Ranking
    rank: int
    size: int
    below: int = 0
    low: tuple | None = None
    high: tuple | None = None

    def inside(self) -> Column:
        after_low = F.lit(True)
        if self.low is not None:
            after_low = ~(self.ranking.precedes(self.low) | self.ranking.equals(self.low))
        before_high = F.lit(True) if self.high is None else self.ranking.precedes(self.high)
        return after_low & before_high


@dataclass(frozen=True)
class _Boundary:
    """The row at a tile's start: the first ``share`` of the ``equal`` rows like it lie before the start."""

    target: _Target
    row: tuple
    share: int
    equal: int = 0
    position: int | None = None

    def before(self) -> Column:
        """True for the rows before the start."""
        ranking = self.target.ranking
        if self.position is None:
            return ranking.precedes(self.row)
        placed = F.col(_POSITION) < self.position
        return ranking.precedes(self.row) | (ranking.equals(self.row) & placed)


#: Column with the position of a row, where equal rows are shared out.
_POSITION = "_tile_position"


def tile_starts(rows: int, k: int) -> list[int]:
    """0-based positions at which tiles 2 to k start; the first tiles get the rest."""
    size, larger = divmod(rows, k)
    starts = [tile * size + min(tile, larger) for tile in range(1, k)]
    return [start for start in starts if start < rows]


def global_ntile(
    df: DataFrame,
    rankings: dict[str, Ranking],
    k: int = 5,
    leaf_rows: int = 1_000_000,
    sample_rows: int = 20_000,
) -> DataFrame:
    """Add one tile column (1 to k) per entry of ``rankings``.

    ``df`` is read several times and should be stored. All rankings share the
    scans that sample and count. Rows that key and tie do not tell apart are shared
    out at a boundary, as many to each tile as NTILE does; only then is the table written once
    more, with positions.
    """
    rows = df.count()
    targets = [
        _Target(ranking, rank, rows)
        for ranking in rankings.values()
        for rank in tile_starts(rows, k)
    ]
    boundaries = _locate(df, targets, leaf_rows, sample_rows)
    columns = df.columns
    if any(b.share for b in boundaries):
        df = materialize(df.withColumn(_POSITION, F.monotonically_increasing_id()), "positions")
        boundaries = [_placed(df, b, leaf_rows, sample_rows) for b in boundaries]
    tiles = {}
    for name, ranking in rankings.items():
        reached = [
            F.when(b.before(), 0).otherwise(1) for b in boundaries if b.target.ranking == ranking
        ]
        tiles[name] = reduce(lambda a, b: a + b, reached, F.lit(1)).cast("int")
    return df.select(*[F.col(f"`{c}`") for c in columns if c not in tiles], *[c.alias(n) for n, c in tiles.items()])


def _placed(df: DataFrame, boundary: _Boundary, leaf_rows: int, sample_rows: int) -> _Boundary:
    """Find the position at which the rows equal to the boundary's are shared out."""
    if not boundary.share:
        return boundary
    same = df.where(boundary.target.ranking.equals(boundary.row))
    equal = boundary.equal or same.count()
    target = _Target(Ranking(_POSITION), boundary.share, equal)
    found = _locate(same, [target], leaf_rows, sample_rows)
    return replace(boundary, position=found[0].row[0])


def _locate(df, targets, leaf_rows, sample_rows) -> list[_Boundary]:
    found: list[_Boundary] = []
    while wide := [t for t in targets if t.size > leaf_rows]:
        narrowed = _narrow(df, wide, sample_rows)
        found += [t for t in narrowed if isinstance(t, _Boundary)]
        targets = [t for t in targets if t.size <= leaf_rows]
        targets += [t for t in narrowed if isinstance(t, _Target)]
    by_ranking: dict[Ranking, list[_Target]] = {}
    for target in targets:
        by_ranking.setdefault(target.ranking, []).append(target)
    picked = together(lambda ranking: _pick(df, ranking, by_ranking[ranking]), by_ranking)
    return [*found, *chain.from_iterable(picked.values())]


def _narrow(df: DataFrame, targets: list[_Target], sample_rows: int) -> list[_Target | _Boundary]:
    """One sampling pass and one counting pass over all brackets."""
    brackets = list(dict.fromkeys(_bracket(t) for t in targets))
    first = {bracket: next(t for t in targets if _bracket(t) == bracket) for bracket in brackets}
    drawn = F.rand()
    tags = F.array_compact(
        F.array(
            *[
                F.when(target.inside() & (drawn < sample_rows / target.size), F.lit(i))
                for i, target in enumerate(first.values())
            ]
        )
    )
    columns = sorted({name for t in targets for name in t.ranking.columns})
    chosen = df.select(*columns, F.explode(tags).alias("_bracket")).collect()
    samples: dict[tuple, list[tuple]] = {bracket: [] for bracket in brackets}
    for row in chosen:
        bracket = brackets[row["_bracket"]]
        samples[bracket].append(tuple(row[name] for name in bracket[0].columns))
    samples = {bracket: bracket[0].sorted(rows) for bracket, rows in samples.items()}
    proposals = [_propose(target, samples[_bracket(target)]) for target in targets]
    counts = iter(
        df.agg(
            *[
                F.count_if(F.lit(False) if row is None else compare(row))
                for target, bounds in zip(targets, proposals)
                for row in bounds
                for compare in (target.ranking.precedes, target.ranking.equals)
            ]
        ).first()
    )
    return [
        _tighten(target, [(row, next(counts), next(counts)) for row in bounds])
        for target, bounds in zip(targets, proposals)
    ]


def _bracket(target: _Target) -> tuple:
    return (target.ranking, target.low, target.high, target.size)


def _propose(target: _Target, sample: list[tuple]) -> tuple[tuple | None, tuple | None]:
    """Sample rows about four standard errors on either side of the target.

    The margin stays below an eighth of the sample, so that a small sample still
    narrows the bracket; the target may then lie outside, which the counts show.
    """
    share = (target.rank - target.below) / target.size
    middle = share * len(sample)
    margin = min(4 * math.sqrt(len(sample) * share * (1 - share)) + 2, len(sample) / 8)
    low, high = math.floor(middle - margin), math.ceil(middle + margin)
    return (
        sample[low] if 0 <= low < len(sample) else None,
        sample[high] if 0 <= high < len(sample) else None,
    )


def _tighten(target: _Target, bounds: list[tuple]) -> _Target | _Boundary:
    """Keep the part of the bracket that the counts show to hold the target, or tell its row.

    ``bounds`` are proposed rows, the rows before and the rows equal to each.
    """
    for row, before, equal in bounds:
        if row is None:
            continue
        end = target.below + target.size
        if target.rank < before:
            return replace(target, high=row, size=before - target.below)
        if target.rank < before + equal:
            return _Boundary(target, row, target.rank - before, equal)
        target = replace(target, low=row, below=before + equal, size=end - before - equal)
    return target


def _pick(df: DataFrame, ranking: Ranking, targets: list[_Target]) -> list[_Boundary]:
    """Number the rows of each remaining bracket and read off the targets."""
    brackets = sorted({(t.below, t.size): t for t in targets}.items())
    number = {key: i for i, (key, _) in enumerate(brackets)}
    member = F.array_compact(
        F.array(*[F.when(t.inside(), F.lit(i)) for i, (_, t) in enumerate(brackets)])
    )
    anywhere = reduce(lambda a, b: a | b, [t.inside() for _, t in brackets])
    wanted = {(number[(t.below, t.size)], t.rank - t.below + 1): t for t in targets}
    hit = F.struct("_bracket", "_row").isin(
        [F.struct(F.lit(b), F.lit(r)) for b, r in wanted]
    )
    key, tie = ranking.columns
    named = Ranking("_key", ranking.tie and "_tie", ranking.descending)
    order = Window.partitionBy("_bracket").orderBy(*named.order())
    rows = (
        df.where(anywhere)
        .select(F.col(key).alias("_key"), F.col(tie).alias("_tie"), F.explode(member).alias("_bracket"))
        .withColumns(
            {
                "_row": F.row_number().over(order),
                "_first": F.rank().over(order),
            }
        )
        .where(hit)
        .select("_bracket", "_row", "_first", "_key", "_tie")
    )
    return [
        _Boundary(wanted[(row[0], row[1])], (row[3], row[4]), row[1] - row[2])
        for row in rows.collect()
    ]
