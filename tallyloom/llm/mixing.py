"""Mixing to target weights: iterative proportional fitting, then calibrated sampling.

Documents are counted into cells of source, language and topic, with their tokens. The
cells' weights are raked: scaled to the target shares of each margin in turn, until all
margins hold, with no cell drawn more than whole. A document's probability is its cell's weight for a token,
so that the expected tokens meet the budget; a hash of its key decides. Only Spark expressions; cells,
not documents, take part in the rounds, and the driver sees one row a round.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.tables import unused
from tallyloom.sinks.scratch import materialize

MARGINS = ("source", "language", "topic")
#: Topics by form, tried in this order; the rest is "prose".
TOPICS = (
    ("table", r" \| "),
    ("markup", r"[#$%&*]{3}"),
    ("licence", r"[Ll]icen[cs]ed? |[Cc]opyright"),
    ("contact", r"\w@\w|\d\.\d+\.\d"),
    ("shouting", r"\p{Lu}{3}\S* \p{Lu}{3}"),
)
NONE = "(none)"


@dataclass(frozen=True)
class Target:
    """Shares of each margin: given, or the shares of tokens raised to a power below 1.

    ``shares`` names a margin's categories; those not named get no weight. ``budget`` is the
    share of all tokens to draw, less if the named categories hold less. Rounds end when no margin is off by
    more than ``close`` of its goal, or after ``rounds`` where the margins contradict each other.
    """

    shares: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    temper: Mapping[str, float] = field(
        default_factory=lambda: {"source": 0.8, "language": 0.7, "topic": 0.7}
    )
    budget: float = 0.5
    close: float = 1e-4
    rounds: int = 40
    seed: int = 20_240


def token_estimate(text: Column) -> Column:
    """A token for every four bytes, rounded up."""
    return F.coalesce(F.ceil(F.octet_length(text) / 4), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    (name, pattern), *others = TOPICS
    first = F.when(text.rlike(pattern), name)
    return reduce(lambda out, rule: out.when(text.rlike(rule[1]), rule[0]), others, first).otherwise("prose")


def margins(source: str = "source", language: str = "lang", text: str = "text") -> dict[str, Column]:
    """The categories of a document; a null one is a category of its own."""
    return {
        "source": F.coalesce(F.col(source).cast("string"), F.lit(NONE)),
        "language": F.coalesce(F.col(language).cast("string"), F.lit(NONE)),
        "topic": F.when(F.col(text).isNull(), NONE).otherwise(topic_of(F.col(text))),
    }


def _level(sums: DataFrame, whole: float) -> float:
    """The factor with which shares, none beyond its cap, add up to ``whole``; one row a round reaches the driver.

    Categories that are full stay so as the factor grows, so the rounds end; they are few.
    """
    level, full = 0.0, -1
    while True:
        at_cap = (F.col("share") * level >= F.col("cap")) & (F.col("share") > 0)
        now, held, free = sums.agg(
            F.count_if(at_cap), F.sum(F.when(at_cap, F.col("cap")).otherwise(0.0)), F.sum(F.when(at_cap, 0.0).otherwise(F.col("share")))
        ).first()
        if not free:
            return level * 2 or 0.0
        if now == full:
            return level
        full, level = now, (whole - held) / free


def _with_targets(cells: DataFrame, target: Target) -> DataFrame:
    """Each cell with its cap and with its margins' target tokens, which add up alike in each margin.

    A category cannot give more than ``tokens / budget``: what a target asks beyond that goes to the
    others of its margin, in proportion. Where a margin's named categories cannot make up the budget, all margins are
    set to what it can give.
    """
    margins_of, whole = {}, None
    for margin in MARGINS:
        sums = cells.groupBy(margin).agg(F.sum("tokens").alias("own"))
        if margin in target.shares:
            named = [F.lit(x) for pair in target.shares[margin].items() for x in pair]
            share = F.coalesce(F.try_element_at(F.create_map(*named), F.col(margin)).cast("double"), F.lit(0.0))
            share = F.when(F.col("own") > 0, share).otherwise(0.0)
        else:
            share = F.pow(F.col("own").cast("double"), F.lit(target.temper[margin]))
        sums = materialize(
            sums.select(margin, share.alias("share"), (F.col("own") / target.budget).alias("cap"), "own"), "margin"
        )
        most, all_ = sums.agg(F.sum(F.when(F.col("share") > 0, F.col("cap"))), F.sum("own").cast("double")).first()
        whole = min(most or 0.0, all_ or 0.0, whole if whole is not None else float("inf"))
        margins_of[margin] = sums
    for margin, sums in margins_of.items():
        goal = F.least(F.col("cap"), F.col("share") * _level(sums, whole))
        cells = cells.join(sums.select(margin, goal.alias(f"goal_{margin}")), margin)
    return cells.withColumn("cap", F.col("tokens") / target.budget)


def _raked_once(cells: DataFrame) -> DataFrame:
    """Weights scaled to each margin in turn, none beyond its cap, and how far a margin was from its goal.

    ``weight`` is not cut: a cell whose weight passes its cap counts with the cap, and the cells below theirs
    make up for it.
    """
    moved = F.lit(0.0)
    for margin in MARGINS:
        full = F.col("weight") >= F.col("cap")
        sums = cells.groupBy(margin).agg(
            F.sum(F.when(full, F.col("cap")).otherwise(0.0)).alias("held"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("free"),
        )
        goal, now = F.col(f"goal_{margin}"), F.col("held") + F.col("free")
        below = F.when(now > 0, goal / now).otherwise(0.0)
        ratio = F.when((goal > F.col("held")) & (F.col("free") > 0), (goal - F.col("held")) / F.col("free")).otherwise(
            F.when(goal < now, below).otherwise(1.0)
        )
        moved = F.greatest(F.col("moved"), F.when(goal > 0, F.abs(now / goal - 1)).otherwise(0.0))
        cells = cells.join(sums, margin).withColumns({"moved": moved, "weight": F.col("weight") * ratio}).drop("held", "free")
    return cells


def raked_cells(measured: DataFrame, target: Target = Target()) -> DataFrame:
    """source, language, topic, documents, tokens, weight, probability, and of each margin target_ and share_.

    ``measured`` has the three margins and tokens of each document. weight is in tokens of the whole, none beyond
    ``tokens / budget``; the probability is that weight times the budget for a token, so no cell is drawn more than once and
    the shares drawn are the raked ones. target_ is the reachable share of a cell's category and share_ the one that its cells
    come to; they differ where margins contradict each other. A cell without tokens
    has probability 0; no documents give no cells.
    """
    cells = measured.groupBy(*MARGINS).agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"))
    cells = materialize(cells, "cells")
    cells = _with_targets(cells, target).withColumn("weight", F.col("tokens").cast("double"))
    cells = materialize(cells, "cells")
    for _ in range(target.rounds):
        # A round reads its cells eight times; two rounds in one plan would read them sixty-four times.
        cells = materialize(_raked_once(cells.withColumn("moved", F.lit(0.0))), "cells")
        moved = cells.agg(F.max("moved")).first()[0]
        if moved is None or moved < target.close:
            break
    cells = cells.withColumn("weight", F.least("weight", "cap"))
    whole = cells.agg(F.sum("weight")).first()[0] or 0.0
    for margin in MARGINS:
        sums = cells.groupBy(margin).agg((F.sum("weight") / F.lit(whole or None)).alias(f"share_{margin}"))
        goals = F.col(f"goal_{margin}")
        cells = cells.join(sums, margin).withColumn(f"target_{margin}", goals / F.lit(whole or None))
    probability = F.when(F.col("tokens") > 0, F.col("weight") * target.budget / F.col("tokens")).otherwise(0.0)
    shown = [f"{kind}_{margin}" for margin in MARGINS for kind in ("target", "share")]
    return cells.select(
        *MARGINS, "documents", "tokens", "weight", F.least(F.lit(1.0), probability).alias("probability"), *shown
    )


def drawn(key: Column, probability: Column, seed: int) -> Column:
    """Whether a hash of the key, spread evenly over 0 to 1, lies below the probability."""
    even = F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) / F.lit(float(1 << 53))
    return even < probability


def measure(
    docs: DataFrame, key: str = "doc_id", source: str = "source", language: str = "lang", text: str = "text"
) -> DataFrame:
    own = margins(source, language, text)
    return docs.select(
        F.col(key), *(column.alias(name) for name, column in own.items()), token_estimate(F.col(text)).alias("tokens")
    )


def sampling_plan(
    docs: DataFrame,
    target: Target = Target(),
    key: str = "doc_id",
    source: str = "source",
    language: str = "lang",
    text: str = "text",
) -> DataFrame:
    """key, source, language, topic, tokens, probability, drawn, and target and share of each margin's
    category: one row per row of ``docs``.

    Null categories are one of their own, ``(none)``. Null and empty texts have no tokens, but
    are drawn at the rate of their cell. Rows that repeat a key are drawn together. Other
    columns are ignored, whatever their names. No rows give no rows.
    """
    measured = materialize(measure(docs, key, source, language, text), "measured")
    cells = raked_cells(measured, target).drop("documents", "weight", "tokens")
    return measured.join(cells, [*MARGINS]).select(
        key,
        *MARGINS,
        "tokens",
        "probability",
        drawn(F.col(key), F.col("probability"), target.seed).alias("drawn"),
        *[f"{kind}_{margin}" for margin in MARGINS for kind in ("target", "share")],
    )


def mixed(
    docs: DataFrame,
    target: Target = Target(),
    key: str = "doc_id",
    source: str = "source",
    language: str = "lang",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that are drawn, with their columns, whatever the names of others; the texts are not shuffled for it
    while the cells fit a broadcast by Spark's own measure."""
    cells = raked_cells(measure(docs, key, source, language, text), target)
    names = {name: unused(docs.columns, f"of_{name}") for name in (*MARGINS, "probability")}
    cells = cells.select(*(F.col(name).alias(as_) for name, as_ in names.items()))
    own = {names[name]: column for name, column in margins(source, language, text).items()}
    kept = docs.withColumns(own).join(cells, [names[m] for m in MARGINS])
    return kept.where(drawn(F.col(key), F.col(names["probability"]), target.seed)).select(*docs.columns)
