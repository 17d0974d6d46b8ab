"""Rows that are held in a task, met by any number of rows that stream past them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.tables import tidy


def _stretches(batch: pa.RecordBatch, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Parts of a batch in which the named columns do not change."""
    change = np.zeros(batch.num_rows, bool)
    change[:1] = True
    for name in names:
        values = batch.column(name).to_numpy(zero_copy_only=False)
        change[1:] |= values[1:] != values[:-1]
    edges = np.append(np.flatnonzero(change), batch.num_rows)
    for first, last in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield batch.slice(first, last - first)


def meet_in_cells(
    held: DataFrame,
    sent: DataFrame,
    cell: list[str],
    tasks: int,
    build: Callable[[pa.Table], object],
    use: Callable[[object, pa.RecordBatch], pa.RecordBatch | None],
    schema: str,
    order: tuple[str | Column, ...] = (),
) -> DataFrame:
    """Every cell's ``held`` rows are built into one object, and ``use`` takes it and the cell's ``sent``
    rows, batch by batch, in the given order.

    Both sides have the same columns, those of ``cell`` among them as whole numbers that are not null.
    A task keeps the held rows of one cell and one batch of the others, however many are sent: it is
    for the caller to bound what a cell holds. A held row is shuffled once. Cells to which nothing is sent
    are built into nothing.
    """
    both = held.withColumn("_sent", F.lit(0)).unionByName(sent.withColumn("_sent", F.lit(1)))
    dealt = both.repartition(tasks, *cell).sortWithinPartitions(*cell, "_sent", *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, built = None, [], None
        for batch in batches:
            for part in _stretches(batch, [*cell, "_sent"]):
                here = tuple(part.column(name)[0].as_py() for name in cell)
                if here != now:
                    now, parts, built = here, [], None
                if part.column("_sent")[0].as_py() == 0:
                    parts.append(part)
                    continue
                if parts:
                    built, parts = build(pa.Table.from_batches(parts)), []
                if built is not None:
                    found = use(built, part)
                    if found is not None and found.num_rows:
                        yield found

    return dealt.mapInArrow(tidy(run), schema)
