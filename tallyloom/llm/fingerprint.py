"""Document fingerprints as a homomorphic hash of the multiset of paragraphs.

A paragraph's vector is wide: lanes that are spread over 32 bits by a hash of its bytes,
and lanes that count, over its runs of two words, the bits of a hash of the run. A
document's fingerprint is the sum of its paragraphs' vectors, each lane modulo 2^32. Order
does not matter, and paragraphs can be put in or taken out by adding or subtracting their
vectors. The wide lanes tell equal from unequal; the counting lanes, taken as signs, are a
random projection of the runs, whose cosine tells how alike two documents are.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.tables import SLAB_BYTES, tidy
from tallyloom.llm.word_hash import mix, run_hashes, word_hashes

WIDE, BITS, RUN = 16, 128, 2
#: Wide lanes, their number of paragraphs, counting lanes, their number of runs.
LANES = WIDE + 1 + BITS + 1

_STEPS = np.arange(1, WIDE + 1, dtype=np.uint64)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def paragraphs(text: str) -> list[bytes]:
    """Lines, blank ones too; an empty text has none."""
    return text.encode("utf-8", "surrogatepass").split(b"\n") if text else []


def vectors(documents: list[list[bytes]]) -> np.ndarray:
    """The sum of the paragraphs' vectors of each list: a row of LANES numbers modulo 2^32."""
    sums = np.zeros((len(documents), LANES), np.uint32)
    counts = np.array([len(own) for own in documents])
    full = np.flatnonzero(counts)
    if not len(full):
        return sums
    flat = [paragraph for own in documents for paragraph in own]
    starts = (np.cumsum(counts) - counts)[full]
    seeds = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, flat)), np.uint64).reshape(-1, 2)
    wide = mix(seeds[:, :1] + _STEPS * _FACTORS[0]) ^ mix(seeds[:, 1:] + _STEPS * _FACTORS[1])
    sums[full, :WIDE] = np.add.reduceat((wide >> np.uint64(32)).astype(np.uint32), starts, axis=0)
    sums[:, WIDE] = counts
    # Runs of words, within each paragraph; paragraphs of few words at a time.
    data = np.frombuffer(b"".join(flat), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(paragraph) for paragraph in flat])])
    words, number = word_hashes(data, offsets)
    runs, number = run_hashes(words, number, RUN)
    edges = np.concatenate([[0], np.cumsum(number)])
    doc_edges = edges[np.concatenate([[0], np.cumsum(counts)])]
    for first in range(0, len(runs), 16_384):
        own = runs[first : first + 16_384]
        both = np.stack([own, mix(own ^ _FACTORS[0])], axis=1)
        bits = np.unpackbits(both.view(np.uint8), axis=1)
        begin = int(np.searchsorted(doc_edges, first, side="right")) - 1
        end = int(np.searchsorted(doc_edges, first + len(own)))
        rows = np.arange(begin, end)
        at = np.maximum(doc_edges[begin:end] - first, 0)
        held = np.diff(np.append(at, len(own))) > 0
        sums[rows[held], WIDE + 1 : -1] += np.add.reduceat(bits, at[held], axis=0, dtype=np.uint32)
    sums[:, -1] = np.diff(doc_edges)
    return sums


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """From 0 to 1, row by row; 1 for equal fingerprints, 0 where one alone has no words."""

    def signs(rows: np.ndarray) -> np.ndarray:
        return 2.0 * rows[:, WIDE + 1 : -1] - rows[:, -1:].astype(float)

    a, b = signs(one), signs(other)
    norms = np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
    cosine = np.where(norms > 0, (a * b).sum(axis=1) / np.where(norms > 0, norms, 1), 0.0)
    return np.where((one == other).all(axis=1), 1.0, np.clip(cosine, 0.0, 1.0))


def hexes(rows: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in rows.astype("<u4")]


def edited(text: str, following: str) -> tuple[str, int]:
    """The last quarter replaced by as much of the following text; length of what stays."""
    quarter = len(text) // 4
    kept = len(text) - quarter
    return text[:kept] + following[:quarter], kept


def _digest(rows: list[tuple[object, str]]) -> Iterator[tuple]:
    """Results for all rows but the last, each with the one after it."""
    heads, olds, news, hashes = [], [], [], []
    for (_, text), (_, following) in zip(rows, rows[1:]):
        changed, kept = edited(text, following)
        line = text.rfind("\n", 0, kept) + 1
        heads.append(paragraphs(text[: line - 1]) or [b""] if line else [])
        olds.append(paragraphs(text[line:]) or [b""] * bool(text))
        news.append(paragraphs(changed[line:]) or [b""] * bool(changed))
        hashes.append(hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest())
    all_vectors = vectors([*heads, *olds, *news, paragraphs(rows[-1][1])])
    heads, olds, news = all_vectors[:-1].reshape(3, -1, LANES)
    whole = heads + olds
    # Take out the paragraphs that the edit touches and put in the new ones.
    changed = whole - olds + news
    following = np.vstack([whole[1:], all_vectors[-1:]])
    return zip(
        [key for key, _ in rows[:-1]],
        [len(text) for _, text in rows[:-1]],
        hashes,
        hexes(whole),
        hexes(changed),
        likeness(whole, changed).tolist(),
        likeness(whole, following).tolist(),
    )


RESULT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprint_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", ranges: int | None = None
) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; a row per row.

    A document's edited text ends with the beginning of the next document's, by ascending
    ``key`` (a whole number), ties by text, rows without a key last; after the last comes the
    first. Keys are cut into ``ranges``, each read in order by one task, which also gets the
    first row of the next range. A null text is an empty one. A table of one row is its own
    next; no rows give no rows. Other columns are ignored, whatever their names. Long texts are
    hashed whole.
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    marks = [i / ranges for i in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("id", marks, max(10_000, 10 * ranges))).first()[0] if marks else []
    cuts = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        found = np.searchsorted(cuts, ids.where(known, 0).astype("int64"), side="right")
        return pd.Series(np.where(known, found, len(cuts) + 1)).astype("int32")

    firsts = sorted(
        tuple(row) for row in rows.select("id", range_of("id").alias("own")).groupBy("own").agg(F.min("id")).collect()
    )
    dealt = rows.select(range_of("id").alias("own"), F.lit(False).alias("only_next"), "id", "text")
    if firsts:
        # Of each range, the first key of the range after it: as many rows as there are ranges.
        pairs = [
            {"of": own, "next": first} for (own, _), (_, first) in zip(firsts, firsts[1:] + firsts[:1])
        ]
        listed = spark.range(1).select(
            F.explode(F.from_json(F.lit(json.dumps(pairs)), f"array<struct<of:int,next:{kind}>>")).alias("p")
        )
        nexts = (
            rows.join(F.broadcast(listed), F.col("id").eqNullSafe(F.col("p.next")))
            .groupBy("p.of", "p.next")
            .agg(F.min("text").alias("text"))
            .select(F.col("of"), F.lit(True), F.col("next"), "text")
        )
        dealt = dealt.union(nexts)
    ordered = dealt.repartitionById(len(cuts) + 2, F.col("own")).sortWithinPartitions(
        "own", "only_next", F.col("id").asc_nulls_last(), "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results(part: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*_digest(part)))
            return pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema
            )

        schema = pa.schema(
            [
                pa.field("id", id_type), pa.field("n_chars", pa.int64()),
                *(pa.field(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")),
                pa.field("near_edited", pa.float64()), pa.field("near_next", pa.float64()),
            ]
        )
        part: list[tuple] = []
        size = 0
        for batch in batches:
            for only_next, row_id, value in zip(batch.column(1), batch.column(2), batch.column(3)):
                own = value.as_py()
                part.append((row_id.as_py(), own))
                size += len(own)
                if only_next.as_py() or size > SLAB_BYTES:
                    if len(part) > 1:
                        yield results(part)
                    part = [] if only_next.as_py() else part[-1:]
                    size = sum(len(text) for _, text in part)

    id_type = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}[kind]
    return ordered.mapInArrow(tidy(run), f"id {kind}, {RESULT}").withColumnRenamed("id", key)
