"""Landing: raw CSV files are checked, copied line by line and counted.

A source entry is a file or a folder of files with one header line each. The
copy is a Spark job over plain text: files are read in splits, lines are cut at
line feeds alone and written as they are, and no CSV parser sees them. The
header is left out of the copy, so the scan of landed files expects none.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.schemas import RAW_FILE_ENDINGS
from tallyloom.session import together


class MissingSource(Exception):
    """The dataset folder, or some of the files it must hold, do not exist."""


class AmbiguousSource(Exception):
    """More than one entry has the name of a required file."""


class EmptySource(Exception):
    """Files or folders without a single byte: not even a header was delivered."""


def _files(spark: SparkSession, path: str) -> DataFrame | None:
    """(file, entry) of a path pattern; contents are not read, and files without a byte not listed."""
    try:
        files = spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    parts = F.split("_metadata.file_path", "/")
    ending = path.rsplit("*", 1)[-1].rsplit("/", 1)[-1]
    name = F.element_at(parts, -1)
    return files.select(
        F.col("_metadata.file_path").alias("file"),
        F.when(name.endswith(ending), name).otherwise(F.element_at(parts, -2)).alias("entry"),
    )


def source_paths(
    spark: SparkSession,
    source: str,
    prefix: str | None = None,
    entities: Iterable[str] = RAW_FILE_ENDINGS,
) -> dict[str, str]:
    """Path per entity, checked before anything is written.

    ``prefix`` is what file names begin with before their fixed endings; without
    one, any beginning will do if it is the only one. Missing, ambiguous and
    empty files raise, each kind in one error that names all of them.
    """
    source = os.path.expanduser(source).rstrip("/")
    start = "*" if prefix is None else prefix
    paths = {entity: f"{source}/{start}{RAW_FILE_ENDINGS[entity]}" for entity in entities}
    if _files(spark, source) is None:
        raise MissingSource(f"dataset path does not exist: {source}")
    found = {entity: _files(spark, path) for entity, path in paths.items()}
    missing = [paths[entity] for entity, files in found.items() if files is None]
    if missing:
        raise MissingSource("missing required files: " + ", ".join(missing))
    listed = reduce(
        DataFrame.unionByName,
        [files.withColumn("entity", F.lit(entity)) for entity, files in found.items()],
    )
    names: dict[str, list[str]] = {}
    for row in listed.groupBy("entity", "entry").count().orderBy("entity", "entry").collect():
        names.setdefault(row.entity, []).append(row.entry)
    several = [", ".join(own) for own in names.values() if len(own) > 1]
    if several:
        raise AmbiguousSource("several files for one table: " + "; ".join(several))
    empty = [paths[entity] for entity in found if entity not in names]
    if empty:
        raise EmptySource("files without a byte: " + ", ".join(empty))
    return {entity: f"{source}/{own[0]}" for entity, own in names.items()}


def _paths(spark: SparkSession, source: str | dict[str, str], prefix: str | None) -> dict[str, str]:
    return source if isinstance(source, dict) else source_paths(spark, source, prefix)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as they are; a carriage return belongs to its line."""
    return spark.read.option("lineSep", "\n").text(path)


def _without_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops the first line of every split that is the beginning of a file."""
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch.column(1), batch.column(2)
        first = (file[0].as_py(), start[0].as_py())
        same = pc.and_(
            pc.equal(file.slice(1), file.slice(0, len(file) - 1)),
            pc.equal(start.slice(1), start.slice(0, len(start) - 1)),
        )
        new = pa.concat_arrays([pa.array([first != before]), pc.invert(same)])
        before = (file[-1].as_py(), start[-1].as_py())
        kept = pc.invert(pc.and_(new, pc.equal(start, 0)))
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept)], ["line"])


def land_raw(
    spark: SparkSession,
    source: str | dict[str, str],
    bronze: str,
    prefix: str | None = None,
    **options: object,
) -> dict[str, str]:
    """Copy each entity's lines to its own bronze folder, replacing what is there.

    ``options`` are those of the text writer, such as ``csv.PACKED``.

    ``source`` is a folder, or the checked paths of one. The lines pass a Python task as bytes, since only the order of lines within
    a split tells a header from a line that is equal to it. Entities are copied at the same time.
    """
    paths = _paths(spark, source, prefix)

    def copy(entity: str) -> str:
        target = f"{bronze.rstrip('/')}/{entity}"
        placed = _lines(spark, paths[entity]).select(
            F.col("value").cast("binary").alias("line"),
            F.xxhash64("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
        )
        lines = placed.mapInArrow(_without_headers, "line binary")
        lines.select(F.col("line").cast("string")).write.mode("overwrite").options(**options).text(target)
        return target

    return together(copy, paths)


def landing_manifest(
    spark: SparkSession, source: str | dict[str, str], prefix: str | None = None
) -> DataFrame:
    """(file, target, record_count): physical lines of each file less its header.

    Lines are counted per file with map-side combining, so one file holding
    most of the lines costs no more than many equal ones.
    """
    counts = [
        _lines(spark, path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg((F.count(F.lit(1)) - 1).alias("record_count"))
        .select("file", F.lit(entity).alias("target"), "record_count")
        for entity, path in _paths(spark, source, prefix).items()
    ]
    return reduce(DataFrame.unionByName, counts)


def bronze_listing(spark: SparkSession, bronze: str) -> DataFrame:
    """Every landed file with its size. File contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "part-*")
        .load(bronze)
        .select("path", "length")
        .orderBy("path")
    )
