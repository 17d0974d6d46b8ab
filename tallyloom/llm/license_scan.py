"""Licence signatures in whole texts, in Spark expressions only and without a shuffle.

A text is reduced to its words with single blanks between. One expression over the beginnings of
words tells whether any keyword occurs; only then are the rules tried whose keyword is there.
Their places, as word numbers, are sorted; a place inside another one is dropped, and one that overlaps
a place of higher priority that stays, the highest priority being settled first. Places of base rules always stay.
Time grows with the length of a text and the number of its places, not with their square.
"""

from __future__ import annotations

import json
from itertools import groupby

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.license_rules import RULES, Signature

#: All that stands between words, both cases being letters of words.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: How far a place of each priority tells that a licence is stated.
STRENGTH = {1: 0.4, 2: 0.7, 3: 0.95}
BEGIN, END = "\x01", "\x02"
#: Places that are scanned at a time.
BLOCK = 256

_RULE = "array<struct<number:int,label:string,priority:int,keyword:string,pattern:string,base:boolean>>"
_PLACE = (
    "array<struct<start:int,minus_end:int,minus_priority:int,number:int,"
    "end:int,priority:int,label:string,base:boolean>>"
)


def _rules(rules: list[Signature]) -> Column:
    rows = [
        {
            "number": number,
            "label": rule.label,
            "priority": rule.priority,
            "keyword": rule.keyword,
            "pattern": f"(?<= )(?:{rule.pattern})(?= )",
            "base": rule.base,
        }
        for number, rule in enumerate(rules)
    ]
    return F.from_json(F.lit(json.dumps(rows)), _RULE)


def _keyword_gate(rules: list[Signature]) -> str:
    """One expression for all keywords, by first letter, so that most words fail at once."""
    words = sorted({rule.keyword for rule in rules})
    branches = [
        f"{first}(?:{'|'.join(word[1:] for word in own)})"
        for first, own in groupby(words, key=lambda word: word[0])
    ]
    return f"(?i) (?:{'|'.join(branches)})"


def _places(words: Column, rule: Column) -> Column:
    """Start and end of every match of a rule, as word numbers, the end not included."""
    marked = F.regexp_replace(words, rule["pattern"], F.lit(f"{BEGIN}$0{END}"))
    numbered = F.array(F.split(F.btrim(marked), " "))

    def where(own: Column, test) -> Column:
        numbers = F.transform(own, lambda word, i: F.when(test(word), i))
        return F.filter(numbers, lambda i: i.isNotNull())

    def zipped(own: Column) -> Column:
        return F.zip_with(
            where(own, lambda word: word.startswith(BEGIN)),
            where(own, lambda word: word.endswith(END)),
            lambda start, end: F.struct(
                start.alias("start"),
                (-end - 1).alias("minus_end"),
                (-rule["priority"]).alias("minus_priority"),
                rule["number"].alias("number"),
                (end + 1).alias("end"),
                rule["priority"].alias("priority"),
                rule["label"].alias("label"),
                rule["base"].alias("base"),
            ),
        )

    return F.when(F.rlike(words, rule["pattern"]), F.flatten(F.transform(numbered, zipped))).otherwise(
        F.array().cast(_PLACE)
    )


def _running_max(values: Column, first: int) -> Column:
    """For each whole number of an array the largest before it, ``first`` before the first.

    An array that grows by one is copied each time, so the numbers are taken in blocks: what grows
    is never longer than a block or the number of blocks.
    """

    def scan(numbers: Column, reach: Column) -> Column:
        start = F.struct(reach.alias("reach"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            numbers,
            start,
            lambda state, x: F.struct(
                F.greatest(state["reach"], x).alias("reach"), F.concat(state["out"], F.array(state["reach"])).alias("out")
            ),
        )["out"]

    starts = F.when(F.size(values) > 0, F.sequence(F.lit(1), F.size(values), F.lit(BLOCK))).otherwise(
        F.array().cast("array<int>")
    )
    blocks = F.transform(starts, lambda start: F.slice(values, start, BLOCK))
    reached = scan(F.transform(blocks, F.array_max), F.lit(first))
    return F.flatten(F.zip_with(blocks, reached, scan))


def _uncontained(places: Column) -> Column:
    """Sorted places without those that lie inside an earlier one; base places stay."""
    reach = _running_max(F.transform(places, lambda place: place["end"]), 0)
    paired = F.zip_with(places, reach, lambda place, end: F.struct(place.alias("place"), end.alias("reach")))
    kept = F.filter(paired, lambda x: x["place"]["base"] | (x["place"]["end"] > x["reach"]))
    return F.transform(kept, lambda x: x["place"])


def _stay_of_level(judged: Column, level: int) -> Column:
    """Places (place, stays) with those of a priority settled: one stays if it overlaps none that stays with a higher one.

    Places are sorted by start, so of those before it the one that ends last decides, and of those after it the one
    that starts first.
    """

    def higher(x: Column) -> Column:
        return x["stays"] & (x["place"]["priority"] > level)

    none = -(1 << 30)
    before = _running_max(F.transform(judged, lambda x: F.when(higher(x), x["place"]["end"]).otherwise(none)), none)
    after = F.reverse(
        _running_max(F.reverse(F.transform(judged, lambda x: F.when(higher(x), -x["place"]["start"]).otherwise(none))), none)
    )
    sides = F.zip_with(before, after, lambda end, start: F.struct(end.alias("end"), (-start).alias("start")))
    return F.zip_with(
        judged,
        sides,
        lambda x, side: F.struct(
            x["place"].alias("place"),
            (
                x["stays"]
                | (
                    (x["place"]["priority"] == level)
                    & (side["end"] <= x["place"]["start"])
                    & (side["start"] >= x["place"]["end"])
                )
            ).alias("stays"),
        ),
    )


def _by_priority(rows: DataFrame, places: str) -> DataFrame:
    """Without places that overlap one of higher priority that stays, the highest settled first; base places stay."""
    rows = rows.withColumn(
        places, F.transform(places, lambda place: F.struct(place.alias("place"), place["base"].alias("stays")))
    )
    for level in sorted(STRENGTH, reverse=True):
        rows = rows.withColumn(places, _stay_of_level(F.col(places), level))
    stayed = F.filter(places, lambda x: x["stays"])
    return rows.withColumn(places, F.transform(stayed, lambda x: x["place"]))


def _labels(places: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")


def scan_licenses(
    docs: DataFrame, rules: list[Signature] = RULES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: words, base places, labels and a score from 0 to 1.

    Words are runs of a-z, 0-9 and of characters past ASCII, A-Z lower-cased. ``n_base`` counts
    all places of base rules, ``first_word`` and ``last_word`` are their smallest and largest
    start or null, ``labels`` joins the labels of all places that are left, sorted. A null or
    empty text has no words, no labels and score 0. Repeated rows stay, each with its result;
    other columns are ignored, whatever their names; no rows give no rows. Long texts are read
    whole.
    """
    words = F.btrim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BETWEEN, " "), F.lit(" "))
    counted = docs.select(F.col(key), words.alias("words")).select(
        key,
        F.when(F.col("words") == "", 0)
        .otherwise(F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit(""))) + 1)
        .cast("long")
        .alias("n_words"),
        F.concat(F.lit(" "), "words", F.lit(" ")).alias("words"),
    )
    gated = counted.select(
        key,
        "n_words",
        F.when(F.col("words").rlike(_keyword_gate(rules)), F.translate("words", UPPER, LOWER)).alias("words"),
    )
    tried = F.filter(_rules(rules), lambda rule: F.contains(F.col("words"), rule["keyword"]))
    found = F.sort_array(F.flatten(F.transform(tried, lambda rule: _places(F.col("words"), rule))))
    nothing = F.array().cast(_PLACE)
    places = gated.select(
        key, "n_words", F.when(F.col("words").isNotNull(), found).otherwise(nothing).alias("found")
    )
    kept = _by_priority(places.withColumn("kept", _uncontained(F.col("found"))), "kept").withColumn(
        "base", F.filter("found", lambda place: place["base"])
    )
    strength = F.create_map(*(F.lit(x) for pair in STRENGTH.items() for x in pair))
    return kept.select(
        key,
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda p: p["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda p: p["start"])).cast("long").alias("last_word"),
        _labels(F.col("base")).alias("base_labels"),
        _labels(F.col("kept")).alias("labels"),
        F.coalesce(
            F.try_element_at(strength, F.array_max(F.transform("kept", lambda p: p["priority"]))), F.lit(0.0)
        ).alias("score"),
        F.size("kept").cast("long").alias("n_places"),
    )
