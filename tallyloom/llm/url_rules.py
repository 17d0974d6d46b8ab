"""URL rules as one bit-parallel automaton (Shift-And with wildcards, many words).

Every rule is a chain of states, one bit each: a start state and one state per byte it
wants. Reading a byte shifts all states by one and keeps those whose byte suits; states
after a wildcard also stay where they are. All rules run together over words of 64
bits, for all URLs of a batch at once, so a rule more costs bits and no further pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.tables import slabs, text_buffer, tidy

ANY, SEGMENT, ALL = "any", "segment", "all"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``tokens``: a byte, ANY (one byte), SEGMENT (any bytes but ``/``), ALL (any bytes)."""

    name: str
    verdict: str
    tokens: tuple[int | str, ...]


def glob(name: str, verdict: str, pattern: str) -> Rule:
    """``?`` is one byte, ``*`` any bytes but ``/``, ``**`` any bytes; all else is itself."""
    tokens: list[int | str] = []
    for part in pattern.replace("**", "\0").replace("*", "\1"):
        special = {"?": ANY, "\0": ALL, "\1": SEGMENT}.get(part)
        tokens += [special] if special else list(part.encode())
    return Rule(name, verdict, tuple(tokens))


def site_rule(verdict: str, host: str, path: str) -> list[Rule]:
    """Host and path prefix as written, for the host itself and for its subdomains."""
    text = [*f"{host}{path}".encode(), ALL]
    return [
        Rule(f"{host}{path}", verdict, (*text,)),
        Rule(f"{host}{path}", verdict, (SEGMENT, ord("."), *text)),
    ]


def word_rule(verdict: str, word: str) -> list[Rule]:
    """Hosts that contain a word, with any path."""
    return [glob(f"*{word}*", verdict, f"*{word}*"), glob(f"*{word}*", verdict, f"*{word}*/**")]


class Automaton:
    def __init__(self, rules: list[Rule]):
        bits = sum(1 + sum(t not in (SEGMENT, ALL) for t in rule.tokens) for rule in rules)
        words = max(1, -(-bits // 64))
        starts = np.zeros(words, np.uint64)
        finals = np.zeros(len(rules), np.int64)
        self.move = np.zeros((256, words), np.uint64)
        self.stay = np.zeros((256, words), np.uint64)
        at = 0
        for number, rule in enumerate(rules):
            starts[at // 64] |= np.uint64(1 << at % 64)
            for token in rule.tokens:
                if token in (SEGMENT, ALL):
                    bytes_in = np.arange(256) != ord("/") if token == SEGMENT else slice(None)
                    self.stay[bytes_in, at // 64] |= np.uint64(1 << at % 64)
                    continue
                at += 1
                suits = slice(None) if token == ANY else token
                self.move[suits, at // 64] |= np.uint64(1 << at % 64)
            finals[number] = at
            at += 1
        self.starts, self.finals = starts, finals

    def match(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which rules fit which text: a boolean row per text, a column per rule."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        begin, length = offsets[:-1][order], lengths[order]
        state = np.repeat(self.starts[None, :], len(order), axis=0)
        # Texts are sorted by falling length, so those still running are the first ones.
        running = len(order)
        for step in range(int(length[0]) if len(length) else 0):
            while length[running - 1] <= step:
                running -= 1
            own = state[:running]
            byte = data[begin[:running] + step]
            moved = own << np.uint64(1)
            moved[:, 1:] |= own[:, :-1] >> np.uint64(63)
            state[:running] = (moved & self.move[byte]) | (own & self.stay[byte])
        fits = np.zeros((len(order), len(self.finals)), bool)
        fits[order] = state[:, self.finals // 64] >> (self.finals % 64).astype(np.uint64) & np.uint64(1)
        return fits


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty if there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.substring(rest, F.length(raw) + 1, F.length(rest))
    host, path = F.translate(raw, UPPER, LOWER), F.regexp_extract(after, "^[^?#]*", 0)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def judge_urls(
    pages: DataFrame,
    site_rules: list[Rule],
    other_rules: list[Rule],
    default: str = "allow",
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``key``, host, path, rule, verdict, other_rule for every row of ``pages``.

    Of the site rules that fit, the longest decides and is named in ``rule``. Without one,
    the longest of the other rules decides, ``block`` first among equally long ones, named
    in ``other_rule``; without that the verdict is ``default``. A null URL, or one without
    ``://``, has an empty host and path; it can only meet rules that take nothing. Repeated
    rows are judged each; other columns are left out; no rows give no rows. Long URLs are
    read to their end.
    """
    rules = [*site_rules, *other_rules]
    rank = sorted(
        range(len(rules)),
        key=lambda i: (i >= len(site_rules), -len(rules[i].name.encode()), rules[i].verdict != "block"),
    )
    names = [rules[i].name for i in rank] + [None]
    verdicts = [rules[i].verdict for i in rank] + [default]
    is_site = [i < len(site_rules) for i in rank] + [False]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton([rules[i] for i in rank])
        for batch in batches:
            data, offsets = text_buffer(batch.column(3))
            best: list[int] = []
            for first, last in slabs(offsets):
                fits = automaton.match(data, offsets[first : last + 1])
                none = np.ones((last - first, 1), bool)
                best += np.argmax(np.hstack([fits, none]), axis=1).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(3)),
                    pa.array([names[i] if is_site[i] else None for i in best], pa.string()),
                    pa.array([verdicts[i] for i in best], pa.string()),
                    pa.array([None if is_site[i] else names[i] for i in best], pa.string()),
                ],
                ["key", "host", "path", "rule", "verdict", "other_rule"],
            )

    host, path = host_and_path(F.col(url))
    kind = pages.schema[key].dataType.simpleString()
    judged = (
        pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
        .withColumn("whole", F.concat("host", "path"))
        .mapInArrow(tidy(run), f"key {kind}, host string, path string, rule string, verdict string, other_rule string")
    )
    return judged.withColumnRenamed("key", key)
