"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads text in segments of some bytes, once from each end, and gives every
byte probabilities of the languages; a document's probabilities are the means over its
letters. It is trained here by backpropagation through time on a bounded sample of
labelled snippets; only numpy is used. Arrays are (features, segments), so that each
gate is one contiguous block.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.tables import slabs, text_buffer, tidy, unused

UNKNOWN = "und"
#: Bytes that start again with an empty state.
SEGMENT = 64
#: Segments that run together, so that all arrays of a step stay in the cache.
WIDTH = 2048

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the snippets that are fetched for training, over all languages."""

    sample_rows: int = 8_000
    hidden: int = 16
    steps: int = 320
    batch: int = 256
    rate: float = 0.01
    seed: int = 17


class Network:
    """``weights``: per direction input table (3H, 256), recurrence (3H, H), output (L, H); bias (L, 1)."""

    def __init__(self, hidden: int, languages: list[str], seed: int = 0):
        rng = np.random.default_rng(seed)
        self.hidden, self.languages = hidden, languages
        count = len(languages)
        self.weights = {"bias": np.zeros((count, 1), np.float32)}
        for way in ("on", "back"):
            self.weights |= {
                f"{way}_in": rng.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32),
                f"{way}_again": rng.normal(0, hidden**-0.5, (3 * hidden, hidden)).astype(np.float32),
                f"{way}_out": rng.normal(0, hidden**-0.5, (count, hidden)).astype(np.float32),
            }

    def _steps(self, way: str, length: int) -> range:
        return range(length) if way == "on" else range(length - 1, -1, -1)

    def _read(self, way: str, x: np.ndarray, logits: np.ndarray, kept: list | None = None) -> None:
        """Adds one direction's part to ``logits`` (T, L, B); ``x`` is (T, B)."""
        size = self.hidden
        table, again, out = (self.weights[f"{way}_{name}"] for name in ("in", "again", "out"))
        h = np.zeros((size, x.shape[1]), np.float32)
        rows = np.ascontiguousarray(table.T)
        for t in self._steps(way, len(x)):
            own = np.ascontiguousarray(rows[x[t]].T)
            old = again @ h
            gates = own[: 2 * size]
            gates += old[: 2 * size]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates += 1.0
            gates *= 0.5  # the logistic function
            reset, update = gates[:size], gates[size:]
            new = own[2 * size :]
            new += reset * old[2 * size :]
            np.tanh(new, out=new)
            before = h
            h = before + update * (new - before)
            logits[t] += out @ h
            if kept is not None:
                kept.append((t, before, reset, update, new, old[2 * size :], h))

    def logits(self, x: np.ndarray) -> np.ndarray:
        logits = np.empty((len(x), len(self.languages), x.shape[1]), np.float32)
        logits[:] = self.weights["bias"]
        for way in ("on", "back"):
            self._read(way, x, logits)
        return logits

    @staticmethod
    def probabilities(logits: np.ndarray) -> np.ndarray:
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return p

    def gradients(self, x: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over the letters of ``x`` (T, B) and its derivatives, back through time."""
        size, width = self.hidden, x.shape[1]
        logits = np.empty((len(x), len(self.languages), width), np.float32)
        logits[:] = self.weights["bias"]
        kept: dict[str, list] = {"on": [], "back": []}
        for way in kept:
            self._read(way, x, logits, kept[way])
        error = self.probabilities(logits)
        letters = _LETTER[x]
        own = error[:, labels, np.arange(width)]
        total = max(1, int(letters.sum()))
        loss = float(-(np.log(own + 1e-9) * letters).sum() / total)
        error[:, labels, np.arange(width)] -= 1.0
        error *= letters[:, None, :] / np.float32(total)
        found = {"bias": error.sum(axis=(0, 2))[:, None]}
        for way, states in kept.items():
            again, out = self.weights[f"{way}_again"], self.weights[f"{way}_out"]
            d_again, d_out = np.zeros_like(again), np.zeros_like(out)
            d_in = np.zeros((len(x), 3 * size, width), np.float32)
            carried = np.zeros((size, width), np.float32)
            for t, before, reset, update, new, old, h in reversed(states):
                d_out += error[t] @ h.T
                d_h = carried + out.T @ error[t]
                d_new = d_h * update * (1 - new * new)
                d_gates = d_in[t]
                d_gates[:size] = d_new * old * reset * (1 - reset)
                d_gates[size : 2 * size] = d_h * (new - before) * update * (1 - update)
                d_gates[2 * size :] = d_new
                d_old = d_gates.copy()
                d_old[2 * size :] *= reset
                d_again += d_old @ before.T
                carried = d_h * (1 - update) + again.T @ d_old
            flat = d_in.transpose(1, 0, 2).reshape(3 * size, -1)
            chosen = np.zeros((x.size, 256), np.float32)
            chosen[np.arange(x.size), x.reshape(-1)] = 1
            found |= {f"{way}_in": flat @ chosen, f"{way}_again": d_again, f"{way}_out": d_out}
        return loss, found

    def train(self, x: np.ndarray, labels: np.ndarray, settings: Settings) -> list[float]:
        """Adam over random batches of ``x`` (T, N); returns the losses."""
        rng = np.random.default_rng(settings.seed)
        first = {k: np.zeros_like(w) for k, w in self.weights.items()}
        second = {k: np.zeros_like(w) for k, w in self.weights.items()}
        losses = []
        for step in range(1, settings.steps + 1):
            rows = rng.integers(0, x.shape[1], settings.batch)
            loss, found = self.gradients(x[:, rows], labels[rows])
            losses.append(loss)
            rate = settings.rate * min(1.0, 2 * (1 - (step - 1) / settings.steps))
            for k, g in found.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                unbiased = first[k] / (1 - 0.9**step)
                self.weights[k] -= (
                    rate * unbiased / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                ).astype(np.float32)
        return losses

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities over the letters of each text, a row per text."""
        counts = np.maximum(1, -(-np.diff(offsets) // SEGMENT))
        ends = np.cumsum(counts)
        of = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(of)) - (ends - counts)[of]
        begin = offsets[:-1][of] + place * SEGMENT
        stop = offsets[1:][of]
        sums = np.zeros((len(counts), len(self.languages)))
        letters = np.zeros(len(counts))
        for first in range(0, len(of), WIDTH):
            part = slice(first, first + WIDTH)
            at = begin[part] + np.arange(SEGMENT)[:, None]
            inside = at < stop[part]
            x = np.where(inside, data[np.minimum(at, max(0, len(data) - 1))], 0) if len(data) else at * 0
            weight = _LETTER[x] & inside
            p = self.probabilities(self.logits(x))
            own = np.einsum("tlb,tb->bl", p, weight.astype(np.float32))
            np.add.at(sums, of[part], own)
            np.add.at(letters, of[part], weight.sum(axis=0))
        return sums / np.maximum(letters, 1)[:, None]


def encode_segments(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All segments of all texts, padded with zeros: (T, N); and the text of each segment.

    A text has as many segments as it takes, one at least, cut as those of a document are.
    """
    cut = [text[i : i + SEGMENT] for text in texts for i in range(0, max(1, len(text)), SEGMENT)]
    of = np.repeat(np.arange(len(texts)), [max(1, -(-len(text) // SEGMENT)) for text in texts])
    padded = b"".join(part.ljust(SEGMENT, b"\0") for part in cut)
    return np.ascontiguousarray(np.frombuffer(padded, np.uint8).reshape(-1, SEGMENT).T), of


def held_out(key: Column) -> Column:
    """Rows that nothing is learned from; a null key is not among them, but gives no label either."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, settings: Settings, key: str, text: str, label: str) -> DataFrame:
    """At most ``sample_rows`` snippets with labels, as many of each language as there are.

    Raises ValueError if there are more languages than rows of the sample: each needs one.

    A snippet lies at a place of its text drawn from the key. Rows are drawn by a hash of key and
    text, first by a rate for each language that leaves a few times the rows wanted, so that
    little is shuffled from a table of any size.
    """
    width = 2 * SEGMENT
    hashed = F.xxhash64(F.col(key), F.col(text))
    room = F.greatest(F.length(text) - width, F.lit(0)) + 1
    labelled = docs.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    counts = (
        labelled.groupBy(F.col(label).cast("string").alias("language"))
        .count()
        .limit(settings.sample_rows + 1)
        .collect()
    )
    if len(counts) > settings.sample_rows:
        raise ValueError(f"more than {settings.sample_rows} languages: raise Settings.sample_rows")
    wanted = 4 * settings.sample_rows / max(1, len(counts))
    rates = [F.lit(x) for row in counts for x in (row["language"], min(1.0, wanted / row["count"]))]
    rate = F.try_element_at(F.create_map(*rates), F.col(label).cast("string")) if rates else F.lit(0.0)
    even = F.shiftrightunsigned(hashed, 11) / F.lit(float(1 << 53))
    rows = labelled.where((even < rate) & F.col(text).rlike(r"\p{L}")).select(
        F.col(label).cast("string").alias("language"),
        hashed.alias("drawn"),
        F.substring(F.col(text), (F.pmod(hashed, room) + 1).cast("int"), F.lit(width)).alias("snippet"),
    )
    turn = F.row_number().over(Window.partitionBy("language").orderBy("drawn", "snippet"))
    return (
        rows.withColumn("turn", turn)
        .where(F.col("turn") <= settings.sample_rows)
        .orderBy("turn", "language")
        .limit(settings.sample_rows)
    )


def train_network(
    docs: DataFrame,
    settings: Settings = Settings(),
    key: str = "doc_id",
    text: str = "text",
    label: str = "lang",
) -> Network | None:
    """A network trained on the sample by one task; None if no row has a label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns))
        )
        languages = sorted({language for language, *_ in rows})
        if not languages:
            return
        network = Network(settings.hidden, languages, settings.seed)
        if len(languages) > 1:
            x, of = encode_segments([snippet.encode() for _, _, snippet, _ in rows])
            network.train(x, np.array([languages.index(row[0]) for row in rows])[of], settings)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(network)])], ["network"])

    sample = training_sample(docs, settings, key, text, label)
    trained = sample.coalesce(1).mapInArrow(tidy(run), "network binary").collect()
    return pickle.loads(trained[0][0]) if trained else None


def identify(
    docs: DataFrame,
    network: Network | None,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """``keep`` columns with ``lang_pred`` and ``score``, one row per row of ``docs``.

    ``names`` are those of the two new columns, none of which may be in ``keep``.

    Only the text is read. A null text, one without a letter, or any text when there is no
    network is ``und`` with score 0. Equal probabilities go to the language first in the
    alphabet. Repeated rows stay; columns that are not in ``keep`` are left out, whatever
    their names; no rows give no rows. Long texts are read whole, some bytes at a time.
    """
    kept = docs.select(*keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column(batch.num_columns - 2).to_pylist()
            best, scores = np.zeros(len(known), int), np.zeros(len(known))
            if network:
                data, offsets = text_buffer(batch.column(batch.num_columns - 1))
                for first, last in slabs(offsets):
                    p = network.documents(data, offsets[first : last + 1])
                    best[first:last] = p.argmax(axis=1)
                    scores[first:last] = p.max(axis=1)
            found = [network.languages[i] if ok and network else UNKNOWN for i, ok in zip(best, known)]
            sure = [round(min(1.0, float(s)), 6) if ok and network else 0.0 for s, ok in zip(scores, known)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(batch.num_columns - 2)]
                + [pa.array(found, pa.string()), pa.array(sure, pa.float64())],
                [*keep, *names],
            )

    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    own = [letter.alias(unused(list(keep), "letter")), F.col(text).alias(unused(list(keep), "of_text"))]
    return docs.select(*keep, *own).mapInArrow(tidy(run), f"{fields}, `{names[0]}` string, `{names[1]}` double")
