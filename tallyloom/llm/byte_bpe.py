"""Byte-level BPE, encoded by backtracking over longest matches.

A sequence of tokens is the BPE encoding of its bytes exactly when every two neighbours
are: when merging the bytes of the two alone gives the two back. So the encoder
takes the longest token at each place, keeps it if it is compatible with the token before
it, else tries the next shorter one, and drops the token before when none is left. Places
from which no encoding goes on are marked, so every place is left once at most and the
time is linear in the text. Compatibility is decided once for a pair and remembered.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.tables import tidy

#: Pieces whose ids a worker remembers, and pairs of tokens.
PIECES = 400_000
PAIRS = 400_000
#: Pieces of a text that are looked up in one go, and bytes of ids that leave a task together.
BLOCK = 65_536
OUT_BYTES = 4 << 20


class ByteBpe:
    """``ranks``: token bytes to id, a smaller id merging earlier. ``pattern`` cuts a text into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces_of = regex.compile(pattern)
        self.token = {rank: token for token, rank in ranks.items()}
        self.compatible = lru_cache(PAIRS)(self._compatible)
        self.length = {rank: len(token) for rank, token in self.token.items()}
        # The longest token that is a proper beginning of a token.
        self.shorter = {
            rank: ranks[begin]
            for token, rank in ranks.items()
            if (begin := next((token[:n] for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), None))
        }
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.known = _Known(self)

    def _merge(self, data: bytes) -> list[bytes]:
        """BPE by its definition; only for the bytes of one or two tokens."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, 1 << 40) for a, b in zip(parts, parts[1:])]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[at] == 1 << 40:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, left: int, right: int) -> bool:
        a, b = self.token[left], self.token[right]
        return self._merge(a + b) == [a, b]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece, merged as far as the ranks go."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        latin = piece.decode("latin-1")
        # No step back is needed where all longest matches suit their neighbours.
        ids = [rank for _, (_, rank) in self.automaton.iter_long(latin)]
        if all(map(self.compatible, ids, islice(ids, 1, None))):
            return ids
        return self._backtrack(latin)

    def _backtrack(self, latin: str) -> list[int]:
        size = len(latin)
        longest = [-1] * size
        for end, (length, rank) in self.automaton.iter(latin):  # longer ones come later
            longest[end + 1 - length] = rank
        dead = bytearray(size + 1)
        ids: list[int] = []
        place, rank = 0, longest[0]
        while place < size:
            after = place + self.length[rank]
            if not dead[after] and (not ids or self.compatible(ids[-1], rank)):
                ids.append(rank)
                place = after
                rank = longest[place] if place < size else -1
                continue
            rank = self.shorter.get(rank, -1)
            while rank == -1:
                if not ids:
                    raise ValueError("the ranks lack a single byte of the text")
                dead[place] = 1
                last = ids.pop()
                place -= self.length[last]
                rank = self.shorter.get(last, -1)
        return ids

    def blocks(self, text: str) -> Iterator[bytes]:
        """Ids of a text as little-endian unsigned 32-bit integers, some pieces at a time."""
        if len(text) <= BLOCK:
            yield b"".join(map(self.known.__getitem__, self.pieces_of.findall(text)))
            return
        found = self.pieces_of.finditer(text)
        while block := [m[0] for m in islice(found, BLOCK)]:
            yield b"".join(map(self.known.__getitem__, block))

    def encode(self, text: str) -> list[int]:
        return [i for (i,) in struct.iter_unpack("<I", b"".join(self.blocks(text)))]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class _Known(dict):
    """Packed ids by piece; emptied when full, so its memory is bounded."""

    def __init__(self, bpe: ByteBpe):
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= PIECES:
            self.clear()
        ids = self.bpe.encode_piece(piece.encode("utf-8"))
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) < 64:
            self[piece] = packed
        return packed


@lru_cache(4)
def load(path: str, pattern: str) -> ByteBpe:
    """Reads a rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return ByteBpe({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(
    docs: DataFrame,
    path: str,
    pattern: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    with_ids: bool = False,
) -> DataFrame:
    """``keep`` columns, number of tokens, hash of the ids and hash of the decoded bytes.

    ``path`` is a rank file that every executor can open, as an installed vocabulary is.
    A null text is an empty one: no tokens, hashes of nothing. Repeated rows stay, each
    with its own result; other columns than ``keep`` are left out, whatever their names.
    ``with_ids`` adds the column ``ids``. An empty table gives an empty result.
    """
    kept = docs.select(*keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    schema = f"{fields}, {DIGEST}" + (", ids array<int>" if with_ids else "")

    def rows_of(bpe: ByteBpe, column: pa.Array) -> Iterator[tuple[int, str, str, bytes]]:
        for value in column:
            hashed, decoded, own, count = hashlib.sha256(), hashlib.sha256(), [], 0
            for packed in bpe.blocks(value.as_py() or ""):
                hashed.update(packed)
                decoded.update(bpe.decode(memoryview(packed).cast("I")))
                count += len(packed) // 4
                if with_ids:
                    own.append(packed)
            yield count, hashed.hexdigest(), decoded.hexdigest(), b"".join(own)

    def record_batch(kept: list[pa.Array], rows: list[tuple[int, str, str, bytes]]) -> pa.RecordBatch:
        counts, ids_hashes, decoded_hashes, ids = zip(*rows)
        columns = [pa.array(counts, pa.int64()), pa.array(ids_hashes), pa.array(decoded_hashes)]
        names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            ends = np.concatenate([[0], np.cumsum(counts)])
            values = np.frombuffer(b"".join(ids), "<i4")
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values)))
            names.append("ids")
        return pa.RecordBatch.from_arrays([*kept, *columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            *others, texts = batch.columns
            first, rows, held = 0, [], 0
            for row in rows_of(bpe, texts):
                rows.append(row)
                held += len(row[3])
                if held > OUT_BYTES or first + len(rows) == len(texts):
                    yield record_batch([column.slice(first, len(rows)) for column in others], rows)
                    first, rows, held = first + len(rows), [], 0

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(tidy(run), schema)
