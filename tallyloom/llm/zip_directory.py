"""The directory of a ZIP file, read by ranges: where its members lie, without extracting any."""

from __future__ import annotations

import struct
from collections.abc import Callable
from dataclasses import dataclass

#: ``read(offset, length)`` gives the bytes of a range of the file.
Reader = Callable[[int, int], bytes]

# Fixed values of the format: record marks, and layouts after the mark.
END, END64_PLACE, END64, ENTRY, LOCAL = b"PK\5\6", b"PK\6\7", b"PK\6\6", b"PK\1\2", b"PK\3\4"
END_LAYOUT = struct.Struct("<4x4H2LH")
END64_PLACE_LAYOUT = struct.Struct("<4xLQL")
END64_LAYOUT = struct.Struct("<4xQ2H2L4Q")
ENTRY_LAYOUT = struct.Struct("<4x6H3L5H2L")
LOCAL_LAYOUT = struct.Struct("<4x5H3L2H")
SHORT, LONG = 0xFFFF, 0xFFFFFFFF
ZIP64_FIELD = 1
STORED = 0
LONGEST_COMMENT = 0xFFFF


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    header: int
    """Place of its local header."""
    size: int
    """Bytes as they lie in the file."""


def _directory_range(read: Reader, size: int) -> tuple[int, int, int]:
    """Place and length of the central directory, and the number of its entries."""
    tail_at = max(0, size - END_LAYOUT.size - LONGEST_COMMENT)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0:  # the mark may also stand in a comment
        if at + END_LAYOUT.size <= len(tail):
            *_, entries, length, place, comment = END_LAYOUT.unpack_from(tail, at)
            if at + END_LAYOUT.size + comment == len(tail):
                break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP file: no end of a central directory")
    end = tail_at + at
    if LONG not in (length, place) and entries != SHORT:
        return place, length, entries
    before = end - END64_PLACE_LAYOUT.size
    mark = read(before, END64_PLACE_LAYOUT.size) if before >= 0 else b""
    if not mark.startswith(END64_PLACE):
        return place, length, entries
    _, end64, _ = END64_PLACE_LAYOUT.unpack(mark)
    record = read(end64, END64_LAYOUT.size)
    if not record.startswith(END64):
        raise ValueError("the ZIP64 end of the central directory is not where its locator points")
    *_, entries, length, place = END64_LAYOUT.unpack(record)
    return place, length, entries


def _wide(extra: bytes, size: int, stored: int, header: int) -> tuple[int, int]:
    """Stored size and header place, from the ZIP64 field for those that did not fit."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == ZIP64_FIELD:
            wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            if size == LONG:
                next(wide)
            if stored == LONG:
                stored = next(wide)
            if header == LONG:
                header = next(wide)
            break
        at += 4 + length
    return stored, header


def members(read: Reader, size: int) -> list[Member]:
    """All members of a ZIP file of ``size`` bytes, in the order of its central directory.

    Reads the end of the file, the ZIP64 records if there are any and the central directory.
    Raises ValueError if these are damaged.
    """
    place, length, entries = _directory_range(read, size)
    directory = read(place, length)
    found, at = [], 0
    for _ in range(entries):
        if not directory.startswith(ENTRY, at) or at + ENTRY_LAYOUT.size > len(directory):
            raise ValueError("the central directory is damaged")
        _, _, flags, method, _, _, _, stored, whole, name, extra, comment, _, _, _, header = ENTRY_LAYOUT.unpack_from(
            directory, at
        )
        at += ENTRY_LAYOUT.size
        text = directory[at : at + name].decode("utf-8" if flags & 0x800 else "cp437")
        stored, header = _wide(directory[at + name : at + name + extra], whole, stored, header)
        found.append(Member(text, method, header, stored))
        at += name + extra + comment
    return found


def stored_range(read: Reader, member: Member) -> tuple[int, int]:
    """Place and length of the bytes of a stored member. Raises ValueError if it is compressed."""
    if member.method != STORED:
        raise ValueError(f"{member.name} is compressed: it cannot be read by ranges")
    head = read(member.header, LOCAL_LAYOUT.size)
    if not head.startswith(LOCAL):
        raise ValueError(f"no local header where the directory has {member.name}")
    *_, name, extra = LOCAL_LAYOUT.unpack(head)
    return member.header + LOCAL_LAYOUT.size + name + extra, member.size
