"""Binary workbooks written by tasks, for the landing folders of queries and tests."""

from __future__ import annotations

import datetime as dt
import struct
from collections.abc import Sequence

from fiscalflow.sources import xls as X

#: A record holds at most this many bytes; longer shared strings go on in the next.
RECORD = 8224


def record(number: int, data: bytes) -> bytes:
    return struct.pack("<HH", number, len(data)) + data


def text(value: str, size: str = "<H") -> bytes:
    """A counted string, with two bytes a character where one does not do."""
    narrow = value.isascii()
    raw = value.encode("latin-1" if narrow else "utf-16-le")
    return struct.pack(size, len(raw) if narrow else len(raw) // 2) + bytes([0 if narrow else 1]) + raw


def shared(values: Sequence[str], limit: int = RECORD) -> bytes:
    """The shared string records; characters are cut where a record is full."""
    parts, here = [], bytearray(struct.pack("<II", len(values), len(values)))
    for value in values:
        narrow = value.isascii()
        step, flag = (1, 0) if narrow else (2, 1)
        raw = value.encode("latin-1" if narrow else "utf-16-le")
        if len(here) + 3 + step > limit:
            parts.append(bytes(here))
            here = bytearray()
        here += struct.pack("<HB", len(raw) // step, flag)
        while raw:
            room = (limit - len(here)) // step * step
            here += raw[:room]
            raw = raw[room:]
            if raw:
                parts.append(bytes(here))
                here = bytearray([flag])
    parts.append(bytes(here))
    return b"".join(record(X.SST if k == 0 else X.CONTINUE, p) for k, p in enumerate(parts))


def rk(value: float) -> int | None:
    """The 30-bit form of a number, if it has one."""
    if float(value).is_integer() and -(1 << 29) <= value < 1 << 29:
        return ((int(value) << 2) | 2) & 0xFFFFFFFF
    cents = round(value * 100)
    if cents / 100 == value and -(1 << 29) <= cents < 1 << 29:
        return ((cents << 2) | 3) & 0xFFFFFFFF
    (bits,) = struct.unpack("<Q", struct.pack("<d", value))
    return bits >> 32 if not bits & 0x3FFFFFFFF else None


def workbook(rows: Sequence[Sequence[object]], date_1904: bool = False, limit: int = RECORD) -> bytes:
    """The workbook stream of one sheet: texts, numbers, dates, booleans; None is no cell, a bytes value a raw record."""
    strings: dict[str, int] = {}
    cells = []
    epoch = X.EPOCH_1904 if date_1904 else X.EPOCH
    for r, row in enumerate(rows):
        for c, v in enumerate(row):
            if isinstance(v, bytes):
                cells.append(v)
            elif isinstance(v, bool):
                cells.append(record(X.BOOLERR, struct.pack("<HHHBB", r, c, 0, v, 0)))
            elif isinstance(v, dt.datetime):
                cells.append(record(X.NUMBER, struct.pack("<HHHd", r, c, 1, (v - epoch).total_seconds() / 86_400)))
            elif isinstance(v, (int, float)):
                packed = rk(v)
                cells.append(record(X.NUMBER, struct.pack("<HHHd", r, c, 0, v)) if packed is None else record(X.RK, struct.pack("<HHHI", r, c, 0, packed)))
            elif v is not None:
                cells.append(record(X.LABELSST, struct.pack("<HHHI", r, c, 0, strings.setdefault(v, len(strings)))))
    style = lambda shown: record(X.XF, struct.pack("<HH16x", 0, shown))
    before = record(X.BOF, struct.pack("<HHHHII", 0x0600, 5, 0, 0, 0, 6)) + record(X.DATEMODE, struct.pack("<H", date_1904)) + record(X.FORMAT, struct.pack("<H", 164) + text("yyyy\\-mm\\-dd"))
    before += style(0) + style(14) + style(164)
    after = shared(list(strings), limit) + record(X.EOF, b"")
    sheet = lambda at: record(X.BOUNDSHEET, struct.pack("<IBB", at, 0, 0) + text("dados", "<B"))
    start = len(before) + len(sheet(0)) + len(after)
    return before + sheet(start) + after + record(X.BOF, struct.pack("<HHHHII", 0x0600, 16, 0, 0, 0, 6)) + b"".join(cells) + record(X.EOF, b"")


def compound(stream: bytes, name: str = "Workbook", size: int = 512) -> bytes:
    """A compound file of one stream; one under 4096 bytes is a small stream."""
    per, small = size // 4, len(stream) < 4096
    sectors: list[bytes] = []
    fat: list[int] = []

    def add(raw: bytes) -> int:
        """A chain of sectors; the number of its first."""
        first = len(sectors)
        n = max(1, -(-len(raw) // size))
        sectors.extend(raw[k * size : (k + 1) * size].ljust(size, b"\0") for k in range(n))
        fat.extend([*range(first + 1, first + n), X.END_OF_CHAIN])
        return first

    data = add(stream)
    mini_fat = X.END_OF_CHAIN
    if small:
        n = -(-len(stream) // 64)
        mini_fat = add(struct.pack(f"<{n}I", *range(1, n), X.END_OF_CHAIN).ljust(size, b"\xff"))

    def entry(label: str, kind: int, start: int, length: int, child: int = X.FREE) -> bytes:
        raw = label.encode("utf-16-le") + b"\0\0"
        return raw.ljust(64, b"\0") + struct.pack("<HBBIII", len(raw), kind, 1, X.FREE, X.FREE, child) + bytes(36) + struct.pack("<III", start, length, 0)

    root = entry("Root Entry", 5, data if small else X.END_OF_CHAIN, -(-len(stream) // 64) * 64 if small else 0, 1)
    directory = add(root + entry(name, 2, 0 if small else data, len(stream)))
    n_fat = n_difat = 0
    while True:  # the tables are listed in themselves
        total = len(sectors) + n_fat + n_difat
        need = -(-total // per)
        more = max(0, -(-(need - 109) // (per - 1)))
        if (need, more) == (n_fat, n_difat):
            break
        n_fat, n_difat = need, more
    places = list(range(len(sectors), len(sectors) + n_fat))
    first_difat = len(sectors) + n_fat
    table = fat + [0xFFFFFFFD] * n_fat + [0xFFFFFFFC] * n_difat
    table += [X.FREE] * (n_fat * per - len(table))
    sectors += [struct.pack(f"<{per}I", *table[k * per : (k + 1) * per]) for k in range(n_fat)]
    rest = places[109:]
    for k in range(n_difat):
        part = rest[k * (per - 1) : (k + 1) * (per - 1)]
        sectors.append(struct.pack(f"<{per}I", *part, *[X.FREE] * (per - 1 - len(part)), first_difat + k + 1 if k + 1 < n_difat else X.END_OF_CHAIN))
    listed = places[:109] + [X.FREE] * max(0, 109 - len(places))
    head = X.SIGNATURE + bytes(16) + struct.pack("<HHHHH", 0x3E, 3 if size == 512 else 4, 0xFFFE, size.bit_length() - 1, 6) + bytes(6)
    head += struct.pack("<IIIIIIIII", 0, n_fat, directory, 0, 4096, mini_fat, int(small), first_difat if n_difat else X.END_OF_CHAIN, n_difat)
    return (head + struct.pack("<109I", *listed)).ljust(size, b"\0") + b"".join(sectors)


def xls_bytes(rows: Sequence[Sequence[object]], **options) -> bytes:
    return compound(workbook(rows, **options))
