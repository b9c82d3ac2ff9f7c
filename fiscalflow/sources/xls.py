"""Binary workbooks (``.xls``, BIFF8): the first sheet's rows as text cells.

A workbook is a compound file: sectors linked by an allocation table, small
streams kept in a stream of their own.  The workbook stream is a row of
records; those that hold cells, shared strings, number formats and the day
count's epoch are read, one after the other, from the sectors as they come,
so only the shared strings and a window of rows are held.  Whatever the other
records say (layout, charts, macros) is passed over.

Values are as those of ``.xlsx``: whole numbers without a point, dates by
their number format as ``yyyy-mm-dd``, a formula by its stored result.
"""

from __future__ import annotations

import datetime as dt
import re
import struct
from collections.abc import Iterator
from typing import BinaryIO

# Fixed values of the file formats: signature, sector marks, record numbers, error codes.
SIGNATURE = bytes.fromhex("D0CF11E0A1B11AE1")
FREE, END_OF_CHAIN = 0xFFFFFFFF, 0xFFFFFFFE
BOF, EOF, CONTINUE, SST, BOUNDSHEET, FORMAT, XF, DATEMODE, FILEPASS = 0x0809, 0x000A, 0x003C, 0x00FC, 0x0085, 0x041E, 0x00E0, 0x0022, 0x002F
LABELSST, LABEL, RSTRING, NUMBER, RK, MULRK, FORMULA, STRING, BOOLERR = 0x00FD, 0x0204, 0x00D6, 0x0203, 0x027E, 0x00BD, 0x0006, 0x0207, 0x0205
ERRORS = {0x00: "#NULL!", 0x07: "#DIV/0!", 0x0F: "#VALUE!", 0x17: "#REF!", 0x1D: "#NAME?", 0x24: "#NUM!", 0x2A: "#N/A"}
EPOCH, EPOCH_1904 = dt.datetime(1899, 12, 30), dt.datetime(1904, 1, 1)
#: Rows that may come out of order.
WINDOW = 1024


class CompoundFile:
    """Streams of a compound file, read by sector."""

    def __init__(self, fh: BinaryIO) -> None:
        self.fh = fh
        head = self._read(0, 512)
        if head[:8] != SIGNATURE:
            raise ValueError("not a compound file")
        self.size, self.mini = 1 << struct.unpack_from("<H", head, 30)[0], 1 << struct.unpack_from("<H", head, 32)[0]
        n_fat, first_dir, _, self.cutoff, first_mini, _, difat, n_difat = struct.unpack_from("<IIIIIIII", head, 44)
        if self.size not in (512, 4096) or self.mini != 64:
            raise ValueError("damaged compound file header")
        places = list(struct.unpack_from("<109I", head, 76))
        for _ in range(n_difat):
            if difat >= END_OF_CHAIN:
                break
            *more, difat = struct.unpack(f"<{self.size // 4}I", self._sector(difat))
            places += more
        per = self.size // 4
        self.fat: list[int] = []
        for s in places[:n_fat]:
            if s < END_OF_CHAIN:
                self.fat += struct.unpack(f"<{per}I", self._sector(s))
        directory = b"".join(self._chain(first_dir))
        self.entries = {}
        self.root = None
        for at in range(0, len(directory) - 127, 128):
            n, kind = struct.unpack_from("<HB", directory, at + 64)
            start, length = struct.unpack_from("<II", directory, at + 116)
            name = directory[at : at + max(0, n - 2)].decode("utf-16-le", "replace")
            if kind == 5:
                self.root = (start, length)
            elif kind == 2:
                self.entries[name] = (start, length)
        self.mini_fat: list[int] = []
        for raw in self._chain(first_mini):
            self.mini_fat += struct.unpack(f"<{per}I", raw)

    def _read(self, at: int, n: int) -> bytes:
        self.fh.seek(at)
        raw = self.fh.read(n)
        if len(raw) < n and at + len(raw) < 512:
            raise ValueError("the file is cut off")
        return raw.ljust(n, b"\0")

    def _sector(self, number: int) -> bytes:
        self.fh.seek((number + 1) * self.size)
        raw = self.fh.read(self.size)
        if not raw:
            raise ValueError("the file is cut off")
        return raw.ljust(self.size, b"\0")

    def _chain(self, number: int) -> Iterator[bytes]:
        for _ in range(len(self.fat) + 1):
            if number >= END_OF_CHAIN:
                return
            yield self._sector(number)
            if number >= len(self.fat):
                raise ValueError("a sector is not in the allocation table")
            number = self.fat[number]
        raise ValueError("sectors run in a circle")

    def _small(self, number: int) -> Iterator[bytes]:
        whole = b"".join(self._chain(self.root[0]))
        for _ in range(len(self.mini_fat) + 1):
            if number >= END_OF_CHAIN:
                return
            yield whole[number * self.mini : (number + 1) * self.mini]
            if number >= len(self.mini_fat):
                raise ValueError("a small sector is not in the allocation table")
            number = self.mini_fat[number]
        raise ValueError("small sectors run in a circle")

    def stream(self, name: str) -> Iterator[bytes]:
        """The stream's bytes, a sector at a time."""
        start, length = self.entries[name]
        for raw in self._small(start) if length < self.cutoff else self._chain(start):
            yield raw[:length]
            length -= len(raw)
            if length <= 0:
                return
        raise ValueError("a stream ends too soon")


def biff_records(chunks: Iterator[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(place, number, data) of the records of a stream."""
    held, base = bytearray(), 0
    for chunk in chunks:
        held += chunk
        at = 0
        while len(held) - at >= 4:
            number, n = struct.unpack_from("<HH", held, at)
            if len(held) - at < 4 + n:
                break
            yield base + at, number, bytes(held[at + 4 : at + 4 + n])
            at += 4 + n
        del held[:at]
        base += at


class _Strings:
    """A reader of counted strings over a record and the records that continue it."""

    def __init__(self, parts: list[bytes]) -> None:
        self.parts, self.part, self.at = parts, 0, 0

    def take(self, n: int) -> bytes:
        out = b""
        while n:
            if self.part >= len(self.parts):
                raise ValueError("a shared string ends too soon")
            raw = self.parts[self.part][self.at : self.at + n]
            out += raw
            n -= len(raw)
            self.at += len(raw)
            if self.at >= len(self.parts[self.part]):
                self.part, self.at = self.part + 1, 0
        return out

    def characters(self, n: int, wide: bool) -> str:
        """Characters may go on in the next record, whose first byte says anew whether they have two bytes."""
        out = []
        while n:
            if self.part >= len(self.parts):
                raise ValueError("a shared string ends too soon")
            here = (len(self.parts[self.part]) - self.at) // (2 if wide else 1)
            some = min(n, here)
            raw = self.take(some * (2 if wide else 1)) if some else b""
            out.append(raw.decode("utf-16-le" if wide else "latin-1", "surrogatepass" if wide else "strict"))
            n -= some
            if n:
                if not some:  # nothing but an odd byte was left
                    self.part, self.at = self.part + 1, 0
                wide = bool(self.take(1)[0] & 1)
        return "".join(out).encode("utf-16", "surrogatepass").decode("utf-16", "replace") if out else ""

    def string(self, size: str = "<H") -> str:
        (n,) = struct.unpack(size, self.take(struct.calcsize(size)))
        flags = self.take(1)[0]
        runs = struct.unpack("<H", self.take(2))[0] if flags & 8 else 0
        extra = struct.unpack("<I", self.take(4))[0] if flags & 4 else 0
        text = self.characters(n, bool(flags & 1))
        self.take(4 * runs + extra)
        return text


def shared_strings(parts: list[bytes]) -> list[str]:
    reader = _Strings([p for p in parts if p])
    _, n = struct.unpack("<II", reader.take(8))
    return [reader.string() for _ in range(n)]


def rk_number(raw: int) -> float:
    """A number packed into 30 bits: a whole one or the upper part of a double, perhaps in hundredths."""
    value = float((raw - (1 << 32) if raw & 0x80000000 else raw) >> 2) if raw & 2 else struct.unpack("<d", struct.pack("<Q", (raw & 0xFFFFFFFC) << 32))[0]
    return value / 100 if raw & 1 else value


class _Formats:
    """Which cell styles show dates, and how numbers are written."""

    def __init__(self) -> None:
        self.own: dict[int, bool] = {}
        self.styles: list[int] = []
        self.epoch = EPOCH

    def number(self, value: float, style: int) -> str:
        from fiscalflow.sources.sheets import DAY_FORMATS, iso_date

        shown = self.styles[style] if style < len(self.styles) else 0
        if self.own.get(shown, shown in DAY_FORMATS):
            return iso_date(value, self.epoch)
        return str(int(value)) if value.is_integer() and abs(value) < 1e15 else repr(value)


def _text(data: bytes, at: int, size: str = "<H") -> str:
    return _Strings([data[at:]]).string(size)


def rows(fh: BinaryIO) -> Iterator[list[str | None]]:
    """Rows of the first worksheet, as many as the last that has a cell; blank rows between are empty."""
    book = CompoundFile(fh)
    name = next((n for n in ("Workbook", "Book") if n in book.entries), None)
    if name is None:
        raise ValueError("no workbook in the file")
    formats, strings, sheet, parts = _Formats(), [], None, None
    held: dict[int, dict[int, str]] = {}
    done = -1
    waiting: tuple[int, int] | None = None  # a formula whose text comes in a record of its own
    for place, number, data in biff_records(book.stream(name)):
        if parts is not None and number != CONTINUE:
            strings, parts = shared_strings(parts), None
        if number == BOF and len(data) >= 4:
            if struct.unpack_from("<H", data, 0)[0] != 0x0600:
                raise ValueError("an older workbook format than BIFF8")
        elif number == FILEPASS:
            raise ValueError("the workbook is encrypted")
        elif number == DATEMODE:
            formats.epoch = EPOCH_1904 if struct.unpack_from("<H", data, 0)[0] else EPOCH
        elif number == FORMAT:
            shown = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", _text(data, 2))
            formats.own[struct.unpack_from("<H", data, 0)[0]] = bool(re.search(r"[yd]", shown, re.IGNORECASE))
        elif number == XF:
            formats.styles.append(struct.unpack_from("<H", data, 2)[0])
        elif number == BOUNDSHEET:
            at, _, kind = struct.unpack_from("<IBB", data, 0)
            if kind == 0 and sheet is None:
                sheet = at
        elif number == SST:
            parts = [data]
        elif number == CONTINUE and parts is not None:
            parts.append(data)
        elif sheet is not None and place > sheet:
            if number == EOF:
                break
            for row, col, value in _cells(number, data, strings, formats, waiting):
                if row <= done:
                    raise ValueError(f"row {row + 1} comes after row {done + 1}")
                if value is not None:
                    held.setdefault(row, {})[col] = value
            if number == FORMULA:
                waiting = struct.unpack_from("<HH", data, 0)
            if held and len(held) > 2 * WINDOW:
                for r in sorted(held)[:WINDOW]:
                    yield from _filled(held.pop(r), r - done - 1)
                    done = r
    else:
        raise ValueError("the first sheet has no end" if sheet is not None else "the workbook has no sheet")
    for r in sorted(held):
        yield from _filled(held[r], r - done - 1)
        done = r


def _filled(cells: dict[int, str], blank: int) -> Iterator[list[str | None]]:
    for _ in range(blank):
        yield []
    yield [cells.get(c) for c in range(max(cells) + 1)]


def _cells(number: int, data: bytes, strings: list[str], formats: _Formats, waiting: tuple[int, int] | None) -> Iterator[tuple[int, int, str | None]]:
    """(row, column, text) of a cell record."""
    if number in (LABELSST, LABEL, RSTRING, NUMBER, RK, FORMULA, BOOLERR):
        row, col, style = struct.unpack_from("<HHH", data, 0)
        if number == LABELSST:
            yield row, col, strings[struct.unpack_from("<I", data, 6)[0]]
        elif number in (LABEL, RSTRING):
            yield row, col, _text(data, 6)
        elif number == NUMBER:
            yield row, col, formats.number(struct.unpack_from("<d", data, 6)[0], style)
        elif number == RK:
            yield row, col, formats.number(rk_number(struct.unpack_from("<I", data, 6)[0]), style)
        elif number == BOOLERR:
            yield row, col, _bool_or_error(data[6], data[7])
        elif data[12:14] != b"\xff\xff":
            yield row, col, formats.number(struct.unpack_from("<d", data, 6)[0], style)
        elif data[6] in (1, 2):
            yield row, col, _bool_or_error(data[8], data[6] - 1)
    elif number == MULRK:
        row, col = struct.unpack_from("<HH", data, 0)
        for k in range((len(data) - 6) // 6):
            style, raw = struct.unpack_from("<HI", data, 4 + 6 * k)
            yield row, col + k, formats.number(rk_number(raw), style)
    elif number == STRING and waiting is not None:
        yield *waiting, _text(data, 0)


def _bool_or_error(value: int, is_error: int) -> str:
    return ERRORS.get(value, f"#{value}") if is_error else ("true" if value else "false")
