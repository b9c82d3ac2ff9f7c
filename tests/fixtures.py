"""Builders for file fixtures: CSV variants, zips, minimal xlsx and ods."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path
from xml.sax.saxutils import escape


def write(path: Path, data: bytes | str, encoding: str = "utf-8") -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data.encode(encoding) if isinstance(data, str) else data)
    return path


def zip_bytes(entries: dict[str, bytes | str]) -> bytes:
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, data in entries.items():
            zf.writestr(name, data.encode("utf-8") if isinstance(data, str) else data)
    return buf.getvalue()


def corrupt_entry_zip(good: dict[str, str], bad_name: str) -> bytes:
    """A zip whose entry ``bad_name`` fails its CRC check when read."""
    data = zip_bytes({**good, bad_name: "x;y\n" + "1;2\n" * 50})
    raw = bytearray(data)
    marker = ("1;2\n" * 50).encode()
    # Stored compressed: flip a byte inside the bad entry's compressed data.
    with zipfile.ZipFile(io.BytesIO(bytes(raw))) as zf:
        info = zf.getinfo(bad_name)
    start = info.header_offset + 30 + len(info.filename.encode()) + len(info.extra)
    raw[start + 2] ^= 0xFF
    del marker
    return bytes(raw)


def xlsx_bytes(rows: list[list[object]]) -> bytes:
    """Minimal workbook: one sheet, inline strings and numbers."""

    def col(i: int) -> str:
        s = ""
        i += 1
        while i:
            i, r = divmod(i - 1, 26)
            s = chr(65 + r) + s
        return s

    sheet_rows = []
    for r_i, row in enumerate(rows, start=1):
        cells = []
        for c_i, v in enumerate(row):
            ref = f"{col(c_i)}{r_i}"
            if v is None:
                continue
            if isinstance(v, (int, float)):
                cells.append(f'<c r="{ref}"><v>{v}</v></c>')
            else:
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>')
        sheet_rows.append(f'<row r="{r_i}">{"".join(cells)}</row>')
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    files = {
        "[Content_Types].xml": '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
        '<Default Extension="xml" ContentType="application/xml"/></Types>',
        "xl/workbook.xml": f'<?xml version="1.0"?><workbook {ns} {rel}><sheets><sheet name="Dados" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="rId1" Type="worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<?xml version="1.0"?><worksheet {ns}><sheetData>{"".join(sheet_rows)}</sheetData></worksheet>',
    }
    return zip_bytes(files)


def ods_bytes(rows: list[list[object]]) -> bytes:
    t = "urn:oasis:names:tc:opendocument:xmlns:table:1.0"
    o = "urn:oasis:names:tc:opendocument:xmlns:office:1.0"
    x = "urn:oasis:names:tc:opendocument:xmlns:text:1.0"
    out = []
    for row in rows:
        cells = []
        for v in row:
            if v is None:
                cells.append("<table:table-cell/>")
            elif isinstance(v, (int, float)):
                cells.append(f'<table:table-cell office:value-type="float" office:value="{v}"><text:p>{v}</text:p></table:table-cell>')
            else:
                cells.append(f'<table:table-cell office:value-type="string"><text:p>{escape(str(v))}</text:p></table:table-cell>')
        cells.append('<table:table-cell table:number-columns-repeated="1000"/>')
        out.append(f"<table:table-row>{''.join(cells)}</table:table-row>")
    out.append('<table:table-row table:number-rows-repeated="1048000"><table:table-cell table:number-columns-repeated="1024"/></table:table-row>')
    content = (
        f'<?xml version="1.0"?><office:document-content xmlns:office="{o}" xmlns:table="{t}" xmlns:text="{x}">'
        f'<office:body><office:spreadsheet><table:table table:name="Dados">{"".join(out)}</table:table>'
        "</office:spreadsheet></office:body></office:document-content>"
    )
    return zip_bytes({"mimetype": "application/vnd.oasis.opendocument.spreadsheet", "content.xml": content})
