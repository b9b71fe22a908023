"""Small writers that give the readers something to read: xlsx and HTML bytes from rows of text."""

from __future__ import annotations

from io import BytesIO
from xml.sax.saxutils import escape, quoteattr
from zipfile import ZIP_DEFLATED, ZipFile, ZipInfo

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DOC_RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG_RELS = "http://schemas.openxmlformats.org/package/2006/relationships"

Cell = str | int | float | None


def _column_name(index: int) -> str:
    letters = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        letters = chr(ord("A") + rest) + letters
    return letters


def xlsx_bytes(sheets: dict[str, list[list[Cell]]], inline: bool = False) -> bytes:
    """Blank and missing cells are left out of the XML, as spreadsheet programs do."""
    shared: dict[str, int] = {}
    parts: dict[str, str] = {}
    for number, rows in enumerate(sheets.values(), start=1):
        lines = []
        for r, row in enumerate(rows, start=1):
            cells = []
            for c, value in enumerate(row):
                at = f"{_column_name(c)}{r}"
                if value is None or value == "":
                    continue
                if isinstance(value, str) and inline:
                    cells.append(f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>')
                elif isinstance(value, str):
                    cells.append(f'<c r="{at}" t="s"><v>{shared.setdefault(value, len(shared))}</v></c>')
                else:
                    cells.append(f'<c r="{at}"><v>{value}</v></c>')
            if cells:
                lines.append(f'<row r="{r}">{"".join(cells)}</row>')
        parts[f"xl/worksheets/sheet{number}.xml"] = (
            f'<worksheet xmlns="{_MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>'
        )
    strings = "".join(f'<si><t xml:space="preserve">{escape(text)}</t></si>' for text in shared)
    names = "".join(
        f'<sheet name={quoteattr(name)} sheetId="{i}" r:id="rId{i}"/>' for i, name in enumerate(sheets, start=1)
    )
    links = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
    parts["xl/sharedStrings.xml"] = f'<sst xmlns="{_MAIN}">{strings}</sst>'
    parts["xl/workbook.xml"] = f'<workbook xmlns="{_MAIN}" xmlns:r="{_DOC_RELS}"><sheets>{names}</sheets></workbook>'
    parts["xl/_rels/workbook.xml.rels"] = f'<Relationships xmlns="{_PKG_RELS}">{links}</Relationships>'
    buffer = BytesIO()
    with ZipFile(buffer, "w") as archive:
        for part, text in parts.items():
            info = ZipInfo(part)
            info.compress_type = ZIP_DEFLATED
            archive.writestr(info, f'<?xml version="1.0" encoding="UTF-8"?>{text}')
    return buffer.getvalue()


def html_bytes(tables: list[list[list[str]]], encoding: str = "cp932") -> bytes:
    body = "".join(
        "<table>" + "".join("<tr>" + "".join(f"<td>{escape(v)}</td>" for v in row) + "</tr>" for row in rows) + "</table>"
        for rows in tables
    )
    return f"<html><body>{body}</body></html>".encode(encoding)
