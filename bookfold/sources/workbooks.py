"""Read one spreadsheet or HTML file into rows of cell text. Used inside the tasks of ``extract``."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import suppress
from datetime import datetime, timedelta
from html import unescape
from html.parser import HTMLParser
from io import BytesIO
from xml.etree.ElementTree import Element, ParseError, fromstring, iterparse
from zipfile import BadZipFile, ZipFile

SheetRow = tuple[str, int, list[str]]

# Cell texts that stand for "no value".
NO_VALUE = frozenset(
    ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
)
# The built-in spreadsheet number formats that show a date or a time.
DATE_FORMAT_IDS = frozenset([*range(14, 23), *range(45, 48)])
DURATION_FORMAT_IDS = frozenset([46])
# Encodings tried in turn on HTML bytes.
HTML_ENCODINGS = ("cp932", "utf-8", "shift_jis")

_SMALL_PART = 1 << 16
_REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_DAY_ZERO = {False: datetime(1899, 12, 30), True: datetime(1904, 1, 1)}


def _tag(node: Element) -> str:
    return node.tag.rpartition("}")[2]


def _children(node: Element, tag: str) -> list[Element]:
    return [child for child in node if _tag(child) == tag]


def _all(archive: ZipFile, part: str, tag: str) -> Iterator[Element]:
    """Small parts are parsed at once; large ones, and those that do not parse, as a stream."""
    if archive.getinfo(part).file_size <= _SMALL_PART:
        with suppress(ParseError, BadZipFile):
            yield from [node for node in fromstring(archive.read(part)).iter() if _tag(node) == tag]
            return
    with archive.open(part) as stream:
        for _, node in iterparse(stream):
            if _tag(node) == tag:
                yield node
                node.clear()


def _rich_text(node: Element) -> str:
    """Plain and styled runs; phonetic hints are not part of the text."""
    runs = _children(node, "t") + [t for run in _children(node, "r") for t in _children(run, "t")]
    return "".join(t.text or "" for t in runs)


def _format_codes(archive: ZipFile) -> list[str | int]:
    """Per cell style: the custom format code, or the built-in format id."""
    if "xl/styles.xml" not in archive.namelist():
        return []
    custom, styles = {}, []
    with archive.open("xl/styles.xml") as stream:
        for _, node in iterparse(stream):
            if _tag(node) == "numFmt":
                custom[int(node.get("numFmtId"))] = node.get("formatCode", "")
            elif _tag(node) == "cellXfs":
                styles = [int(xf.get("numFmtId", "0")) for xf in _children(node, "xf")]
    return [custom.get(i, i) for i in styles]


def _number_style(code: str | int) -> str:
    if isinstance(code, int):
        return "duration" if code in DURATION_FORMAT_IDS else "date" if code in DATE_FORMAT_IDS else "number"
    first = code.split(";")[0]
    if re.search(r"\[(h+|m+|s+)\]", first, re.IGNORECASE):
        return "duration"
    plain = re.sub(r'"[^"]*"|\[[^\]]*\]', "", first)
    return "date" if re.search(r"(?<![_\\])[dmhys]", plain, re.IGNORECASE) else "number"


def _number_text(text: str, style: str, base_1904: bool) -> str:
    number = float(text) if re.search(r"[.eE]", text) else int(text)
    if style == "number":
        return str(int(number)) if number == int(number) else str(number)
    whole, part = divmod(number, 1)
    moment = timedelta(days=int(whole), milliseconds=round(part * 86_400_000))
    if style == "duration":
        return str(moment)
    if 0 <= number < 1 and moment < timedelta(days=1):
        return str((datetime.min + moment).time())
    if not base_1904 and 0 < number < 60:  # serials before the fictitious 1900-02-29
        moment += timedelta(days=1)
    return str(_DAY_ZERO[base_1904] + moment)


def _cell_text(cell: Element, strings: list[str], styles: list[str], base_1904: bool) -> str:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(_rich_text(node) for node in _children(cell, "is"))
    value = next((v.text for v in _children(cell, "v")), None)
    if value is None or kind == "e":
        return ""
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return str(value.strip() not in ("0", "false"))
    if kind == "d":
        return str(datetime.fromisoformat(value))
    if kind == "str":
        return value
    style = int(cell.get("s", "0"))
    return _number_text(value.strip(), styles[style] if style < len(styles) else "number", base_1904)


def _column_index(reference: str) -> int:
    index = 0
    for letter in reference:
        if not letter.isalpha():
            break
        index = index * 26 + ord(letter.upper()) - ord("A") + 1
    return index - 1


def xlsx_rows(payload: bytes) -> Iterator[SheetRow]:
    """All sheets in workbook order. Row numbers are the sheet's own; a blank row between rows is a row."""
    with ZipFile(BytesIO(payload)) as archive:
        parts = set(archive.namelist())
        links = {r.get("Id"): r.get("Target") for r in _all(archive, "xl/_rels/workbook.xml.rels", "Relationship")}
        strings = []
        if "xl/sharedStrings.xml" in parts:
            strings = [_rich_text(si).replace("x005F_", "") for si in _all(archive, "xl/sharedStrings.xml", "si")]
        styles = [_number_style(code) for code in _format_codes(archive)]
        base_1904 = any(p.get("date1904") in ("1", "true") for p in _all(archive, "xl/workbook.xml", "workbookPr"))
        sheets = [(s.get("name"), links[s.get(_REL_ID)]) for s in _all(archive, "xl/workbook.xml", "sheet")]
        for name, target in sheets:
            part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            if part in parts:  # chart sheets have no rows
                yield from _sheet_rows(archive, part, name, strings, styles, base_1904)


def _sheet_rows(archive, part, name, strings, styles, base_1904) -> Iterator[SheetRow]:
    emitted = position = 0
    for row in _all(archive, part, "row"):
        position = int(row.get("r", position + 1))
        cells: list[str] = []
        for cell in _children(row, "c"):
            column = _column_index(cell.get("r", "")) if cell.get("r") else len(cells)
            cells.extend([""] * (column - len(cells)))
            cells.append(_cell_text(cell, strings, styles, base_1904))
        while cells and cells[-1] == "":
            cells.pop()
        if cells:  # rows left blank are written only once a later row has text
            for blank in range(emitted + 1, position):
                yield name, blank, []
            yield name, position, ["" if text in NO_VALUE else text for text in cells]
            emitted = position


_SPACE = r"[ \t\r\n\f]"
# Tags between which text is text, in the plain form; what else there may be is left to the full parser.
_PLAIN_TAGS = "html|body|table|thead|tbody|tfoot|tr|td|th|br|p|b|i|u|a|span|div|font|center|strong|em|colgroup|col|caption"
_PLAIN_ATTRIBUTE = rf"""{_SPACE}+([a-zA-Z][a-zA-Z-]*)(?:=(?:"([^"<>&]*)"|'([^'<>&]*)'|([^ \t\r\n\f"'<>=&`/]+)))?"""
_PLAIN_TAG = re.compile(rf"""([^<]*)<(/?)((?i:{_PLAIN_TAGS}))((?:{_PLAIN_ATTRIBUTE})*){_SPACE}*>""")
_ATTRIBUTE = re.compile(_PLAIN_ATTRIBUTE)


class _Tables(HTMLParser):
    """Collects ``<table>`` rows as (section, all header cells?, [(text, colspan, rowspan)])."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list] = []
        self._open: list[dict] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables.append([])
            self._open.append({"rows": self.tables[-1], "section": "tbody", "row": None, "cell": None})
        elif not self._open:
            return
        elif tag == "br":
            self.handle_data("\n")
        top = self._open[-1]
        if tag in ("thead", "tbody", "tfoot"):
            top["section"], top["row"] = tag, None
        elif tag == "tr":
            top["row"], top["cell"] = [], None
            top["rows"].append((top["section"], top["row"]))
        elif tag in ("td", "th"):
            if top["row"] is None:
                top["row"] = []
                top["rows"].append((top["section"], top["row"]))
            spans = dict(attrs)
            top["cell"] = [tag, [], _span(spans.get("colspan")), _span(spans.get("rowspan"))]
            top["row"].append(top["cell"])

    def handle_startendtag(self, tag, attrs):
        if tag == "br":
            self.handle_data("\n")

    def handle_endtag(self, tag):
        if not self._open:
            return
        top = self._open[-1]
        if tag == "table":
            self._open.pop()
        elif tag in ("td", "th"):
            top["cell"] = None
        elif tag == "tr":
            top["row"] = top["cell"] = None
        elif tag in ("thead", "tbody", "tfoot"):
            top["section"], top["row"], top["cell"] = "tbody", None, None

    def handle_data(self, data):
        for level in self._open:
            if level["cell"] is not None:
                level["cell"][1].append(data)


def _plain_tables(text: str) -> list | None:
    """What ``_Tables`` collects, if the text holds nothing but plain tags and text between them; else None."""
    tables = _Tables()
    start, end, data = tables.handle_starttag, tables.handle_endtag, tables.handle_data
    at = 0
    for tag in _PLAIN_TAG.finditer(text):
        if tag.start() != at:
            return None
        before, closing, name, attributes = tag.group(1, 2, 3, 4)
        at = tag.end()
        if before and tables._open:
            data(unescape(before))
        if not closing:
            start(name.lower(), [(a[0].lower(), a[1] or a[2] or a[3]) for a in _ATTRIBUTE.findall(attributes)] if attributes else [])
        elif attributes:
            return None
        else:
            end(name.lower())
    rest = text[at:]
    if "<" in rest:
        return None
    if rest and tables._open:
        data(unescape(rest))
    return tables.tables


def _tables(text: str) -> list:
    plain = _plain_tables(text)
    if plain is not None:
        return plain
    parser = _Tables()
    parser.feed(text)
    parser.close()
    return parser.tables


def _span(text: str | None) -> int:
    return int(text) if text and text.strip().isdigit() and int(text) > 0 else 1


def _text(pieces: list[str]) -> str:
    return re.sub(r"[\r\n]+|\s{2,}", " ", "".join(pieces).strip())


def _without_spans(rows: list) -> Iterator[list[str]]:
    """Repeat spanned cells; ``carried`` holds, per column, a text still owed to the rows below."""
    carried: dict[int, tuple[str, int]] = {}
    for row in rows:
        cells: list[str] = []
        below: dict[int, tuple[str, int]] = {}

        def owed() -> None:
            while len(cells) in carried:
                text, left = carried[len(cells)]
                if left > 1:
                    below[len(cells)] = (text, left - 1)
                cells.append(text)

        for _, pieces, across, down in row:
            owed()
            text = _text(pieces)
            for _ in range(across):
                if down > 1:
                    below[len(cells)] = (text, down - 1)
                cells.append(text)
        owed()
        carried = below
        yield cells


def _read_as(encoding: str, payload: bytes) -> str | None:
    with suppress(UnicodeDecodeError):
        return payload.decode(encoding)
    return None


def decode_html(payload: bytes) -> str:
    """The first strict reading; without any, the UTF-8 one less the bytes that do not fit."""
    readings = (_read_as(encoding, payload) for encoding in HTML_ENCODINGS)
    strict = next((text for text in readings if text is not None), None)
    return payload.decode("utf-8", "ignore") if strict is None else strict


def html_rows(payload: bytes) -> Iterator[SheetRow]:
    """Every table that holds text, as ``html_table_1``, ``html_table_2``, ...

    Header rows (a ``<thead>``, else leading rows of ``<th>`` only) name columns and are not data rows.
    """
    with_text = [t for t in _tables(decode_html(payload)) if any("".join(cell[1]).strip("\r\n") for _, row in t for cell in row)]
    if not with_text:
        raise ValueError("no tables found")
    for index, table in enumerate(with_text):
        body = [row for section, row in table if section == "tbody"]
        if not any(section == "thead" for section, _ in table):
            while body and all(cell[0] == "th" for cell in body[0]):
                body.pop(0)
        body += [row for section, row in table if section == "tfoot"]
        for number, cells in enumerate(_without_spans(body), start=1):
            yield f"html_table_{index + 1}", number, ["" if text in NO_VALUE else text for text in cells]
