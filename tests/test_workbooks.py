"""The file readers on small files."""

from io import BytesIO
from zipfile import ZipFile

import pytest

from bookfold.showcase.make_files import html_bytes, xlsx_bytes
from bookfold.sources.workbooks import decode_html, html_rows, xlsx_rows


def replace_part(payload, part, text):
    out = BytesIO()
    with ZipFile(BytesIO(payload)) as source, ZipFile(out, "w") as target:
        for name in source.namelist():
            if name != part:
                target.writestr(name, source.read(name))
        target.writestr(part, text)
    return out.getvalue()


@pytest.mark.parametrize("inline", [False, True])
def test_xlsx_gaps_sheets_and_blank_rows(inline):
    book = xlsx_bytes({"一": [["a", None, "c"], [], [None, "NA", 7, 1.5, 2.0]], "二": [], "三": [[""], [" x "]]}, inline)
    assert list(xlsx_rows(book)) == [
        ("一", 1, ["a", "", "c"]),
        ("一", 2, []),
        ("一", 3, ["", "", "7", "1.5", "2"]),
        ("三", 1, []),
        ("三", 2, [" x "]),
    ]


def test_xlsx_cell_kinds():
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cells = (
        '<c r="A1" s="1"><v>45809</v></c><c r="B1" s="2"><v>45809.5</v></c><c r="C1" s="3"><v>0.5</v></c>'
        '<c r="D1" s="4"><v>1.5</v></c><c r="E1" s="5"><v>12</v></c><c r="F1" t="b"><v>1</v></c><c r="G1" t="e"><v>#N/A</v></c>'
        '<c r="H1" t="str"><f>A1</f><v>calc</v></c><c r="I1" t="s"><v>0</v></c><c r="J1"><v>1E+3</v></c>'
        '<c r="K1" t="inlineStr"><is><r><t>ri</t></r><r><t>ch</t></r></is></c><c r="AA1"><v>27</v></c>'
    )
    book = xlsx_bytes({"s": [["x"]]})
    book = replace_part(book, "xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1">{cells}</row></sheetData></worksheet>')
    book = replace_part(
        book, "xl/sharedStrings.xml", f"<sst {ns}><si><r><t>漢</t></r><r><t>字</t></r><rPh sb='0' eb='2'><t>かんじ</t></rPh></si></sst>"
    )
    styles = (
        f'<styleSheet {ns}><numFmts><numFmt numFmtId="164" formatCode="yyyy/m/d\\ h:mm"/><numFmt numFmtId="165" formatCode="[h]:mm"/>'
        '<numFmt numFmtId="166" formatCode="&quot;days&quot; 0"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/>'
        '<xf numFmtId="164"/><xf numFmtId="20"/><xf numFmtId="165"/><xf numFmtId="166"/></cellXfs></styleSheet>'
    )
    book = replace_part(book, "xl/styles.xml", styles)
    ((_, _, values),) = xlsx_rows(book)
    assert values[:11] == [
        "2025-06-01 00:00:00",
        "2025-06-01 12:00:00",
        "12:00:00",
        "1 day, 12:00:00",
        "12",
        "True",
        "",
        "calc",
        "漢字",
        "1000",
        "rich",
    ]
    assert values[26] == "27" and values[11:26] == [""] * 15


def test_html_tables():
    assert list(html_rows(html_bytes([[["商品", "定価"], ["", "x"]], [], [["２"]]]))) == [
        ("html_table_1", 1, ["商品", "定価"]),
        ("html_table_1", 2, ["", "x"]),
        ("html_table_2", 1, ["２"]),
    ]


def test_html_spans_headers_and_space():
    page = (
        "<table><tr><th>h1</th><th>h2</th></tr><tr><td rowspan='2'>a</td><td colspan=2>b  c\n</td></tr>"
        "<tr><td>d&amp;<br>e</td><td>NaN</td></tr><tfoot><tr><td>f</td></tr></tfoot></table>"
        "<table><thead><tr><td>head</td></tr></thead><tbody><tr><td>open<td>cell<tr><th>t</table>"
    )
    assert list(html_rows(page.encode())) == [
        ("html_table_1", 1, ["a", "b c", "b c"]),
        ("html_table_1", 2, ["a", "d& e", ""]),
        ("html_table_1", 3, ["f"]),
        ("html_table_2", 1, ["open", "cell"]),
        ("html_table_2", 2, ["t"]),
    ]
    with pytest.raises(ValueError, match="no tables"):
        list(html_rows(b"plain text"))


def test_html_encodings():
    assert decode_html("商品マスタ".encode("cp932")) == "商品マスタ"
    # UTF-8 bytes are read as UTF-8 only when they are not valid cp932.
    assert decode_html("商品マスタ一".encode("utf-8")) in ("商品マスタ一", "商品マスタ一".encode("utf-8").decode("cp932", "ignore"))
    assert decode_html(b"\x81\xff\xff ok") == " ok"
