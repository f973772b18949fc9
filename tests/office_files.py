"""Small XLSX and DOCX files written with zipfile."""

from __future__ import annotations

import zipfile
from datetime import date
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
WORD = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def _letter(index: int) -> str:
    return chr(ord("A") + index)


def write_xlsx(path, rows: list[list]) -> None:
    """Text goes to the shared strings, dates become styled serial numbers."""
    shared: list[str] = []
    lines = []
    for number, row in enumerate(rows, start=1):
        cells = []
        for index, value in enumerate(row):
            ref = f"{_letter(index)}{number}"
            if value is None:
                continue
            if isinstance(value, date):
                cells.append(f'<c r="{ref}" s="1"><v>{(value - date(1899, 12, 30)).days}</v></c>')
            elif isinstance(value, (int, float)):
                cells.append(f'<c r="{ref}"><v>{value}</v></c>')
            elif value.startswith("inline:"):
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(value[7:])}</t></is></c>')
            else:
                if value not in shared:
                    shared.append(value)
                cells.append(f'<c r="{ref}" t="s"><v>{shared.index(value)}</v></c>')
        lines.append(f'<row r="{number}">{"".join(cells)}</row>')
    items = "".join(f"<si><t>{escape(text)}</t></si>" for text in shared)
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("xl/worksheets/sheet1.xml",
                         f'<worksheet xmlns="{MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
        archive.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{items}</sst>')
        archive.writestr("xl/styles.xml",
                         f'<styleSheet xmlns="{MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')


def _paragraph(text: str) -> str:
    return f"<w:p><w:r><w:t>{escape(text)}</w:t></w:r></w:p>"


def write_docx(path, paragraphs: list[str] = (), table: list[list[str]] = ()) -> None:
    rows = "".join(
        "<w:tr>" + "".join(f"<w:tc>{_paragraph(cell)}</w:tc>" for cell in row) + "</w:tr>" for row in table
    )
    body = "".join(_paragraph(text) for text in paragraphs) + (f"<w:tbl>{rows}</w:tbl>" if table else "")
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("word/document.xml", f'<w:document xmlns:w="{WORD}"><w:body>{body}</w:body></w:document>')
