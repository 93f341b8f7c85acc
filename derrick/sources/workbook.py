"""Cells of the first sheet of an ``.xlsx`` workbook, read and written inside a task."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from xml.etree import ElementTree
from xml.sax.saxutils import escape

# XML namespaces and the built-in date formats of the file format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINKS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
BUILTIN_DATES = {*range(14, 23), *range(45, 48)}
EPOCH = dt.datetime(1899, 12, 30)


def _texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in item.iter(f"{MAIN}t")) for item in root.iter(f"{MAIN}si")]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {
        int(f.get("numFmtId"))
        for f in root.iter(f"{MAIN}numFmt")
        if re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "").lower()))
    }
    styles = root.find(f"{MAIN}cellXfs")
    formats = [] if styles is None else [int(x.get("numFmtId", "0")) for x in styles]
    return {i for i, f in enumerate(formats) if f in BUILTIN_DATES or f in custom}


def _first_sheet(book: zipfile.ZipFile) -> str:
    sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{MAIN}sheets")
    link = sheets[0].get(f"{LINKS}id")
    for relation in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if relation.get("Id") == link:
            target = relation.get("Target")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError("the workbook names no first sheet")


def _column(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def _as_date(serial: str) -> str:
    stamp = EPOCH + dt.timedelta(days=float(serial))
    return stamp.date().isoformat() if stamp.time() == dt.time(0) else stamp.isoformat(sep=" ", timespec="seconds")


def sheet_rows(content: bytes):
    """Rows as ``{column position: text}``, one after the other."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        texts, dates = _texts(book), _date_styles(book)
        with book.open(_first_sheet(book)) as sheet:
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != f"{MAIN}row":
                    continue
                cells = {}
                for place, cell in enumerate(row.iter(f"{MAIN}c")):
                    kind, value = cell.get("t"), cell.find(f"{MAIN}v")
                    if kind == "inlineStr":
                        text = "".join(t.text or "" for t in cell.iter(f"{MAIN}t"))
                    elif value is None or value.text is None:
                        continue
                    elif kind == "s":
                        text = texts[int(value.text)]
                    elif kind is None and int(cell.get("s", "0")) in dates:
                        text = _as_date(value.text)
                    else:
                        text = value.text
                    cells[_column(cell.get("r")) if cell.get("r") else place] = text
                yield cells
                row.clear()


def _letters(column: int) -> str:
    name = ""
    while column >= 0:
        name, column = chr(ord("A") + column % 26) + name, column // 26 - 1
    return name


def workbook_bytes(rows: list[list]) -> bytes:
    """A workbook of one sheet: numbers as numbers, dates as styled serials, other values as shared strings; None is no cell."""
    main, rel, package = MAIN[1:-1], LINKS[1:-1], "http://schemas.openxmlformats.org/package/2006/relationships"
    texts: dict[str, int] = {}
    body = []
    for r, row in enumerate(rows, 1):
        cells = []
        for c, value in enumerate(row):
            at = f'r="{_letters(c)}{r}"'
            if value is None:
                continue
            if isinstance(value, dt.date):
                cells.append(f'<c {at} s="1"><v>{(value - EPOCH.date()).days}</v></c>')
            elif isinstance(value, (int, float)):
                cells.append(f"<c {at}><v>{value!r}</v></c>")
            else:
                cells.append(f'<c {at} t="s"><v>{texts.setdefault(str(value), len(texts))}</v></c>')
        body.append(f'<row r="{r}">{"".join(cells)}</row>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="rows" sheetId="1" r:id="rId1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        book.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        strings = "".join(f'<si><t xml:space="preserve">{escape(t)}</t></si>' for t in texts)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{strings}</sst>')
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{"".join(body)}</sheetData></worksheet>')
    return out.getvalue()
