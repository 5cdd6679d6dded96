"""Readers for zipped office files: bytes of one file in, plain values out."""

import datetime as dt
import io
import re
import zipfile
from xml.etree import ElementTree as ET

import pandas as pd

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
SHEET_TITLE = "# Hoja: {name}\n\n"

# Built-in number formats that show a date or time.
DATE_FORMAT_IDS = frozenset({*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)})


def docx_paragraphs(content):
    """Non-blank body-level paragraphs; tables are not read."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        body = ET.fromstring(archive.read("word/document.xml")).find(f"{W}body")
    texts = (_paragraph(p) for p in body.findall(f"{W}p"))
    return [t for t in texts if t and not t.isspace()]


def _paragraph(paragraph):
    parts = []
    for child in paragraph:
        runs = [child] if child.tag == f"{W}r" else []
        if child.tag == f"{W}hyperlink":
            runs = child.findall(f"{W}r")
        for item in (x for run in runs for x in run):
            kind = item.tag.removeprefix(W)
            if kind == "t":
                parts.append(item.text or "")
            elif kind in ("tab", "ptab"):
                parts.append("\t")
            elif kind == "cr" or (kind == "br" and item.get(f"{W}type", "textWrapping") == "textWrapping"):
                parts.append("\n")
            elif kind == "noBreakHyphen":
                parts.append("-")
    return "".join(parts)


def xlsx_sheets(content):
    """Yield (position, name, frame-or-error) for every sheet of a workbook."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        names = set(archive.namelist())
        book = ET.fromstring(archive.read("xl/workbook.xml"))
        links = {
            rel.get("Id"): rel.get("Target")
            for rel in ET.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
        }
        shared = _shared_strings(archive) if "xl/sharedStrings.xml" in names else []
        dates = _date_styles(archive) if "xl/styles.xml" in names else []
        properties = book.find(f"{S}workbookPr")
        old_epoch = properties is not None and properties.get("date1904") in ("1", "true")
        epoch = dt.datetime(1904, 1, 1) if old_epoch else dt.datetime(1899, 12, 30)
        for position, sheet in enumerate(book.find(f"{S}sheets"), start=1):
            name = sheet.get("name")
            try:
                target = links[sheet.get(f"{R}id")].lstrip("/")
                part = target if target.startswith("xl/") else f"xl/{target}"
                frame = _frame(ET.fromstring(archive.read(part)), shared, dates, epoch)
                yield position, name, frame
            except Exception as error:  # one bad sheet does not fail the workbook
                yield position, name, error


def _shared_strings(archive):
    root = ET.fromstring(archive.read("xl/sharedStrings.xml"))
    return [_rich_text(item) for item in root.findall(f"{S}si")]


def _rich_text(item):
    return "".join(
        t.text or ""
        for part in item
        for t in ([part] if part.tag == f"{S}t" else part.findall(f"{S}t") if part.tag == f"{S}r" else [])
    )


def _date_styles(archive):
    root = ET.fromstring(archive.read("xl/styles.xml"))
    custom = {
        int(fmt.get("numFmtId"))
        for fmt in root.iter(f"{S}numFmt")
        if re.search(r"[dmhys]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", fmt.get("formatCode", "")), re.I)
    }
    formats = root.find(f"{S}cellXfs")
    ids = [] if formats is None else [int(x.get("numFmtId", "0")) for x in formats]
    return [i in DATE_FORMAT_IDS or i in custom for i in ids]


def _cell(cell, shared, dates, epoch):
    kind, style = cell.get("t", "n"), int(cell.get("s", "0"))
    if kind == "inlineStr":
        return _rich_text(cell.find(f"{S}is"))
    raw = cell.findtext(f"{S}v")
    if raw is None:
        return None
    if kind == "s":
        return shared[int(raw)]
    if kind == "b":
        return raw == "1"
    if kind in ("str", "e", "d"):
        return raw
    number = float(raw)
    if style < len(dates) and dates[style]:
        return epoch + dt.timedelta(days=number)
    return int(number) if number.is_integer() else number


def _column(reference):
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _frame(sheet, shared, dates, epoch):
    """Sheet as a frame whose header is the first row, like a default spreadsheet read."""
    grid = {}
    next_row = 0
    for row in sheet.iter(f"{S}row"):
        at = int(row.get("r", next_row + 1)) - 1
        next_row, next_column, cells = at + 1, 0, {}
        for cell in row.findall(f"{S}c"):
            column = _column(cell.get("r")) if cell.get("r") else next_column
            next_column = column + 1
            value = _cell(cell, shared, dates, epoch)
            if value is not None and value != "":
                cells[column] = value
        if cells:
            grid[at] = cells
    if not grid:
        return pd.DataFrame()
    width = max(max(cells) for cells in grid.values()) + 1
    rows = [[grid.get(r, {}).get(c) for c in range(width)] for r in range(max(grid) + 1)]
    header = _unique([f"Unnamed: {i}" if h is None else str(h) for i, h in enumerate(rows[0])])
    return pd.DataFrame(rows[1:], columns=header).convert_dtypes(
        convert_string=False, convert_integer=False, convert_boolean=False, convert_floating=False
    ).infer_objects()


def _unique(header):
    seen, out = {}, []
    for name in header:
        count = seen.get(name, 0)
        seen[name] = count + 1
        out.append(f"{name}.{count}" if count else name)
    return out


def pipe_table(frame):
    """Markdown pipe table of a frame: numbers right-aligned, text left-aligned."""
    columns = [_render_column(frame.iloc[:, i]) for i in range(frame.shape[1])]
    lines = [[], []] + [[] for _ in range(len(frame))]
    for name, (numeric, cells) in zip(frame.columns, columns):
        width = max([len(name) + 2, *map(len, cells)])
        pad = str.rjust if numeric else str.ljust
        dashes = "-" * (width + 1)
        lines[0].append(f" {pad(name, width)} ")
        lines[1].append(f"{dashes}:" if numeric else f":{dashes}")
        for line, cell in zip(lines[2:], cells):
            line.append(f" {pad(cell, width)} ")
    return "\n".join(f"|{'|'.join(line)}|" for line in lines)


def _is_number(value):
    try:
        float(value)
        return not isinstance(value, bool)
    except (TypeError, ValueError):
        return False


def _render_column(column):
    values = [None if v is None or v is pd.NaT else v for v in column.tolist()]
    if all(_is_number(v) for v in values if v is not None):
        whole = all(isinstance(v, int) or (isinstance(v, str) and re.fullmatch(r"[+-]?\d+", v.strip()))
                    for v in values)
        cells = [str(v).strip() if whole else format(float("nan" if v is None else v), "g") for v in values]
        return True, cells if whole else _align_points(cells)
    dates = all(isinstance(v, dt.datetime) for v in values if v is not None)
    missing = "NaT" if dates else "nan"
    return False, [missing if v is None else str(v) for v in values]


def _align_points(cells):
    """Pad on the right so that decimal points line up."""
    after = [len(c) - c.index(".") if "." in c else 0 for c in cells]
    return [c + " " * (max(after) - n) for c, n in zip(cells, after)]
