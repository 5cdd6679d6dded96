"""Small office files built with the standard zip module."""

import io
import zipfile

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
S = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
R = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _zip(parts):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in parts.items():
            archive.writestr(name, body)
    return buffer.getvalue()


def docx(body):
    return _zip({"word/document.xml": f'<w:document xmlns:w="{W}"><w:body>{body}</w:body></w:document>'})


def paragraph(value):
    return f"<w:p><w:r><w:t>{value}</w:t></w:r></w:p>"


def xlsx(sheets, shared=(), formats=()):
    """``sheets`` maps a name to the XML of its rows, or None for a missing part."""
    names = list(sheets)
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{S}" xmlns:r="{R}"><sheets>'
        + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))
        + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        + "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1))
        + "</Relationships>",
        "xl/sharedStrings.xml": f'<sst xmlns="{S}">' + "".join(f"<si><t>{t}</t></si>" for t in shared) + "</sst>",
        "xl/styles.xml": f'<styleSheet xmlns="{S}"><cellXfs>'
        + "".join(f'<xf numFmtId="{f}"/>' for f in (0, *formats))
        + "</cellXfs></styleSheet>",
    }
    for i, name in enumerate(names, 1):
        if sheets[name] is not None:
            parts[f"xl/worksheets/sheet{i}.xml"] = f'<worksheet xmlns="{S}"><sheetData>{sheets[name]}</sheetData></worksheet>'
    return _zip(parts)
