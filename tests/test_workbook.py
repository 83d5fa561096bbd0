"""Workbooks against the wide CSV form of the same sheets."""

import io
import zipfile
from xml.sax.saxutils import escape

import pytest

from leadpipe.sources import readers, workbook

SHEETS = {
    "title_matrix": [["Title", "Manager", "Vice President"], ["ring & co", 70, 75.0], ["bolt", None, 80], ["  gap ", 5, 6]],
    "mapping": [["old", "new"], ["a", "b"], ["ä <x>", "ö"]],
    "level_mapping": [["Actual", "SFDC"], ["senior", "manager"], ["lead", "director"]],
    "keywords": [["k", "p"], ["z", 3], ["y", -4]],
    "no_match_levels": [["l", "p"], ["manager", 8]],
}
NAMES = ("xmlns", "http://schemas.openxmlformats.org/spreadsheetml/2006/main")
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def letters(i):
    return (letters(i // 26 - 1) if i >= 26 else "") + chr(65 + i % 26)


def sheet_xml(rows, shared, first=1, kind="s"):
    """Rows from number `first` on; texts as shared, inline or plain ones."""
    out = []
    for n, row in enumerate(rows, first):
        cells = ""
        for i, v in enumerate(row):
            place = f'r="{letters(i)}{n}"'
            if v is None:
                continue
            if not isinstance(v, str):
                cells += f"<c {place}><v>{v}</v></c>"
            elif kind == "s":
                if v not in shared:
                    shared.append(v)
                cells += f'<c {place} t="s"><v>{shared.index(v)}</v></c>'
            elif kind == "inlineStr":
                cells += f'<c {place} t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
            else:
                cells += f'<c {place} t="str"><f>A1</f><v>{escape(v)}</v></c>'
        out.append(f'<row r="{n}">{cells}</row>')
    return f'<worksheet {NAMES[0]}="{NAMES[1]}"><sheetData>{"".join(out)}</sheetData></worksheet>'


def make(sheets, kinds=("s",), first=1):
    shared, parts = [], {}
    for i, (name, rows) in enumerate(sheets.items()):
        parts[name] = sheet_xml(rows, shared, first, kinds[i % len(kinds)])
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as book:
        listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(parts))
        book.writestr("xl/workbook.xml", f'<workbook {NAMES[0]}="{NAMES[1]}" xmlns:r="{OFFICE}"><sheets>{listed}</sheets></workbook>')
        links = "".join(
            f'<Relationship Id="r{i}" Type="x" Target="{"/xl/" if i % 2 else ""}worksheets/s{i}.xml"/>' for i, _ in enumerate(parts)
        )
        package = "http://schemas.openxmlformats.org/package/2006/relationships"
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}">{links}</Relationships>')
        for i, xml in enumerate(parts.values()):
            book.writestr(f"xl/worksheets/s{i}.xml", xml)
        items = "".join(
            f"<si><r><t>{escape(s[:1])}</t></r><r><t>{escape(s[1:])}</t></r></si>" if i % 2 else f"<si><t>{escape(s)}</t><rPh><t>no</t></rPh></si>"
            for i, s in enumerate(shared)
        )
        if shared:
            book.writestr("xl/sharedStrings.xml", f'<sst {NAMES[0]}="{NAMES[1]}">{items}</sst>')
    return held.getvalue()


def rows_of(sheets):
    return {name: sorted(map(tuple, df.collect())) for name, df in sheets.items()}


@pytest.mark.parametrize("kinds", [("s",), ("inlineStr",), ("str", "s", "inlineStr")])
def test_five_sheets_are_read_as_their_wide_form(spark, tmp_path, kinds):
    (tmp_path / "scores.xlsx").write_bytes(make(SHEETS, kinds, first=3))
    for name, rows in SHEETS.items():
        (tmp_path / "csv" / name).mkdir(parents=True)
        text = "".join(",".join("" if v is None else f"{v:g}" if not isinstance(v, str) else v for v in r) + "\n" for r in rows)
        (tmp_path / "csv" / name / "s.csv").write_text(text)
    found = readers.scan_dims_workbook(spark, str(tmp_path / "scores.xlsx"))
    wide = readers.scan_dims_wide(spark, str(tmp_path / "csv"))
    assert rows_of(found) == rows_of(wide)
    assert {n: df.dtypes for n, df in found.items()} == {n: df.dtypes for n, df in wide.items()}


def test_positions_go_by_row_number(spark, tmp_path):
    sheets = SHEETS | {"keywords": [["k", "p"], ["a", 1], [None, None], ["b", 2]]}
    (tmp_path / "scores.xlsx").write_bytes(make(sheets))
    found = readers.scan_dims_workbook(spark, str(tmp_path / "scores.xlsx"))
    assert rows_of(found)["keywords"] == [(1, "a", 1), (3, "b", 2)]


def test_missing_and_misshapen_sheets_are_errors(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(make({n: r for n, r in SHEETS.items() if n != "mapping"}))
    with pytest.raises(ValueError, match="mapping"):
        readers.scan_dims_workbook(spark, str(tmp_path / "a.xlsx"))
    (tmp_path / "b.xlsx").write_bytes(make(SHEETS | {"keywords": [["k", "p", "more"], ["a", 1, 2]]}))
    with pytest.raises(ValueError, match="keywords"):
        readers.scan_dims_workbook(spark, str(tmp_path / "b.xlsx"))


def test_many_files_and_wide_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workbook, "BATCH", 2)
    wide = [[f"c{i}" for i in range(60)], *([i] * 60 for i in range(9))]
    for n in range(3):
        (tmp_path / f"{n}.xlsx").write_bytes(make({"data": wide, "other": [["x"]]}))
    rows = workbook.scan_workbook(spark, str(tmp_path), ["data", "none"]).collect()
    assert len(rows) == 30 and {r.sheet for r in rows} == {"data"}
    assert {(r.row, r.cells[59]) for r in rows} == {(1, "c59")} | {(i + 2, str(i)) for i in range(9)}


def test_values_of_cells():
    xml = (
        f'<worksheet {NAMES[0]}="{NAMES[1]}"><sheetData><row><c t="b"><v>1</v></c><c t="e"><v>#N/A</v></c><c><v>1.50</v></c>'
        '<c><v>1E3</v></c><c t="str"><v>x</v></c><c/></row></sheetData></worksheet>'
    )
    held = io.BytesIO(make({"data": [["x"]]}))
    with zipfile.ZipFile(held, "a") as book:
        book.writestr("xl/worksheets/s0.xml", xml)
    assert list(workbook.sheet_rows(held.getvalue(), "data")) == [(1, ["true", None, "1.5", "1000", "x", None])]
