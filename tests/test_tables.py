"""Binding, roles, inputs and outputs."""

from __future__ import annotations

import io
import zipfile

import pytest
from pyspark.sql import types as T

import findery as fy
from findery.operators import binding as bd
from findery.sources import tables as tb

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def write_book(path, sheets: dict[str, str], shared: list[str] = ()):
    """A workbook whose sheets are given as row XML."""
    with zipfile.ZipFile(path, "w") as book:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="t" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        for i, rows in enumerate(sheets.values(), 1):
            book.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{rows}</sheetData></worksheet>')
        if shared:
            items = "".join(f"<si><t>{t}</t></si>" for t in shared)
            book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{items}</sst>')


def text(ref, value):
    return f'<c r="{ref}" t="inlineStr"><is><t>{value}</t></is></c>'


def row(n, *cells):
    return f'<row r="{n}">{"".join(cells)}</row>'


def test_workbook_folder(spark, tmp_path):
    head = row(1, text("A1", "Allid"), text("C1", "Title"))
    write_book(tmp_path / "a.xlsx", {"Other": row(1, text("A1", "x")), "Sheet1": ""})
    write_book(tmp_path / "b.xlsx", {"Other": row(1, text("A1", "x")), "Sheet1": head + row(2, '<c r="A2"><v>1</v></c>', text("B2", "gap"), '<c r="C2" t="s"><v>1</v></c>', text("D2", "beyond"))}, ["s0", "s1"])
    write_book(tmp_path / "c.xlsx", {"First": head + row(2, '<c r="A2"><v>2.50</v></c>', '<c r="C2" t="b"><v>1</v></c>') + row(4) + row(5, text("C5", "last"))})
    (tmp_path / "notes.txt").write_text("not a workbook")
    df = tb.read_workbooks(spark, str(tmp_path))
    assert df.columns == ["Allid", "_c1", "Title"]
    assert df.rdd.getNumPartitions() == 3
    assert sorted(tuple(r) for r in df.fillna("").collect()) == [("", "", "last"), ("1", "gap", "s1"), ("2.5", "", "TRUE")]
    plain = tb.read_workbooks(spark, str(tmp_path), header=False)
    assert plain.columns == ["_c0", "_c1", "_c2"] and plain.count() == 5


def test_workbooks_of_different_width_fail(spark, tmp_path):
    write_book(tmp_path / "a.xlsx", {"Sheet1": row(1, text("A1", "x"), text("B1", "y")) + row(2, text("A2", "1"))})
    write_book(tmp_path / "b.xlsx", {"Sheet1": row(1, text("A1", "x")) + row(2, text("A2", "1"))})
    with pytest.raises(Exception, match="b.xlsx has 1 columns"):
        tb.read_workbooks(spark, str(tmp_path)).collect()


def test_bad_workbooks_are_named(spark, tmp_path):
    (tmp_path / "broken.xlsx").write_bytes(b"no zip")
    with pytest.raises(Exception, match="broken.xlsx"):
        tb.read_workbooks(spark, str(tmp_path)).collect()
    (tmp_path / "old.xls").write_bytes(b"")
    with pytest.raises(Exception, match="binary workbooks"):
        tb.read_workbooks(spark, str(tmp_path)).collect()


def test_workbook_round_trip(spark, tmp_path):
    values = ["plain", 'a\r\nb\tc\x01 _x0041_ <&>"  ', "锅炉", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, v string").repartition(2)
    path = str(tmp_path / "out")
    assert tb.export_workbooks(df, path, sheet="S & T") == 5
    assert tb.export_workbooks(df, path, sheet="S & T", header=False) == 4
    assert tb.export_workbooks(df, path, sheet="S & T") == 5
    back = tb.read_workbooks(spark, path, sheet="S & T")
    assert sorted(tuple(r) for r in back.collect()) == [(str(i), v or "") for i, v in enumerate(values)]
    files = [f for f in (tmp_path / "out").iterdir()]
    assert all(f.suffix == ".xlsx" for f in files)
    with zipfile.ZipFile(io.BytesIO(files[0].read_bytes())) as book:
        assert book.testzip() is None


def test_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'quote " comma , line\nbreak'), (2, None)], "n int, v string")
    assert tb.export_text(df, str(tmp_path / "o")) == 3
    back = tb.read_delimited(spark, str(tmp_path / "o"), multi_line=True).fillna("")
    assert sorted(tuple(r) for r in back.collect()) == [("1", 'quote " comma , line\nbreak'), ("2", "")]
    assert tb.export_text(df, str(tmp_path / "p"), header=False) == 2
    assert tb.read_delimited(spark, str(tmp_path / "p"), header=False, multi_line=True).columns == ["_c0", "_c1"]


def test_unions(spark):
    a = spark.createDataFrame([("1", "x")], "a string, b string")
    b = spark.createDataFrame([("2", "y")], "b string, c string")
    assert [tuple(r) for r in tb.positional_union([a, b]).collect()] == [("1", "x"), ("2", "y")]
    assert tb.union_by_name([a, b]).columns == ["a", "b", "c"]
    with pytest.raises(ValueError, match="column counts"):
        tb.positional_union([a, b.drop("c")])


def test_bind(spark):
    source = spark.createDataFrame([("7", None, "extra")], "ALLID string, title string, other string")
    bound = bd.bind(source, bd.QUESTION)
    assert bound.columns == bd.QUESTION.fieldNames()
    first = bound.first()
    assert first["Allid"] == 7 and first["Title"] == "" and first["Answer"] is None
    assert bound.schema["Allid"].dataType == T.IntegerType()
    assert bd.key_field(bound.schema) == "Allid"
    assert bd.indexed_fields(bound.schema) == ["Title", "Choosea", "Chooseb", "Choosec", "Choosed", "Answer", "Explain", "Remark"]
    assert bd.stored_fields(bound.schema) == ["Allid", *bd.indexed_fields(bound.schema)]


@pytest.mark.parametrize("value", ["x7", None, "1.5"])
def test_strict_binding_fails(spark, value):
    source = spark.createDataFrame([(value,)], "Allid string")
    with pytest.raises(Exception, match="Allid: cannot convert"):
        bd.bind(source, bd.QUESTION).collect()


def test_permissive_binding(spark):
    source = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "Allid string, Title string")
    good, bad = bd.bind_permissive(source, bd.QUESTION)
    assert [r["Allid"] for r in good.collect()] == [1]
    assert {(r["Title"], tuple(r["bad_fields"])) for r in bad.collect()} == {("b", ("Allid",)), ("c", ("Allid",))}


def test_from_workbook_to_answer(spark, tmp_path, ask):
    head = row(1, text("A1", "ALLID"), text("B1", "title"), text("C1", "Answer"))
    write_book(tmp_path / "q1.xlsx", {"Sheet1": head + row(2, '<c r="A2"><v>1</v></c>', text("B2", "pump pressure"), text("C2", "A"))})
    write_book(tmp_path / "q2.xlsx", {"Sheet1": head + row(2, '<c r="A2"><v>2</v></c>', text("B2", "valve"), text("C2", "B"))})
    records = bd.bind(tb.read_workbooks(spark, str(tmp_path)), bd.QUESTION)
    schema = records.schema
    store = fy.IndexStore(spark, str(tmp_path / "index"), shards=2)
    with pytest.raises(ValueError, match="Choosea"):  # an indexed field that no workbook has
        store.replace(records, bd.key_field(schema), bd.indexed_fields(schema), stored=bd.stored_fields(schema))
    store.replace(records, bd.key_field(schema), ["Title", "Answer"], stored=bd.stored_fields(schema))
    index = store.open()
    top = fy.search_keywords(index, ask("Valve?"), fields="Title")
    shown = fy.attach_stored(index, top).select(bd.rendered().alias("shown")).collect()
    assert [r["shown"] for r in shown] == ["valveB"]


def test_record_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None)], "id int, x string, y string")
    assert [r["id"] for r in bd.drop_empty(df, ["x", "y"]).collect()] == [1]
    assert {tuple(r) for r in bd.to_fields(df, ["id"], ["x", "y"]).collect()} == {(1, "x", "a"), (1, "y", None), (2, "x", None), (2, "y", None)}
    with pytest.raises(ValueError, match="no column"):
        bd.project_roles(df, T.StructType([bd.role_field("z", T.StringType(), store=True)]))
