import datetime
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.sources import readers, writers, xlsx

DAY = datetime.datetime(2024, 2, 29)


def handmade(path, sheets, strings=(), styles="", book=""):
    """A workbook as other programs write it: shared strings, styles, cell references."""
    main, rel = xlsx.SPREADSHEET, "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets))
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}">{book}<sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Type="{rel}/worksheet" Target="/xl/worksheets/s{i}.xml"/>' for i in range(len(sheets)))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        for i, rows in enumerate(sheets.values()):
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {main}><sheetData>{rows}</sheetData></worksheet>")
        if strings:
            z.writestr("xl/sharedStrings.xml", f"<sst {main}>{''.join(f'<si>{s}</si>' for s in strings)}</sst>")
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {main}>{styles}</styleSheet>")


STRINGS = ("<t>day</t>", "<t>amount</t>", "<r><t>two </t></r><r><rPr/><t>runs</t></r><rPh><t>hint</t></rPh>", "<t>note_x0041_</t>")
STYLES = '<numFmts count="2"><numFmt numFmtId="170" formatCode="[$-409]d\\ mmm;@"/><numFmt numFmtId="171" formatCode="0.00&quot; days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs>'
REPORT = (
    '<row r="1"><c r="A1" t="inlineStr"><is><t>Report</t></is></c></row><row r="2"/>'
    '<row r="3"><c r="A3" t="s"><v>0</v></c><c r="B3" t="s"><v>1</v></c><c r="D3" t="s"><v>3</v></c></row>'
    '<row r="4"><c r="A4" s="1"><v>45351</v></c><c r="B4" s="3"><v>1.5</v></c><c r="C4"><v>9</v></c><c r="D4" t="s"><v>2</v></c></row>'
    '<row r="6"><c r="A6" s="2"><v>45351.5</v></c><c r="B6" t="e"><v>#N/A</v></c><c r="D6" t="b"><v>1</v></c></row>'
    '<row r="7"><c r="A7" s="1"/><c r="B7" s="3"/></row>'
    '<row r="8"><c r="AA8"><v>5</v></c><c r="B8" t="str"><f>x</f><v>7</v></c></row>'
)


def test_sheet_with_banner_shared_strings_and_dates(spark, tmp_path):
    path = f"{tmp_path}/report.xlsx"
    handmade(path, {"Other": "", "Report": REPORT}, STRINGS, STYLES)
    df = readers.read_xlsx(spark, path, sheet="Report", skip=2)
    assert df.dtypes == [("day", "timestamp_ntz"), ("amount", "string"), ("noteA", "string")]
    noon = DAY + datetime.timedelta(hours=12)
    assert sorted(map(tuple, df.collect()), key=str) == sorted([(DAY, "1.5", "two runs"), (noon, None, "true"), (None, "7", None)], key=str)
    typed = readers.read_xlsx(spark, path, T.StructType.fromDDL("amount double, day date, missing int"), sheet="1", skip=2)
    assert sorted(map(tuple, typed.collect()), key=str) == sorted([(1.5, DAY.date(), None), (None, DAY.date(), None), (7.0, None, None)], key=str)
    places = readers.read_xlsx(spark, path, T.StructType.fromDDL("a string, b int, c long"), sheet="Report", skip=3, header=False)
    assert ("2024-02-29", None, 9) in [tuple(r) for r in places.collect()]
    assert readers.read_xlsx(spark, path, T.StructType.fromDDL("a string"), sheet="Other").collect() == []
    with pytest.raises(Exception, match="no sheet"):
        readers.read_xlsx(spark, path, sheet="None").collect()


def test_epochs():
    at = datetime.datetime
    assert xlsx.to_datetime(1, False) == at(1900, 1, 1) and xlsx.to_datetime(59, False) == at(1900, 2, 28) and xlsx.to_datetime(61, False) == at(1900, 3, 1)
    assert xlsx.to_datetime(0, True) == at(1904, 1, 1) and xlsx.to_datetime(43889.25, True) == at(2024, 2, 29, 6) and xlsx.to_datetime(1e9, False) is None


def test_workbook_that_counts_from_1904(spark, tmp_path):
    handmade(f"{tmp_path}/old.xlsx", {"S": '<row><c t="inlineStr"><is><t>d</t></is></c></row><row><c s="1"><v>0</v></c></row>'}, (), STYLES, '<workbookPr date1904="1"/>')
    assert readers.read_xlsx(spark, str(tmp_path)).first()["d"] == datetime.datetime(1904, 1, 1)


@pytest.mark.parametrize("code, date", [("General", False), ("0.00", False), ("yyyy", True), ("[h]:mm", True), ("[Red]0", False), ('0" days"', False), ("\\d0", False), ("mmm-yy;@", True), ("#,##0_d", False)])
def test_date_formats(code, date):
    assert xlsx.is_date_format(code) == date


ROWS = [
    (1, 2.5, "plain", True, DAY, DAY.date(), Decimal("3.25")),
    (2, None, None, None, None, None, None),
    (2**40, -1e-300, " <&> \"quotes\"\n\ttabs\r _x0041_ \x01 é\U0001f426", False, datetime.datetime(1999, 12, 31, 23, 59, 59, 999000), datetime.date(1900, 1, 1), Decimal("-0.01")),
    (4, float("nan"), "", True, datetime.datetime(1850, 1, 1, 1), datetime.date(1850, 1, 1), Decimal("0")),
]
SCHEMA = "id long, x double, s string, b boolean, t timestamp_ntz, d date, m decimal(10,2)"


def test_round_trip(spark, tmp_path):
    table = spark.createDataFrame(ROWS, SCHEMA).repartition(2)
    path = writers.write_xlsx(table, f"file://{tmp_path}/out")
    back = readers.read_xlsx(spark, path, table.schema)
    want = [tuple(None if isinstance(v, float) and v != v else v for v in r) for r in ROWS]
    assert sorted(map(tuple, back.collect())) == sorted(want)
    writers.write_xlsx(table.limit(1), path)
    assert readers.read_xlsx(spark, path, table.schema).count() == 5


def test_a_partition_a_sheet_and_full_sheets_go_on(spark, tmp_path):
    table = spark.range(0, 250, 1, 2).select("id", F.col("id").cast("string").alias("s"))
    xlsx.register(spark)
    table.write.format("xlsx").mode("append").option("rows", 51).save(f"{tmp_path}/out")
    every = readers.read_xlsx(spark, f"{tmp_path}/out", table.schema, sheet="*")
    assert every.rdd.getNumPartitions() == 6
    assert sorted(r["id"] for r in every.collect()) == list(range(250))
    assert readers.read_xlsx(spark, f"{tmp_path}/out", table.schema).count() == 100
    table.limit(3).write.format("xlsx").mode("overwrite").save(f"{tmp_path}/out")
    assert readers.read_xlsx(spark, f"{tmp_path}/out", table.schema, sheet="*").count() == 3


def test_empty_table_and_what_a_sheet_cannot_hold(spark, tmp_path):
    table = spark.createDataFrame(ROWS, SCHEMA).limit(0)
    path = writers.write_xlsx(table, f"{tmp_path}/none")
    assert readers.read_xlsx(spark, path, table.schema).collect() == []
    assert readers.read_xlsx(spark, path).columns == table.columns
    with pytest.raises(Exception, match="array"):
        writers.write_xlsx(spark.range(1).select(F.array("id").alias("a")), f"{tmp_path}/arrays")
    with pytest.raises(Exception, match="FileNotFound|nowhere"):
        readers.read_xlsx(spark, f"{tmp_path}/nowhere.xlsx").collect()
