"""CSV policy, split-safe record numbers, workbook scan, catalog sinks, streaming ingest."""

import os

import pytest
import zipfile

from pyspark.sql import functions as F

from effdated.sources import catalog, files
from effdated.sources.csv import read_csv_with_lineage
from effdated.sources.workbook import parse_workbook, read_workbook_with_lineage, unreadable_workbooks


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_policy(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "land", "pay_2021.csv")
    _write(p, 'a,b,c\n1,x,NA\n2,y\n3,z,q,EXTRA\n\n4,"multi\nline",w\n')
    df = read_csv_with_lineage(spark, os.path.dirname(p), multiline=True)
    rows = {r.a: r for r in df.collect()}
    assert set(rows) == {"1", "2", "4"}                    # too-long row dropped, blank skipped
    assert rows["1"].c is None                             # NA token -> null
    assert rows["2"].c is None                             # short row padded
    assert rows["4"].b == "multi\nline"                    # one multi-line record
    assert rows["1"].Source == "pay_2021:row:2"            # header is row 1
    assert rows["2"].Source == "pay_2021:row:3"
    assert rows["4"].Source == "pay_2021:row:4"            # bad line not counted (pandas index + 2)


def test_record_numbers_across_splits(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "big")
    for f in range(3):
        lines = ["id,val"] + [f"{f}-{i},{'v' * (i % 17)}" for i in range(5000)]
        _write(os.path.join(d, f"file{f}.csv"), "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = read_csv_with_lineage(spark, d)
        assert spark.read.text(d).rdd.getNumPartitions() > 3  # the scan has many splits
        bad = df.filter(F.col("record_no") != F.split("id", "-")[1].cast("long") + 2).count()
        assert bad == 0 and df.count() == 15000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _xlsx(path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} {rns}><sheets><sheet name="Staff" sheetId="1" r:id="rId1"/>'
                   '</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst {ns}><si><t>Staff Member</t></si><si><t>Joined</t></si>'
                   '<si><t>E1</t></si><si><t>Report title</t></si></sst>')
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/>'
                   '</cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData>'
                   '<row r="1"><c r="A1" t="s"><v>3</v></c></row>'
                   '<row r="2"><c r="A2" t="s"><v>0</v></c><c r="B2" t="s"><v>1</v></c></row>'
                   '<row r="3"><c r="A3" t="s"><v>2</v></c><c r="B3" s="1"><v>44197</v></c></row>'
                   '<row r="4"><c r="A4" t="inlineStr"><is><t>E2</t></is></c><c r="B4"><v>7</v></c></row>'
                   '</sheetData></worksheet>')


def test_workbook_scan(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "wb", "master EMP.xlsx")
    os.makedirs(os.path.dirname(p))
    _xlsx(p)
    rows = list(parse_workbook(open(p, "rb").read()))
    assert rows[2] == ("Staff", 3, 2, ["E1", "2021-01-01 00:00:00"])
    long = read_workbook_with_lineage(spark, os.path.dirname(p), header=1)
    got = {(r.Source, r.column): r.value for r in long.collect()}
    assert got[("master EMP:Staff:row:3", "Joined")] == "2021-01-01 00:00:00"
    assert got[("master EMP:Staff:row:4", "Staff Member")] == "E2"
    _write(os.path.join(os.path.dirname(p), "broken.xlsx"), "not a zip archive")
    again = read_workbook_with_lineage(spark, os.path.dirname(p), header=1)
    assert {(r.Source, r.column): r.value for r in again.collect()} == got  # the bad file is skipped
    bad = unreadable_workbooks(spark, os.path.dirname(p)).collect()
    assert [(os.path.basename(r.path), r.error.split(":")[0]) for r in bad] == [("broken.xlsx", "BadZipFile")]


def test_listing_filter_assign(spark, tmpdir_path):
    for rel in ["a/payslip_2020.csv", "a/payslip_2021.CSV", "archive/payslip_old.csv", "a/notes.doc", "a/master.xlsx"]:
        _write(os.path.join(tmpdir_path, rel), "x\n1\n")
    lst = files.list_files(spark, tmpdir_path)
    assert sorted(r.name for r in lst.collect()) == ["master.xlsx", "payslip_2020.csv", "payslip_2021.CSV", "payslip_old.csv"]
    kept = files.filelist_filter(lst, ["payslip"], ["2021"])
    assert [r.name for r in kept.collect()] == ["payslip_2020.csv"]
    rules = {"payslip": {"filename_include": ["payslip"]}, "late": {"filename_include": ["2021"]}}
    ds = {r.name: r.dataset for r in files.assign_datasets(lst, rules).collect()}
    assert ds == {"payslip_2020.csv": "payslip", "payslip_2021.CSV": "late"}  # archive folder ignored


def test_bronze_is_idempotent_and_evolves(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "land")
    _write(os.path.join(d, "f1.csv"), "a,b\n1,x\n2,y\n")
    t = "bronze_test_tbl"
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    df = read_csv_with_lineage(spark, d)
    catalog.write_bronze(spark, df, t)
    catalog.write_bronze(spark, df, t)
    assert spark.table(t).count() == 2
    extra = df.withColumn("c", F.lit("new"))
    catalog.write_bronze(spark, extra, t)
    assert "c" in spark.table(t).columns and spark.table(t).count() == 2
    assert catalog.table_shape(spark, t)["row"] == 2
    assert catalog.normalise_table_name("Pay Slips (2021)-v2.csv") == "Pay_Slips_2021_v2_csv"


def test_streaming_ingest(spark, tmpdir_path):
    from effdated.streaming.ingest import start_csv_ingest
    land = os.path.join(tmpdir_path, "stream-land")
    _write(os.path.join(land, "s1.csv"), "a,b\n1,x\n2,NA\n")
    t = "bronze_stream_tbl"
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    q = start_csv_ingest(spark, land, t, ["a", "b"], checkpoint=os.path.join(tmpdir_path, "ck"))
    q.awaitTermination(120)
    rows = sorted((r.a, r.b, r.Source) for r in spark.table(t).collect())
    assert rows == [("1", "x", "s1:row:2"), ("2", None, "s1:row:3")]


def test_catalog_sinks_and_audits(spark, tmpdir_path):
    import datetime as dtm
    df = spark.createDataFrame([("E1", dtm.datetime(2021, 3, 4, 5, 6, 7), "f1.csv"), ("E2", None, "f1.csv")],
                               "EmployeeCode string, StartDate timestamp_ntz, source_file string")
    catalog.save_dict_to_folder({"Pay Slips": df, "master": df}, os.path.join(tmpdir_path, "out"))
    assert spark.read.parquet(os.path.join(tmpdir_path, "out", "Pay_Slips")).count() == 2
    catalog.write_exception_report(df, csv_path=os.path.join(tmpdir_path, "exceptions"))
    assert spark.read.option("header", "true").csv(os.path.join(tmpdir_path, "exceptions")).count() == 2
    with pytest.raises(ValueError, match="Missing"):
        catalog.load_output(df, ["EmployeeCode", "Missing"])
    out = catalog.load_output(df, {"EmployeeCode": "Code", "StartDate": "StartDate"}, iso_columns=["StartDate"])
    assert out.columns == ["Code", "StartDate"]
    assert sorted((r.StartDate or "") for r in out.collect()) == ["", "2021-03-04T05:06:07"]
    assert catalog.load_output(df, ["EmployeeCode"], switch=False) is None
    audit = catalog.reading_audit(df, "payslips", options={"dtype": "object"}).collect()[0]
    assert (audit.dataset, audit.filename, audit.rows, audit.columns) == ("payslips", "f1.csv", 2, 2)
    b = catalog.build_audit(spark, "payslips", "batch1", ["t1", "t2"], ["row_filter", "flatten"])
    catalog.append_audit(b, "audit_build_tbl")
    assert spark.table("audit_build_tbl").count() >= 2
    catalog.ensure_schema(spark, "stage_test_db")
    assert catalog.schema_exists(spark, "stage_test_db")
    catalog.ensure_table(spark, "stage_test_db.pay_tbl", {"a": "string", "b": "int"})
    assert catalog.table_exists(spark, "stage_test_db.pay_tbl")
    assert catalog.dataset_tables(spark, "stage_test_db", ["pay"]) == ["pay_tbl"]
    assert set(catalog.inspect_table(spark, "stage_test_db.pay_tbl")) == {"a", "b"}


def test_preamble_counts_physical_lines(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "preamble")
    os.makedirs(d)
    # a blank, a wide and a short line before the header; a blank line after it
    _write(os.path.join(d, "p.csv"), "\nTitle,with,many,commas\nshort\ncode,amt\n\nA,1\nB,2,extra\nC,3\n")
    rows = sorted((r.code, r.amt, r.record_no) for r in read_csv_with_lineage(spark, d, skiprows=3).collect())
    assert rows == [("A", "1", 5), ("C", "3", 6)]
    e = os.path.join(tmpdir_path, "blank")
    os.makedirs(e)
    _write(os.path.join(e, "b.csv"), "\n" * 60 + "code,amt\nA,1\n")
    assert [(r.code, r.amt) for r in read_csv_with_lineage(spark, e).collect()] == [("A", "1")]
    h = os.path.join(tmpdir_path, "second")
    os.makedirs(h)
    _write(os.path.join(h, "h.csv"), "x,y\ncode,amt\nA,1\n")
    assert [(r.code, r.amt, r.record_no) for r in read_csv_with_lineage(spark, h, header=1).collect()] == [("A", "1", 3)]


def test_each_file_has_its_own_header(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "mixed")
    os.makedirs(d)
    _write(os.path.join(d, "a.csv"), "Emp,Amt\nA,1\n")
    _write(os.path.join(d, "b.csv"), "Amt,Emp,More\n2,B,x\n3,C\n")
    rows = sorted((r.Emp, r.Amt, r.More, r.Source) for r in read_csv_with_lineage(spark, d).collect())
    assert rows == [("A", "1", None, "a:row:2"), ("B", "2", "x", "b:row:2"), ("C", "3", None, "b:row:3")]


def test_same_file_name_in_two_folders(spark, tmpdir_path):
    t = "bronze_same_name"
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    for folder in "ab":
        d = os.path.join(tmpdir_path, folder)
        os.makedirs(d)
        _write(os.path.join(d, "data.csv"), f"k\n{folder}1\n{folder}2\n")
        for _ in range(2):  # the second load replaces the first
            catalog.write_bronze(spark, read_csv_with_lineage(spark, d), t)
    assert sorted(r.k for r in spark.table(t).collect()) == ["a1", "a2", "b1", "b2"]


def test_equal_names_in_one_load_keep_all_rows(spark, tmpdir_path):
    """Labels and line codes are unique, so deduplication keeps every line."""
    from effdated.functions.columns import payslip_line_code
    from effdated.operators.filters import dedupe_keep_first
    for folder in "ab":
        _write(os.path.join(tmpdir_path, folder, "pay.csv"), f"k\n{folder}1\n{folder}2\n")
    _write(os.path.join(tmpdir_path, "c", "other.csv"), "k\nc1\n")
    rows = payslip_line_code(read_csv_with_lineage(spark, tmpdir_path), "code")
    assert rows.select("Source").distinct().count() == 5 == rows.select("code").distinct().count()
    assert rows.filter("Source = 'other:row:2'").count() == 1
    assert dedupe_keep_first(rows, ["code"], ["Source"]).count() == 5


@pytest.mark.parametrize("multiline", [False, True])
def test_wide_preamble_loses_no_row(spark, tmpdir_path, multiline):
    d = os.path.join(tmpdir_path, "wide")
    _write(os.path.join(d, "p.csv"), 'Title,a,b,c\nA,B\n1,2\n3,4\n5,6,7\n8,"9"\n')
    rows = sorted((r.A, r.B, r.record_no, r.Source) for r in read_csv_with_lineage(spark, d, skiprows=1, multiline=multiline).collect())
    assert rows == [("1", "2", 3, "p:row:3"), ("3", "4", 4, "p:row:4"), ("8", "9", 5, "p:row:5")]
    e = os.path.join(tmpdir_path, "blank")
    _write(os.path.join(e, "p.csv"), "\nTitle\nA,B\n1,2\n")
    assert [(r.A, r.record_no) for r in read_csv_with_lineage(spark, e, skiprows=2, multiline=multiline).collect()] == [("1", 4)]
    broken = read_csv_with_lineage(spark, d, skiprows=1, multiline=multiline, keep_broken=True)
    assert sorted((r.A, r.record_no, r._overflow) for r in broken.filter("_overflow is not null").collect()) == [("5", None, "7")]


def test_wide_preamble_in_a_stream(spark, tmpdir_path):
    from effdated.streaming.ingest import start_csv_ingest
    land, t = os.path.join(tmpdir_path, "land"), "bronze_stream_wide"
    _write(os.path.join(land, "s1.csv"), "Title,x,y,z\na,b\n1,x\n2,y\n3,z,zz\n4,w\n")
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    start_csv_ingest(spark, land, t, ["a", "b"], skiprows=1, checkpoint=os.path.join(tmpdir_path, "ck")).awaitTermination(120)
    assert sorted((r.a, r.b, r.Source) for r in spark.table(t).collect()) == [("1", "x", "s1:row:3"), ("2", "y", "s1:row:4"), ("4", "w", "s1:row:5")]


@pytest.mark.parametrize("multiline", [False, True])
def test_each_multiline_file_has_its_own_header(spark, tmpdir_path, multiline):
    _write(os.path.join(tmpdir_path, "m", "a.csv"), 'x,y\n1,"2"\n')
    _write(os.path.join(tmpdir_path, "m", "b.csv"), "y,z,x\n3,4,5\n")
    rows = sorted((r.x, r.y, r.z) for r in read_csv_with_lineage(spark, os.path.join(tmpdir_path, "m"), multiline=multiline).collect())
    assert rows == [("1", "2", None), ("5", "3", "4")]


def test_bad_csv_files_are_listed_and_skipped(spark, tmpdir_path):
    """Of three files and an empty one, two are bad; the others load."""
    from effdated.sources.csv import csv_faults
    _write(os.path.join(tmpdir_path, "good.csv"), "a,b\n1,2\n")
    _write(os.path.join(tmpdir_path, "also.csv"), "a,b\n3,4\n")
    _write(os.path.join(tmpdir_path, "empty.csv"), "")
    with open(os.path.join(tmpdir_path, "bad.csv"), "wb") as f:
        f.write(b"a,b\n\xff\xfe5,6\n")
    assert sorted((r.a, r.b) for r in read_csv_with_lineage(spark, tmpdir_path).collect()) == [("1", "2"), ("3", "4")]
    faults = {r.path.rsplit("/", 1)[1]: r.error for r in csv_faults(spark, tmpdir_path).collect()}
    assert faults == {"empty.csv": "no header line after 0 lines", "bad.csv": "not valid utf-8"}


def test_plan_does_not_grow_with_layouts_and_shuffles_no_lines(spark, tmpdir_path):
    def plan(n):
        d = os.path.join(tmpdir_path, f"layouts{n}")
        for i in range(n):
            _write(os.path.join(d, f"f{i}.csv"), f"k,v{i}\n{i},x\n")
        df = read_csv_with_lineage(spark, d)
        assert df.count() == n
        text = df._jdf.queryExecution().sparkPlan().toString()
        return text.count("FileScan text"), text.count("Join")

    assert plan(2) == plan(12)


def test_workbooks_of_one_name_stay_apart(spark, tmpdir_path):
    from effdated.sources.workbook import pivot_workbook
    for folder in "ab":
        os.makedirs(os.path.join(tmpdir_path, folder))
        _xlsx(os.path.join(tmpdir_path, folder, "emp.xlsx"))
    wide = pivot_workbook(read_workbook_with_lineage(spark, tmpdir_path, header=1), ["Staff Member", "Joined"])
    rows = wide.collect()
    assert len(rows) == 4 == len({r.Source for r in rows}) and all(r.Source.startswith("emp~") for r in rows)
