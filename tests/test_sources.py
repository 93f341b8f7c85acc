import datetime as dt
import io
import json
import os
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from derrick.sources import files, storage, tables
from derrick.sources.workbook import workbook_bytes


def write(path, text):
    path.write_text(text)
    return str(path)


def workbook(rows, date_column=None) -> bytes:
    """A minimal .xlsx file: numbers, shared strings and a date style."""
    texts, body = [], []
    for r, row in enumerate(rows, 1):
        cells = []
        for c, value in enumerate(row):
            ref = f"{chr(65 + c)}{r}"
            if value is None:
                continue
            if isinstance(value, str):
                texts.append(value)
                cells.append(f'<c r="{ref}" t="s"><v>{len(texts) - 1}</v></c>')
            else:
                style = ' s="1"' if c == date_column else ""
                cells.append(f'<c r="{ref}"{style}><v>{value}</v></c>')
        body.append(f'<row r="{r}">{"".join(cells)}</row>')
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="one" sheetId="1" r:id="rId7"/></sheets></workbook>')
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            f'<Relationship Id="rId7" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        z.writestr("xl/sharedStrings.xml", f'<sst {main}>{"".join(f"<si><t>{t}</t></si>" for t in texts)}</sst>')
        z.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {main}><sheetData>{"".join(body)}</sheetData></worksheet>')
    return out.getvalue()


def test_csv_null_tokens_and_junk(spark, tmp_path):
    path = write(tmp_path / "a.csv", "DATEPRD,X,T\n2020-01-01,NA,ok\nbad,,null\n2020-01-03,7,n/a\n")
    rows = files.read_file(spark, path).collect()
    assert [tuple(r) for r in rows] == [("2020-01-01", None, "ok"), ("bad", None, None), ("2020-01-03", "7", None)]


def test_txt_is_read_like_csv(spark, tmp_path):
    path = write(tmp_path / "a.txt", "A,B\n1,2\n")
    assert [tuple(r) for r in files.read_file(spark, path).collect()] == [("1", "2")]


def test_files_with_another_column_order_are_refused(spark, tmp_path):
    write(tmp_path / "a.csv", "A,B\n1,2\n")
    write(tmp_path / "b.csv", "B,A\n2,1\n")
    with pytest.raises(Exception, match="CSV header"):
        files.read_file(spark, str(tmp_path / "*.csv")).collect()


def test_json_records_take_the_union_of_keys(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps([{"A": 1, "B": "x"}, {"B": "y", "C": 2.5}]))
    rows = files.read_file(spark, path).select("A", "B", "C").collect()
    assert [tuple(r) for r in rows] == [("1", "x", None), (None, "y", "2.5")]
    rows = files.read_json(spark, path, ["A", "B", "D"]).collect()
    assert [tuple(r) for r in rows] == [("1", "x", None), (None, "y", None)]


def test_json_numbers_are_read_as_written_across_lines(spark, tmp_path):
    records, arrays = tmp_path / "records", tmp_path / "arrays"
    for i, text in enumerate(["1.50", "12345678901234567890.123", "1e5"]):
        for folder, document in ((records, f'[{{"A":{text},"B":"x"}},\n {{"A":{text}}}]\n'), (arrays, f'{{"A":[{text},{text}],\n"B":["x",null]}}')):
            folder.mkdir(exist_ok=True)
            write(folder / f"{i}.json", document)
    want = sorted((t, b) for t in ("1.50", "12345678901234567890.123", "1e5") for b in ("x", "-"))
    for folder in (records, arrays):
        found = files.read_json(spark, str(folder))
        assert sorted((r["A"], r["B"] or "-") for r in found.collect()) == want
        assert found.columns == ["A", "B"]


def test_json_records_that_are_not_flat_keep_their_inferred_shape(spark, tmp_path):
    cases = {"nested": '[{"A":{"x":1}}]', "malformed": '[{"A":1},{"B":', "text": '[{"A":"{not"}]', "number": '[1,{"A":2}]'}
    shapes = {}
    for name, text in cases.items():
        path = write(tmp_path / f"{name}.json", text)
        shapes[name] = [f.dataType.simpleString() for f in files.read_json(spark, path).schema.fields]
        inferred = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)
        assert files.read_json(spark, path).schema == inferred.schema, name
    assert shapes["nested"] == ["struct<x:string>"]


def test_a_workbook_is_built_from_one_document_at_a_time(spark):
    from derrick.plans.queries_files import _documents, _workbooks

    raw = spark.range(500).select(F.lit("2020-01-02").alias("DATEPRD"), F.concat(F.lit("W-"), F.col("id") % 50).alias("WELL_BORE_CODE"), F.lit("t").alias("WELL_TYPE"), F.col("id").cast("double").alias("BORE_OIL_VOL"), F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"))
    books = _workbooks(_documents(raw, 100).coalesce(1))
    assert "MapInArrow" in books._jdf.queryExecution().executedPlan().toString()
    assert sorted(float(r["BORE_OIL_VOL"]) for r in files.workbook_rows(books).collect()) == [float(i) for i in range(500)]


def test_json_dictionary_of_arrays(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps({"A": [1, 2], "B": ["x", None]}))
    assert [tuple(r) for r in files.read_file(spark, path).collect()] == [("1", "x"), ("2", None)]
    path = write(tmp_path / "b.json", json.dumps({"A": [1, 2], "B": ["x"]}))
    with pytest.raises(Exception, match="different length"):
        files.read_file(spark, path).collect()


def test_json_dictionary_of_index_maps(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps({"A": {"0": 1, "1": 2}, "B": {"1": "x"}}))
    assert sorted(tuple(r) for r in files.read_file(spark, path).collect()) == [("1", None), ("2", "x")]


def test_json_of_another_shape_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported JSON"):
        files.read_file(spark, write(tmp_path / "a.json", json.dumps({"A": 1})))


def test_workbooks_by_header_name(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook([["DATEPRD", "X", "T"], [43831, 1.5, "u"], [43832.5, None, "v"]], 0))
    rows = files.read_file(spark, str(tmp_path / "a.xlsx")).collect()
    assert [tuple(r) for r in rows] == [("2020-01-01", "1.5", "u"), ("2020-01-02 12:00:00", None, "v")]
    (tmp_path / "b.xlsx").write_bytes(workbook([["T", "DATEPRD"], ["w", 43833]], 1))
    many = files.read_workbook(spark, str(tmp_path / "*.xlsx"), ["DATEPRD", "T", "Z"])
    assert sorted(tuple(r) for r in many.collect())[-1] == ("2020-01-03", "w", None)
    assert many.count() == 3


def test_written_workbooks_are_read_back(spark):
    day = dt.date(2021, 3, 4)
    books = [
        ("a", [["DAY", "N", "T"], [day, 1.5, "x & <y>"], [None, -2, " b "], ["bad", None, "é"]]),
        ("b", [[f"c{i}" for i in range(30)] + ["N"], [*range(30), 7]]),
        ("c", [["N"]]),
    ]
    table = spark.createDataFrame([(p, bytearray(workbook_bytes(rows))) for p, rows in books], "path string, content binary")
    found = files.workbook_rows(table, ["DAY", "N", "T", "c27"])
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [("2021-03-04", "1.5", "x & <y>", None), (None, "-2", " b ", None), ("bad", None, "é", None), (None, "7", None, "27")], key=str
    )
    assert files.workbook_rows(table).columns == ["DAY", "N", "T", *[f"c{i}" for i in range(30)]]


def test_unknown_legacy_missing_and_empty_files(spark, tmp_path):
    with pytest.raises(ValueError, match=r"supported: .*\.csv"):
        files.read_file(spark, write(tmp_path / "a.pdf", "x"))
    with pytest.raises(ValueError, match="legacy"):
        files.read_file(spark, write(tmp_path / "a.xls", "x"))
    with pytest.raises(FileNotFoundError):
        files.read_file(spark, str(tmp_path / "none.csv"))
    empty = write(tmp_path / "e.csv", "")
    with pytest.raises(ValueError, match="empty file"):
        files.read_file(spark, empty)
    assert files.extract(spark, empty) is None
    assert [os.path.basename(p) for p in storage.empty_files(spark, str(tmp_path))] == ["e.csv"]


def test_newest_file_among_supported_ones(spark, tmp_path):
    now = time.time()
    for age, name in ((30, "old.csv"), (20, "new.json"), (10, "newer.pdf")):
        write(tmp_path / name, "x")
        os.utime(tmp_path / name, (now - age, now - age))
    assert files.newest_file(spark, str(tmp_path)).endswith("new.json")
    assert [r["path"].rsplit("/", 1)[1] for r in files.newest_files(spark, str(tmp_path), 5).collect()] == ["new.json", "old.csv"]
    os.mkdir(tmp_path / "none")
    assert files.newest_file(spark, str(tmp_path / "none")) is None


def test_sql_with_parameters_and_errors(spark):
    frame = spark.range(5)
    assert tables.run_sql(spark, "SELECT id FROM {t} WHERE id > :low", {"low": 2}, t=frame).count() == 2
    with pytest.raises(Exception):
        tables.run_sql(spark, "SELECT nothing FROM nowhere")
    assert tables.require_row(frame, id=3)["id"] == 3
    with pytest.raises(LookupError):
        tables.require_row(frame, id=9)


def test_point_lookup_reaches_the_scan(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    plan = tables.point_lookup(tables.scan_path(spark, str(tmp_path / "t")), id=4)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,4)" in plan


def test_listing_does_not_read_contents(spark, tmp_path):
    write(tmp_path / "a.csv", "x")
    plan = files._listing(spark, str(tmp_path)).agg(F.max("path"))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_a_well_with_many_rows_is_many_documents(spark):
    from pyspark.sql import functions as F

    from derrick.plans.queries_files import _documents

    raw = spark.range(900).select(F.lit("d").alias("DATEPRD"), F.when(F.col("id") > 99, "hot").alias("WELL_BORE_CODE"), F.lit("t").alias("WELL_TYPE"), F.col("id").alias("BORE_OIL_VOL"), F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"))
    sizes = [len(r.rows) for r in _documents(raw, 100).collect()]
    assert sum(sizes) == 900 and max(sizes) < 200
