"""SRC-01 raw CSV reader: BOM, quoted thousands separators, all strings."""

import os
import tempfile

import pytest

from campanula.sources.files import RAW_COLUMNS, quarantine, read_raw, scan_raw, write_raw
from campanula.sources.testdata import bronze_campaigns
from harness import SF_SMALL
from harness import compare


def test_read_raw_csv_round_trip(spark):
    bronze = bronze_campaigns(spark, SF_SMALL).drop("_src_row")
    pdf = bronze.toPandas()
    path = os.path.join(tempfile.mkdtemp(prefix="campanula-csv-"), "campaigns.csv")
    pdf.to_csv(path, index=False, encoding="utf-8-sig")   # BOM + quoted "65,494.00"
    got = read_raw(spark, path, "campaigns", columns=list(pdf.columns))
    assert all(f.dataType.typeName() == "string" for f in got.schema.fields)
    ok, msg = compare(got.toPandas(), pdf)
    assert ok, msg
    assert "campaign_id" in RAW_COLUMNS["campaigns"]


COLS = ["id", "name", "note"]


def _file(tmp_path, name, *lines):
    (tmp_path / name).mkdir()
    (tmp_path / name / "a.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(tmp_path / name)


def test_other_header_is_an_error(spark, tmp_path):
    for i, header in enumerate(["name,id,note", "id,name,remark", "id,name"]):
        path = _file(tmp_path, f"h{i}", header, "1,x,y")
        with pytest.raises(Exception, match="(?i)header"):
            read_raw(spark, path, columns=COLS).collect()


def test_quarantine_keeps_whole_records(spark, tmp_path):
    path = _file(tmp_path, "q", "id,name,note", '1,"a,b",ok', "2,short", "3,c,d,stray", "4,,", ' 5 ,"say ""hi""",x')
    assert [tuple(r) for r in read_raw(spark, path, columns=COLS).collect()] == [
        ("1", "a,b", "ok"), ("4", None, None), (" 5 ", 'say "hi"', "x")]
    bad = quarantine(spark, path, columns=COLS)
    assert sorted((r.key, r.record) for r in bad.collect()) == [("2", "2,short"), ("3", "3,c,d,stray")]
    assert bad.first().file.endswith("a.csv")
    # asking for few columns must not change which records are bad
    assert read_raw(spark, path, columns=COLS).select("id").count() == 3 and bad.count() == 2
    assert scan_raw(spark, path, columns=COLS).count() == 5


def test_write_raw_round_trip_and_damage(spark, tmp_path):
    df = spark.sql("""SELECT cast(id AS string) AS id, CASE id % 4 WHEN 0 THEN 'a,b' WHEN 1 THEN 'q"uo"te' WHEN 2 THEN ' space ' END AS name,
                      CASE WHEN id % 3 = 0 THEN NULL ELSE 'n' END AS note FROM range(40)""")
    path = str(tmp_path / "w")
    write_raw(df.repartition(3), path)
    ok, msg = compare(read_raw(spark, path, columns=COLS).toPandas(), df.toPandas())
    assert ok, msg
    write_raw(df.repartition(3), path, (df.id.cast("int") % 10).cast("int"))
    assert read_raw(spark, path, columns=COLS).count() == 32 and quarantine(spark, path, columns=COLS).count() == 8


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "id string, name string, note string")
    write_raw(df, str(tmp_path / "e"))
    assert read_raw(spark, str(tmp_path / "e"), columns=COLS).collect() == []
