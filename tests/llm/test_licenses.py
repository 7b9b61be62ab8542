from campanula.llm import licenses as L
from harness import compare, duck


def test_equivalent_forms_match(spark):
    mit = L.LICENSES["MIT"]
    docs = [(1, mit), (2, "Copyright (c) 2020 A. Person\n\n" + mit.upper().replace(",", " ;")), (3, "© 1999 B\nAll rights reserved.\n" + L.LICENSES["BSD-2-Clause"]),
            (4, mit + " and more"), (5, "text\n  LICENCED under   the MIT Licence!!\nmore"), (6, "see Licensed under the MIT License."), (7, None), (8, ""),
            (9, L.LICENSES["BSD-3-Clause"].replace("HOLDERS", "OWNERS")), (10, "All rights reserved.\nReleased under the MIT License.")]
    out = {r.doc_id: r for r in L.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [out[k].license_id for k in range(1, 11)] == ["MIT", "MIT", "BSD-2-Clause", None, None, None, None, None, "BSD-3-Clause", None]
    assert out[5].notices == "MIT" and out[6].notices == "" and out[10].notices == "MIT,all-rights-reserved"
    assert out[3].verdict == "restricted" and out[10].verdict == "restricted" and out[5].verdict == "permissive" and out[7].verdict == "none"
    assert out[7].text_digest == out[8].text_digest


def test_against_duckdb(spark):
    sf = "/root/testdata/sf0.001"
    got = L.scan_licenses(spark.read.parquet(f"{sf}/documents.parquet")).toPandas()
    ok, msg = compare(got, duck(sf).execute(L.oracle_sql()).df())
    assert ok, msg
    assert (got.n_notices > 0).any()


def test_odd_input(edge, empty):
    assert L.scan_licenses(empty).count() == 0
    out = L.scan_licenses(edge)
    assert out.count() == edge.count() and "Python" not in out._jdf.queryExecution().toString()
