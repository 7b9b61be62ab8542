import random

import numpy as np
import pyarrow as pa
import pytest
from test_line_dedup import dist, edited, trees

from campanula.llm import line_dedup as L


@pytest.mark.parametrize("heavy", [[], [7]])
@pytest.mark.parametrize("sizes", [(4, 4), (4, 1, 3), (4, 2, 2), (4, 1), (1, 1, 1, 1, 1, 3), (8,)])
def test_no_row_of_a_hot_key_is_lost(sizes, heavy):
    """Five rows of key 7 (hot from the fourth on) and three others, whatever the batch borders."""
    keys, lids = [7] * 5 + [9] * 3, list(range(1, 9))
    batches, at = [], 0
    for n in sizes:
        part = slice(at, at + n)
        size = len(keys[part])
        batches.append(pa.RecordBatch.from_arrays(
            [pa.array([k << 1 for k in keys[part]], pa.int64()), pa.array(lids[part], pa.int64()), pa.array(np.zeros(size, np.int64))],
            names=["key", "lid", "sig"]))
        at += n
    out = [r for b in L._match_stream(3, heavy)(iter(batches)) for r in b.to_pylist()]
    seen = sum(sizes)
    assert sorted(r["a"] for r in out if r["b"] is None) == [1, 2, 3, 4, 5][:seen]
    assert {(r["a"], r["b"]) for r in out if r["b"] is not None} == ({(6, 7), (6, 8), (7, 8)} if seen == 8 else set())


@pytest.mark.parametrize("records", [1, 2, 7])
def test_links_with_small_arrow_batches(spark, records):
    rng = random.Random(records)
    lines = sorted({edited(rng, "this line begins alike in all of them and ends " + f"{rng.randrange(30):04d}", rng.randrange(3), "xyz") for _ in range(60)})
    lids = L.line_ids(lines)[0].tolist()
    want = {tuple(sorted((lids[i], lids[j]))) for i in range(len(lines)) for j in range(i + 1, len(lines)) if dist(lines[i], lines[j]) <= 2}
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(records))
    try:
        got = {tuple(sorted((r.a, r.b))) for r in L.edit_links(spark.createDataFrame(list(zip(lids, lines)), "lid long, line string"), 2, 32, 3).collect()}
    finally:
        spark.conf.set(name, before)
    assert got <= want and trees(got, lids) == trees(want, lids) and len(want) > 20
