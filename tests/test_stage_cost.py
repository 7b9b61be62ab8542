"""Stages and shared steps do no work that their readers don't need."""

import datetime as dt
import itertools
import threading

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from campanula.operators import describe as D
from campanula.operators import kmeans as K
from campanula.operators.tables import CLEANERS
from campanula.plans import q_core
from campanula.plans.registry import Tables
from campanula.session import split_methods
from campanula.sources import files
from harness import SF_SMALL

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_silver_does_not_land_bronze(spark):
    t = Tables(spark, SF_SMALL)
    silver = sorted(map(tuple, t.leads.collect()), key=repr)
    assert set(t._stages) == {"silver_leads"}
    landed = Tables(spark, SF_SMALL)
    assert silver == sorted(map(tuple, CLEANERS["leads"](landed.bronze_table("leads")).collect()), key=repr)
    assert silver == sorted(map(tuple, landed.leads.collect()), key=repr)


def test_csv_exports_are_written_once_from_the_source_and_side_by_side(spark, monkeypatch):
    together, seen, write = threading.Barrier(5), [], files.write_raw

    def waiting(df, path, damage):
        together.wait(60)  # no export ends before all have begun
        seen.append((path.rsplit("/", 1)[1], path.rsplit("/", 1)[0], spark.conf.get(LIMIT)))
        write(df, path, damage)
    monkeypatch.setattr(files, "write_raw", waiting)
    t, before = Tables(spark, SF_SMALL), spark.conf.get(LIMIT)
    monkeypatch.setattr(q_core, "tables", lambda *_: t)
    first = sorted(map(tuple, q_core.q_csv_scan(spark, SF_SMALL).collect()))
    assert {s[0] for s in seen} == {f"csv_{n}" for n in q_core._EXPORTS} and len(seen) == 5
    assert {s[1:] for s in seen} == {(t.stage_root, "8000")} and spark.conf.get(LIMIT) == before
    assert not t._stages  # no Parquet copy of the exports on the way
    monkeypatch.setattr(files, "write_raw", None)
    assert sorted(map(tuple, q_core.q_csv_scan(spark, SF_SMALL).collect())) == first  # written once
    good = {r[0]: r[1] + r[2] for r in first}
    assert good == {n: t.raw_bronze[n].count() for n in q_core._EXPORTS}


def test_stages_are_compiled_in_small_methods(spark, monkeypatch):
    seen, write = [], files.write_stage
    monkeypatch.setattr(files, "write_stage", lambda df, path: (seen.append(spark.conf.get(LIMIT)), write(df, path)))
    before = spark.conf.get(LIMIT)
    Tables(spark, SF_SMALL).campaigns.count()
    assert seen == ["8000"] and spark.conf.get(LIMIT) == before
    with pytest.raises(ZeroDivisionError), split_methods(spark):
        1 / 0
    assert spark.conf.get(LIMIT) == before


def test_first_and_second_order(spark):
    day = [None, dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 3, 1)]
    rows = [(k, day[i], f"o{j}", c, p) for k, (i, j, c, p) in enumerate(itertools.product(range(4), range(2), ("b", None), ("x", "a")))]
    rows = [(None if k % 11 == 0 else f"c{k % 5}", *r) for k, *r in rows]
    rows += rows[::3]
    tx = spark.createDataFrame(rows, "customer_id string, order_date date, order_id string, product_category string, payment_type string").select(
        "*", *[F.lit(None).cast("double").alias(c) for c in ("revenue_usd", "units", "discount_pct")],
        F.lit(True).alias("returned_flag"), F.lit("m").alias("marketing_channel_last_touch"))
    out = D.nth2_by(tx, "customer_id", "order_date", D.TX_TIEBREAK, ["product_category", "payment_type"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_sk" not in plan and "_row" not in plan  # each column is sorted and sent once
    low = lambda v: (v is not None, v or "")
    want = {}
    for k in {r[0] for r in rows} - {None}:
        own = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is None, r[1] or day[1], low(r[2]), low(r[3]), low(r[4])))
        want[k] = (own[0][1], own[0][3], own[0][4], own[1][1])
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == want


def test_one_distance_table_for_all_models(monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2300, 3))
    models = {m: rng.normal(size=(2 + m % 3, 3)) for m in range(6)}
    batch = pa.RecordBatch.from_arrays([pa.array(x.tolist())], names=["x"])
    empty = batch.slice(0, 0)
    made = []

    class Points:
        def mapInArrow(self, sums, schema):
            self.rows = pa.Table.from_batches(list(sums(iter([empty, batch])))).to_pylist()
            return self

        def groupBy(self, *_):
            return self

        agg = groupBy

        def collect(self):
            return [type("Row", (), r)() for r in self.rows]
    distances = K._distances
    monkeypatch.setattr(K, "_distances", lambda a, b: (made.append(len(a)), distances(a, b))[1])
    monkeypatch.setattr(K.F, "sum", lambda c: type("C", (), {"alias": lambda self, n: self})())
    got = K._pass(Points(), models)
    assert made == [1000, 1000, 300]
    for m, c in models.items():
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        near = d.argmin(1)
        for j in range(len(c)):
            at = near == j
            assert np.allclose(got[m][j], [at.sum(), d[at, j].sum(), (x[at] ** 2).sum(), *x[at].sum(0)])
