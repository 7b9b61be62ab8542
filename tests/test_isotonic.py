"""P-12: blocks pooled in buckets against the min-max form of the same fit."""

import random

from campanula.operators import isotonic as IS


def brute(rows):
    """max over starts of min over ends of the mean label: the fit by definition."""
    xs = sorted({x for x, _, _ in rows})
    w = [sum(c for x, _, c in rows if x == v) for v in xs]
    s = [sum(c * y for x, y, c in rows if x == v) for v in xs]
    fit = [max(min(sum(s[j:k + 1]) / sum(w[j:k + 1]) for k in range(i, len(xs))) for j in range(i + 1)) for i in range(len(xs))]
    return dict(zip(xs, fit))


def frame(spark, rows):
    return spark.createDataFrame(rows, "score double, label double, w double")


def test_blocks_match_definition_in_tiny_buckets(spark):
    rng = random.Random(3)
    for n, kind in ((60, "noise"), (40, "falling"), (40, "rising"), (50, "ties")):
        rows = []
        for i in range(n):
            x = float(rng.randrange(8) if kind == "ties" else rng.randrange(400))
            y = {"noise": float(rng.random() < x / 400), "falling": -x, "rising": x, "ties": float(rng.randrange(2))}[kind]
            rows.append((x, y, float(rng.choice([1, 1, 2, 5]))))
        want = brute(rows)
        for bucket in (4, 1000):  # many rounds of shifted buckets; one bucket
            blocks = sorted(IS.fit(frame(spark, rows), weight="w", bucket=bucket).collect())
            assert all(a.hi < b.lo and a.value < b.value for a, b in zip(blocks, blocks[1:]))
            for x, v in want.items():
                (hit,) = [b for b in blocks if b.lo <= x <= b.hi]
                assert abs(hit.value - v) < 1e-9, (kind, bucket, x)
            assert sum(b.weight for b in blocks) == sum(c for _, _, c in rows)


def test_apply_steps_lines_and_ends(spark):
    train = frame(spark, [(1.0, 0.0, 1.0), (2.0, 0.0, 1.0), (4.0, 1.0, 1.0), (5.0, 3.0, 1.0), (6.0, 1.0, 1.0)])
    blocks = IS.fit(train)   # [1, 2] -> 0, [4] -> 1, [5, 6] -> 2
    ask = spark.createDataFrame([(k, x) for k, x in enumerate([0.0, 1.5, 3.0, 4.0, 4.5, 5.5, 9.0, None, float("nan"), 3.0])], "k int, score double")
    got = {r.k: r.calibrated for r in IS.apply(ask, blocks).collect()}
    assert got == {0: 0.0, 1: 0.0, 2: 0.5, 3: 1.0, 4: 1.5, 5: 2.0, 6: 2.0, 7: None, 8: None, 9: 0.5}


def test_empty_null_and_single(spark):
    empty = frame(spark, [])
    assert IS.fit(empty).collect() == []
    assert IS.apply(frame(spark, [(1.0, 0.0, 1.0)]), IS.fit(empty)).first().calibrated is None
    odd = frame(spark, [(None, 1.0, 1.0), (1.0, None, 1.0), (2.0, 0.5, 1.0), (2.0, 1.0, 0.0), (float("nan"), 1.0, 1.0)])
    assert [tuple(r) for r in IS.fit(odd, weight="w").collect()] == [(2.0, 2.0, 1.0, 0.5)]
