import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from campanula.llm import prefix_trie as P
from campanula.llm import queries
from harness import compare, duck

SF = "/root/testdata/sf0.001"


def towards_zero(c):
    return c - (abs(c) % 5) * (1 if c > 0 else -1)


def plain_trie(rows):
    """All rebuilt conversations written out as tuples; nodes in a dictionary."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [(r, x) for _, r, x in sorted(v)] for c, v in convs.items()}
    members, length = defaultdict(list), {}
    for c in sorted(convs):
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(convs.get(towards_zero(c), [])[:h] + convs[c][h:])
        length[c] = len(path)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    below = defaultdict(lambda: [0, 0])
    kids = defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path, m in members.items():
        saved = (len(m) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            below[path[:d]][0] += saved
            below[path[:d]][1] += not kids[path]
    out = []
    for path, m in members.items():
        ends = ",".join(str(c) for c in m if length[c] == len(path))
        out.append((m[0], len(path), members[path[:-1]][0] if path else None, len(m), kids[path], below[path][1], below[path][0],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def random_rows(seed, convs, most):
    """Few different turns, so that many prefixes are shared, end inside others or are equal."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-15, 5 * convs), convs):
        for k in range(rng.randrange(1, most)):
            text = rng.choice(["a", "b", "é\U0001F600", "", None]) if rng.random() < 0.35 else "a"
            rows.append((c, rng.choice([k, k, k, None]), rng.choice(["user", "user", "user", None]), text))
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, depth string, n_convs int")


def ordered(rows):
    """Turns with equal numbers in a fixed order, so that the plain version needs no hashes."""
    seen = set()
    return [r for r in rows if (r[0], r[1]) not in seen and not seen.add((r[0], r[1]))]


@pytest.mark.parametrize("seed,convs,most", [(1, 60, 12), (2, 25, 30), (3, 200, 4)])
def test_against_plain(spark, seed, convs, most):
    rows = ordered(random_rows(seed, convs, most))
    got = P.prefix_trie(frame(spark, rows).repartition(3))
    assert got.columns == P.OUTPUT and {t for _, t in got.dtypes} == {"bigint", "string"}
    assert sorted(tuple(r) for r in got.collect()) == plain_trie(rows)


def test_one_conversation_over_many_partitions(spark):
    """A third of all turns in one conversation, repeated rows, and conversations that share its head."""
    rows = [(10, k, "user", f"t{k % 3}") for k in range(500)] + [(c, k, "user", f"t{k % 3}") for c in range(11, 60) for k in range(12)]
    rows += [(100, 5, "user", "again")] * 150 + [(101, k, "u", "x") for k in range(2)] + [(None, 1, "user", "lost")]
    want = plain_trie(rows)
    got = P.prefix_trie(frame(spark, rows).repartition(7)).collect()
    assert sorted(tuple(r) for r in got) == want


def test_shuffled_references_and_wrong_hashes(spark, monkeypatch):
    """Colliding turn hashes are noticed and replaced."""
    monkeypatch.setattr(P, "BROADCAST_REFS", 0)
    rows = ordered(random_rows(4, 40, 9))
    tried = []

    def weak(seed, *cols):
        seed_value = int(str(seed._jc.toString()))
        tried.append(seed_value)
        return F.length(cols[0]).cast("long") if seed_value < 2 else real(seed, *cols)
    real = F.xxhash64
    monkeypatch.setattr(P.F, "xxhash64", weak)
    got = P.prefix_trie(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == plain_trie(rows) and max(tried) == 3


def test_turnless_absent_base_and_empty(spark):
    absent = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:4]
    rows = [(c, 0, "user", "hi") for c in absent]
    got = sorted(tuple(r) for r in P.prefix_trie(frame(spark, rows)).collect())
    assert got == plain_trie(rows) and len(got) == 1 and got[0][4:6] == (0, 1)
    assert P.prefix_trie(frame(spark, rows).where("1 = 0")).collect() == []


def test_long_ends_are_streamed(spark):
    """More members than one block holds, in one node."""
    ids = [c for c in range(0, 50_000, 5)]
    df = spark.createDataFrame([(c, 0, "user", "same") for c in ids], "conv_id long, turn long, role string, text string")
    got = {r.depth: r for r in P.prefix_trie(df).collect()}
    assert got[1].n_convs == len(ids) and got[1].ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_query_against_sql_and_plain(spark):
    got = queries.op11_prefix_trie(spark, SF)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(tuple(r) for r in got.collect()) == plain_trie(rows)
    ok, msg = compare(got.toPandas(), duck(SF).execute(P.oracle_sql()).df())
    assert ok, msg
