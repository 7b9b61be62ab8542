import random
import re
from collections import defaultdict

import numpy as np
import xxhash

from campanula.llm import simhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, budget):
    vals = sorted(set(fps))
    parent = {v: v for v in vals}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(vals):
        for b in vals[i + 1:]:
            if (a ^ b).bit_count() <= budget:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {v: root(v) for v in vals}


def clustered(rng, n):
    out = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        v = rng.choice(out)
        for _ in range(rng.randrange(4)):
            v ^= 1 << rng.randrange(64)
        out.append(v)
    return sorted(set(out))


def test_documents_against_all_pairs(both):
    rows = both.where("doc_id < 1000900").collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    root = plain_components(fps.values(), 2)
    least = defaultdict(lambda: 1 << 62)
    for d, f in fps.items():
        least[root[f]] = min(least[root[f]], d)
    got = simhash.near_duplicate_classes(both.where("doc_id < 1000900"), leaf_rows=16).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(d, f"{f:016x}", least[root[f]]) for d, f in fps.items()}


def test_trie_links_against_all_pairs():
    rng = random.Random(2)
    v = np.array(clustered(rng, 250), np.uint64)
    want = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if (int(v[i]) ^ int(v[j])).bit_count() <= 2}
    got = [(min(i, j), max(i, j)) for a, b in simhash.trie_links(v, None, 0, 0, 2, most=64) for i, j in zip(a.tolist(), b.tolist())]
    assert sorted(got) == sorted(want)
    a, b = v[::2], v[1::2]
    cross = {(i, j) for i in range(len(a)) for j in range(len(b)) if (int(a[i]) ^ int(b[j])).bit_count() <= 2}
    assert cross == {(i, j) for x, y in simhash.trie_links(a, b, 0, 0, 2) for i, j in zip(x.tolist(), y.tolist())}


def test_crowded_prefixes_and_long_chains(spark):
    """Half of all values share 40 bits; a chain of single-bit steps is one class."""
    rng = random.Random(4)
    values = clustered(rng, 120) + [(0xABCDEF0123 << 24) | rng.getrandbits(24) for _ in range(250)]
    chain = [0]
    for b in range(40):
        chain.append(chain[-1] ^ (1 << b))
    values = sorted(set(values + chain))
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    roots = simhash.components(simhash.hamming_forest(df, 2, leaf_rows=20)).collect()
    got = defaultdict(set)
    for r in roots:
        got[r.root].add(r.node % (1 << 64))
    want = defaultdict(set)
    for v, r in plain_components(values, 2).items():
        want[r].add(v)
    assert {frozenset(s) for s in got.values()} == {frozenset(s) for s in want.values() if len(s) > 1}


def test_one_of_each_class_stays(edge, empty, spark):
    kept = simhash.drop_near_duplicates(edge)
    assert kept.columns == edge.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id is not null").collect())
    assert ids.count(900) == 1 and ids[0] == 0 and not {1, 2, 3} & set(ids)  # texts without words are one class
    assert ids.count(901) == 2  # a repeated id with two texts: two classes
    assert simhash.drop_near_duplicates(empty).count() == 0 and simhash.near_duplicate_classes(empty).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (1, "e f g h")], "doc_id long, text string")
    assert simhash.drop_near_duplicates(nulls).count() == 3
