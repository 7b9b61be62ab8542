import zlib
from collections import Counter, defaultdict

import numpy as np

from campanula.llm import sharding


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_one():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 3000, dtype=np.uint64)
    for n in (1, 2, 40, 41, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [plain_jump(int(k), n) for k in keys]


def test_documents(both):
    out = sharding.shard_documents(both, 40).collect()
    texts = defaultdict(list)
    for r in both.collect():
        texts[r.doc_id].append((r.text or "").encode())
    assert len(out) == both.count()
    slots = defaultdict(list)
    for r in out:
        assert (r.size, r.text_crc32) in {(len(t) + 16, zlib.crc32(t)) for t in texts[r.doc_id]}
        assert r.law == "key" and 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert any(r.grown_shard == 40 for r in out)


def test_same_key_same_shard_whatever_the_table(documents):
    one = {r.doc_id: r.shard for r in sharding.shard_documents(documents, 40).collect()}
    some = {r.doc_id: r.shard for r in sharding.shard_documents(documents.where("doc_id % 3 = 0").repartition(5), 40).collect()}
    assert all(one[k] == v for k, v in some.items()) and max(Counter(one.values()).values()) < 20


def test_odd_input(edge, empty):
    assert sharding.shard_documents(empty, 4).count() == 0
    out = sharding.shard_documents(edge, 4, buckets=2)
    assert out.count() == edge.count() and out.where("doc_id is null").count() == 1
