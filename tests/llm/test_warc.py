import gzip
import hashlib
import os
import uuid

import pytest
from pyspark.sql import functions as F

from campanula.llm import queries, warc
from harness import compare, duck

SF = "/root/testdata/sf0.001"
LONG = "<p>" + "same body " * 20 + "</p>"


@pytest.fixture
def folder(tmp_path):
    return f"file://{tmp_path}/{uuid.uuid4().hex}"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(5, "http://a.example/ x\r\n?q", LONG, 1), (3, None, LONG, 1), (9, "u9", LONG, 1), (9, "u9", LONG, 1), (4, "u4", "short", 1),
            (2, "u2", "short", 1), (1, "u1", None, 1), (0, "u0", "", 1), (None, "n", LONG, 1), (None, "n", "alone " * 40, 1),
            (None, "n2", "alone " * 40, 1), (7, "u7", "\r\n\r\nWARC/1.1\r\n\r\n" + "é\U0001F600" * 60, 1), (8, "u8", "big " * 400_000, 1),
            (6, "same", "twice " * 30, 1), (6, "same", "twice " * 30, 1), (-4, "minus", "below zero " * 20, 1), (11, "plus", "below zero " * 20, 1)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload int")


def plain(rows):
    out = []
    for r in rows:
        b = (r.html or "").encode()
        first = min((x.page_id for x in rows if x.html == r.html and x.page_id is not None), default=None) if len(b) >= 100 else None
        again = first is not None and (r.page_id is None or r.page_id > first)
        out.append((r.page_id, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_odd_pages_against_plain(spark, odd, folder):
    got = warc.archive_digest(spark, odd, folder)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(odd.collect())


def test_shuffled_copies_give_the_same(spark, odd, folder, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    got = warc.archive_digest(spark, odd, folder)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(odd.collect())


def test_index_points_at_records(spark, odd, folder):
    """Each index row's bytes are one gzip member with one record; small archives roll over."""
    index = warc.write_archives(odd.repartition(2), folder, archive_bytes=2000).collect()
    root = folder.removeprefix("file://")
    assert len({r.archive for r in index}) > 2 and len(index) == odd.count()
    for r in index:
        with open(f"{root}/{r.archive}", "rb") as f:
            f.seek(r.offset)
            record = warc.parse_record(gzip.decompress(f.read(r.length)))
        assert (record["page_id"], record["payload_digest"], record["record_type"]) == (r.page_id, r.digest, r.record_type)
    for name in {r.archive for r in index}:  # records fill the archives without gaps
        spans = sorted((r.offset, r.length) for r in index if r.archive == name)
        ends = [0] + [o + n for o, n in spans]
        assert [o for o, _ in spans] == ends[:-1] and ends[-1] == os.path.getsize(f"{root}/{name}")


def test_selection_and_whole_payloads(spark, odd, folder):
    index = warc.write_archives(odd, folder)
    revisits = index.where("record_type = 'revisit'")
    got = warc.whole_records(index, revisits, folder).collect()
    assert len(got) == revisits.count() > 3
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in got)
    one = warc.read_records(index.where("url = 'u7'"), folder).collect()
    assert len(one) == 1 and bytes(one[0].payload).decode() == odd.where("page_id = 7").first().html
    assert warc.read_records(index.where("1 = 0"), folder).collect() == []


def test_joined_ranges():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 5), ("b", 0, 500), ("b", 500, 10), ("b", 500, 10)]
    got = [[(a, o) for a, o, _ in g] for g in warc.joined_ranges(rows, gap=10, most=50)]
    assert got == [[("a", 0), ("a", 10), ("a", 25)], [("a", 100)], [("b", 0)], [("b", 500), ("b", 500)]]


def test_damage_is_an_error(spark, odd, folder):
    index = warc.write_archives(odd.where("page_id = 7"), folder)
    moved = index.withColumn("offset", F.col("offset") + 1)
    with pytest.raises(Exception, match="archives/"):
        warc.read_records(moved, folder).collect()


def test_query_against_sql(spark):
    ok, msg = compare(queries.op12_warc(spark, SF).toPandas(), duck(SF).execute(warc.oracle_sql()).df())
    assert ok, msg


def test_empty(spark, odd, folder):
    assert warc.archive_digest(spark, odd.where("1 = 0"), folder).collect() == []
