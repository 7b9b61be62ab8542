import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from campanula.llm import packing
from campanula.llm.queries import default_ranks, default_tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


def check(docs, pieces, tokenizer, window):
    ids = defaultdict(list)
    for r in docs:
        ids[r.doc_id].append(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0])
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    assert set(by_doc) == set(ids)
    for doc, ps in by_doc.items():
        assert sum(p.length for p in ps) == sum(map(len, ids[doc]))
        if len(ids[doc]) == 1:
            (whole,) = ids[doc]
            at = 0
            for p in sorted(ps, key=lambda p: p.start):
                assert p.start == at and p.length > 0 and p.doc_tokens == len(whole)
                part = np.array(whole[at:at + p.length], "<u4").tobytes()
                assert p.ids_crc32 == zlib.crc32(part)
                at += p.length
            assert at == len(whole)
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
    total = sum(p.length for p in pieces)
    return sum(window - sum(p.length for p in ps) for ps in by_seq.values()) / total


@pytest.mark.parametrize("window,opened", [(1024, 64), (128, 4)])
def test_round_trip(both, tokenizer, window, opened):
    docs = both.where("doc_id is not null").repartition(3, "doc_id").collect()
    df = both.where("doc_id is not null").repartition(3, "doc_id")
    pieces = packing.pack(df, default_tokenizer(), window=window, open_windows=opened, merge_fan_in=2, ranks_file=default_ranks()).collect()
    assert check(docs, pieces, tokenizer, window) < 0.02


def test_text_ids_equal_the_tokenizer(both, tokenizer):
    to_ids = packing.TextIds(default_tokenizer(), default_ranks())
    for r in both.collect():
        got = np.frombuffer(to_ids(r.text or ""), "<u4").tolist()
        assert got == tokenizer.encode(r.text or "", add_special_tokens=False).ids, r.text[:80]


def test_text_ids_random(tokenizer):
    import random
    rng = random.Random(3)
    to_ids = packing.TextIds(default_tokenizer(), default_ranks())
    plain = [chr(c) for c in (10, *range(32, 127), *range(0xC0, 0x250)) if c not in (0xD7, 0xF7)]
    for _ in range(3000):
        t = "".join(rng.choices(plain, [9 if c.isascii() else 1 for c in plain], k=rng.randrange(60)))
        assert packing._PLAIN.fullmatch(t)
        assert np.frombuffer(to_ids(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)
    for _ in range(5000):
        t = "".join(rng.choice(["a", "bc", " ", " ", "\n", ".", ",", "'s", "1", "é", " ", "\t", "²", "中", "<|endoftext|>", "\U0001F600", "\x1c", "​", "́"])
                    for _ in range(rng.randrange(30)))
        assert np.frombuffer(to_ids(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_best_fit_and_fullest_out():
    w = packing.OpenWindows(10, 2)
    assert w.place(6, "a") is None and w.place(7, "b") is None
    assert w.place(3, "c") == ["b", "c"]           # best fit fills b, which is emitted
    assert w.place(8, "d") is None and w.place(9, "e") == ["d"]  # none fits: the fullest goes
    assert sorted(map(tuple, w.rest())) == [("a",), ("e",)]


def test_odd_input(empty, edge):
    assert packing.pack(empty, default_tokenizer()).count() == 0
    large = (1 << 62) + 1  # must stay whole beside a null id
    edge = edge.unionByName(edge.limit(1).withColumn("doc_id", F.lit(large)))
    out = packing.pack(edge, default_tokenizer(), with_ids=True)
    assert out.where(f"doc_id = {large}").count() == 1
    assert out.where("doc_id is null").count() >= 1 and out.where("length * 4 <> octet_length(ids)").count() == 0


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|endoftext|> b", "plain<|endoftext|><|endoftext|>\u4e2d", "<|endoftext", "x <|endoftext|>\n\n y"])
def test_texts_of_special_tokens(tokenizer, text):
    """As the contract's call encodes them: the text of an added token is that token."""
    ids = np.frombuffer(packing.TextIds(default_tokenizer(), default_ranks())(text), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids
    assert (50256 in ids) == ("<|endoftext|>" in text)
