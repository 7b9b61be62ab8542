"""Benchmark decontamination with one Aho-Corasick automaton.

Texts and benchmark items are normalised alike: A-Z to lower case, words are
runs of ASCII digits, letters and all characters beyond ASCII.  A *window* is
``window`` consecutive words of an item; an item with fewer words, but not
none, is one window.  All windows go into one automaton, which reads each
normalised text once.  Word numbers of the hits lead back to code point
offsets of the original text.

A window that several items share is reported for each.  Null texts and texts
without words have no hits; items without words have no windows.  An item whose
id is null can hit words but is not listed.  Repeated rows are handled each on
their own, repeated item ids count once.

The benchmark is a stated query set.  It is cut into blocks of at most
``block_chars`` pattern characters (an automaton takes about 47 bytes a
character: 190 MB at the default); an item longer than that is a block of its
own.  Blocks are read one at a time, each is released after its pass, and a
Python worker builds the automaton of a block once and holds no other, so a
benchmark of any number of items is handled.  Every block after the first is
one more pass over the documents.

An empty benchmark, or one without words, hits nothing.  Empty tables give empty
results; very long texts are read whole; other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campanula.session import materialize

#: bytes to lower case, everything that is not part of a word to a space
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

FOUND = T.StructType([
    T.StructField("n_words", T.LongType(), False),
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField("first", T.LongType(), False),
                                                    T.StructField("last", T.LongType(), False)]), False), False),
    T.StructField("items", T.ArrayType(T.StringType(), False), False),
])


def words(text: str) -> list[str]:
    return text.encode("utf-8", "replace").translate(_FOLD).decode("utf-8").split(" ")


def _folded(text: str) -> tuple[str, int]:
    """The words between single spaces, with a space at both ends, and their number."""
    parts = text.encode("utf-8", "replace").translate(_FOLD).split(b" ")
    parts = [p for p in parts if p]
    return f" {b' '.join(parts).decode('utf-8')} ", len(parts)


def item_windows(text: str | None, window: int) -> list[str]:
    """The distinct windows of one item, each with a space at both ends."""
    parts = [w for w in words(text or "") if w]
    if not parts:
        return []
    return list(dict.fromkeys(f" {' '.join(parts[i:i + window])} " for i in range(max(1, len(parts) - window + 1))))


class Matcher:
    """The automaton of one block."""

    def __init__(self, items: list[tuple[str | None, str]], window: int) -> None:
        owners: dict[str, list[str | None]] = defaultdict(list)
        for item_id, text in items:
            for w in item_windows(text, window):
                owners[w].append(item_id)
        self.automaton = ahocorasick.Automaton()
        for w, ids in owners.items():
            self.automaton.add_word(w, (len(w), w.count(" ") - 1, ids))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def find(self, text: str) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, merged runs of hit words (first, last), item ids."""
        folded, n = _folded(text)
        if self.empty or not n:
            return n, [], []
        hits = list(self.automaton.iter(folded))
        if not hits:
            return n, [], []
        spaces = [i for i, c in enumerate(folded) if c == " "]  # word k stands behind spaces[k]
        runs: list[list[int]] = []
        found: set[str] = set()
        spans = sorted((bisect_right(spaces, last + 1 - size) - 1, count) for last, (size, count, _) in hits)
        for first, count in spans:
            if runs and first <= runs[-1][1] + 1:
                runs[-1][1] = max(runs[-1][1], first + count - 1)
            else:
                runs.append([first, first + count - 1])
        for _, (_, _, ids) in hits:
            found.update(i for i in ids if i is not None)
        return n, [(a, b) for a, b in runs], sorted(found)


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point offsets (end exclusive) of runs of words in the original text."""
    at = [m.span() for m in _ORIGINAL_WORD.finditer(text)]
    return [(at[a][0], at[b][1]) for a, b in runs]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_chars: int) -> Iterator[list[tuple[str | None, str]]]:
    """The items, in blocks that are made one at a time; at least one block."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).where("t is not null").distinct()
    block: list[tuple[str | None, str]] = []
    used = 0
    for r in materialize(rows).toLocalIterator():
        size = len(r["t"]) * window
        if block and used + size > block_chars:
            yield block
            block, used = [], 0
        block.append((r["i"], r["t"]))
        used += size
    yield block


#: the automaton that this Python worker holds, with the name of its block
_held: tuple[str, Matcher] | None = None


def _matcher(shared, name: str, window: int) -> Matcher:
    """The automaton of a block, built once a worker process; the one before it goes first."""
    global _held
    if _held is None or _held[0] != name:
        _held = None
        _held = (name, Matcher(shared.value, window))
    return _held[1]


def _finder(shared, window: int):
    name = uuid.uuid4().hex

    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = _matcher(shared, name, window)
        for texts in batches:
            got = [matcher.find(t or "") for t in texts]
            yield pd.DataFrame({"n_words": [g[0] for g in got],
                                "runs": [[{"first": a, "last": b} for a, b in g[1]] for g in got],
                                "items": [g[2] for g in got]})
    return find


def find_contamination(documents: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", window: int = 10, block_chars: int = 4_000_000,
                       out_col: str = "contamination") -> DataFrame:
    """``documents`` with ``struct<n_words, runs, items>`` of each whole text:
    the number of words, the merged runs of hit words and the ids (as text,
    sorted) of the items whose windows occur."""
    sc = documents.sparkSession.sparkContext
    out, shared = documents, None
    for block in _blocks(benchmark, item_col, item_text_col, window, block_chars):
        if shared is None:
            shared = sc.broadcast(block)
            out = out.withColumn(out_col, F.pandas_udf(_finder(shared, window), FOUND)(F.col(text_col).cast("string")))
            continue
        # a later block: its own pass, so that two automata never share a worker; the written rows need no earlier block
        out = materialize(out)
        shared.destroy()
        shared = sc.broadcast(block)
        found = F.pandas_udf(_finder(shared, window), FOUND)(F.col(text_col).cast("string"))
        out = out.withColumn("__more", found).withColumn(out_col, _united(out_col, "__more")).drop("__more")
    return out


def _united(one: str, two: str):
    """Both results together: runs of hit words merged again."""
    def merge(runs: pd.Series) -> pd.Series:
        def join(rs):
            kept: list[list[int]] = []
            for a, b in sorted((r["first"], r["last"]) for r in rs):
                if kept and a <= kept[-1][1] + 1:
                    kept[-1][1] = max(kept[-1][1], b)
                else:
                    kept.append([a, b])
            return [{"first": a, "last": b} for a, b in kept]
        return runs.map(join)
    runs = F.pandas_udf(merge, FOUND["runs"].dataType)(F.concat(F.col(f"{one}.runs"), F.col(f"{two}.runs")))
    return F.struct(F.col(f"{one}.n_words").alias("n_words"), runs.alias("runs"),
                    F.array_sort(F.array_union(F.col(f"{one}.items"), F.col(f"{two}.items"))).alias("items"))


def contamination_spans(df: DataFrame, text_col: str = "text", found_col: str = "contamination", out_col: str = "spans") -> DataFrame:
    """``df`` with the runs as code point offsets of the original text."""
    def spans(texts: pd.Series, runs: pd.Series) -> pd.Series:
        return pd.Series([[{"first": a, "last": b} for a, b in original_spans(t, [(r["first"], r["last"]) for r in rs])]
                          if t is not None and len(rs) else [] for t, rs in zip(texts, runs)], dtype=object)
    kind = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
    return df.withColumn(out_col, F.pandas_udf(spans, kind)(F.col(text_col).cast("string"), F.col(f"{found_col}.runs")))


def contamination_digest(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", window: int = 10) -> DataFrame:
    """Per document: words, hit words, items, digest of the item ids."""
    found = find_contamination(documents.select(id_col, "text"), benchmark, window=window, out_col="__found")
    f = F.col("__found")
    n_hit = F.aggregate(f["runs"], F.lit(0).cast("long"), lambda s, r: s + r["last"] - r["first"] + 1)
    return found.select(
        F.col(id_col), f["n_words"].alias("n_words"), n_hit.alias("n_hit"), F.size(f["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(f["items"], ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(f["runs"]) > 0).alias("contaminated"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents in which no window of any item occurs."""
    found = find_contamination(documents, benchmark, window=window, out_col="__found")
    return found.where(F.size("__found.runs") == 0).drop("__found")


def sha256_of(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
