"""Line dedup by a segment-partition edit join.

Lines are compared in a normal form (lower case, white space runs as one space,
none at the ends).  Empty ones are left alone; all others, however short, are one
class with their equals.  Lines of at
least ``edit_chars`` characters that are within ``threshold`` edits of each
other are linked as well, and so are, within one edit, pairs whose shorter line
has ``short_chars`` to ``edit_chars`` - 1 characters (two edits change too much
of a short line); linked lines are one class.  Of each class the
first occurrence stays (smallest id, then row, then line number); the others go.

*The edit join.*  With the threshold of its length, a line is split into ``threshold + 1`` segments of nearly
equal length; by the pigeonhole principle, of two lines within the threshold one
has a whole segment of the other, shifted by no more than the threshold.  Each
line puts its segments into an index by (length, segment number, text) and
probes the indexes of its own and of smaller lengths, only at those positions
that the multi-match-aware bounds leave (Li et al., 2011).  Index and probes are
rows keyed by a hash, dealt out and sorted by it, and matched as a stream.  A
signature (parities of characters and of character pairs, which a few edits can
change in a few bits only) removes most false matches on the spot; the others
are verified with the texts by a banded bit-parallel edit distance.

Lines are normalised, numbered and hashed once; what follows reads that table,
in which a line's text stands once a partition.

*Hot keys.*  A sample of the lines shows which keys hold so many rows that one
task would feel it (at most a few a partition); their rows are dealt out by line
instead of by key.  These and all other keys with more than ``group_rows`` lines
are cut into blocks, and pairs of blocks are matched as groups of their own, of at
most twice ``block_rows`` lines.  A group has its texts, verifies on the spot and
reports a spanning forest of the links, so lines that are all alike (numbered
templates) cost about one comparison each, not one a pair.  All this is exact: the
sample only decides where rows go.

Null texts have no lines.  Rows that repeat an id with the same text count as
one document and get the same result.  Null ids come after all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campanula.session import materialize, shuffle_partitions

from .common import whole_text
from .simhash import components


def line_ids(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each line; both together name it."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), ">i8").reshape(-1, 2).astype(np.int64)
    return both[:, 0].copy(), both[:, 1].copy()


# -- verification ------------------------------------------------------------

_BAND = 64
_FULL = (1 << _BAND) - 1


def within(a: str, b: str, threshold: int) -> bool:
    """Whether the edit distance of two texts is at most ``threshold`` (up to 31).

    Equal beginnings and ends are taken off; the rest is compared on a band of
    64 rows around the diagonal, one machine word of vertical differences a
    column (Hyyrö, 2003)."""
    if abs(len(a) - len(b)) > threshold:
        return False
    if a == b:
        return True
    start, most = 0, min(len(a), len(b))
    while start < most and a[start] == b[start]:
        start += 1
    end, most = 0, most - start
    while end < most and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = sorted((a[start:len(a) - end], b[start:len(b) - end]), key=len, reverse=True)
    if len(a) <= threshold:
        return True
    if not b:
        return False
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    rise, fall = (_FULL << (_BAND - threshold - 1)) & _FULL, 0
    distance, bottom = threshold, len(a) - threshold
    for j, c in enumerate(b):
        low = j + threshold + 1 - _BAND     # row of a that the word's lowest bit stands for
        p = places.get(c, 0)
        equal = (p >> low if low >= 0 else p << -low) & _FULL
        diagonal = ((((equal & rise) + rise) ^ rise) | equal | fall) & _FULL
        right_up = (fall | ~(diagonal | rise)) & _FULL
        right_down = diagonal & rise
        if j < bottom:                      # along the lower edge of the band
            distance += not diagonal >> (_BAND - 1)
        else:                               # along the last row, which moves up in the word
            bit = _BAND - 2 - (j - bottom)
            distance += (right_up >> bit & 1) - (right_down >> bit & 1)
        if distance - (len(b) - 1 - j if j >= bottom else len(b) - bottom) > threshold:
            return False
        shifted = diagonal >> 1
        rise = (right_down | ~(shifted | right_up)) & _FULL
        fall = shifted & right_up
    return distance <= threshold


# -- segments, probes and signatures -----------------------------------------

#: lines from here on are compared by edits in the registered queries: all that the exact step takes
SHORT_CHARS = 10


def edits_of(length: int, threshold: int, edit_chars: int) -> int:
    """Edits within which a line of ``length`` characters is linked with one
    that is not shorter."""
    return threshold if length >= edit_chars else min(threshold, 1)


def segments(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, size) of nearly equal parts, the longer ones last."""
    size, longer = divmod(length, parts)
    out, at = [], 0
    for k in range(parts):
        n = size + (k >= parts - longer)
        out.append((at, n))
        at += n
    return out


def probes(length: int, shorter: int, threshold: int) -> list[tuple[int, int, int]]:
    """(segment, start, size) at which a line of ``length`` is looked up in the
    index of lines with ``shorter`` characters."""
    gap, out = length - shorter, []
    for k, (at, size) in enumerate(segments(shorter, threshold + 1)):
        low = max(at - k, at + gap - (threshold - k), 0)
        high = min(at + k, at + gap + (threshold - k), length - size)
        out += [(k, p, size) for p in range(low, high + 1)]
    return out


def _codes(lines: list[str]) -> np.ndarray:
    """The code points of all lines, one after the other."""
    return np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32).astype(np.uint64)


def signatures(lines: list[str], codes: np.ndarray | None = None) -> np.ndarray:
    """Per line 32 parities of hashed characters and 32 of character pairs."""
    codes = (_codes(lines) if codes is None else codes).astype(np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(x) for x in lines])))
    one, spread, bits = np.uint32(1), np.uint32(0x9E3779B1), np.uint32(27)
    single = one << (codes * spread >> bits)
    pairs = np.zeros_like(codes)
    pairs[:-1] = one << ((codes[:-1] * np.uint32(0x85EBCA6B) + codes[1:]) * spread >> bits)
    pairs[starts[1:] - 1] = 0  # no pair across lines
    single, pairs = (np.bitwise_xor.reduceat(x, starts[:-1]).astype(np.uint64) for x in (single, pairs))
    return single | pairs << np.uint64(32)


def _alike(a: np.ndarray, b: np.ndarray, threshold: int) -> np.ndarray:
    """Signatures that ``threshold`` edits can turn into each other: an edit
    changes at most 2 characters and 4 pairs."""
    x = a ^ b
    low = np.uint64(0xFFFFFFFF)
    return (np.bitwise_count(x & low) <= 2 * threshold) & (np.bitwise_count(x >> np.uint64(32)) <= 4 * threshold)


def _matches(lid: np.ndarray, sig: np.ndarray, probe: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one key: indexed lines with indexed or probing ones."""
    sig = np.ascontiguousarray(sig, np.int64).view(np.uint64)
    held = np.flatnonzero(~probe)
    if not len(held) or lid[0] == lid[-1] and (lid == lid[0]).all():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    left, right = [], []
    for i in held.tolist():
        ok = (lid != lid[i]) & _alike(sig, sig[i], threshold) & (probe | (np.arange(len(lid)) > i))
        j = np.flatnonzero(ok)
        left.append(np.full(len(j), lid[i]))
        right.append(lid[j])
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    return np.minimum(a, b), np.maximum(a, b)


# -- the join ----------------------------------------------------------------

_KEYS = T.StructType([T.StructField(c, T.LongType()) for c in ("key", "lid", "sig")])
_FOUND = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "key", "sig")])


#: documents whose texts a worker holds as Python strings at a time
SLICE = 500


def _occurrences(min_chars: int, least: int):
    """Rows (id, row, pos, lid, lid2, line) of all lines of (id, row, text); the
    normal text of a line of at least ``least`` characters stands at its first row
    in the partition.  Arrow keeps ids of any type whole beside nulls."""
    def occur(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):
                yield of_slice(batch.slice(first, SLICE), seen)

    def of_slice(batch: pa.RecordBatch, seen: set[int]) -> pa.RecordBatch:
        at, pos, lines = [], [], []
        for k, t in enumerate(batch.column("text").to_pylist()):
            for n, line in enumerate(t.lower().split("\n")):
                x = " ".join(line.split())
                if len(x) >= min_chars:
                    at.append(k)
                    pos.append(n)
                    lines.append(x)
        one, two = line_ids(lines)
        texts: list[str | None] = []
        for lid, x in zip(one.tolist(), lines):
            new = len(x) >= least and lid not in seen
            if new:
                seen.add(lid)
            texts.append(x if new else None)
        where = pa.array(at, pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("id").take(where), batch.column("row").take(where), pa.array(pos, pa.int32()),
                                           pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(texts, pa.string())],
                                          names=["id", "row", "pos", "lid", "lid2", "line"])
    return occur


#: a key ends in the threshold of its lines (five bits) and a bit for probes, so
#: that the rows of a key stand together when sorted, indexed lines first
_EDITS = 31


_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(max(n, 1), np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class _Pieces:
    """64-bit hashes of pieces of texts that stand one after the other: a
    polynomial in the code points, from running sums, so that a piece costs the
    same however long it is, and equal pieces have equal hashes wherever they stand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def hashes(self, codes: np.ndarray, seeds: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(codes):
            n = 2 * len(codes) + 1
            self.up, self.down = _powers(_MULTIPLIER, n), _powers(_INVERSE, n)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes + np.uint64(1)) * self.up[:len(codes)], out=sums[1:])
        return _mixed((sums[ends] - sums[starts]) * self.down[starts] ^ seeds)


def _make_keys(threshold: int, edit_chars: int, least: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans: dict[int, np.ndarray] = {}
        pieces = _Pieces()

        def plan(n: int) -> np.ndarray:
            """Columns (seed, start, end, low bits of the key) of the segments and
            then of the probes of a line of ``n`` characters."""
            edits = {m: edits_of(m, threshold, edit_chars) for m in range(max(least, n - threshold), n + 1)}
            held = [(n << 8 | k, at, at + size) for k, (at, size) in enumerate(segments(n, edits[n] + 1))]
            asked = [(shorter << 8 | k, p, p + size) for shorter, most in edits.items() if n - shorter <= most
                     for k, p, size in probes(n, shorter, most)]
            steps = held + [x for x in asked if x not in held]
            columns = np.array([(*x, edits[x[0] >> 8] << 1 | (i >= len(held))) for i, x in enumerate(steps)], np.int64)
            columns[:, 0] = _mixed(columns[:, 0].astype(np.uint64)).view(np.int64)
            return columns

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                lines, lids = part.column("line").to_pylist(), part.column("lid").to_numpy(zero_copy_only=False)
                sizes = np.array([len(x) for x in lines], np.int64)
                for n in set(sizes.tolist()) - plans.keys():
                    plans[n] = plan(n)
                todo = [plans[n] for n in sizes.tolist()]
                count = [len(p) for p in todo]
                seeds, starts, ends, low = np.ascontiguousarray(np.concatenate(todo).T)
                begin = np.repeat(np.cumsum(sizes) - sizes, count)
                codes = _codes(lines)
                keys = pieces.hashes(codes, seeds.view(np.uint64), begin + starts, begin + ends).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys & ~(_EDITS << 1 | 1) | low), pa.array(np.repeat(lids, count)),
                                                  pa.array(np.repeat(signatures(lines, codes).view(np.int64), count))], names=["key", "lid", "sig"])
    return make


def _match_stream(group_rows: int, heavy: list[int]):
    """Rows sorted by key: pairs of a key, or the rows of a key with too many (or a heavy one)."""
    heavy_keys = np.array(sorted(heavy), np.int64)

    def table(pairs, hot):
        """One batch: pairs (a, b), then rows of hot keys (lid, key, sig)."""
        a, b = (np.concatenate([p[k] for p in pairs]) if pairs else np.empty(0, np.int64) for k in range(2))
        lid, key, sig = (np.concatenate([h[k] for h in hot]) if hot else np.empty(0, np.int64) for k in range(3))
        some, none = len(a), len(lid)

        def column(values, before, after):
            return pa.concat_arrays([pa.nulls(before, pa.int64()), pa.array(values, pa.int64()), pa.nulls(after, pa.int64())])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, lid]), pa.int64()), column(b, 0, none), column(key, some, 0),
                                           column(sig, some, 0)], names=["a", "b", "key", "sig"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None      # rows of the last key so far, at most group_rows
        hot = None        # a key that has shown more
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "lid", "sig")]
            pairs, rows = [], []
            if len(heavy_keys):
                known = np.isin(cols[0] >> 1, heavy_keys)
                if known.any():
                    key, lid, sig = (c[known] for c in cols)
                    rows.append((lid, key, sig))
                    cols = [c[~known] for c in cols]
            if open_ is not None:
                cols = [np.concatenate(x) for x in zip(open_, cols)]
                open_ = None
            key, lid, sig = cols
            if len(key):
                name = key >> 1
                starts = np.concatenate(([0], np.flatnonzero(name[1:] != name[:-1]) + 1))
                ends = np.append(starts[1:], len(key))
                # of the groups only those with an indexed row (these stand first) and two lines can have pairs
                some = (ends - starts > 1) & (key[starts] & 1 == 0) & (np.minimum.reduceat(lid, starts) != np.maximum.reduceat(lid, starts))
                some |= ends - starts > group_rows
                some[0] |= name[0] == hot    # the last row of a hot key may open a batch on its own
                for s, e in zip(starts[some].tolist(), ends[some].tolist()):
                    if name[s] == hot or e - s > group_rows:
                        hot = name[s]
                        rows.append((lid[s:e], key[s:e], sig[s:e]))
                    elif e < len(key):
                        pairs.append(of_key(key[s:e], lid[s:e], sig[s:e]))
                s = int(starts[-1])
                if name[s] != hot:
                    open_ = [c[s:].copy() for c in cols]
            if pairs or rows:
                yield table(pairs, rows)
        if open_ is not None and len(open_[0]) > 1:
            yield table([of_key(*open_)], [])

    def of_key(key, lid, sig):
        if len(lid) > 2 and not key[0] & 1:
            rows = np.unique(np.stack([lid, key & 1]), axis=1, return_index=True)[1]
            key, lid, sig = key[rows], lid[rows], sig[rows]
        return _matches(lid, sig, (key & 1).astype(bool), int(key[0]) >> 1 & _EDITS)
    return match


def _verify_blocks(threshold: int, edit_chars: int):
    """A forest of the verified links across two blocks of a hot key (or within one)."""
    def verify(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lid, probe, block = (rows[c].to_numpy() for c in ("lid", "probe", "block"))
        sig = np.ascontiguousarray(rows["sig"].to_numpy(), np.int64).view(np.uint64)
        lines, edits, probe = rows["line"].tolist(), int(key[0]) & _EDITS, probe.astype(bool)
        label = np.arange(len(lid))   # the tree that a line is in
        links = []
        across, places = key[1] != key[2], np.arange(len(lid))
        for i in np.flatnonzero(~probe).tolist():
            ok = _alike(sig, sig[i], edits) & (probe | (places > i)) & (label != label[i])
            if across:
                ok &= block != block[i]
            for j in np.flatnonzero(ok).tolist():
                if label[i] != label[j] and within(lines[i], lines[j], edits_of(min(len(lines[i]), len(lines[j])), threshold, edit_chars)):
                    label[label == label[j]] = label[i]
                    links.append((lid[i], lid[j]))
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)
    return verify


#: one line in so many shows which keys are heavy
SAMPLE = 64


def heavy_keys(texts: DataFrame, make, rows: int) -> list[int]:
    """Keys that hold about ``rows`` rows or more and a share of all rows that one
    task would feel; at most four a shuffle partition."""
    sample = materialize(texts.where(F.pmod("lid", F.lit(SAMPLE)) == 0).mapInArrow(make, _KEYS).select(F.shiftright("key", 1).alias("key")))
    parts = shuffle_partitions(texts.sparkSession)
    least = max(rows // SAMPLE, sample.count() // (4 * parts), 1)
    return [r.key for r in sample.groupBy("key").count().where(F.col("count") >= least).select("key").collect()]


def edit_links(texts: DataFrame, threshold: int = 2, edit_chars: int = 32, group_rows: int = 1024,
               broadcast_rows: int = 500_000, short_chars: int | None = None, block_rows: int | None = None) -> DataFrame:
    """Links ``(a, b)`` between the ids of lines ``(lid, line)`` that are within
    ``threshold`` edits of each other, or within one if the shorter has
    ``short_chars`` to ``edit_chars`` - 1 characters (None: none such); those of a
    hot key as a forest.  ``texts`` is read more than once, so give a written table."""
    least = edit_chars if short_chars is None else min(short_chars, edit_chars)
    block_rows = block_rows or 2 * group_rows
    make = _make_keys(threshold, edit_chars, least)
    heavy = heavy_keys(texts, make, 20 * group_rows)
    keys = texts.mapInArrow(make, _KEYS)
    name = F.shiftright("key", 1)
    route = F.when(name.isin(heavy), F.xxhash64("lid")).otherwise(name) if heavy else name
    found = materialize(keys.repartition(route).sortWithinPartitions("key").mapInArrow(_match_stream(group_rows, heavy), _FOUND))
    hot = (found.where("b is null").groupBy(F.shiftright("key", 1).alias("key"), F.col("a").alias("lid"))
           .agg(F.min("sig").alias("sig"), F.min(F.col("key").bitwiseAND(1)).alias("probe")))
    blocks = hot.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("n"))
    hot = materialize(hot.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("lid"), F.col("n"))))
    hot_lines = texts.join(hot.select("lid").distinct(), "lid", "left_semi").groupBy("lid").agg(F.min("line").alias("line"))
    hot = (hot.join(hot_lines, "lid").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
           .withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other")))
    forest = hot.groupBy("key", "x", "y").applyInPandas(_verify_blocks(threshold, edit_chars), "a long, b long")
    pairs = materialize(found.where("b is not null").select("a", "b").distinct())
    ids = materialize(pairs.select(F.col("a").alias("lid")).unionByName(pairs.select(F.col("b").alias("lid"))).distinct())
    few = ids.count() <= broadcast_rows  # 8 bytes each: a checked size
    lines = materialize(texts.join(F.broadcast(ids) if few else ids, "lid").groupBy("lid").agg(F.min("line").alias("line")))

    @F.pandas_udf(T.BooleanType())
    def verified(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([within(x, y, edits_of(min(len(x), len(y)), threshold, edit_chars)) for x, y in zip(a, b)], dtype=bool)
    one, two = (lines.select(F.col("lid").alias(x), F.col("line").alias(f"line_{x}")) for x in "ab")
    links = pairs.join(one, "a").join(two, "b").where(verified(F.col("line_a"), F.col("line_b"))).select("a", "b")
    return links.unionByName(forest)


# -- documents ---------------------------------------------------------------

_RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()),
                        T.StructField("n_removed", T.LongType()), T.StructField("share", T.DoubleType())])


_ARROW = pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("n_removed", pa.int64()), ("share", pa.float64())])


def _left(text: str | None, gone: list[int] | None) -> tuple[str | None, int, int, float]:
    if text is None:
        return None, 0, 0, 1.0
    if not gone:
        return text, text.count("\n") + 1, 0, 1.0
    lines, out = text.split("\n"), set(gone)
    kept = "\n".join(x for i, x in enumerate(lines) if i not in out)
    before, after = (len("".join(x.split())) for x in (text, kept))
    return kept, len(lines), len(out), after / before if before else 1.0


def _without_lines(texts: pa.Array, removed: pa.Array) -> pa.Array:
    parts = []
    for at in range(0, len(texts), SLICE):
        rows = zip(*map(_left, texts.slice(at, SLICE).to_pylist(), removed.slice(at, SLICE).to_pylist()))
        parts.append(pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(rows, _ARROW)], fields=list(_ARROW)))
    return pa.concat_arrays(parts) if parts else pa.array([], _ARROW)


#: called nondeterministic, so that a filter on the result stays above it: pushed
#: below, it would call the function a second time, by a second worker
_without = F.arrow_udf(_without_lines, _RESULT).asNondeterministic()


def dedup_lines(documents: DataFrame, threshold: int = 2, min_chars: int = 1, edit_chars: int = 32, id_col: str = "doc_id",
                text_col: str = "text", group_rows: int = 1024, broadcast_rows: int = 500_000, out_col: str = "__dedup",
                short_chars: int | None = None) -> DataFrame:
    """``documents`` with the struct ``out_col``: the text without repeated
    lines, the number of lines, the number and the list ``removed`` of line
    numbers (from 0) that went, and the share of its characters that is left.
    Lines with fewer than ``min_chars`` characters (1: empty ones) stay."""
    text = whole_text(text_col)
    rows = documents.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("row"), text.alias("text"))
    fields = [*rows.schema.fields[:2], *(T.StructField(n, t) for n, t in (("pos", T.IntegerType()), ("lid", T.LongType()), ("lid2", T.LongType()), ("line", T.StringType())))]
    least = edit_chars if short_chars is None else min(short_chars, edit_chars)
    lines = materialize(rows.mapInArrow(_occurrences(min_chars, least), T.StructType(fields)))
    links = materialize(edit_links(lines.where("line is not null").select("lid", "line"), threshold, edit_chars, group_rows, broadcast_rows, short_chars))
    roots = materialize(components(links))
    few = roots.count() <= broadcast_rows  # 16 bytes each: a checked size
    roots = roots.withColumnRenamed("node", "lid")
    named = lines.join(F.broadcast(roots) if few else roots, "lid", "left").select(
        F.coalesce("root", "lid").alias("c1"), F.when(F.col("root").isNull(), F.col("lid2")).otherwise(0).alias("c2"),
        F.struct(F.col("id").isNull().alias("n"), "id", "row", "pos").alias("at"))
    # written, so that the join below reads two plain shuffles and can split the rows of a hot class
    first = materialize(named.groupBy("c1", "c2").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    gone = (named.join(first, ["c1", "c2"]).where("at <> first")
            .groupBy(F.col("at.id").alias("__id"), F.col("at.row").alias("__row")).agg(F.collect_set("at.pos").alias("__gone")))
    kept = [F.col(f"d.`{c}`") for c in documents.columns]
    out = documents.alias("d").join(gone, F.col(f"d.{id_col}").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(F.col(f"d.{text_col}").cast("string"), F.lit(""))) == F.col("__row")), "left")
    out = out.select(*kept, F.col("__gone"), _without(F.col(f"d.{text_col}").cast("string"), F.col("__gone")).alias("__new"))
    return out.select(*[F.col(f"`{c}`") for c in documents.columns], F.struct(
        "__new.text", "__new.n_lines", "__new.n_removed", "__new.share", F.coalesce(F.array_sort("__gone"), F.array().cast("array<int>")).alias("removed")).alias(out_col))


def keeps(dedup: Column, min_share: float = 0.2) -> Column:
    """Whether a document stays: its text, if lines went, still has a word and
    at least ``min_share`` of its characters (0, as in the registered queries:
    whatever is left stays, and near copies are another stage's job)."""
    return (dedup["n_removed"] == 0) | (dedup["text"].rlike(r"[^\x20\x09-\x0D]") & (dedup["share"] >= min_share))


def line_dedup_digest(documents: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: lines, removed lines, the text that is left, the verdict."""
    out = dedup_lines(documents.select(id_col, "text"), id_col=id_col, short_chars=SHORT_CHARS)
    d = F.col("__dedup")
    return out.select(F.col(id_col), d["n_lines"].alias("n_lines"), d["n_removed"].alias("n_removed"),
                      F.array_join(d["removed"].cast("array<string>"), ",").alias("removed"), F.coalesce(d["text"], F.lit("")).alias("text"), keeps(d, 0.0).alias("kept"))


def drop_repeated_lines(documents: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
                        short_chars: int | None = None, min_share: float = 0.2) -> DataFrame:
    """The documents without repeated lines, and without those of which no word
    or less than ``min_share`` is left.  ``length_col``, if there is one, is set to the new length where
    lines went."""
    out = dedup_lines(documents, text_col=text_col, short_chars=short_chars)
    d = F.col("__dedup")
    out = out.where(keeps(d, min_share))
    if length_col in documents.columns:
        kind = documents.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(d["n_removed"] > 0, F.length(d["text"]).cast(kind)).otherwise(F.col(length_col)))
    return out.withColumn(text_col, d["text"]).select(*[F.col(f"`{c}`") for c in documents.columns])
