"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are 64-bit SimHashes of word shingles.  The distinct fingerprints
form a binary trie.  The trie is joined with itself: starting at the pair
(root, root), node pairs are traversed together, the differing bits of their
prefixes are added up, and a pair is dropped as soon as they exceed the budget.

The upper part of the trie is traversed by Spark, ``STEP`` bits a level: a pair
of nodes whose fingerprints are few enough is *ready*; any other pair is
replaced by the pairs of their children within the budget, by joins with the
table of nodes.  Crowded prefixes are thus split further down than others, as
far as single fingerprints if needed, so a task never gets more than
``2 * leaf_rows`` fingerprints.  Below a ready pair, one task traverses the
pair's subtries bit by bit, a whole level at a time.

Each task reports a spanning forest of the links it found; connected components
of all forests together (alternating large and small stars) give the classes.
All links between different fingerprints are seen, none is dropped; copies of a
text meet in one fingerprint before the join, so they are never paired up.

Texts without words (and null texts) have fingerprint zero and are linked like
any other.  Null ids are ignored by the minimum; a class of null ids alone has
a null component.  Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campanula.session import materialize

BITS = 64
STEP = 4


# -- fingerprints ------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of one text, unsigned."""
    # bytes.lower and bytes.split know ASCII letters and ASCII white space only
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)  # one shingle: its own hash
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-shingle].tolist()]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], seed) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())])
    n = len(starts)
    ones = np.zeros(BITS, np.int64)
    rows = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for at in range(0, n, 4096):
        ones += np.unpackbits(rows[at:at + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprint_col(text: Column, shingle: int = 3) -> Column:
    """SimHash of a text column as a signed 64-bit number."""
    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        got = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(got.view(np.int64), index=texts.index)
    return of(text.cast("string"))


# -- the part of the trie below a pair of nodes ------------------------------

def trie_links(a: np.ndarray, b: np.ndarray | None, depth: int, spent: int, budget: int,
               most: int = 1 << 18) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions in the sorted distinct arrays ``a`` and ``b`` (None:
    ``a`` itself, each pair once) within ``budget`` differing bits.

    All values of an array share the bits above ``depth``; the two prefixes
    differ in ``spent`` bits.  A node is a range of a sorted array.  At most
    about ``most`` node pairs are held a level; the others wait on a stack.
    """
    same = b is None
    b = a if same else b

    def ones_before(v: np.ndarray, bit: int) -> np.ndarray:
        return np.concatenate(([0], np.cumsum((v >> np.uint64(BITS - 1 - bit)) & np.uint64(1), dtype=np.int64)))

    sums = [(ones_before(a, d), ones_before(b, d)) if not same else (s := ones_before(a, d), s) for d in range(depth, BITS)]
    first = np.array([[0], [len(a)], [0], [len(b)], [spent]], np.int64)
    stack, out = [(depth, first)], []
    while stack:
        d, pairs = stack.pop()
        while d < BITS and pairs.shape[1]:
            if pairs.shape[1] > most:
                half = pairs.shape[1] // 2
                stack.append((d, pairs[:, half:]))
                pairs = pairs[:, :half]
            al, ah, bl, bh, diff = pairs
            sa, sb = sums[d - depth]
            am, bm = ah - (sa[ah] - sa[al]), bh - (sb[bh] - sb[bl])
            twin = (al == bl) & (ah == bh) if same else np.zeros(len(al), bool)
            children = [np.stack([al, am, bl, bm, diff]), np.stack([am, ah, bm, bh, diff]), np.stack([al, am, bm, bh, diff + 1]),
                        np.stack([am, ah, bl, bm, diff + 1])[:, ~twin]]
            pairs = np.concatenate(children, axis=1)
            pairs = pairs[:, (pairs[0] < pairs[1]) & (pairs[2] < pairs[3]) & (pairs[4] <= budget)]
            d += 1
        if pairs.shape[1]:
            i, j = pairs[0], pairs[2]
            keep = i != j if same else slice(None)
            out.append((i[keep], j[keep]))
    return out


def _forest(n: int, links: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Links that connect what all links connect, fewer than ``n``."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i, j in links:
        for x, y in zip(i.tolist(), j.tolist()):
            rx, ry = root(x), root(y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
                kept.append((x, y))
    return kept


def _prefix(value: Column, depth: int) -> Column:
    return F.shiftrightunsigned(value, BITS - depth)


def _masks(bits: int, budget: int) -> list[int]:
    return [m for m in range(1 << bits) if m.bit_count() <= budget]


def hamming_forest(values: DataFrame, budget: int, leaf_rows: int = 16384) -> DataFrame:
    """Links ``(a, b)`` between the distinct 64-bit numbers ``fp`` of ``values``
    whose connected components are those of all pairs within ``budget``
    differing bits.  ``values`` is read several times: give a written table."""
    spark = values.sparkSession
    found = None
    depth = 0
    total = values.count()
    pairs = spark.createDataFrame([(0, 0, 0, total, total)], "a long, b long, diff int, n_a long, n_b long")
    links = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def join_below(depth: int):
        def below(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            _, _, spent = (int(x) for x in key)
            fp = rows["fp"].to_numpy(np.int64).view(np.uint64)
            second = rows["second"].to_numpy(bool)
            a = np.sort(fp[~second])
            if second.any():
                b = np.sort(fp[second])
                got = [(i, j + len(a)) for i, j in trie_links(a, b, depth, spent, budget)]
                every = np.concatenate([a, b])
            else:
                got, every = trie_links(a, None, depth, spent, budget), a
            kept = np.array(_forest(len(every), got), np.int64).reshape(-1, 2)
            return pd.DataFrame({"a": every[kept[:, 0]].view(np.int64), "b": every[kept[:, 1]].view(np.int64)})
        return below

    if total <= leaf_rows:
        alone = values.select(F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("diff"), "fp", F.lit(False).alias("second"))
        return materialize(alone.groupBy("a", "b", "diff").applyInPandas(join_below(0), links))
    while True:
        few = (F.col("n_a") <= leaf_rows) & (F.col("n_b") <= leaf_rows)
        if depth:
            ready = pairs.where(few).select("a", "b", "diff")
            member = values.select("fp", _prefix(F.col("fp"), depth).alias("__p"))
            sides = [member.join(ready, F.col("__p") == F.col("a")).select("a", "b", "diff", "fp", F.lit(False).alias("second")),
                     member.join(ready.where("a <> b"), F.col("__p") == F.col("b")).select("a", "b", "diff", "fp", F.lit(True).alias("second"))]
            got = materialize(sides[0].unionByName(sides[1]).groupBy("a", "b", "diff").applyInPandas(join_below(depth), links))
            found = got if found is None else found.unionByName(got)
        crowded = pairs.where(~few).select("a", "b", "diff")
        if crowded.isEmpty():
            return found
        depth += STEP
        nodes = values.groupBy(_prefix(F.col("fp"), depth).alias("node")).agg(F.count(F.lit(1)).alias("n"))
        low = (1 << STEP) - 1
        masks = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(m.bit_count()).alias("bits")) for m in _masks(STEP, budget)])
        one = nodes.select(F.shiftrightunsigned("node", STEP).alias("a"), F.col("node").alias("a2"), F.col("n").alias("n_a"))
        two = nodes.select(F.col("node").alias("b2"), F.col("n").alias("n_b"))
        step = (crowded.join(one, "a").withColumn("m", F.explode(masks)).withColumn("diff", (F.col("diff") + F.col("m.bits")).cast("int"))
                .where(F.col("diff") <= budget)
                .withColumn("b2", F.shiftleft("b", STEP).bitwiseOR(F.col("a2").bitwiseAND(F.lit(low).cast("long")).bitwiseXOR(F.col("m.mask"))))
                .where((F.col("a") != F.col("b")) | (F.col("a2") <= F.col("b2"))))
        pairs = materialize(step.join(two, "b2").select(F.col("a2").alias("a"), F.col("b2").alias("b"), "diff", "n_a", "n_b"))


# -- connected components ----------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``; the root is the
    smallest node of its component.

    Alternating large and small stars (Kiveris et al., 2014): the number of
    rounds grows with the logarithm of the longest path.  Each round writes its
    links; a node's minimum is aggregated before the shuffle, and a node with
    very many links is split by the adaptive skew join.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def star(both: DataFrame, large: bool) -> DataFrame:
        # links of u with its smaller (small star) or all neighbours; m: the smallest of u and those
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        to_min = both.join(least, "u")
        moved = to_min.where("v > u" if large else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not large:
            moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
        return moved.where("u <> v")

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()

    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = star(both, large=True).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        edges = materialize(star(materialize(edges), large=False).distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(edges.select(F.col("u").alias("node"), F.col("v").alias("root")))


# -- documents ---------------------------------------------------------------

def near_duplicates(rows: DataFrame, budget: int = 2, leaf_rows: int = 16384) -> DataFrame:
    """Classes of the written table ``rows (id, fp)``: for every fingerprint
    ``(fp, root, component_id)``, where ``root`` is the smallest fingerprint of
    its class and ``component_id`` the smallest id."""
    prints = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(hamming_forest(prints.select("fp"), budget, leaf_rows))
    rooted = materialize(prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                         .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id")


def near_duplicate_classes(documents: DataFrame, shingle: int = 3, budget: int = 2, id_col: str = "doc_id",
                           text_col: str = "text", leaf_rows: int = 16384) -> DataFrame:
    """Per document: fingerprint as 16 hex digits and component id."""
    rows = materialize(documents.select(F.col(id_col).alias("id"), fingerprint_col(F.col(text_col), shingle).alias("fp")))
    return rows.join(near_duplicates(rows, budget, leaf_rows), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(documents: DataFrame, shingle: int = 3, budget: int = 2, id_col: str = "doc_id",
                         text_col: str = "text", leaf_rows: int = 16384) -> DataFrame:
    """The documents with one row left of each class: that of the smallest id.
    If rows repeat this id within the class, one of them stays.  Classes in
    which no row has an id are left whole."""
    marked = materialize(documents.withColumn("__fp", fingerprint_col(F.col(text_col), shingle)))
    rows = marked.select(F.col(id_col).alias("id"), F.col("__fp").alias("fp"))
    classes = materialize(near_duplicates(rows, budget, leaf_rows))
    first = (rows.join(classes, "fp").where(F.col("id") == F.col("component_id"))
             .groupBy("root").agg(F.min("fp").alias("__fp"), F.min("id").alias(id_col)).select(id_col, "__fp"))
    # the whole rows are dealt by id and fingerprint, so a large class is not gathered anywhere
    kept = marked.join(first, [id_col, "__fp"], "left_semi").dropDuplicates([id_col, "__fp"])
    without = classes.where("component_id is null").select(F.col("fp").alias("__fp"))
    whole = marked.where(F.col(id_col).isNull()).join(without, "__fp", "left_semi")
    columns = [F.col(f"`{c}`") for c in documents.columns]
    return kept.select(*columns).unionByName(whole.select(*columns))
