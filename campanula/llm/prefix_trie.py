"""Prefix trie of rebuilt conversations, from composable fingerprints.

Every conversation ``c`` is rebuilt: the first ``h`` turns of its base
conversation, then its own turns after its first ``h``.  The rebuilt turns are
never written out.  A sequence of turns has the fingerprint

    (k, v) = (number of turns, sum of t[i] * B**i)      i = 1..k, modulo 2**64

(two of them, with different turn hashes ``t`` and odd bases ``B``), a monoid:
``(k, v) * (m, w) = (k + m, v + B**k * w)``.  ``B`` has an inverse, so a piece
of a conversation is the quotient of two of its prefixes, and the fingerprint of
any rebuilt prefix is head product times suffix product, from three prefixes of
original conversations:

    F(c, d) = P_base(head) + B**(head - h) * (P_c(d + h - head) - P_c(h))

1. **Prefix products.**  Turns (hashes only, no texts) are range-partitioned by
   conversation, turn and hash, each task scans its sorted rows, and the products
   of the conversations cut by a partition border are put together from one row a
   partition.  A conversation with a third of all turns is cut like any other.
2. **Nodes.**  Each turn stands in at most one place of the trie (a base's turn
   in its own path, another's own turn in its suffix), so nodes are groups of
   turn rows by (depth, F); members that pass through a base's turn are counted
   on that row (the few conversations that share the base).
3. **Equality.**  A node's rows store their turn's reference (its two content
   hashes) and the fingerprint of the prefix before it.  All rows of a node must
   agree in both, and all texts behind a reference that occurs more than once
   must be equal; by induction over the depth equal fingerprints are then equal
   sequences.  If a check ever fails, all is done again with other hashes.
4. **Subtree sums.**  A node is named (smallest member, depth), so the nodes of
   one conversation are a contiguous *chain* of its path, hung below one node of
   another chain.  Sums over chains of chains take pointer doubling (a logarithmic
   number of rounds in the nesting of chains); within a chain they are prefix
   sums over range partitions.
5. **Ends.**  Ids of conversations that end in a node are joined in blocks of
   4,096 id values before the shuffle; the blocks of a node are streamed in order
   through one SHA-256, which is sequential by its nature, in bounded memory.

Nulls: a null role or text is empty, a null turn number comes first, rows without
a conversation id are left out.  Turns with equal numbers stand in the order of
their content hashes; repeated rows are repeated turns.  Very long texts are only
hashed, and compared where a hash occurs twice.  Columns other than the four used
are not read.  An empty table has no nodes, not even a root.  For negative ids the
base is the multiple of five towards zero.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campanula.operators.ranks import prefix_sums
from campanula.session import materialize, shuffle_partitions

MAX_HEAD = 8
BLOCK = 4096
BROADCAST_REFS = 1_000_000
_WORD = 1 << 64
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(1 << 14, b, np.uint64))), dtype=np.uint64) for b in BASES]
NODE = ["depth", "f1", "f2"]


def base_of(conv: Column) -> Column:
    """The conversation that a conversation's head is taken from."""
    return conv - conv % 5


def head_of(conv: Column) -> Column:
    """How many turns of the base a conversation starts with, at most ``MAX_HEAD``."""
    return (F.crc32(conv.cast("string").cast("binary")) % 9).cast("int")


def _power(lane: int, k: int) -> int:
    return pow(BASES[lane], k, _WORD)


def _longs(schema: T.StructType, columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], names=schema.names)


def _long_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in names])


def _column(batch: pa.RecordBatch, name: str, unsigned: bool = False) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
    return values.view(np.uint64) if unsigned else values


# -- 1. prefix products --------------------------------------------------------

_SCAN = _long_schema("conv_id", "part", "pos", "p1", "p2", "q1", "q2", "t1", "t2", "bytes")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions and products of sorted turns, counted from where the conversation
    begins in this partition; ``q`` is the product before the turn."""
    conv, pos, value = None, 0, [np.uint64(0)] * 2
    for whole in batches:
        for at in range(0, whole.num_rows, 1 << 14):
            batch = whole.slice(at, 1 << 14)
            ids = _column(batch, "conv_id")
            first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(ids))))
            local = np.arange(len(ids)) - first[group] + 1
            carried = ids[0] == conv
            place = local + np.where(group == 0, pos if carried else 0, 0)
            columns = []
            for lane in (0, 1):
                turn = _column(batch, f"t{lane + 1}", unsigned=True)
                scale = np.ones(len(first), np.uint64)
                scale[0] = _power(lane, pos) if carried else 1
                term = turn * _POWERS[lane][local] * scale[group]
                total = np.cumsum(term, dtype=np.uint64)
                before = total[first] - term[first]
                start = np.zeros(len(first), np.uint64)
                start[0] = value[lane] if carried else 0
                product = total - before[group] + start[group]
                columns += [product, product - term]
                value[lane] = product[-1]
            p1, q1, p2, q2 = columns
            conv, pos = int(ids[-1]), int(place[-1])
            rest = [_column(batch, c) for c in ("t1", "t2", "bytes")]
            yield _longs(_SCAN, [ids, _column(batch, "part"), place, p1, p2, q1, q2, *rest])


def _carried(scanned: DataFrame) -> dict[int, tuple[int, int, int, int]]:
    """Per partition the conversation still open when it begins: (id, turns, products).

    From the last row of each partition, so the driver gets one row a partition."""
    lasts = scanned.groupBy("part").agg(F.max(F.struct("conv_id", "pos", "p1", "p2")).alias("r")).select("part", "r.*").collect()
    out, open_ = {}, None
    for r in sorted(lasts, key=lambda r: r.part):
        now = (r.pos, r.p1 % _WORD, r.p2 % _WORD)
        if open_ is not None:
            out[r.part] = open_
            if open_[0] == r.conv_id:
                now = (open_[1] + now[0], *((open_[2 + k] + _power(k, open_[1]) * now[1 + k]) % _WORD for k in (0, 1)))
        open_ = (r.conv_id, *now)
    return out


def prefix_products(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, t1, t2, bytes) with their place in the conversation
    and the products up to (p) and before (q) them."""
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), "t1", "t2", "row"]
    rows = turns.withColumn("row", F.monotonically_increasing_id())  # splits repeated rows; equal rows are interchangeable
    rows = rows.repartitionByRange(shuffle_partitions(turns.sparkSession), *order).sortWithinPartitions(*order)
    rows = rows.select("conv_id", F.spark_partition_id().cast("long").alias("part"), "t1", "t2", "bytes")
    scanned = materialize(rows.mapInArrow(_scan, _SCAN))
    carried = _carried(scanned)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, part, pos = (_column(batch, c).copy() for c in ("conv_id", "part", "pos"))
            products = {c: _column(batch, c, unsigned=True).copy() for c in ("p1", "p2", "q1", "q2")}
            for k in np.unique(part).tolist():
                if k in carried:
                    conv, turns_before, *value = carried[k]
                    at = np.flatnonzero((part == k) & (ids == conv))
                    pos[at] += turns_before
                    for name, column in products.items():
                        lane = int(name[1]) - 1
                        column[at] = np.uint64(value[lane]) + np.uint64(_power(lane, turns_before)) * column[at]
            yield _longs(_SCAN, [ids, part, pos, *products.values(), *(_column(batch, c) for c in ("t1", "t2", "bytes"))])
    return scanned.mapInArrow(join, _SCAN).drop("part")


# -- 2. places of turns in the trie ---------------------------------------------

def _rebuilt(turns: DataFrame, base: Callable, head: Callable) -> DataFrame:
    """One row a conversation: how it is rebuilt, and the products that takes."""
    heads = F.sort_array(F.collect_list(F.when(F.col("pos") <= MAX_HEAD, F.struct("pos", "p1", "p2"))))
    convs = materialize(turns.groupBy("conv_id").agg(F.max("pos").alias("n"), heads.alias("heads"))
                        .withColumn("base", base(F.col("conv_id"))).withColumn("h", head(F.col("conv_id"))))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("heads").alias("base_heads"))
    head_len = F.least(F.col("h"), F.coalesce(F.size("base_heads"), F.lit(0))).cast("int")
    rows = convs.join(bases, "base", "left").withColumn("head", F.when(F.col("base_heads").isNull(), 0).otherwise(head_len))

    def at(heads: str, k: Column, field: str) -> Column:
        return F.coalesce(F.when(k > 0, F.try_element_at(F.col(heads), F.greatest(k, F.lit(1)))[field]), F.lit(0)).cast("long")

    length = F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    rows = rows.select("conv_id", "base", "n", "h", "head", length.alias("length"),
                       *[at("base_heads", F.col("head"), f"p{k}").alias(f"h{k}") for k in (1, 2)],
                       *[at("heads", F.col("h"), f"p{k}").alias(f"o{k}") for k in (1, 2)])
    rows = materialize(rows)
    family = (rows.where((F.col("conv_id") != F.col("base")) & (F.col("head") > 0))
              .groupBy(F.col("base").alias("conv_id")).agg(F.collect_list(F.struct("conv_id", "head", "length")).alias("family")))
    return rows.join(family, "conv_id", "left")


_PLACE = _long_schema("conv_id", "depth", "f1", "f2", "g1", "g2")


def _places(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Turn rows that stand in the trie: depth, fingerprints of the prefix that ends
    with the turn (f) and before it (g), members that pass, smallest one, ends."""
    own = F.col("conv_id") == F.col("base")
    rows = turns.join(convs, "conv_id").where(own | (F.col("pos") > F.col("h")))
    rows = rows.withColumn("shift", F.when(own, F.lit(0)).otherwise(F.col("head") - F.col("h")).cast("long")) \
               .withColumn("depth", F.col("pos") + F.col("shift")).withColumn("rebuilt", (~own).cast("long"))
    passing = F.when(F.col("rebuilt") == 0, F.filter("family", lambda s: s["head"] >= F.col("pos")))
    rows = rows.withColumn("passing", F.coalesce(passing, F.array().cast("array<struct<conv_id:bigint,head:int,length:bigint>>")))
    ends = F.transform(F.filter("passing", lambda s: s["length"] == F.col("pos")), lambda s: s["conv_id"])
    ends = F.when(F.col("length") == F.col("depth"), F.concat(ends, F.array("conv_id"))).otherwise(ends)
    rows = rows.select(
        "conv_id", "depth", "p1", "p2", "q1", "q2", "t1", "t2", "bytes", "shift", "rebuilt", "h1", "h2", "o1", "o2",
        (F.size("passing") + 1).cast("long").alias("members"),
        F.least(F.col("conv_id"), F.coalesce(F.array_min(F.transform("passing", lambda s: s["conv_id"])), F.col("conv_id"))).alias("low"),
        ends.alias("ends"))
    keep = ["depth", "t1", "t2", "bytes", "members", "low", "ends"]
    schema = T.StructType([*_long_schema("f1", "f2", "g1", "g2"), *[rows.schema[c] for c in keep]])
    turned = [{s: np.uint64(_power(lane, s)) for s in range(-MAX_HEAD, MAX_HEAD + 1)} for lane in (0, 1)]

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shift, rebuilt = _column(batch, "shift"), _column(batch, "rebuilt").astype(bool)
            out = []
            for kind in "pq":
                for lane in (0, 1):
                    product, head, skipped = (_column(batch, f"{c}{lane + 1}", unsigned=True) for c in (kind, "h", "o"))
                    table = np.array([turned[lane][s] for s in range(-MAX_HEAD, MAX_HEAD + 1)], np.uint64)
                    out.append(np.where(rebuilt, head + table[shift + MAX_HEAD] * (product - skipped), product))
            arrays = [pa.array(c.view(np.int64)) for c in out] + [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
    return rows.mapInArrow(combine, schema)


# -- 3. nodes and their verification ---------------------------------------------

def _nodes(places: DataFrame) -> DataFrame:
    checked = ("g1", "g2", "t1", "t2", "bytes")
    return places.groupBy(*NODE).agg(
        F.sum("members").alias("n_convs"), F.min("low").alias("conv_id"), F.count(F.lit(1)).alias("rows"),
        *[F.min(c).alias(c) for c in checked], *[F.max(c).alias(f"{c}_most") for c in checked])


def _equal(nodes: DataFrame, source: DataFrame) -> bool:
    """Whether all rows of each node have one prefix and one turn, to the letter."""
    checked = ("g1", "g2", "t1", "t2", "bytes")
    differ = F.lit(False)
    for c in checked:
        differ = differ | (F.col(c) != F.col(f"{c}_most"))
    if not nodes.where(differ).isEmpty():
        return False
    refs = materialize(nodes.where("rows > 1").select("t1", "t2").distinct())
    if refs.count() <= BROADCAST_REFS:  # texts of other references are not even shuffled
        source = source.join(F.broadcast(refs), ["t1", "t2"], "left_semi")
    contents = source.groupBy("t1", "t2", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    return contents.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


# -- 4. subtree sums ---------------------------------------------------------------

def _chain_totals(chains: DataFrame) -> DataFrame:
    """Per chain (conv_id, up, saved, leaves) the sums over all chains below it, itself included."""
    state = chains
    while not state.where("up IS NOT NULL").isEmpty():
        add = state.where("up IS NOT NULL").groupBy(F.col("up").alias("conv_id")) \
                   .agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
        jump = state.where("up IS NOT NULL").select(F.col("conv_id").alias("up"), F.col("up").alias("next"))
        state = materialize(state.join(jump, "up", "left").join(add, "conv_id", "left").select(
            "conv_id", F.col("next").alias("up"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves")))
    return state.select("conv_id", "saved", "leaves")


def _hash_ends(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids per node, ascending and comma-joined; ``ends`` has NODE and conv_id."""
    blocks = (ends.groupBy(*NODE, F.floor(F.col("conv_id") / BLOCK).alias("block")).agg(F.collect_list("conv_id").alias("ids"))
              .withColumn("ids", F.array_join(F.transform(F.sort_array("ids"), lambda v: v.cast("string")), ",")))
    schema = T.StructType([*_long_schema(*NODE), T.StructField("ends_sha256", T.StringType())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for *now, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if now != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = now, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _rows(done)
        yield _rows([] if key is None else [(*key, digest.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()])], names=schema.names)

    return blocks.repartition(*NODE).sortWithinPartitions(*NODE, "block").select(*NODE, "ids").mapInArrow(stream, schema)


def prefix_trie(conversations: DataFrame, base: Callable[[Column], Column] = base_of, head: Callable[[Column], Column] = head_of,
                conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """All nodes of the trie of rebuilt conversations, one row each.

    ``base`` and ``head`` say how a conversation is rebuilt; a base is its own
    base, few conversations share one, and heads have at most ``MAX_HEAD`` turns.
    """
    for attempt in range(0, 64, 2):
        source = conversations.where(F.col(conv_col).isNotNull()).select(
            F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        source = source.withColumn("t1", F.xxhash64(F.lit(attempt), "role", "text")) \
                       .withColumn("t2", F.xxhash64(F.lit(attempt + 1), "text", "role"))
        turns = prefix_products(source.select("conv_id", "turn", "t1", "t2", F.octet_length("text").cast("long").alias("bytes")))
        convs = materialize(_rebuilt(turns, base, head))
        places = materialize(_places(turns, convs))
        nodes = materialize(_nodes(places))
        if _equal(nodes, source):
            return _summary(convs, places, nodes)
    raise RuntimeError("turn hashes collide under all seeds")


def _summary(convs: DataFrame, places: DataFrame, nodes: DataFrame) -> DataFrame:
    spark = convs.sparkSession
    root_id, n_convs = convs.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    if root_id is None:
        none = T.StructType([T.StructField(c, T.StringType() if c == "ends_sha256" else T.LongType()) for c in OUTPUT])
        return spark.createDataFrame([], none)
    zero = {c: 0 for c in ("depth", "f1", "f2", "g1", "g2", "bytes")}
    root = spark.createDataFrame([(root_id, n_convs, *zero.values())], f"conv_id long, n_convs long, {', '.join(f'{c} long' for c in zero)}")
    nodes = nodes.select("conv_id", "n_convs", *zero).unionByName(root)
    nodes = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
    # chains: all nodes named after one conversation, and the node that the chain hangs on
    chains = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "g1", "g2")).alias("top"), F.max("depth").alias("bottom"),
                                          F.sum("saved").alias("saved"))
    chains = materialize(chains.select("conv_id", F.col("top.depth").alias("top"), "top.g1", "top.g2", "bottom", "saved"))
    holders = nodes.where("n_convs > 1").select((F.col("depth") + 1).alias("top"), F.col("f1").alias("g1"), F.col("f2").alias("g2"),
                                                F.col("conv_id").alias("up"))
    deep = chains.where("top > 1").join(holders, ["top", "g1", "g2"], "left")
    flat = chains.where("top <= 1").withColumn("up", F.when(F.col("top") == 1, F.lit(root_id)).cast("long"))
    chains = deep.unionByName(flat).select("conv_id", "up", "top", "bottom", "saved")
    chains = materialize(chains)
    hung = chains.where("up IS NOT NULL").groupBy(F.col("up").alias("conv_id"), (F.col("top") - 1).alias("depth")) \
                 .agg(F.count(F.lit(1)).alias("hung"))
    tips = hung.select("conv_id", F.col("depth").alias("bottom"), "hung")
    chains = materialize(chains.join(tips, ["conv_id", "bottom"], "left")
                         .withColumn("leaves", F.col("hung").isNull().cast("long")).drop("hung"))
    totals = _chain_totals(chains.select("conv_id", "up", "saved", "leaves"))
    below = (chains.where("up IS NOT NULL").select("conv_id", "up", "top").join(totals, "conv_id")
             .groupBy(F.col("up").alias("conv_id"), (F.col("top") - 1).alias("depth"))
             .agg(F.sum("saved").alias("below_saved"), F.sum("leaves").alias("below_leaves"), F.count(F.lit(1)).alias("hung")))
    # own value and hung chains of each node, summed from the node to its chain's end
    ends = places.select(*NODE, F.explode("ends").alias("conv_id")).unionByName(
        convs.where("length = 0").select(*[F.lit(0).cast("long").alias(c) for c in NODE], "conv_id"))
    rows = (nodes.join(chains.select("conv_id", "up", "top", "bottom", "leaves"), "conv_id")
            .join(below, ["conv_id", "depth"], "left").join(_hash_ends(ends), NODE, "left"))
    last = F.col("depth") == F.col("bottom")
    rows = rows.select(
        "conv_id", "depth", F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("up")).alias("parent_conv_id"), "n_convs",
        (F.coalesce("hung", F.lit(0)) + F.when(last, 0).otherwise(1)).cast("long").alias("n_children"),
        (F.coalesce("below_leaves", F.lit(0)) + F.when(last, F.col("leaves")).otherwise(0)).alias("leaves"),
        (F.col("saved") + F.coalesce("below_saved", F.lit(0))).alias("saved"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
    summed = materialize(prefix_sums(rows, ["conv_id", "depth"], {"saved": "saved", "leaves": "leaves"}))
    spans = summed.groupBy("conv_id").agg(F.max("_cum_saved").alias("all_saved"), F.max("_cum_leaves").alias("all_leaves"))
    return summed.join(spans, "conv_id").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("all_leaves") - F.col("_cum_before_leaves")).alias("n_leaves"),
        (F.col("all_saved") - F.col("_cum_before_saved")).alias("saved_tokens"), "ends_sha256")


OUTPUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def oracle_sql() -> str:
    """The rebuilt turns written out, paths as strings of turn hashes, every node counted in all its ancestors."""
    return """
WITH t AS (SELECT conv_id AS c, COALESCE(role, '') AS r, COALESCE(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, list_concat([4294967295], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
    lambda s: [ord(s), -1, -1, -1, -1, -1, -1, -1, -1]))) AS steps FROM (SELECT DISTINCT c FROM t)),
crc AS (SELECT c, xor(list_reduce(steps, lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) ELSE xor(a >> 1, 3988292384 * (a & 1)) END),
    4294967295) % 9 AS h FROM ids),
heads AS (SELECT k.c, b.pos AS d, b.r, b.x FROM crc k JOIN t b ON b.c = k.c - k.c % 5 AND b.pos <= k.h),
lens AS (SELECT k.c, k.h, count(e.d) AS n FROM crc k LEFT JOIN heads e ON e.c = k.c GROUP BY k.c, k.h),
turns AS (SELECT * FROM heads UNION ALL
    SELECT t.c, t.pos - l.h + l.n AS d, t.r, t.x FROM t JOIN lens l ON l.c = t.c AND t.pos > l.h),
paths AS (SELECT c, d, string_agg(sha256(r || chr(31) || x), ',') OVER (PARTITION BY c ORDER BY d) AS path,
    octet_length(encode(x)) AS bytes FROM turns
    UNION ALL SELECT c, 0, '', 0 FROM crc),
last AS (SELECT c, max(d) AS n FROM paths GROUP BY c),
nodes AS (SELECT d, path, min(p.c) AS c, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved,
    COALESCE(string_agg(CASE WHEN l.n = d THEN CAST(p.c AS VARCHAR) END, ',' ORDER BY p.c), '') AS ends
    FROM paths p JOIN last l ON l.c = p.c GROUP BY d, path),
up AS (SELECT n.d, n.c, p.c AS parent FROM nodes n JOIN paths q ON q.c = n.c AND q.d = n.d - 1 JOIN nodes p ON p.d = q.d AND p.path = q.path),
kids AS (SELECT parent AS c, d - 1 AS d, count(*) AS n FROM up GROUP BY 1, 2),
below AS (SELECT a.c, a.d, sum(n.saved) AS saved, count_if(k.n IS NULL) AS leaves
    FROM nodes n JOIN paths q ON q.c = n.c AND q.d <= n.d JOIN nodes a ON a.d = q.d AND a.path = q.path
    LEFT JOIN kids k ON k.c = n.c AND k.d = n.d GROUP BY a.c, a.d)
SELECT n.c AS conv_id, CAST(n.d AS BIGINT) AS depth, u.parent AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
  CAST(COALESCE(k.n, 0) AS BIGINT) AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens,
  sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b ON b.c = n.c AND b.d = n.d LEFT JOIN up u ON u.c = n.c AND u.d = n.d LEFT JOIN kids k ON k.c = n.c AND k.d = n.d"""
