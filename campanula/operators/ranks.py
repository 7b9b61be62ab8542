"""Global order statistics without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one
task.  Here a global running sum is computed in two passes instead:

1. range-partition the rows by the full ordering (Spark samples the
   ordering tuples, so partitions are balanced even when one value holds a
   third of all rows, as long as the tuple is unique) and tag each row with
   its partition id; the result is checkpointed so the range bounds and ids
   are fixed once (deterministic under retries / executor loss);
2. per partition: a local running sum (window partitioned by the partition
   id) and the partition total; the totals (one row per partition, bounded
   by the partition count) become offsets via a tiny window and are
   broadcast back.

Rank-type operators aggregate to *distinct values* before ordering, so the
ordered table is at most the number of distinct values.  There is one path for
every size: nothing is counted while a plan is built.  Tested against brute
force.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanula.session import materialize, shuffle_partitions


def prefix_sums(df: DataFrame, order_cols: Sequence[str | Column], weights: dict[str, Column | str],
                num_partitions: int | None = None) -> DataFrame:
    """For each named weight ``w`` add ``_cum_w`` (inclusive global running sum
    in the given order) and ``_cum_before_w`` (exclusive).  Ties in
    ``order_cols`` are ordered arbitrarily; pass a unique ordering when
    that matters."""
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    ordered = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    names = list(weights)
    wdf = df
    for name, w in weights.items():
        wdf = wdf.withColumn(f"_w_{name}", F.col(w) if isinstance(w, str) else w)
    parted = wdf.repartitionByRange(n, *ordered).withColumn("_pid", F.spark_partition_id())
    parted = materialize(parted)
    local = Window.partitionBy("_pid").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, 0)
    with_local = parted.select("*", *[F.sum(f"_w_{k}").over(local).alias(f"_l_{k}") for k in names])
    totals = parted.groupBy("_pid").agg(*[F.sum(f"_w_{k}").alias(f"_t_{k}") for k in names])
    # One row per partition: a single-task window over <= n rows is fine.
    run = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    offsets = totals.select("_pid", *[(F.sum(f"_t_{k}").over(run) - F.col(f"_t_{k}")).alias(f"_o_{k}")
                                      for k in names])
    out = with_local.join(F.broadcast(offsets), "_pid")
    for k in names:
        out = (out.withColumn(f"_cum_{k}", F.col(f"_o_{k}") + F.col(f"_l_{k}"))
                  .withColumn(f"_cum_before_{k}", F.col(f"_cum_{k}") - F.col(f"_w_{k}")))
    return out.drop("_pid", *[f"_l_{k}" for k in names], *[f"_o_{k}" for k in names])


def prefix_sum(df: DataFrame, order_cols: Sequence[str | Column], weight: str | Column | None = None,
               num_partitions: int | None = None) -> DataFrame:
    """Single-weight form: adds ``_w``, ``_cum`` and ``_cum_before``."""
    w = weight if weight is not None else F.lit(1)
    out = prefix_sums(df, order_cols, {"x": w}, num_partitions)
    return (out.withColumnRenamed("_w_x", "_w").withColumnRenamed("_cum_x", "_cum")
               .withColumnRenamed("_cum_before_x", "_cum_before"))


def prefix_max_before(df: DataFrame, order_cols: Sequence[str | Column], value: str,
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``_max_before``: the maximum of ``value`` over all rows strictly
    before each row in the global order (null for the first row).  Same
    two-pass scheme as ``prefix_sums`` with ``max`` as the combiner."""
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    ordered = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    parted = materialize(df.repartitionByRange(n, *ordered).withColumn("_pid", F.spark_partition_id()))
    local = Window.partitionBy("_pid").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, -1)
    with_local = parted.withColumn("_lmax", F.max(value).over(local))
    totals = parted.groupBy("_pid").agg(F.max(value).alias("_tmax"))
    run = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # <= n rows
    offsets = totals.select("_pid", F.max("_tmax").over(run).alias("_omax"))
    out = with_local.join(F.broadcast(offsets), "_pid")
    both = F.when(F.col("_omax").isNull(), F.col("_lmax")).when(F.col("_lmax").isNull(), F.col("_omax")) \
            .otherwise(F.greatest("_omax", "_lmax"))
    return out.withColumn("_max_before", both).drop("_pid", "_lmax", "_omax")


def value_ranks(df: DataFrame, value: str) -> DataFrame:
    """WIN-10: average rank (ties share the mean rank) per distinct value.

    Returns ``(value, _cnt, rank)``; rows with a null value are excluded.
    """
    counts = (df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
              .groupBy(value).agg(F.count(F.lit(1)).alias("_cnt")))
    return ranks_from_counts(counts, value, "_cnt")


def ranks_from_counts(counts: DataFrame, value: str, count: str) -> DataFrame:
    """Average ranks from a (distinct value, multiplicity) table; returns
    ``(value, _cnt, rank)``."""
    counts = counts.select(value, F.col(count).alias("_cnt"))
    ps = prefix_sum(counts, [value], "_cnt")
    return ps.select(value, "_cnt",
                     (F.col("_cum_before") + (F.col("_cnt") + 1) / 2.0).alias("rank"))


def exact_quantiles(df: DataFrame, value: str | Column, quantiles: dict[str, float],
                    by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, per group (one row without
    ``by``); null values are left out, and so are groups without any value.

    Values are counted first (a map-side combine), the distinct ones get their
    positions by the distributed prefix sum, and each quantile picks the values
    at its lower and upper position: no task ever holds all values of a group.
    """
    v = F.col(value) if isinstance(value, str) else value
    counts = (df.select(*by, v.cast("double").alias("_v")).filter(F.col("_v").isNotNull())
              .groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c")))
    ps = prefix_sum(counts, [*by, "_v"], "_c")
    if by:
        groups = ps.groupBy(*by).agg(F.min("_cum_before").alias("_start"), F.max("_cum").alias("_end"))
        g = [F.col(f"_g{i}") for i in range(len(by))]
        groups = groups.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], "_start", "_end")
        on = None
        for c, k in zip(by, g):
            on = F.col(c).eqNullSafe(k) if on is None else on & F.col(c).eqNullSafe(k)
        ps = ps.join(groups, on)
        start, n = F.col("_start"), F.col("_end") - F.col("_start")
    else:
        start, n = F.lit(0), ps.select(F.sum("_c")).scalar()
    ps = ps.withColumn("_from", F.col("_cum_before") - start).withColumn("_to", F.col("_cum") - start).withColumn("_n", n)
    aggs = []
    for name, q in quantiles.items():
        at = F.lit(float(q)) * (F.col("_n") - 1)
        for part, pos in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            inside = (F.col("_from") <= pos) & (pos < F.col("_to"))
            aggs.append(F.max(F.when(inside, F.col("_v"))).alias(f"_{part}_{name}"))
        aggs.append(F.max(at - F.floor(at)).alias(f"_f_{name}"))
    out = ps.groupBy(*by).agg(*aggs) if by else ps.agg(*aggs)
    return out.select(*by, *[(F.col(f"_lo_{k}") + (F.col(f"_hi_{k}") - F.col(f"_lo_{k}")) * F.col(f"_f_{k}")).alias(k)
                             for k in quantiles])


def quantile(df: DataFrame, value: str | Column, q: float) -> Column:
    """One exact quantile of all rows, as a scalar for any row expression."""
    return exact_quantiles(df, value, {"q": q}).scalar()


def row_rank(df: DataFrame, value: str, tiebreak: Sequence[str], descending: bool = False) -> DataFrame:
    """``rank(method='first')``: 1..n over non-null values, ties by ``tiebreak``.

    Adds ``_rn`` and ``_n`` (count of ranked rows); null values get null.
    """
    v = F.col(value)
    keyed = df.filter(v.isNotNull())
    order = [v.desc() if descending else v.asc()] + [F.col(t).asc() for t in tiebreak]
    ranked = prefix_sum(keyed, order).withColumnRenamed("_cum", "_rn").drop("_cum_before", "_w")
    n = keyed.select(F.count(F.lit(1))).scalar()
    ranked = ranked.withColumn("_n", n)
    nulls = (df.filter(v.isNull())
             .withColumn("_rn", F.lit(None).cast("bigint"))
             .withColumn("_n", n))
    return ranked.unionByName(nulls)


def qcut_bucket(rn: Column, n: Column, q: int) -> Column:
    """WIN-04: equal-frequency bucket 1..q of rank ``rn`` among ``n`` (pandas
    ``qcut`` on first-ranks: right-closed, lowest included)."""
    num = (rn - 1) * q
    den = n - 1
    # integer ceil of num / den for non-negative num, positive den
    b = F.when(den <= 0, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.floor((num + den - 1) / den)))
    return F.when(rn.isNull(), F.lit(None)).otherwise(b.cast("int"))


def qcut_rank(df: DataFrame, value: str, tiebreak: Sequence[str], q: int, out: str,
              reverse: bool = False) -> DataFrame:
    """WIN-04: rank-first then equal-frequency labels (reverse: q..1)."""
    r = row_rank(df, value, tiebreak)
    b = qcut_bucket(F.col("_rn"), F.col("_n"), q)
    if reverse:
        b = F.lit(q + 1) - b
    return r.withColumn(out, b.cast("int")).drop("_rn", "_n")


def qcut_boundaries(df: DataFrame, values: Sequence[str], key: str, q: int, bins: int = 1024) -> dict[str, list[tuple[float, str | None]]]:
    """WIN-04 without ordering any rows: for each value column the ``q - 1`` tuples
    (value, key) that end the first ``q - 1`` of ``q`` equal-frequency buckets.

    Multi-pass selection.  A pass counts the rows of each still open interval in
    ``bins`` equal parts (one scan and one map-side aggregate for all columns and
    boundaries together) and goes on with the parts that hold the wanted ranks,
    between the least and greatest value that occur there, until such a part holds
    a single value.  Where that value is shared by rows on both sides of the
    boundary, the key is selected among them likewise, two characters a pass.  The
    driver sees counts only: at most ``bins`` a boundary and pass, whatever the
    number of rows.  A key of None means that all rows with the value are inside.

    Values are finite; nulls have no rank.  ``key`` is a unique string.
    """
    cols = {v: F.col(v).cast("double") + F.lit(0.0) for v in values}
    first = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(cols.values()) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    open_, done = {}, {}
    for i, v in enumerate(values):
        n = first[f"n{i}"]
        for k in range(1, q) if n else ():
            # the bucket of rank r is at most k exactly when r <= k (n - 1) / q + 1
            open_[v, k] = (first[f"lo{i}"], first[f"hi{i}"], k * (n - 1) // q + 1, n)
    while open_:
        spans = sorted({(v, lo, hi) for (v, _), (lo, hi, _, _) in open_.items() if lo < hi})
        done |= {t: state for t, state in open_.items() if state[0] == state[1]}
        open_ = {t: state for t, state in open_.items() if t not in done}
        if not spans:
            break
        parts = [F.when(cols[v].between(lo, hi), F.struct(
            F.lit(i).alias("span"), F.least(F.floor((cols[v] - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int").alias("bin"),
            cols[v].alias("v"))) for i, (v, lo, hi) in enumerate(spans)]
        counts = (df.select(F.explode(F.array(*parts)).alias("p")).filter(F.col("p").isNotNull()).select("p.*")
                  .groupBy("span", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
        counts.sort(key=lambda r: (r.span, r.bin))
        for (v, k), (lo, hi, rank, _) in list(open_.items()):
            for r in counts:
                if spans[r.span] == (v, lo, hi):
                    if rank <= r.n:
                        open_[v, k] = (r.lo, r.hi, rank, r.n)
                        break
                    rank -= r.n
    ties = {t: ("", rank) for t, (_, _, rank, n) in done.items() if rank < n}
    keys: dict[tuple[str, int], str] = {}
    width = 0
    while ties:
        width += 2
        named = sorted(ties)
        parts = [F.when((cols[v] == done[v, k][0]) & F.col(key).startswith(ties[v, k][0]),
                        F.struct(F.lit(i).alias("at"), F.substring(key, 1, width).alias("prefix"))) for i, (v, k) in enumerate(named)]
        counts = (df.select(key, F.explode(F.array(*parts)).alias("p")).filter(F.col("p").isNotNull()).select(key, "p.*")
                  .groupBy("at", "prefix").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("least")).collect())
        counts.sort(key=lambda r: (r.at, r.prefix.encode()))
        for i, t in enumerate(named):
            rank = ties[t][1]
            for r in counts:
                if r.at == i:
                    if rank <= r.n:
                        ties[t] = (r.prefix, rank)
                        if r.n == 1:
                            keys[t] = r.least
                            del ties[t]
                        break
                    rank -= r.n
    return {v: [(done[v, k][0], keys.get((v, k))) for k in range(1, q) if (v, k) in done] for v in values}


def qcut_scores(df: DataFrame, scores: dict[str, tuple[str, bool]], key: str, q: int) -> DataFrame:
    """WIN-04: rank-first equal-frequency labels 1..q of several columns, ties by
    ``key``; ``scores`` names (value column, reversed).  Rows are compared with the
    boundaries where they are: no shuffle."""
    found = qcut_boundaries(df, sorted({v for v, _ in scores.values()}), key, q)
    out = {}
    for name, (v, reverse) in scores.items():
        x, bucket = F.col(v).cast("double"), F.lit(1)
        for value, last in found[v]:
            above = x > value if last is None else (x > value) | ((x == value) & (F.col(key) > last))
            bucket = bucket + above.cast("int")
        out[name] = F.when(x.isNotNull(), (F.lit(q + 1) - bucket) if reverse else bucket).cast("int")
    return df.withColumns(out)


def gini(df: DataFrame, value: str) -> DataFrame:
    """STA-10: Gini of max(x, 0) via the rank-sum closed form on distinct values.

    For a distinct value v with count c after a items:
    sum over its positions of (2i - n - 1) * v = v * (c * (2a + c + 1) - c * (n + 1)).
    """
    x = F.greatest(F.col(value).cast("double"), F.lit(0.0))
    vals = df.filter(F.col(value).isNotNull()).select(x.alias("_x"))
    counts = vals.groupBy("_x").agg(F.count(F.lit(1)).alias("_c"))
    ps = prefix_sum(counts, ["_x"], "_c")
    n = vals.select(F.count(F.lit(1))).scalar()
    c, a = F.col("_c"), F.col("_cum_before")
    term = F.col("_x") * (c * (2 * a + c + 1) - c * (n + 1))
    agg = ps.agg(F.sum(term).alias("_num"), F.sum(F.col("_x") * c).alias("_tot"), F.max(F.lit(n)).alias("n"))
    return agg.select(F.col("n").cast("bigint").alias("n"),
                      F.try_divide(F.col("_num"), F.col("n") * F.col("_tot")).alias("gini"))


def lorenz(df: DataFrame, value: str) -> DataFrame:
    """WIN-06: Lorenz curve points, one per distinct value of max(x, 0):
    population share (x) and cumulative value share (y)."""
    x = F.greatest(F.col(value).cast("double"), F.lit(0.0))
    vals = df.filter(F.col(value).isNotNull()).select(x.alias("_x"))
    counts = vals.groupBy("_x").agg(F.count(F.lit(1)).alias("_c"), F.sum("_x").alias("_s"))
    ps = prefix_sums(counts, ["_x"], {"n": "_c", "s": "_s"})
    n = vals.select(F.count(F.lit(1))).scalar()
    tot = vals.select(F.sum("_x")).scalar()
    return ps.select(F.col("_x").alias("value"), F.col("_cum_n").cast("bigint").alias("cum_count"),
                     (F.col("_cum_n") / n).alias("pop_share"),
                     F.try_divide(F.col("_cum_s"), tot).alias("value_share"))
