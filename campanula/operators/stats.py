"""Hypothesis tests as aggregations to sufficient statistics (STA-01..13).

Every test reduces the data with grouped aggregates (partial, map-side)
to a handful of numbers per group, then finishes with arithmetic on a tiny
table.  Tests of a kind are *stacked*: their aggregates go into one table with
a ``test`` column, and every later step (margins, ranks, sums) is done once for
all tests.  Rank tests rank distinct values of all tests in one ordered pass
over (test, value) ranges (no single-partition window over data rows).
Statistic rows carry ``dist``/``df1``/``df2`` so ``with_p_values`` can add
tail probabilities afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanula.functions import clean as C
from campanula.functions.pvalues import p_value
from campanula.session import materialize, shuffle_partitions

_D = "double"


def _div(a: Column, b: Column) -> Column:
    """Division that yields null on a zero divisor (ANSI mode raises)."""
    return F.try_divide(a, b)


def safe_corr(x: str, y: str) -> Column:
    """Pearson r as an aggregate; null (not an error) when a variance is 0."""
    return _div(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def _lit(v, t=_D) -> Column:
    return F.lit(v).cast(t)


def _stat_row(df_one: DataFrame, test: str, statistic: Column, n: Column, dist: str,
              df1: Column | None = None, df2: Column | None = None, extra: dict | None = None) -> DataFrame:
    cols = [F.lit(test).alias("test"), statistic.cast(_D).alias("statistic"), n.cast("bigint").alias("n"),
            F.lit(dist).alias("dist"), (df1 if df1 is not None else _lit(None)).cast(_D).alias("df1"),
            (df2 if df2 is not None else _lit(None)).cast(_D).alias("df2")]
    for k, v in (extra or {}).items():
        cols.append(v.cast(_D).alias(k))
    return df_one.select(*cols)


def contingency(df: DataFrame, tables: dict[str, tuple[str | Column, str | Column]]) -> DataFrame:
    """STA-01: the non-empty cells ``(test, a, b, o)`` of any number of two-way
    tables over one input, from one scan; rows with a null in either are left out."""
    def pair(test, a, b):
        a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
        return F.struct(F.lit(test).alias("test"), a.cast("string").alias("a"), b.cast("string").alias("b"))
    pairs = F.explode(F.array(*[pair(t, a, b) for t, (a, b) in tables.items()]))
    return (df.select(pairs.alias("_c")).select("_c.*").filter(F.col("a").isNotNull() & F.col("b").isNotNull())
            .groupBy("test", "a", "b").agg(F.count(F.lit(1)).alias("o")))


def chi2_from_cells(cells: DataFrame, yates: bool = True) -> DataFrame:
    """STA-01 + STA-02: Pearson chi-square and Cramer's V of r x c tables given by
    their non-empty cells; no dense grid is built, so levels may be many.

    A cell that does not occur adds its expected count, so all of them together
    add n minus the expected counts of those that do occur.  With one degree of
    freedom Yates' correction applies (as in the reference): all four cells
    deviate by the same amount, which the margins give.  A test without cells has
    no row; one with a single row or column has 0 degrees and a null V.
    """
    cells = materialize(cells)  # read for both margins and for the sums
    rows = cells.groupBy("test", "a").agg(F.sum("o").cast(_D).alias("r"))
    cols = cells.groupBy("test", "b").agg(F.sum("o").cast(_D).alias("c"))
    row_sums = rows.groupBy("test").agg(F.sum("r").alias("n"), F.count(F.lit(1)).alias("nr"), F.sum(F.col("r") * F.col("r")).alias("rr"))
    col_sums = cols.groupBy("test").agg(F.count(F.lit(1)).alias("nc"), F.sum(F.col("c") * F.col("c")).alias("cc"))
    totals = row_sums.join(col_sums, "test")
    e = F.col("r") * F.col("c") / F.col("n")
    n, dof = F.col("n"), (F.col("nr") - 1) * (F.col("nc") - 1)
    sums = (cells.join(rows, ["test", "a"]).join(cols, ["test", "b"]).join(totals, "test")
            .groupBy("test", "n", "nr", "nc", "rr", "cc")
            .agg(F.sum(F.pow(F.col("o") - e, 2) / e).alias("full"), F.sum(e).alias("e"), F.count(F.lit(1)).alias("k")))
    plain = F.col("full") + F.when(F.col("k") < F.col("nr") * F.col("nc"), n - F.col("e")).otherwise(0.0)
    # 2 x 2: the products of both margins are (n^2 - sum of squares) / 2
    product = (n * n - F.col("rr")) * (n * n - F.col("cc")) / 4.0
    off = F.sqrt(plain * product / F.pow(n, 3))
    corrected = F.pow(off - F.least(F.lit(0.5), off), 2) * F.pow(n, 3) / product
    out = sums.withColumn("chi2", F.when(dof == 1, corrected).otherwise(plain) if yates else plain)
    v = F.sqrt(_div(F.col("chi2"), n * (F.least("nr", "nc") - 1)))
    return out.select("test", F.col("chi2").alias("statistic"), n.cast("bigint").alias("n"), F.lit("chi2").alias("dist"),
                      dof.cast(_D).alias("df1"), _lit(None).alias("df2"), v.alias("cramers_v"))


def chi2_flag(df: DataFrame, a: str, flag: Column, test: str, yates: bool = True) -> DataFrame:
    """STA-01 + STA-02 of a category and a flag (null: false)."""
    return chi2_from_cells(contingency(df, {test: (a, F.coalesce(flag, F.lit(False)))}), yates)


def _tests(spark, names: Sequence[str]) -> DataFrame:
    """One row a declared test, so that a test without data still has its (null) row."""
    return spark.createDataFrame([(n,) for n in names], "test string")


def _group_values(tests: dict[str, tuple[DataFrame, str | Column, str | Column]]) -> list[DataFrame]:
    """Per input frame the rows (test, _g, _v) of all its tests, from one scan;
    null groups and null or NaN values are left out."""
    frames: dict[int, tuple[DataFrame, list[Column]]] = {}
    for test, (df, g, v) in tests.items():
        g, v = (F.col(c) if isinstance(c, str) else c for c in (g, v))
        row = F.struct(F.lit(test).alias("test"), g.cast("string").alias("_g"), v.cast(_D).alias("_v"))
        frames.setdefault(id(df), (df, []))[1].append(row)
    return [df.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
            .filter(F.col("_g").isNotNull() & F.col("_v").isNotNull() & ~F.isnan("_v")) for df, rows in frames.values()]


def stacked_counts(tests: dict[str, tuple[DataFrame, str | Column, str | Column]], min_n: int = 1) -> DataFrame:
    """(test, _g, _v, _c) of all tests, written once: group, value, multiplicity.

    Groups with fewer than ``min_n`` values are left out (FIL-03)."""
    parts = [kept.groupBy("test", "_g", "_v").agg(F.count(F.lit(1)).alias("_c")) for kept in _group_values(tests)]
    counts = materialize(union_all(parts))
    if min_n > 1:
        keep = counts.groupBy("test", "_g").agg(F.sum("_c").alias("_n")).filter(F.col("_n") >= min_n).select("test", "_g")
        counts = counts.join(keep, ["test", "_g"], "left_semi")
    return counts


def stacked_ranks(counts: DataFrame) -> DataFrame:
    """Average ranks within each test, in one ordered pass for all tests: adds
    ``rank`` and ``_t`` (the number of rows tied at the value).

    Ranges of (test, value) keep the rows of one value together (at most one a
    group), so ranks and ties are local sums plus one offset a (test, range)."""
    n = shuffle_partitions(counts.sparkSession)
    parted = materialize(counts.repartitionByRange(n, "test", "_v").withColumn("_pid", F.spark_partition_id()))
    upto = Window.partitionBy("_pid", "test").orderBy("_v").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    peers = Window.partitionBy("_pid", "test", "_v")
    local = parted.withColumn("_upto", F.sum("_c").over(upto)).withColumn("_t", F.sum("_c").over(peers))
    before = Window.partitionBy("test").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = parted.groupBy("test", "_pid").agg(F.sum("_c").alias("_s")) \
                    .select("test", "_pid", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), ["test", "_pid"])  # at most ranges + tests rows
            .withColumn("rank", F.col("_off") + F.col("_upto") - F.col("_t") + (F.col("_t") + 1) / 2.0)
            .drop("_pid", "_upto", "_off"))


def _rank_sums(counts: DataFrame) -> DataFrame:
    """Per (test, group): n_g, rank sum r_g and its part of the tie term sum(t^3 - t)."""
    t = F.col("_t").cast(_D)
    return stacked_ranks(counts).groupBy("test", "_g").agg(
        F.sum("_c").alias("n_g"), F.sum(F.col("_c") * F.col("rank")).alias("r_g"), F.sum(F.col("_c") * (t * t - 1)).alias("ties"))


def _stats(df: DataFrame, statistic: Column, n: Column, dist: str | Column, df1: Column | None = None,
           df2: Column | None = None, extra: dict | None = None) -> DataFrame:
    """Statistic rows of a table with a ``test`` column."""
    none = _lit(None)
    cols = ["test", statistic.cast(_D).alias("statistic"), n.cast("bigint").alias("n"),
            (F.lit(dist) if isinstance(dist, str) else dist).alias("dist"),
            (none if df1 is None else df1).cast(_D).alias("df1"), (none if df2 is None else df2).cast(_D).alias("df2")]
    return df.select(*cols, *[v.cast(_D).alias(k) for k, v in (extra or {}).items()])


def kruskal_tests(tests: dict[str, tuple[DataFrame, str | Column, str | Column]]) -> DataFrame:
    """STA-03: Kruskal-Wallis H with tie correction, for any number of
    (frame, group, value) tests in one ordered pass."""
    per = _rank_sums(stacked_counts(tests, min_n=2))
    agg = per.groupBy("test").agg(F.sum("n_g").cast(_D).alias("N"), F.count(F.lit(1)).alias("k"), F.sum("ties").alias("ties"),
                                  F.sum(F.col("r_g") * F.col("r_g") / F.col("n_g")).alias("S"))
    n = F.col("N")
    h0 = F.lit(12.0) / (n * (n + 1)) * F.col("S") - 3.0 * (n + 1)
    corr = 1.0 - _div(F.col("ties"), F.pow(n, 3) - n)
    return _stats(_tests(per.sparkSession, list(tests)).join(agg, "test", "left"), _div(h0, corr), n, "chi2", F.col("k") - 1)


def kruskal(df: DataFrame, group: str, value: str, test: str) -> DataFrame:
    """STA-03, one test."""
    return kruskal_tests({test: (df, group, value)})


def anova_tests(tests: dict[str, tuple[DataFrame, str | Column, str | Column]]) -> DataFrame:
    """STA-04: one-way ANOVA F of any number of (frame, group, value) tests from
    per-group count, mean and variance (mergeable, one aggregate a frame)."""
    parts = [kept.groupBy("test", "_g").agg(F.count(F.lit(1)).alias("n_g"), F.avg("_v").alias("m_g"), F.var_samp("_v").alias("v_g"))
             .filter(F.col("n_g") > 1) for kept in _group_values(tests)]
    whole = Window.partitionBy("test")  # one row a group
    grand = F.sum(F.col("n_g") * F.col("m_g")).over(whole) / F.sum("n_g").over(whole)
    agg = union_all(parts).withColumn("_gm", grand).groupBy("test").agg(
        F.sum("n_g").alias("n"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n_g") * F.pow(F.col("m_g") - F.col("_gm"), 2)).alias("ssb"), F.sum((F.col("n_g") - 1) * F.col("v_g")).alias("ssw"))
    k, n = F.col("k"), F.col("n")
    fstat = _div(_div(F.col("ssb"), k - 1), _div(F.col("ssw"), n - k))
    return _stats(_tests(agg.sparkSession, list(tests)).join(agg, "test", "left"), fstat, n, "f", k - 1, n - k)


def anova(df: DataFrame, group: str, value: str, test: str) -> DataFrame:
    """STA-04, one test."""
    return anova_tests({test: (df, group, value)})


def _two_groups(df: DataFrame, flag: Column, value: str) -> DataFrame:
    return (df.filter(flag.isNotNull() & F.col(value).isNotNull())
            .select(flag.cast("boolean").alias("_x"), F.col(value).alias(value)))


def mann_whitney_tests(tests: dict[str, tuple], alternative: str = "two-sided") -> DataFrame:
    """STA-05: Mann-Whitney U of the ``flag`` group vs the rest for any number of
    (frame, flag, value[, alternative]) tests in one ordered pass; normal
    approximation with tie and continuity correction (as scipy's default)."""
    per = _rank_sums(stacked_counts({k: (t[0], t[1].cast("boolean"), t[2]) for k, t in tests.items()}))
    yes = F.col("_g") == "true"
    agg = per.groupBy("test").agg(
        F.coalesce(F.sum(F.when(yes, F.col("n_g"))), F.lit(0)).cast(_D).alias("n1"), F.sum(F.when(yes, F.col("r_g"))).alias("r1"),
        F.coalesce(F.sum(F.when(~yes, F.col("n_g"))), F.lit(0)).cast(_D).alias("n2"), F.sum("ties").alias("ties"))
    n1, r1, n2 = F.col("n1"), F.col("r1"), F.col("n2")
    n = n1 + n2
    u1 = r1 - n1 * (n1 + 1) / 2.0
    u2 = n1 * n2 - u1
    mu = n1 * n2 / 2.0
    sigma = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - _div(F.col("ties"), n * (n - 1))))
    one_sided = F.col("test").isin(*[k for k, t in tests.items() if (t[3] if len(t) > 3 else alternative) == "greater"])
    z = _div(F.when(one_sided, u1).otherwise(F.greatest(u1, u2)) - mu - 0.5, sigma)
    rows = _tests(per.sparkSession, list(tests)).join(agg, "test", "left")
    return _stats(rows, u1, n, F.when(one_sided, F.lit("norm1")).otherwise(F.lit("norm2")), extra={"z": z, "n1": n1, "n2": n2})


def mann_whitney(df: DataFrame, flag: Column, value: str, test: str, alternative: str = "two-sided") -> DataFrame:
    """STA-05, one test."""
    return mann_whitney_tests({test: (df, flag, value, alternative)})


def welch_t(df: DataFrame, flag: Column, value: str, test: str) -> DataFrame:
    """STA-06: Welch's t (flag group minus the rest), Satterthwaite df."""
    base = _two_groups(df, flag, value)
    g = base.agg(
        F.count_if(F.col("_x")).alias("n1"), F.avg(F.when(F.col("_x"), F.col(value))).alias("m1"),
        F.var_samp(F.when(F.col("_x"), F.col(value))).alias("v1"),
        F.count_if(~F.col("_x")).alias("n2"), F.avg(F.when(~F.col("_x"), F.col(value))).alias("m2"),
        F.var_samp(F.when(~F.col("_x"), F.col(value))).alias("v2"))
    a, b = _div(F.col("v1"), F.col("n1")), _div(F.col("v2"), F.col("n2"))
    t = _div(F.col("m1") - F.col("m2"), F.sqrt(a + b))
    dof = _div((a + b) * (a + b), _div(a * a, F.col("n1") - 1) + _div(b * b, F.col("n2") - 1))
    return _stat_row(g, test, t, F.col("n1") + F.col("n2"), "t2", dof,
                     extra={"mean_1": F.col("m1"), "mean_0": F.col("m2")})


def point_biserial(df: DataFrame, flag: Column, value: Column, test: str) -> DataFrame:
    """STA-07: Pearson r of a 0/1 flag and a value; t = r sqrt((n-2)/(1-r^2))."""
    x = F.coalesce(flag, F.lit(False)).cast(_D)
    v = value.cast(_D)
    g = df.select(x.alias("_f"), v.alias("_v")).filter(F.col("_v").isNotNull()) \
          .agg(safe_corr("_f", "_v").alias("r"), F.count(F.lit(1)).alias("n"))
    t = F.col("r") * F.sqrt(_div(F.col("n") - 2, 1 - F.col("r") * F.col("r")))
    return _stat_row(g, test, F.col("r"), F.col("n"), "t2", (F.col("n") - 2).cast(_D), extra={"t": t})


def spearman_tests(tests: dict[str, tuple[DataFrame, str | Column, str | Column]]) -> DataFrame:
    """STA-08: Pearson correlation of average ranks (pairs with both values) for
    any number of (frame, x, y) tests: the values of all x and y are ranked in
    one ordered pass."""
    parts = []
    for test, (df, x, y) in tests.items():
        x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
        kept = df.select(x.cast(_D).alias("_x"), y.cast(_D).alias("_y")).filter(
            F.col("_x").isNotNull() & F.col("_y").isNotNull() & ~F.isnan("_x") & ~F.isnan("_y"))
        parts.append(kept.groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("_c")).withColumn("_pair", F.lit(test)))
    pairs = materialize(union_all(parts))  # distinct pairs with multiplicity
    axes = [pairs.groupBy(F.concat(F.lit(axis), "_pair").alias("test"), F.col(f"_{axis}").alias("_v")).agg(F.sum("_c").alias("_c"))
            for axis in "xy"]
    ranks = materialize(stacked_ranks(axes[0].unionByName(axes[1])).select("test", "_v", "rank"))
    j = pairs
    for axis in "xy":
        r = ranks.filter(F.col("test").startswith(axis)).select(
            F.substring("test", 2, 1 << 20).alias("_pair"), F.col("_v").alias(f"_{axis}"), F.col("rank").alias(f"_r{axis}"))
        j = j.join(r, ["_pair", f"_{axis}"])
    w = F.col("_c").cast(_D)
    g = j.groupBy(F.col("_pair").alias("test")).agg(
        F.sum(w).alias("n"), F.sum(w * F.col("_rx")).alias("sx"), F.sum(w * F.col("_ry")).alias("sy"),
        F.sum(w * F.col("_rx") * F.col("_rx")).alias("sxx"), F.sum(w * F.col("_ry") * F.col("_ry")).alias("syy"),
        F.sum(w * F.col("_rx") * F.col("_ry")).alias("sxy"))
    n = F.col("n")
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / n
    rho = _div(cov, F.sqrt((F.col("sxx") - F.col("sx") * F.col("sx") / n)
                           * (F.col("syy") - F.col("sy") * F.col("sy") / n)))
    t = rho * F.sqrt(_div(n - 2, 1 - rho * rho))
    return _stats(_tests(g.sparkSession, list(tests)).join(g, "test", "left"), rho, n, "t2", n - 2, extra={"t": t})


def spearman(df: DataFrame, x: str, y: str, test: str) -> DataFrame:
    """STA-08, one test."""
    return spearman_tests({test: (df, x, y)})


def slr(df: DataFrame, x: Column, y: Column, model: str, min_n: int = 5) -> DataFrame:
    """STA-12: simple linear regression of y on x over finite pairs."""
    xx, yy = x.cast(_D), y.cast(_D)
    d = df.select(xx.alias("_x"), yy.alias("_y")).filter(
        F.col("_x").isNotNull() & F.col("_y").isNotNull() & (F.abs("_x") < float("inf")) & (F.abs("_y") < float("inf")))  # NaN is above infinity
    slope = _div(F.covar_pop("_x", "_y"), F.var_pop("_x"))
    g = d.agg(F.count(F.lit(1)).alias("n"), slope.alias("slope"),
              (F.avg("_y") - slope * F.avg("_x")).alias("intercept"), safe_corr("_x", "_y").alias("r"))
    ok = F.col("n") >= min_n
    r = F.when(ok, F.col("r"))
    return g.select(F.lit(model).alias("model"), F.col("n").cast("bigint").alias("n"),
                    F.when(ok, F.col("slope")).alias("slope"), F.when(ok, F.col("intercept")).alias("intercept"),
                    r.alias("r"), (r * r).alias("R2"),
                    (r * F.sqrt(_div(F.col("n") - 2, 1 - r * r))).alias("t"),
                    (F.col("n") - 2).cast(_D).alias("df1"))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def with_p_values(stats: DataFrame, stat: str = "statistic") -> DataFrame:
    """STA-09: add p-value and significance stars to statistic rows."""
    p = p_value(F.col("dist"), F.col(stat), F.col("df1"), F.col("df2"))
    return stats.withColumn("p_value", p).withColumn("significance", C.stars("p_value"))
