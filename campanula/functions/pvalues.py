"""P-values from test statistics (STA-*), as column expressions.

Chi-square, normal, t and F tails are one integral.  On the log scale the density
of a gamma variable is ``exp(a v - e^v)`` and that of a ratio of two such variables
``e^(a v) / (1 + e^v)^(a + b)``, up to a constant; chi-square and z^2 are the first
kind, F and t^2 the second.  With T the area right of the statistic and H the area
left of it, the tail probability is ``1 / (1 + H / T)``: the constant cancels, so no
gamma function is needed.

Both areas are taken relative to the density at the statistic and start there, so
small tails keep their relative accuracy.  The distance from the statistic is
``s = exp(u - exp(-u))``, which covers every scale of decay with evenly spaced u.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# steps a unit of u, and the range of u: s from about 1e-25 to 400
STEPS, FIRST, LAST = 64, -4, 6


def _share_right(a: Column, b: Column, y: Column, rest: Column) -> Column:
    """Share of the density right of the statistic.

    ``b`` null: gamma kind, ``y`` = e^v.  Else ratio kind, ``y`` = e^v / (1 + e^v) and
    ``rest`` = 1 - ``y``, given apart because it may be tiny."""
    def density(s: Column) -> Column:  # at distance s from the statistic, relative to the density there
        ratio = F.when(y < 0.5, F.log1p(y * F.expm1(s))).otherwise(F.log(rest + y * F.exp(s)))
        return F.exp(a * s - F.when(b.isNull(), y * F.expm1(s)).otherwise((a + b) * ratio))

    def step(areas: Column, i: Column) -> Column:
        u = i / F.lit(float(STEPS))
        s = F.exp(u - F.exp(-u))
        width = s * (F.exp(-u) + 1.0)
        return F.struct((areas["right"] + width * density(s)).alias("right"), (areas["left"] + width * density(-s)).alias("left"))

    return F.aggregate(F.sequence(F.lit(FIRST * STEPS), F.lit(LAST * STEPS)),
                       F.struct(F.lit(0.0).alias("right"), F.lit(0.0).alias("left")), step,
                       lambda areas: 1.0 / (1.0 + areas["left"] / areas["right"]))


def p_value(dist: Column | str, stat: Column | str, df1: Column | str | None = None,
            df2: Column | str | None = None) -> Column:
    """Tail probability for a statistic column.

    ``dist``: ``chi2`` (df1), ``norm2`` (two-sided z), ``norm1`` (upper z),
    ``t2`` (two-sided t, df1), ``f`` (df1, df2).  Null where the statistic or a
    needed degree of freedom is null, NaN, or not above zero (degrees)."""
    def number(x):
        x = F.lit(None) if x is None else F.col(x) if isinstance(x, str) else x
        return F.nanvl(x.cast("double"), F.lit(None).cast("double"))

    kind = F.lit(dist) if isinstance(dist, str) and dist in ("chi2", "norm2", "norm1", "t2", "f") else (
        F.col(dist) if isinstance(dist, str) else dist)
    x, d1, d2 = number(stat), number(df1), number(df2)
    normal, squared = kind.isin("norm1", "norm2"), kind.isin("norm1", "norm2", "t2")
    # degrees of the two kinds: a z or t squared has one in the numerator
    top = F.when(squared, F.lit(1.0)).when(d1 > 0, d1)
    under = F.when(kind == "t2", d1).when(kind == "f", d2)
    under = F.when(under > 0, under)
    ratio_kind = kind.isin("t2", "f")
    size = F.when(squared, x * x).otherwise(x)
    scaled = F.when(ratio_kind, top * size).otherwise(size / 2.0)  # the gamma kind's e^v is half a chi-square
    y = F.when(ratio_kind, scaled / (scaled + under)).otherwise(scaled)
    share = _share_right(top / 2.0, under / 2.0, y, under / (scaled + under))
    infinite = scaled == float("inf")
    whole = F.when(size <= 0, 1.0).when(infinite, 0.0).otherwise(share)
    known = x.isNotNull() & top.isNotNull() & (~ratio_kind | under.isNotNull()) & (normal | ratio_kind | (kind == "chi2"))
    one_sided = F.when(x > 0, whole / 2.0).otherwise(1.0 - whole / 2.0)
    return F.when(known, F.when(kind == "norm1", one_sided).otherwise(whole))
