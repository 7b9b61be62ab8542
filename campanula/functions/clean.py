"""Column-level cleaning expressions (CLN-01 .. CLN-26).

All functions take and return ``Column`` objects built from JVM-side
built-ins, so they fuse into whole-stage codegen.  Nothing here calls
Python per row.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's cleaning rules) --------------
TRUTHY = ("yes", "true", "1", "1.0")
TRUTHY_WIDE = ("1", "true", "yes", "y", "t")
GENDER_MAP = {"m": "male", "f": "female", "male": "male", "female": "female"}
REGION_MAP = {
    "sw": "south west", "nw": "north west", "se": "south east", "ne": "north east",
    "south west": "south west", "north west": "north west",
    "south east": "south east", "north east": "north east",
    "south": "south", "north": "north", "east": "east", "west": "west",
}
# labels that occur in the exports but stay unmapped in the rules above
REGION_MAP |= {"south-west": "south west", "s/south": "south", "s/s": "south", "n central": "north central",
               "north cntrl": "north central", "north c.": "north central"}
DEVICE_MAP = {"phone": "mobile", "tab": "tablet"}
TARGET_REGION_MAP = {**REGION_MAP, "all": "nationwide", "nationwide": "nationwide"}
CHANNEL_MAP = {"e-mail": "email", "paid-social": "paid social", "influencers": "influencer"}
CATEGORY_MAP = {"baby care": "baby", "personal-care": "personal care", "beverage": "beverages"}
# Mixed-format date parsing order: month-first wins when ambiguous.
DATE_FORMATS = (
    "yyyy-MM-dd", "yyyy/MM/dd", "MM-dd-yyyy", "MM/dd/yyyy", "dd/MM/yyyy",
    "dd-MM-yyyy", "MMM dd, yyyy", "MMM d, yyyy", "yyyy-MM-dd HH:mm:ss",
)
CURRENCY_TOKENS = ("$", ",", "USD")
PERCENT_TOKENS = ("%", "percent")
# -----------------------------------------------------------------------------

# A plain decimal number, optionally signed, optionally in exponent form.
# Spark's cast accepts suffixes like ``12f``/``12d`` that Python and SQL
# engines reject, so casting is gated on this pattern.
NUMERIC_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_tokens(s: Column, tokens: Sequence[str]) -> Column:
    """Remove each literal token in turn (plain replace, no regex)."""
    for t in tokens:
        s = F.replace(s, F.lit(t), F.lit(""))
    return s


def to_number(c, strip: Sequence[str] = ()) -> Column:
    """CLN-07: text -> double, anything unparseable -> null (never NaN).
    ``strip`` lists literal tokens removed first, in order."""
    s = F.trim(strip_tokens(_col(c).cast("string"), strip))
    return F.when(s.rlike(NUMERIC_RE), s.try_cast("double"))


def clean_currency(c) -> Column:
    """CLN-01/02: remove ``$``, ``,`` and ``USD`` (in that order); keep the sign."""
    return to_number(c, CURRENCY_TOKENS)


def clean_percent(c) -> Column:
    """CLN-03/04: percent text in points; ``15``, ``15%``, ``15 percent``."""
    return to_number(F.lower(_col(c).cast("string")), PERCENT_TOKENS)


def parse_bool(c, truthy: Sequence[str] = TRUTHY) -> Column:
    """CLN-05/06: membership in the truth set; null and anything else -> false."""
    return F.coalesce(F.lower(F.trim(_col(c).cast("string"))).isin(list(truthy)), F.lit(False))


def parse_flag(c) -> Column:
    """CLN-06: 1 for the wider truth set; any other number is cut to its whole
    part (``1.0`` is 1, ``0.9`` is 0, ``2`` is 2); null, prose and numbers
    beyond 64 bits are 0."""
    s = F.lower(F.trim(_col(c).cast("string")))
    return F.when(s.isin(list(TRUTHY_WIDE)), F.lit(1).cast("bigint")).otherwise(F.coalesce(to_number(s).try_cast("bigint"), F.lit(0).cast("bigint")))


def date_shape(fmt: str) -> str:
    """Anchored regex covering every string a (fixed-width) Spark date
    pattern can parse: ``yyyy`` 4 digits, ``MM``/``dd``/``HH``/``mm``/``ss``
    2 digits, ``d`` 1-2 digits, ``MMM`` a 3-letter month.  Months, days and
    times out of range have no shape: a parser that meets one (``31/12/1995``
    read month first) raises an exception, which costs as much as ten parses."""
    parts = {"yyyy": "[0-9]{4}", "MMM": "[A-Za-z]{3}", "MM": "(?:0[1-9]|1[0-2])", "dd": "(?:0[1-9]|[12][0-9]|3[01])",
             "d": "(?:0?[1-9]|[12][0-9]|3[01])", "HH": "(?:[01][0-9]|2[0-3])", "mm": "[0-5][0-9]", "ss": "[0-5][0-9]"}
    return "^" + re.sub("yyyy|MMM|MM|dd|d|HH|mm|ss|[/.]", lambda m: parts.get(m.group(), "\\" + m.group()), fmt) + "$"


def parse_date(c, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """CLN-08/09: first format that parses wins; unparseable -> null. Returns DATE.

    Same result as ``coalesce(try_to_timestamp(s, f) for f in formats)``, but
    a format is only attempted when the string has its shape (a cheap regex
    test), so the common case is one successful parse instead of several
    failing ones.
    """
    s = F.trim(_col(c).cast("string"))
    return F.coalesce(*[F.when(s.rlike(date_shape(f)), F.to_date(F.try_to_timestamp(s, F.lit(f))))
                        for f in formats])


def norm_label(c) -> Column:
    """CLN-10: lower + trim."""
    return F.lower(F.trim(_col(c)))


def map_label(c, mapping: Mapping[str, str], normalise: bool = True) -> Column:
    """CLN-11: synonym map after normalising; unmapped values pass through."""
    base = norm_label(c) if normalise else _col(c)
    if not mapping:
        return base
    expr = None
    for k, v in mapping.items():
        expr = (F.when(base == k, F.lit(v)) if expr is None else expr.when(base == k, F.lit(v)))
    return expr.otherwise(base)


def null_if(c, predicate: Column) -> Column:
    """CLN-12: value where the predicate is not true, else null."""
    return F.when(F.coalesce(predicate, F.lit(False)), F.lit(None)).otherwise(_col(c))


def days_between(end, start) -> Column:
    """CLN-14: whole elapsed days (floor), negative spans floor down.

    Dates (values at midnight) use calendar days, which is exact in any
    session time zone (a DST change makes a local day 23 or 25 hours);
    values with a time of day use the floor of the elapsed instant.
    """
    e, s = _col(end), _col(start)
    et, st = e.cast("timestamp"), s.cast("timestamp")

    def midnight(t):
        return (F.hour(t) == 0) & (F.minute(t) == 0) & (F.second(t) == 0)

    secs = F.unix_timestamp(et) - F.unix_timestamp(st)
    return (F.when(midnight(et) & midnight(st), F.datediff(et, st))
            .otherwise(F.floor(secs / F.lit(86400)))).cast("bigint")


def fill_median(df, cols):
    """CLN-16: replace nulls by the column's exact global median (each median
    a scalar subquery, evaluated once)."""
    from campanula.operators.ranks import quantile
    out = df
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), quantile(df, c, 0.5)))
    return out


def money_sum(c) -> Column:
    """Exact sum of cent-valued amounts (DECIMAL accumulation, returned as
    double): independent of partitioning and summation order, so ties in
    later rank statistics do not depend on the physical plan."""
    return F.sum(_col(c).cast("decimal(20,2)")).cast("double")


def safe_div(a, b) -> Column:
    """CLN-17: a / b, null when b is zero or null."""
    return F.try_divide(_col(a).cast("double"), F.nullif(_col(b).cast("double"), F.lit(0.0)))


def safe_div0(a, b) -> Column:
    """CLN-18: a / b when b > 0, else 0."""
    bb = _col(b).cast("double")
    return F.when(F.coalesce(bb > 0, F.lit(False)), _col(a).cast("double") / bb).otherwise(F.lit(0.0))


def cut(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """CLN-19: right-closed intervals ``(lo, hi]``; out of range -> null."""
    assert len(labels) == len(edges) - 1
    x = _col(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def clip(c, lo=None, hi=None) -> Column:
    """CLN-20: bound a value; nulls stay null."""
    x = _col(c)
    if lo is not None:
        lo_c = lo if isinstance(lo, Column) else F.lit(lo)
        x = F.when(x.isNull(), x).otherwise(F.greatest(x, lo_c))
    if hi is not None:
        hi_c = hi if isinstance(hi, Column) else F.lit(hi)
        x = F.when(x.isNull(), x).otherwise(F.least(x, hi_c))
    return x


def engagement_score(checkout="checkout_started", cart="add_to_cart",
                     pages="pages_viewed", bounce="bounce") -> Column:
    """CLN-21: 3*checkout + 2*cart + coalesce(pages, 0)/10 - bounce."""
    return (_col(checkout).cast("int") * 3 + _col(cart).cast("int") * 2
            + F.coalesce(_col(pages), F.lit(0.0)) / 10.0 - _col(bounce).cast("int"))


def rfm_tier(r="R_score", f="F_score", m="M_score") -> Column:
    """CLN-22: first matching rule wins; any missing score -> No Orders."""
    r, f, m = _col(r), _col(f), _col(m)
    return (F.when(r.isNull() | f.isNull() | m.isNull(), "No Orders")
            .when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
            .when((r <= 2) & (f >= 4), "At Risk")
            .when((r <= 2) & (f <= 2), "Lost Causes")
            .when((r >= 4) & (f <= 2), "New Customers")
            .otherwise("Average"))


def band(c, thresholds: Sequence[float], labels: Sequence[str], strict: bool = True) -> Column:
    """CLN-23: descending threshold bands, e.g. quality >90 / >70 / else."""
    x = _col(c)
    expr = None
    for t, lab in zip(thresholds, labels):
        cond = (x > F.lit(t)) if strict else (x >= F.lit(t))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(labels[len(thresholds)]))


def stars(p) -> Column:
    """CLN-23 / STA-09: significance stars from a p-value."""
    p = _col(p)
    return (F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*")
            .otherwise("ns"))


def month_diff(a, b) -> Column:
    """CLN-25: whole months between the months of two dates."""
    a_, b_ = _col(a), _col(b)
    return ((F.year(a_) - F.year(b_)) * 12 + (F.month(a_) - F.month(b_))).cast("bigint")


def flag(pred: Column) -> Column:
    """CLN-26: a null-safe 0/1 indicator."""
    return F.coalesce(pred, F.lit(False)).cast("int")


def all_of(preds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds)
