"""Column expressions: everything here stays JVM-side (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import PROPERTY_TYPE_LABELS

# FIXED VALUES: the characters with Unicode's White_Space property.  Spark's
# trim() removes spaces only, Java's \s only the ASCII ones.
WHITE_SPACE = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col: Column | str) -> Column:
    """Trim all leading/trailing white space (tabs, newlines, no-break spaces)."""
    return F.btrim(_c(col), F.lit(WHITE_SPACE))


def normalize_key(col: Column | str) -> Column:
    """``upper(trim(x))``: the lookup form of free-text codes (county, postcode)."""
    return F.upper(strip_ws(col))


def parse_txn_date(col: Column | str, strict: bool = True) -> Column:
    """First 10 characters parsed as ``yyyy-MM-dd``.

    ``strict`` raises on a bad value (ANSI, like the reference); otherwise a
    bad value becomes NULL (quarantine mode).
    """
    head = F.left(_c(col), F.lit(10))
    return F.to_date(head, "yyyy-MM-dd") if strict else F.try_to_date(head, "yyyy-MM-dd")


def month_start(col: Column | str) -> Column:
    """``date_trunc(d, month)`` as a DATE (Spark's date_trunc returns TIMESTAMP)."""
    return F.trunc(_c(col), "MM")


def lag_months(col: Column | str, n: int) -> Column:
    """First day of the month ``n`` months before ``col``."""
    return F.trunc(F.add_months(_c(col), -int(n)), "MM")


def safe_divide(a: Column | str, b: Column | str) -> Column:
    """NULL when the divisor is 0 or NULL (plain ``/`` throws under ANSI)."""
    return F.try_divide(_c(a), _c(b))


def property_type_label(col: Column | str) -> Column:
    """D/S/T/F/O -> label; anything else NULL (simple CASE without ELSE)."""
    expr = None
    for code, label in PROPERTY_TYPE_LABELS.items():
        expr = (F.when(_c(col) == code, label) if expr is None
                else expr.when(_c(col) == code, label))
    return expr


def rate_direction(new: Column | str, prev: Column | str) -> Column:
    return (F.when(_c(new) > _c(prev), "hike")
            .when(_c(new) < _c(prev), "cut")
            .otherwise("hold"))


def concat_key(*cols: Column | str) -> Column:
    """``concat(a, '_', b, ...)``: NULL as soon as any part is NULL."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("_"))
        parts.append(_c(c).cast("string"))
    return F.concat(*parts)


def deterministic_id(*cols: Column | str) -> Column:
    """Rerun-safe id: sha256 over ``|``-joined parts (a replay maps to the
    same id).  Doubles are rendered with 6 decimals so the id does not
    depend on float-to-text conventions (the streaming detector uses the
    same form)."""
    return F.sha2(F.concat_ws("|", *[_c(c).cast("string") for c in cols]), 256)


def fixed6(col: Column | str) -> Column:
    """A double as text with 6 decimals (``%.6f``)."""
    return F.format_string("%.6f", _c(col))


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over pairs where both are non-NULL.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI when one side is constant; this
    form returns NULL instead.  Built from mergeable aggregates, so it keeps
    partial aggregation.
    """
    both = _c(x).isNotNull() & _c(y).isNotNull()
    xs = F.when(both, _c(x).cast("double"))
    ys = F.when(both, _c(y).cast("double"))
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))
