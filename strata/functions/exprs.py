"""Expression builders shared by the operators."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Fixed text form of a timestamp inside surrogate keys: session-zone free,
# microsecond precision.
TS_TEXT_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# Bound of either side of a quotient of 64-bit integers.
_LONG_HALF = 4 * 10 ** 18


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts) -> Column:
    """``md5(p1 || '|' || p2 ...)``; NULL in any part gives a NULL key."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit("|"))
        pieces.append(_col(p).cast("string"))
    return F.md5(F.concat(*pieces))


def ts_text(c) -> Column:
    return F.date_format(_col(c), TS_TEXT_PATTERN)


def blank_to_null(c) -> Column:
    """``nullif(c, '')``: blank text becomes NULL before a cast."""
    return F.nullif(_col(c), F.lit(""))


def utc_date(c) -> Column:
    """Business date of a timestamp (the session runs in UTC)."""
    return F.to_date(_col(c))


def _lit_bound(v):
    if isinstance(v, str):
        return F.to_date(F.lit(v))
    if isinstance(v, (_dt.date, _dt.datetime)):
        return F.lit(v)
    return v if isinstance(v, Column) else F.lit(v)


def in_window(c, start, end) -> Column:
    """Half-open window ``start <= c < end``."""
    col = _col(c)
    return (col >= _lit_bound(start)) & (col < _lit_bound(end))


def classify_prefix(c, pattern: str, known: Iterable[str], default: str) -> Column:
    """Capture group 1 of ``pattern`` when it is a known name, else ``default``.

    NULL input gives ``default`` (the capture of NULL is NULL, not known)."""
    prefix = F.regexp_extract(_col(c), pattern, 1)
    return F.when(prefix.isin(sorted(set(known))), prefix).otherwise(F.lit(default))


def band_key(c, bands: Sequence[tuple], key_type: str | DataType = "int") -> Column:
    """CASE chain ``lo <= c < hi -> key`` over non-overlapping bands.

    ``bands`` holds ``(key, lo, hi)`` tuples; values in no band give NULL.
    One codegen'd expression instead of a nested-loop join."""
    col = _col(c)
    expr = None
    for key, lo, hi in bands:
        cond = (col >= F.lit(lo)) & (col < F.lit(hi))
        expr = F.when(cond, F.lit(key)) if expr is None else expr.when(cond, F.lit(key))
    return expr.cast(key_type) if expr is not None else F.lit(None).cast(key_type)


def first_failing_rule(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule whose *failure* condition is true, else NULL.

    Conditions must be null-safe (``coalesce(cond, true)`` style) so a row is
    tagged exactly once."""
    expr = None
    for name, failed in rules:
        expr = F.when(failed, F.lit(name)) if expr is None else expr.when(failed, F.lit(name))
    return expr if expr is not None else F.lit(None).cast("string")


def row_text(cols: Sequence[str]) -> Column:
    """Canonical text of a row: each column as ``<length>:<text>``, NULL as
    ``N``, so different rows never have one text. Used for checksums that must
    not depend on order."""
    text = lambda c: F.col(c).cast("string")
    return F.concat(F.lit(""), *[F.coalesce(F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("N"))
                                 for c in cols])


def row_digest(cols: Sequence[str]) -> Column:
    """First 60 bits of ``md5(row_text)`` as a decimal, summable exactly.

    A sum of per-row digests plus a row count is an order-insensitive,
    multiset-sensitive checksum that aggregates partially on every executor
    (equal rows add up instead of cancelling as with xor)."""
    return F.conv(F.substring(F.md5(row_text(cols)), 1, 15), 16, 10).cast("decimal(38,0)")


def half_up_ratio(num: str, den: str, num_scale: int, out_scale: int) -> Column:
    """``round(num / den, out_scale)`` with HALF_UP (away from zero), exact.

    ``num`` names a decimal column of scale ``num_scale`` (for instance a sum),
    ``den`` a positive integer column (a count). The quotient is formed by
    integer division on unscaled values, so no intermediate rounding can push
    a value across a .5 boundary, however large the count. NULL when
    ``den`` is 0 or ``num`` is NULL."""
    ns, ks = 10 ** num_scale, 10 ** out_scale
    quotient = lambda n, d: f"((2 * abs({n}) * {ks} + {d}) div (2 * {d}))"
    unscaled = f"CAST(`{num}` * {ns} AS DECIMAL(38,0))"
    mag = quotient(unscaled, f"(CAST(`{den}` AS DECIMAL(38,0)) * {ns})")
    q = f"(CASE WHEN {unscaled} < 0 THEN -{mag} ELSE {mag} END)"
    wide = f"CAST(CAST({q} AS DECIMAL(38,0)) / {ks} AS DECIMAL(18,{out_scale}))"
    # Where no step passes 64 bits the same integers are plain longs: a decimal division costs microseconds a row.
    most = _LONG_HALF // (2 * ks * ns)
    small = quotient("__n", f"(CAST(`{den}` AS BIGINT) * {ns}L)").replace(
        "__n", f"CAST(CAST(`{num}` AS DECIMAL(18,{num_scale})) * {ns} AS BIGINT)")
    near = (f"CAST(CAST((CASE WHEN `{num}` < 0 THEN -{small} ELSE {small} END) AS DECIMAL(20,0)) "
            f"* CAST('{Decimal(1).scaleb(-out_scale):f}' AS DECIMAL({out_scale + 1},{out_scale})) AS DECIMAL(18,{out_scale}))")
    expr = (f"CASE WHEN `{den}` IS NULL OR `{den}` = 0 OR `{num}` IS NULL THEN NULL "
            f"WHEN `{den}` BETWEEN 1 AND {_LONG_HALF // (2 * ns)} AND `{num}` BETWEEN -{most} AND {most} THEN {near} "
            f"ELSE {wide} END")
    return F.expr(expr)
