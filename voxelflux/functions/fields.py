"""Pointwise expressions on fields. All of them are built-in Column operations, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

AXES = ("x", "y", "z")
QUADRANTS = ("Q1", "Q2", "Q3", "Q4")
REGIMES = (0, 1, 2, 3, 4)
TINY = 1e-30


def wide(c: Column | str) -> Column:
    """Fields are stored as float; every reduction runs in double."""
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def rounded(c: Column, digits: int) -> Column:
    """Rounded, and without a negative zero."""
    r = F.round(c, digits)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)


def finite(c: Column | str) -> Column:
    v = wide(c)
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))


def guarded(c: Column | str, name: str) -> Column:
    """The value, or an error that ends the query if it is null, NaN or infinite.

    NaN counts as greater than any number in Spark, so a class by sign would take it in silently.
    """
    v = F.col(c) if isinstance(c, str) else c
    return F.when(finite(v), v).otherwise(F.raise_error(F.lit(f"{name} holds a value that is not finite")).cast("double"))


def quadrant(full: Column, resolved: Column) -> Column:
    """Q1 to Q4 by the signs of both works; zero (and -0.0) belongs to the nonnegative side."""
    return (
        F.when((full >= 0) & (resolved >= 0), "Q1").when((full >= 0) & (resolved < 0), "Q2")
        .when((full < 0) & (resolved >= 0), "Q3").otherwise("Q4")
    )


def regime(full: Column, resolved: Column, eps_full: Column, eps_resolved: Column) -> Column:
    """1 to 4 where both works are beyond their thresholds, else 0 (uncertain)."""
    up_f, down_f, up_r, down_r = full > eps_full, full < -eps_full, resolved > eps_resolved, resolved < -eps_resolved
    return F.when(up_f & up_r, 1).when(up_f & down_r, 2).when(down_f & up_r, 3).when(down_f & down_r, 4).otherwise(0)


def sign_class(v: Column) -> Column:
    return F.when(v > 0, "positive").when(v < 0, "negative").otherwise("zero")


def identity_residual(full: Column, resolved: Column, pi: Column, s_bar: Column) -> Column:
    """What is left of work_full = work_resolved - pi + s_bar."""
    return full - resolved + pi - s_bar


def ratio(num: Column, den: Column) -> Column:
    """num / den; 0 for 0 / 0 and null if only the denominator is 0."""
    return F.when(den != 0, F.try_divide(num, den)).when(num == 0, F.lit(0.0))


def symlog(v: Column, threshold: float) -> Column:
    if not threshold > 0:
        raise ValueError("the linear threshold must be positive")
    return F.signum(v) * F.log1p(F.abs(v) / F.lit(threshold))


def coordinate(index: Column, n: int, length: float) -> Column:
    inside = (index >= 0) & (index < n)
    return F.when(inside, index.cast("double") * F.lit(length) / F.lit(n)).otherwise(F.raise_error(F.lit("grid index out of range")).cast("double"))


def physical_time(time_index: Column, step: float = 0.002) -> Column:
    return F.when(time_index >= 1, (time_index - 1).cast("double") * F.lit(step)).otherwise(F.raise_error(F.lit("time_index starts at 1")).cast("double"))


def tile_key(x0: Column, y0: Column, z0: Column) -> Column:
    return F.format_string("x%04d_y%04d_z%04d", x0.cast("int"), y0.cast("int"), z0.cast("int"))


def api_range(start: Column, size: Column) -> Column:
    """One-based closed range of a zero-based half-open one."""
    return F.array(start + 1, start + size)


def sigma_tag(sigma: float) -> str:
    return f"{sigma:.8g}".replace("-", "m").replace(".", "p")


def tag(v: Column) -> Column:
    """sigma_tag() of a column of finite numbers: eight digits without trailing zeros, `-` as m and `.` as p."""
    text = F.format_string("%.7e", v.cast("double"))
    power = F.regexp_extract(text, r"e([+-]\d+)$", 1).cast("int")
    digits = F.regexp_replace(F.regexp_extract(text, r"^(-?[\d.]+)e", 1), r"\.?0+$", "")
    plain = F.regexp_replace(text.cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    short = F.when((power >= -4) & (power < 8), plain).otherwise(F.concat(digits, F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.format_string("%02d", F.abs(power))))
    return F.translate(short, "-.", "mp")


def result_name(time_index: Column, sigma: Column) -> Column:
    return F.concat(F.format_string("t%06d_sigma_", time_index.cast("int")), tag(sigma))


def hours_left(now: Column, expires: Column) -> Column:
    """Hours from one time to the other, 0 if it has passed."""
    return F.greatest(F.lit(0.0), (F.unix_micros(expires) - F.unix_micros(now)) / 3.6e9)


def redacted(text: Column, secret: str) -> Column:
    """text without a secret, which error messages may repeat."""
    return F.replace(text, F.lit(secret), F.lit("***")) if secret else text


def scientific(v: Column, missing: str = "undefined") -> Column:
    return F.when(v.isNull(), F.lit(missing)).otherwise(F.format_string("%.6e", v))


def dot(left: Sequence[Column], right: Sequence[Column]) -> Column:
    total = left[0] * right[0]
    for a, b in zip(left[1:], right[1:], strict=True):
        total = total + a * b
    return total
