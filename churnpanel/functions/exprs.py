"""Column expressions.  All of them stay inside whole-stage code generation.

Wide plans repeat a few expressions for many columns; given column names and
conditions as SQL text, those are sent to the JVM in one call each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnpanel.schema import SPEND_SPLIT, SURVIVED


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum0(c) -> Column:
    """Sum that gives 0, not NULL, for a group without values."""
    if isinstance(c, str):
        return F.expr(f"coalesce(cast(sum(`{c}`) as double), 0D)")
    return F.coalesce(F.sum(c).cast("double"), F.lit(0.0))


def sum_if(cond: str, c: str) -> Column:
    return F.expr(f"coalesce(cast(sum(case when {cond} then {c} end) as double), 0D)")


def count_if(cond: str) -> Column:
    return F.expr(f"count_if({cond})")


def ratio(num, den) -> Column:
    """num / den, NULL where the denominator is zero (no inf, no NaN, no error)."""
    return col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def hhmmss(time) -> Column:
    """'HH:MM:SS' as the integer HHMMSS."""
    return F.replace(col(time), F.lit(":"), F.lit("")).cast("int")


def time_bin(time, bins: int = 4, midnight: str = "zero") -> Column:
    """Bin of a trade time.  Intervals are right-closed, so 06:00:00 is in bin 0;
    00:00:00 is in none of them and gives 0 (``"zero"``) or NULL (``"none"``)."""
    width = {4: 60000, 24: 10000}[bins]
    t = hhmmss(time)
    inside = F.when((t > 0) & (t <= 239999), F.floor((t - 1) / width).cast("int"))
    return F.coalesce(inside, F.lit(0)) if midnight == "zero" else inside


def evening_flag(bin4) -> Column:
    """0 for the evening bin, 1 for the other three."""
    return F.when(col(bin4) == 3, 0).when(col(bin4).isNotNull(), 1)


def week_of(day) -> Column:
    return F.ceil(col(day) / 7).cast("int")


def survival_group(survival_time="survival_time") -> Column:
    return F.when(col(survival_time) == SURVIVED, 1).otherwise(0)


def spend_group(amount="amount_spent", split: float = SPEND_SPLIT) -> Column:
    return F.when(col(amount) == 0, 0).when(col(amount) < split, 1).otherwise(2)


def log_or_zero(x) -> Column:
    return F.when(col(x) == 0, F.lit(0.0)).otherwise(F.log(col(x)))


def key_hash(key, seed: int = 0, modulus: int = 1000003) -> Column:
    """Arithmetic hash in [0, modulus), the same in any SQL engine and after any
    repartitioning.  The key is reduced first, so large ids cannot overflow."""
    reduced = F.pmod(col(key).cast("bigint"), F.lit(modulus))
    return F.pmod(reduced * 7919 + seed, F.lit(modulus))


def rounded(x: str, digits: int) -> str:
    """``round(x, digits)`` of a double as SQL text, the same to the last bit.

    Spark rounds by a decimal number made from the value's text.  Where the scaled value is
    below 1e12 and not near the middle of two whole numbers, plain arithmetic finds the same
    whole number; its quotient is the double nearest to the decimal.  Other values (near
    ties, large ones, NaN, NULL) are left to ``round``.  A result of 0 may be -0."""
    scaled = f"({x} * 1e{digits}D)"
    return (f"if(abs({scaled}) < 1e12D and abs({scaled} - rint({scaled})) < 0.499D, "
            f"rint({scaled}) / 1e{digits}D, round({x}, {digits}))")


def unit_scale(x: str, lo: str, hi: str) -> str:
    """(x - lo) / (hi - lo) as SQL text; a constant column gives 0."""
    return f"coalesce(cast({x} - {lo} as double) / nullif(cast({hi} - {lo} as double), 0D), 0D)"


def fixed_bin(x: str, lo: str, hi: str, bins: int) -> str:
    """Equal-width bin number in [0, bins) as SQL text; the maximum falls in the
    last bin."""
    width = f"(({hi} - {lo}) / {bins})"
    raw = f"coalesce(floor(({x} - {lo}) / nullif({width}, 0D)), 0)"
    return f"cast(least({raw}, {bins - 1}) as int)"
