"""Output contract of a registered query: column names, order and types.

Both engines' results pass through the same cast and rounding, so that integer
widths and the last bits of floating sums cannot decide a comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame

from churnpanel.functions.exprs import rounded

# Decimal places kept: general doubles, large sums of price ratios (whose sixth
# decimal is at the edge of double precision), and small exact decimals.
DIGITS = {"d": 6, "m": 3, "e": 10}


def columns(spec: str) -> list[tuple[str, str]]:
    """``"l acc_id day; d playtime; s server"`` → [(name, kind), ...]."""
    out = []
    for group in spec.split(";"):
        words = group.split()
        if words:
            out += [(name, words[0]) for name in words[1:]]
    return out


def shape_frame(df: DataFrame, spec: str) -> DataFrame:
    kinds = {
        "l": "cast({c} as bigint) as {c}",
        "s": "cast({c} as string) as {c}",
        **{k: f"{rounded('cast({c} as double)', n)} + 0D as {{c}}" for k, n in DIGITS.items()},
    }
    return df.selectExpr(*[kinds[k].format(c=c) for c, k in columns(spec)])


def shape_sql(body: str, spec: str) -> str:
    kinds = {
        "l": 'cast("{c}" as bigint) as "{c}"',
        "s": 'cast("{c}" as varchar) as "{c}"',
        **{k: f'round(cast("{{c}}" as double), {n}) + 0.0 as "{{c}}"' for k, n in DIGITS.items()},
    }
    picks = ", ".join(kinds[k].format(c=c) for c, k in columns(spec))
    return f"select {picks} from ({body}) as result"
