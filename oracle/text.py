"""Small helpers for writing the checking SQL."""

from __future__ import annotations


def out(table: str, spec: str, where: str = "") -> str:
    """Final select.  ``name:i`` is an integer, ``:m`` a number as double, ``:d`` a day, ``:t`` a time."""
    forms = {
        "i": "cast({c} as bigint) as {c}",
        "m": "cast({c} as double) as {c}",
        "d": "strftime({c}, '%Y-%m-%d') as {c}",
        "t": "strftime({c}, '%Y-%m-%d %H:%M:%S') as {c}",
        "s": "{c}",
    }
    cols = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        cols.append(forms[kind or "s"].format(c=name))
    return f"select {', '.join(cols)} from {table}{' ' + where if where else ''}"


def half_up(num: str, den: str, digits: int) -> str:
    """``num / den`` of whole numbers, rounded half away from zero, in integer arithmetic."""
    n, d, p = f"cast(({num}) as hugeint)", f"cast(({den}) as hugeint)", 10**digits
    return (
        f"(case when ({d}) = 0 then null else "
        f"cast(sign({n}) * ((2 * abs({n}) * {p} + ({d})) // (2 * ({d}))) as double) / {p} end)"
    )


def units(col: str, digits: int = 4) -> str:
    """A decimal amount as a whole number of its smallest unit."""
    return f"cast(({col}) * {10**digits} as hugeint)"


def pct(num: str, den: str) -> str:
    return f"(case when ({den}) > 0 then {half_up(f'({num}) * 100', den, 2)} else 0.0::double end)"
