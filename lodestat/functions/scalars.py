"""Numeric column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(text: Column) -> Column:
    """"$1,234.50" or "12.5%" as a number; null where it is none."""
    return F.regexp_replace(text, "[$,%]", "").try_cast("double")


def signed_hex_tail(text: Column, digits: int = 16) -> Column:
    """The last hex digits as a signed 64-bit number (wraps)."""
    return F.conv(F.right(text, F.lit(digits)), 16, -10).cast("long")


def percent_text(value: Column, decimals: int = 2) -> Column:
    return F.format_string(f"%.{decimals}f%%", value * 100)


def powers(columns: Sequence[str]) -> dict[str, Column]:
    out = {}
    for c in columns:
        out[f"{c}_squared"] = F.col(c) * F.col(c)
        out[f"{c}_cubed"] = F.col(c) * F.col(c) * F.col(c)
        out[f"{c}_sqrt"] = F.sqrt(c)
    return out


def row_reductions(columns: Sequence[str], prefix: str = "row") -> dict[str, Column]:
    """Product, sum, median, maximum and sample deviation over a list of columns, per row."""
    cols = [F.col(c) for c in columns]
    n = len(cols)
    total = reduce(lambda a, b: a + b, cols)
    mean = total / n
    ordered = F.array_sort(F.array(*cols))
    median = (F.get(ordered, F.lit((n - 1) // 2)) + F.get(ordered, F.lit(n // 2))) / 2
    squares = reduce(lambda a, b: a + b, [(c - mean) * (c - mean) for c in cols])
    return {
        f"{prefix}_product": reduce(lambda a, b: a * b, cols),
        f"{prefix}_sum": total,
        f"{prefix}_median": median,
        f"{prefix}_max": F.greatest(*cols),
        f"{prefix}_std": F.sqrt(squares / (n - 1)),
    }


OPERATIONS = {"add": lambda a, b: a + b, "sub": lambda a, b: a - b, "mul": lambda a, b: a * b}


def interactions(columns: Sequence[str]) -> dict[str, Column]:
    """Sums, differences and products of all column pairs, and a op (b op c) of all triplets."""
    out = {}
    for name, op in OPERATIONS.items():
        for a, b in combinations(columns, 2):
            out[f"{a}_{name}_{b}"] = op(F.col(a), F.col(b))
        for a, b, c in combinations(columns, 3):
            out[f"{a}_{name}_{b}_{name}_{c}"] = op(F.col(a), op(F.col(b), F.col(c)))
    return out


def monomials(columns: Sequence[str], degree: int) -> dict[str, Column]:
    """All products of the columns of total degree 1..degree."""
    out = {}
    for d in range(1, degree + 1):
        for combo in combinations_with_replacement(columns, d):
            out["_x_".join(combo)] = reduce(lambda a, b: a * b, [F.col(c) for c in combo])
    return out


def sigmoid(z: Column) -> Column:
    """Logistic function without overflow on either side."""
    e = F.exp(-F.abs(z))
    return F.when(z >= 0, 1 / (1 + e)).otherwise(e / (1 + e))


def softplus(z: Column) -> Column:
    """log(1 + exp z), stable."""
    return F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))


def box_cox(x: Column, lam: float) -> Column:
    return F.log(x) if lam == 0 else (F.pow(x, F.lit(lam)) - 1) / lam


def inverse_box_cox(y: Column, lam: float) -> Column:
    return F.exp(y) if lam == 0 else F.pow(y * lam + 1, F.lit(1 / lam))


def lift(p0: Column, p1: Column, kind: str = "additive") -> Column:
    if kind == "additive":
        return p1 - p0
    if kind == "multiplicative":
        return F.when(F.abs(p0) > 1e-12, (p1 - p0) / p0)
    raise ValueError(f"unknown kind of lift: {kind}")


def argmax_with_value(values: Column) -> Column:
    """Struct (place from 0, value) of the largest member, first on ties."""
    best = F.array_max(values)
    return F.struct((F.array_position(values, best) - 1).cast("int").alias("place"), best.alias("value"))
