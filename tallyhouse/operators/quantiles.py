"""Exact quantiles of a whole-number column over any number of rows.

Ranks are located by histograms that get finer: a pass counts the values in equal parts of the
stretches in which a wanted rank still may be, and goes on with the part that holds it, until a part
is a single value. Counting is by group, so a task sends one row per part, and the driver gets at most
``PARTS`` rows for each wanted rank and pass. A range of 2^40 values takes four passes; no task ever
holds the values.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = 1024


def values_at(df: DataFrame, column: str, wanted: list[int], low: int, high: int, parts: int = PARTS) -> dict[int, int]:
    """Rank (from 0, in ascending order) to the value at it. ``low`` and ``high`` bound all values;
    NULLs have no rank."""
    # Stretch of values to the wanted ranks in it, counted from its start.
    stretches = {(low, high): {rank: rank for rank in wanted}}
    found: dict[int, int] = {}
    value = F.col(column)
    while stretches:
        open_, tests, chosen = [], [], F.lit(None).cast("struct<s:int,p:bigint>")
        for (a, b), ranks in stretches.items():
            if a == b:
                found |= dict.fromkeys(ranks, a)
                continue
            step = -(-(b - a + 1) // parts)
            inside = value.between(a, b)
            part = F.struct(F.lit(len(open_)).alias("s"), F.expr(f"({column} - {a}L) DIV {step}L").alias("p"))
            tests.append(inside)
            chosen = F.when(inside, part).otherwise(chosen)
            open_.append((a, b, step, ranks))
        stretches = {}
        if not open_:
            break
        counted = df.where(reduce(or_, tests)).select(chosen.alias("at")).groupBy("at").count()
        counts: dict[int, list[tuple[int, int]]] = {}
        for at, n in counted.collect():
            counts.setdefault(at["s"], []).append((at["p"], n))
        for s, (a, b, step, ranks) in enumerate(open_):
            below = 0
            for p, n in sorted(counts[s]):
                here = {rank: k - below for rank, k in ranks.items() if below <= k < below + n}
                if here:
                    stretches[a + p * step, min(b, a + (p + 1) * step - 1)] = here
                below += n
    return found


def exact_quantiles(df: DataFrame, column: str, shares: list[float], parts: int = PARTS) -> list[Fraction | None]:
    """The quantiles for ``shares``, interpolated between neighbouring values; None without values."""
    low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n:
        return [None] * len(shares)
    places = [Fraction(share) * (n - 1) for share in shares]
    ranks = {int(p) for p in places} | {min(int(p) + 1, n - 1) for p in places}
    at = values_at(df, column, sorted(ranks), low, high, parts)
    return [at[int(p)] + (p - int(p)) * (at[min(int(p) + 1, n - 1)] - at[int(p)]) for p in places]
