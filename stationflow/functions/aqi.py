"""Air-quality index expressions (no UDF; all inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from ..fixed_values import INDEX_BREAKPOINTS, INDEX_CEILING, INDEX_DECIMALS


def sub_index(conc: str, pollutant: str, truncate: bool = False) -> Column:
    """Index of the concentration in column ``conc``, linear inside each breakpoint segment and
    rounded half to even.

    A concentration between two segments has no index unless ``truncate`` first cuts it to
    the number of decimals of the breakpoint table.
    """
    segments = INDEX_BREAKPOINTS[pollutant]
    c = f"CAST(`{conc}` AS DOUBLE)"
    if truncate:
        scale = 10 ** INDEX_DECIMALS[pollutant]
        c = f"(floor({c} * {scale} + 1e-9D) / {scale}D)"
    cases = [
        f"WHEN isnan({c}) THEN NULL",
        f"WHEN {c} > {segments[-1][1]}D THEN {INDEX_CEILING}D",
        f"WHEN {c} < {segments[0][0]}D THEN 0D",
    ]
    for c_low, c_high, i_low, i_high in segments:
        slope = (i_high - i_low) / (c_high - c_low)
        cases.append(f"WHEN {c} BETWEEN {c_low}D AND {c_high}D THEN rint({slope!r}D * ({c} - {c_low}D) + {i_low})")
    return F.expr("CASE " + " ".join(cases) + " END")


def overall_index(columns: Sequence[str]) -> Column:
    """Largest of the given indices, ignoring missing ones."""
    if not columns:
        return F.lit(None).cast("double")
    if len(columns) == 1:
        return F.col(columns[0])
    return F.greatest(*columns)


def nowcast_terms(value: str, window, hours: int = 12) -> Column:
    """The last ``hours`` values of ``window`` as an array, oldest first.

    Read as lags, so no frame is collected. A missing value is marked NaN and thereby told apart
    from "before the start of the series" (NULL).
    """
    marked = F.coalesce(F.col(value), F.lit(float("nan")))
    return F.array(*[marked if k == 0 else F.lag(marked, k).over(window) for k in range(hours - 1, -1, -1)])


def nowcast_weight(top: str, low: str) -> Column:
    """Weight of one hour of age: 1 - range / maximum, at least one half."""
    return F.expr(f"greatest(0.5D, 1 - ({top} - {low}) / nullif({top}, 0D))")


def nowcast_mean(terms: str, weight: str, top: str) -> Column:
    """Mean of ``terms`` weighted by ``weight ** age``; NULL if any value is missing, 0 if all are 0.

    Folding the array keeps the generated code small; written out per hour it outgrows what the
    JVM compiles.
    """
    mean = f"""aggregate({terms}, named_struct('t', 0D, 'n', 0D),
      (a, x) -> named_struct('t', a.t * {weight} + coalesce(x, 0D), 'n', a.n * {weight} + if(x IS NULL, 0D, 1D)),
      a -> a.t / nullif(a.n, 0D))"""
    return F.expr(f"CASE WHEN isnan({top}) THEN NULL WHEN {top} = 0 THEN 0D ELSE {mean} END")
