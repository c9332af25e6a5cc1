"""Equal-width binning and min-max scaling. Fitting collects only one min and max per column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ranges(cols: Sequence[str], *dfs: DataFrame) -> dict[str, tuple[float, float]]:
    """min and max of every column over all given tables, in one pass per table."""
    found: dict[str, tuple[float, float]] = {}
    if not cols:
        return found
    for df in dfs:
        row = df.agg(
            *[F.min(f"`{c}`").cast("double").alias(f"lo_{i}") for i, c in enumerate(cols)],
            *[F.max(f"`{c}`").cast("double").alias(f"hi_{i}") for i, c in enumerate(cols)],
        ).first()
        for i, c in enumerate(cols):
            lo, hi = row[f"lo_{i}"], row[f"hi_{i}"]
            if lo is None:
                continue
            if c in found:
                lo, hi = min(lo, found[c][0]), max(hi, found[c][1])
            found[c] = (lo, hi)
    return found


def bin_edges(lo: float, hi: float, n: int) -> list[float]:
    """n + 1 evenly spaced edges; a constant column gets a range 0.1 % wider on both sides."""
    if lo == hi:
        slack = 0.001 * abs(lo) if lo != 0 else 0.001
        lo, hi = lo - slack, hi + slack
    step = (hi - lo) / n
    return [lo + i * step for i in range(n)] + [hi]


def bin_number(c: str, edges: list[float]) -> Column:
    """Right-closed bin of a value; the lowest value falls in bin 0.

    The bin is guessed by one division, then moved by at most one after comparing with the true edges, so the cost
    per row does not grow with the number of bins.
    """
    n = len(edges) - 1
    x = F.col(f"`{c}`").cast("double")
    step = (edges[-1] - edges[0]) / n
    guess = F.least(F.greatest(F.ceil((x - edges[0]) / step).cast("int") - 1, F.lit(0)), F.lit(n - 1))
    grid = F.lit(edges)
    up = ((x > grid[guess + 1]) & (guess < n - 1)).cast("int")
    down = ((x <= grid[guess]) & (guess > 0)).cast("int")
    return guess + up - down


@dataclass
class EqualWidthBinner:
    """Replace columns by their equal-width bin number. Pass every table to fit on (train, or train and test)."""

    cols: Sequence[str]
    n: int = 50
    edges: dict[str, list[float]] = field(default_factory=dict)

    def fit(self, *dfs: DataFrame | None) -> EqualWidthBinner:
        tables = [df for df in dfs if df is not None]
        self.edges = {c: bin_edges(lo, hi, self.n) for c, (lo, hi) in ranges(self.cols, *tables).items()}
        return self

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns({c + suffix: bin_number(c, e) for c, e in self.edges.items()})


@dataclass
class MinMax:
    """Scale columns to [0, 1] by the fitted range; a constant column becomes 0 where it equals the fitted value."""

    cols: Sequence[str]
    range: dict[str, tuple[float, float]] = field(default_factory=dict)

    def fit(self, *dfs: DataFrame) -> MinMax:
        self.range = ranges(self.cols, *dfs)
        return self

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        out = {}
        for c, (lo, hi) in self.range.items():
            width = hi - lo if hi != lo else 1.0
            out[c + suffix] = (F.col(f"`{c}`").cast("double") - lo) / width
        return df.withColumns(out)
