"""Exact running sums over the whole table without a whole-table task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wiretide.operators.layout import INNER, Layout
from wiretide.sources.storage import materialize


def _earlier(totals: DataFrame, names: list[str], by: str, within: list[str], add: str = "") -> DataFrame:
    """Per row, the totals of the rows before it; ``add`` is the prefix of columns that come on top."""
    before = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    sums = {name: F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0)) for name in names}
    return totals.select(by, *[(s + F.col(add + name) if add else s).alias(f"_o_{name}") for name, s in sums.items()])


def _offsets(totals: DataFrame, names: list[str], layout: Layout) -> DataFrame:
    """What all slices before each slice add up to."""
    if layout.inner is None:
        return _earlier(totals, names, "_slice", [])
    totals = totals.withColumn("_top", F.floor(F.col("_slice") / INNER))
    tops = totals.groupBy("_top").agg(*[F.sum(f"_t_{name}").alias(f"_t_{name}") for name in names])
    tops = _earlier(tops, names, "_top", []).withColumnsRenamed({f"_o_{name}": f"_p_{name}" for name in names})
    return _earlier(totals.join(F.broadcast(tops), "_top"), names, "_slice", ["_top"], "_p_")


def running_totals(
    df: DataFrame, measures: Mapping[str, Column], layout: Layout, start: Mapping[str, int] | None = None
) -> DataFrame:
    """Add, for each named bigint expression, its sum over all rows up to and including this one.

    Each slice is summed by itself, the few slice totals are summed in order (at
    most ``layout.n_slices`` rows, a number fixed when the layout was made), and
    the total of all earlier slices is added to the sum within the slice. Slices within
    slices are summed within theirs, and only the totals of these in one order. The sums
    within slices are written once to the shared folder, so what is behind them runs
    once; totals and result are narrow reads of that table.
    """
    start = start or {}
    before = {name: F.lit(int(start.get(name, 0))).cast("bigint") for name in measures}
    work = df.withColumns({f"_m_{name}": column for name, column in measures.items()})
    order = [F.col(c) for c in layout.order]
    running = (Window.partitionBy("_slice") if layout.cuts else Window).orderBy(*order)
    running = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    work = layout.with_slice(work) if layout.cuts else work
    work = work.withColumns({f"_w_{name}": F.sum(f"_m_{name}").over(running) for name in measures})
    if layout.cuts:
        work = materialize(work, "running")
        totals = work.groupBy("_slice").agg(*[F.sum(f"_m_{name}").alias(f"_t_{name}") for name in measures])
        work = work.join(layout.small(_offsets(totals, list(measures), layout)), "_slice")
        before = {name: before[name] + F.col(f"_o_{name}") for name in measures}
    out = work.withColumns({name: (before[name] + F.col(f"_w_{name}")).cast("bigint") for name in measures})
    helpers = ["_slice"] + [f"_{kind}_{name}" for kind in ("m", "w", "o") for name in measures]
    return out.drop(*helpers)
