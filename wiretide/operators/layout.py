"""How to cut ordered data so that no task gets a hot flow or a hot moment whole.

Window functions run one task per partition key. With a flow that holds a third
of all packets, or one running sum over the whole table, that is one task with
an unbounded share of the data. A layout says where to cut:

* ``cuts`` split the global (ts_us, packet_id) order into slices of about equal
  size, a single instant that is larger than a slice being split further by
  packet_id;
* ``hot_flows`` lists the flows that are split along those slices too.

The cut points come from a bounded sample, as in Spark's own range partitioning. A table
of more than ``max_slices`` slices is cut again within them: ``inner``, tables with the cuts
of each slice from a larger sample that stays distributed, and ``hot_table`` for its flows.
A row finds its cut as in a search tree, in steps of a few cuts each, however many there are.
They only decide where the work is done: every operator that uses a layout gives
the same rows for any cut points.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiretide.sources.storage import materialize

TIME_ORDER = ("ts_us", "packet_id")
ARRIVAL_ORDER = ("packet_id",)
SAMPLE_ROWS_PER_SLICE = 40
#: Numbers of the inner slices of one slice; up to so many cuts, and flows, in a broadcast table.
INNER, BROADCAST_CUTS = 2**32, 1_000_000
#: Cuts a row is compared with at once.
FAN = 16


@dataclass(frozen=True)
class LayoutOptions:
    """How finely to cut: an input of no more than ``rows_per_slice`` rows is one slice.

    More than ``max_slices`` (2 at least) are not cut at the driver, but within those.
    """

    rows_per_slice: int = 1_000_000
    max_slices: int = 20_000


@dataclass(frozen=True)
class Instant:
    """A single order value with more rows than a slice, split evenly by its tie-breaker."""

    parts: int
    low: int
    width: int


@dataclass(frozen=True)
class Layout:
    order: tuple[str, ...] = TIME_ORDER
    cuts: tuple[int, ...] = ()
    instants: dict[int, Instant] = field(default_factory=dict)
    hot_flows: tuple[int, ...] = ()
    inner: tuple[tuple[int, DataFrame], ...] | None = field(default=None, compare=False)
    hot_table: DataFrame | None = field(default=None, compare=False)
    parts: int = 1

    @property
    def cuts_flows(self) -> bool:
        return bool(self.hot_flows) or self.hot_table is not None

    def top(self) -> Layout:
        """The slices without those within them."""
        return Layout(self.order, self.cuts, self.instants)

    def small(self, table: DataFrame, step: int = 1) -> DataFrame:
        """A table of one row or so per ``step`` slices, marked for a broadcast if the number of slices allows it."""
        return F.broadcast(table) if self.n_slices * self.parts <= BROADCAST_CUTS * step else table

    @property
    def n_slices(self) -> int:
        """Slices, without those within them."""
        return len(self.cuts) + 1 + sum(i.parts - 1 for i in self.instants.values())

    def with_slice(self, df: DataFrame, name: str = "_slice") -> DataFrame:
        """Add the slice number of each row; it never falls along the order."""
        if not self.cuts:
            return df.withColumn(name, F.lit(0))
        bucketizer = Bucketizer(
            splits=[float("-inf"), *map(float, self.cuts), float("inf")],
            inputCol="_position",
            outputCol="_bucket",
            handleInvalid="keep",
        )
        out = bucketizer.transform(df.withColumn("_position", F.col(self.order[0]).cast("double")))
        slice_number = F.col("_bucket").cast("int")
        if self.instants:
            buckets = len(self.cuts) + 1
            parts, low, width = np.ones(buckets, int), np.zeros(buckets, int), np.ones(buckets, int)
            for bucket, instant in self.instants.items():
                parts[bucket], low[bucket], width[bucket] = instant.parts, instant.low, instant.width
            first = np.concatenate([[0], np.cumsum(parts)[:-1]])
            at = F.col("_bucket").cast("int") + 1

            def of_bucket(values):
                return F.element_at(F.lit([int(v) for v in values]), at).cast("bigint")

            past = F.col(self.order[1]) > of_bucket(low)
            step = F.floor((F.col(self.order[1]) - of_bucket(low)) / of_bucket(width))
            inner = F.when(past, F.least(of_bucket(parts) - 1, step)).otherwise(0)
            slice_number = (of_bucket(first) + inner).cast("int")
        out = out.withColumn(name, slice_number).drop("_position", "_bucket")
        if self.inner is None:
            return out
        out = out.withColumn("_within", F.lit(0).cast("bigint"))
        for step, cuts in self.inner:
            out = out.join(self.small(cuts.withColumnRenamed("_top", name), step), [name, "_within"], "left")
            passed = F.size(F.filter("_cuts", lambda cut: cut <= place(self.order)))
            passed = F.when(F.col("_cuts").isNull(), 0).otherwise(passed)
            out = out.withColumn("_within", F.col("_within") * FAN + passed).drop("_cuts")
        return out.withColumn(name, F.col(name).cast("bigint") * INNER + F.col("_within")).drop("_within")

    def with_flow_slice(self, df: DataFrame, name: str = "flow_slice") -> DataFrame:
        """Add the slice number for rows of hot flows and -1 for all others."""
        sliced = self.with_slice(df, name)
        if self.hot_table is not None:
            sliced = sliced.join(self.small(self.hot_table), "flow_hash", "left")
            return sliced.withColumn(name, F.when(F.col("_hot"), F.col(name)).otherwise(-1)).drop("_hot")
        hot = F.col("flow_hash").isin(*self.hot_flows)
        return sliced.withColumn(name, F.when(hot, F.col(name)).otherwise(-1))


def place(order: tuple[str, ...]) -> Column:
    """Where a row stands in the order, as one value."""
    return F.struct(*[F.col(c).cast("bigint").alias(c) for c in order])


def search_steps(inner: DataFrame, most: int) -> tuple[tuple[int, DataFrame], ...]:
    """The cuts (_top, _i, _cut), at most ``most`` in a slice, as the levels of a search tree, the widest steps first.

    A level has, for every stretch of FAN steps, the last cut of each but the last step: those up to
    a row tell its stretch of the next level.
    """
    step = 1
    while step * FAN <= most:
        step *= FAN
    levels = []
    while step >= 1:
        ends, stretch = (F.col("_i") + 1) % step == 0, F.floor(F.col("_i") / (step * FAN)).cast("bigint")
        own = inner.filter(ends & ((F.col("_i") + 1) % (step * FAN) != 0)).groupBy("_top", stretch.alias("_within"))
        levels.append((step, materialize(own.agg(F.collect_list("_cut").alias("_cuts")), "layout-cuts")))
        step //= FAN
    return tuple(levels)


def cut_within(rows: DataFrame, layout: Layout, parts: int, fraction: float) -> Layout:
    """The layout with about ``parts`` slices in each of its own, and the flows larger than two of them.

    Every cut is one in ``SAMPLE_ROWS_PER_SLICE`` sampled rows of its slice, in order; an
    instant is cut by the rest of the order.
    """
    by_flow = "flow_hash" in rows.columns
    columns = [*layout.order, "flow_hash"] if by_flow else list(layout.order)
    sample = materialize(rows.select(*columns).sample(fraction=fraction, seed=11), "layout-sample")
    places = F.array_sort(F.collect_list(place(layout.order)))
    picked = F.filter(places, lambda x, i: (i > 0) & (i % SAMPLE_ROWS_PER_SLICE == 0))
    inner = layout.with_slice(sample, "_top").groupBy("_top").agg(picked.alias("_inner"))
    inner = materialize(inner.select("_top", F.posexplode("_inner").alias("_i", "_cut")), "layout-inner")
    most = inner.agg(F.coalesce(F.max("_i") + 1, F.lit(0))).first()[0]
    hot = None
    if by_flow:
        counts = sample.groupBy("flow_hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 2 * SAMPLE_ROWS_PER_SLICE)
        hot = materialize(counts.select("flow_hash", F.lit(True).alias("_hot")), "layout-hot")
    return replace(layout, hot_flows=(), inner=search_steps(inner, most), hot_table=hot, parts=parts)


def plan_layout(
    rows: DataFrame, order: tuple[str, ...] = TIME_ORDER, options: LayoutOptions = LayoutOptions(), n: int | None = None
) -> Layout:
    """Choose cut points for ``rows``, and hot flows if it has a ``flow_hash`` column.

    Runs a narrow count, unless the number ``n`` is known, and, where there is more than one
    slice, a sample of at most about ``40 * max_slices`` rows of two or three longs. Beyond
    ``max_slices``, a sample of 40 rows a slice is written to the shared folder.
    """
    n = rows.count() if n is None else n
    wanted = -(-n // options.rows_per_slice)
    slices = min(options.max_slices, wanted)
    if slices <= 1:
        return Layout(order)
    by_flow = "flow_hash" in rows.columns
    columns = [*order, "flow_hash"] if by_flow else list(order)
    fraction = min(1.0, SAMPLE_ROWS_PER_SLICE * slices / n)
    sample = rows.select(*columns).sample(fraction=fraction, seed=7).toPandas()
    if sample.empty:
        return Layout(order)

    position = np.sort(sample[order[0]].to_numpy(dtype="int64"))
    picks = position[np.linspace(0, len(position) - 1, slices + 1).astype(int)[1:-1]]
    values, repeats = np.unique(picks, return_counts=True)
    # A value picked again spans whole slices by itself: give it a bucket of its own.
    crowded = values[repeats > 1] if len(order) > 1 else values[:0]
    cuts = np.unique(np.concatenate([values, crowded, crowded + 1]))
    instants = {}
    for value, count in zip(values, repeats):
        if value in crowded:
            ids = sample.loc[sample[order[0]] == value, order[1]].to_numpy(dtype="int64")
            parts = int(count) + 1
            low, high = int(ids.min()), int(ids.max())
            bucket = int(np.searchsorted(cuts, value, side="right"))
            instants[bucket] = Instant(parts, low, (high - low) // parts + 1)

    layout = Layout(order, tuple(int(c) for c in cuts), instants)
    if wanted > slices:
        return cut_within(rows, layout, -(-wanted // slices), min(1.0, SAMPLE_ROWS_PER_SLICE * wanted / n))
    hot = ()
    if by_flow:
        counts = sample["flow_hash"].value_counts()
        limit = 2 * n / slices * fraction
        hot = tuple(int(h) for h in counts.index[counts.to_numpy() >= limit])
    return replace(layout, hot_flows=hot)
