"""Open flows of a stream, kept as a log of runs that are read and written by bucket.

A micro-batch writes one run: the new records of the flows it touched, and marks for
those it closed. A run is spread over buckets of the flow hash, the more the larger it is,
and a lookup opens only the buckets that hold a wanted flow. Of several records of a flow
the latest version counts. An index by time tells the buckets in which flows were last
seen in each stretch of time, so that what runs out is found without opening the others.

Runs of like size are merged into one, and all of them once as many rows as the last
full merge held have been added, so the bytes written follow the packets and not the
number of open flows. Merges run beside the micro-batches, in a thread of their own.

A manifest per micro-batch, written last, names the runs that count. A repeated
micro-batch starts from the manifest before its number and so gives the same result;
files are deleted when no kept manifest names them.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wiretide.functions.flowkey import FLOW_KEYS
from wiretide.schemas import MICROS
from wiretide.sources.storage import children, delete, read_text, write_text

log = logging.getLogger(__name__)

KEPT_VERSIONS = 3
#: Buckets at most, a power of two, and rows for which a run gets one more.
MOST_BUCKETS, BUCKET_ROWS = 4_096, 4_096
#: Runs of one size class (each four times the one below) that are merged into one.
MERGED_RUNS = 4
#: Width of a stretch of the time index.
SLOT_US = 5 * MICROS

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("flow_hash", T.LongType()),
        T.StructField("flow_id", T.StringType()),
        T.StructField("session", T.LongType()),
        T.StructField("endpoint_1_ip", T.StringType()),
        T.StructField("endpoint_1_port", T.LongType()),
        T.StructField("endpoint_2_ip", T.StringType()),
        T.StructField("endpoint_2_port", T.LongType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("start_us", T.LongType()),
        T.StructField("last_seen_us", T.LongType()),
        T.StructField("total_packets", T.LongType()),
        T.StructField("total_bytes", T.LongType()),
        T.StructField("connection_state", T.StringType()),
        T.StructField("initiator_ip", T.StringType()),
        T.StructField("duration_us", T.LongType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("avg_packet_size", T.DoubleType()),
        T.StructField("packet_rate", T.DoubleType()),
        T.StructField("byte_rate", T.DoubleType()),
    ]
)
RECORD = RECORD_SCHEMA.fieldNames()
# A record in a run, its micro-batch, and whether its flow is still open.
_STORED = T.StructType([*RECORD_SCHEMA.fields, T.StructField("version", T.LongType()), T.StructField("open", T.BooleanType())])


@dataclass(frozen=True)
class Totals:
    """Sums over everything seen so far."""

    duration_us: int = 0
    flows: int = 0
    latest_us: int = -(2**62)


@dataclass(frozen=True)
class Run:
    """Records in one folder, spread over the buckets that are not empty."""

    path: str
    rows: int
    buckets: int
    filled: tuple[int, ...]


@dataclass(frozen=True)
class Manifest:
    runs: tuple[Run, ...] = ()
    # Per stretch of time the finest buckets in which flows were last seen then. Flows that are
    # open were seen within the timeout, so stretches are few, and buckets at most MOST_BUCKETS.
    index: tuple[tuple[int, tuple[int, ...]], ...] = ()
    totals: Totals = Totals()
    # Rows of the last full merge, and rows added since.
    merged: int = 0
    added: int = 0

    def to_json(self) -> str:
        # A stretch's buckets as the bits of one number: a kilobyte of digits at most.
        index = [(slot, f"{sum(1 << b for b in buckets):x}") for slot, buckets in self.index]
        return json.dumps(asdict(self) | {"index": index})

    @staticmethod
    def from_json(text: str) -> Manifest:
        raw = json.loads(text)
        runs = tuple(Run(r["path"], r["rows"], r["buckets"], tuple(r["filled"])) for r in raw["runs"])
        index = tuple((slot, tuple(b for b in range(MOST_BUCKETS) if int(bits, 16) >> b & 1)) for slot, bits in raw["index"])
        return Manifest(runs, index, Totals(**raw["totals"]), raw["merged"], raw["added"])


@dataclass(frozen=True)
class Merge:
    """Runs to be merged; `full` if they are all there are, so that closed flows can go."""

    runs: tuple[Run, ...]
    full: bool


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.col("flow_hash"), F.lit(buckets)).cast("int")


def slot_of(last_seen: Column) -> Column:
    return F.floor(last_seen / F.lit(SLOT_US)).cast("bigint")


def buckets_for(rows: int) -> int:
    """The power of two that gives a bucket about BUCKET_ROWS rows."""
    return min(MOST_BUCKETS, 1 << max(0, (max(rows, 1) - 1) // BUCKET_ROWS).bit_length())


def size_class(rows: int) -> int:
    return max(rows // BUCKET_ROWS, 1).bit_length() // 2


def choose_merge(manifest: Manifest) -> Merge | None:
    """All runs if as much was added as the last full merge held, else the smallest class with enough runs."""
    if len(manifest.runs) > 1 and manifest.added >= max(manifest.merged, MERGED_RUNS * BUCKET_ROWS):
        return Merge(manifest.runs, True)
    classes: dict[int, list[Run]] = {}
    for run in manifest.runs:
        classes.setdefault(size_class(run.rows), []).append(run)
    for _, runs in sorted(classes.items()):
        if len(runs) >= MERGED_RUNS:
            return Merge(tuple(runs), len(runs) == len(manifest.runs))
    return None


def newest(records: DataFrame) -> DataFrame:
    """The latest record of each flow, closed ones among them."""
    names = [c for c in _STORED.fieldNames() if c not in FLOW_KEYS]
    return records.groupBy(*FLOW_KEYS).agg(F.max_by(F.struct(*names), "version").alias("_r")).select(*FLOW_KEYS, "_r.*")


@dataclass
class FlowStore:
    """Open flows and totals, one manifest per micro-batch, in a folder all executors reach."""

    spark: SparkSession
    folder: str
    merges: ThreadPoolExecutor = field(default_factory=lambda: ThreadPoolExecutor(1, "flow-merge"), repr=False)
    _merge: tuple[Merge, str, Future] | None = None

    # Manifests

    def _manifest_path(self, version: int) -> str:
        return f"{self.folder}/manifests/{version:012d}.json"

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in children(self.spark, f"{self.folder}/manifests") if n.endswith(".json")]

    def manifest_before(self, batch_id: int) -> Manifest:
        earlier = [v for v in self.versions() if v < batch_id]
        return self._read_manifest(max(earlier)) if earlier else Manifest()

    def _read_manifest(self, version: int) -> Manifest:
        return Manifest.from_json(read_text(self.spark, self._manifest_path(version)))

    # Reading

    def _leaves(self, runs: Iterable[Run], wanted: set[int] | None) -> list[str]:
        """Folders of the buckets that may hold a wanted flow; `wanted` numbers the finest buckets, None is all."""
        out = []
        for run in runs:
            own = set(run.filled) if wanted is None else set(run.filled) & {b % run.buckets for b in wanted}
            out += [f"{self.folder}/{run.path}/bucket={b}" for b in sorted(own)]
        return out

    def _records(self, leaves: list[str], schema: T.StructType) -> DataFrame:
        if not leaves:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*leaves)

    def before(self, batch_id: int) -> tuple[DataFrame | None, Totals]:
        """All flows open before a micro-batch, None before the first, and the totals."""
        manifest = self.manifest_before(batch_id)
        if not manifest.runs and not manifest.totals.flows:
            return None, manifest.totals
        records = newest(self._records(self._leaves(manifest.runs, None), _STORED))
        return records.filter("open").select(*RECORD), manifest.totals

    def lookup(self, manifest: Manifest, flows: DataFrame, buckets: set[int], horizon_us: int) -> DataFrame:
        """Open records of the given flows, and of all that were last seen before the horizon.

        flows: keys; buckets: the finest buckets they lie in. Only these are opened, and those
        in which the time index has a flow before the horizon.
        """
        late = {b for slot, found in manifest.index if slot * SLOT_US < horizon_us for b in found}
        wanted = flows.distinct().withColumn("_wanted", F.lit(True))
        records = self._records(self._leaves(manifest.runs, buckets | late), _STORED)
        if late:
            # An outdated record may look as if its flow ran out, so the newest ones are found first. A
            # small run's folder holds other buckets too, whose newer records may lie in folders not opened.
            records = records.filter(bucket_of(MOST_BUCKETS).isin(*sorted(buckets | late)))
            found = newest(records).filter("open").join(wanted, list(FLOW_KEYS), "left")
            found = found.filter(F.col("_wanted") | (F.col("last_seen_us") < horizon_us))
        else:
            found = newest(records.join(wanted, list(FLOW_KEYS), "left_semi")).filter("open")
        return found.select(*RECORD)

    # Writing

    def _write_run(self, records: DataFrame, path: str, expected: int) -> tuple[Run, dict[int, set[int]]]:
        """The run, and per stretch of time the finest buckets of its open flows."""
        n, seen = buckets_for(expected), Observation()
        # Ports may come as any whole number; files hold the types of the schema.
        rows = records.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in _STORED.fields], bucket_of(n).alias("bucket"))
        place = F.when(F.col("open"), F.struct(slot_of(F.col("last_seen_us")).alias("slot"), bucket_of(MOST_BUCKETS).alias("bucket")))
        rows = rows.repartition("bucket").observe(
            seen, F.count(F.lit(1)).alias("rows"), F.collect_set("bucket").alias("filled"), F.collect_set(place).alias("places")
        )
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/{path}")
        told, index = seen.get, {}
        for p in told["places"]:
            index.setdefault(p["slot"], set()).add(p["bucket"])
        return Run(path, told["rows"], n, tuple(sorted(told["filled"]))), index

    def commit(self, batch_id: int, manifest: Manifest, changed: DataFrame, totals: Totals, expected: int, horizon_us: int) -> None:
        """Add a micro-batch to the manifest before it.

        changed: the newest records of the flows that it touched or closed, with a column `open`;
        expected: about how many they are; horizon_us: flows last seen before it are all closed.
        """
        records = changed.withColumn("version", F.lit(batch_id).cast("bigint"))
        run, places = self._write_run(records, f"runs/{batch_id:012d}-{uuid.uuid4().hex[:8]}", expected)
        for slot, buckets in manifest.index:
            places.setdefault(slot, set()).update(buckets)
        index = tuple((slot, tuple(sorted(b))) for slot, b in sorted(places.items()) if (slot + 1) * SLOT_US > horizon_us)
        runs = (*manifest.runs, run) if run.rows else manifest.runs
        after = self._adopt(replace(manifest, runs=runs, index=index, totals=totals, added=manifest.added + run.rows))
        write_text(self.spark, self._manifest_path(batch_id), after.to_json())
        self._clean(batch_id)
        self._start_merge(after)

    def import_flows(self, open_flows: DataFrame, totals: Totals, batch_id: int = 0) -> None:
        """Start from flows that are open already, as if a micro-batch had left them."""
        flows = open_flows.select(*RECORD, F.lit(True).alias("open"))
        n = flows.count()
        # The first run is as good as merged.
        self.commit(batch_id, Manifest(merged=n, added=-n), flows, totals, n, -(2**62))

    # Merging

    def _start_merge(self, manifest: Manifest) -> None:
        chosen = choose_merge(manifest) if self._merge is None else None
        if chosen:
            path = f"runs/merged-{uuid.uuid4().hex}"
            self._merge = (chosen, path, self.merges.submit(self._merged, chosen, path))

    def _merged(self, merge: Merge, path: str) -> Run:
        records = newest(self._records(self._leaves(merge.runs, None), _STORED))
        # A closed flow must be remembered while an older run may hold it as open.
        records = records.filter("open") if merge.full else records
        return self._write_run(records, path, sum(r.rows for r in merge.runs))[0]

    def wait(self) -> None:
        """Until the merge that is going on has ended; the next micro-batch takes it over."""
        if self._merge is not None:
            self._merge[2].exception()

    def _adopt(self, manifest: Manifest) -> Manifest:
        """The manifest with a finished merge in place of its runs. A failed merge changes nothing."""
        if self._merge is None or not self._merge[2].done():
            return manifest
        (merge, _, result), self._merge = self._merge, None
        if result.exception() is not None:
            log.warning("merge failed: %s", result.exception())
            return manifest
        if not set(merge.runs) <= set(manifest.runs):
            return manifest
        run = result.result()
        left = tuple(r for r in manifest.runs if r not in merge.runs)
        runs = (*left, run) if run.rows else left
        if merge.full:
            return replace(manifest, runs=runs, merged=run.rows, added=sum(r.rows for r in left))
        return replace(manifest, runs=runs)

    def _clean(self, batch_id: int) -> None:
        """Delete manifests beyond the kept ones, and what none of these names."""
        earlier = sorted(v for v in self.versions() if v <= batch_id)
        for version in earlier[:-KEPT_VERSIONS]:
            delete(self.spark, self._manifest_path(version))
        kept = [self._read_manifest(v) for v in earlier[-KEPT_VERSIONS:]]
        named = {r.path for m in kept for r in m.runs}
        if self._merge is not None:
            named |= {self._merge[1]} | {r.path for r in self._merge[0].runs}
        for name in children(self.spark, f"{self.folder}/runs"):
            if f"runs/{name}" not in named:
                delete(self.spark, f"{self.folder}/runs/{name}")
