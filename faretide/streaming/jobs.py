"""Structured Streaming jobs.

A micro-batch of change records goes to append-only logs (accepted rows; keys of deleted rows; rejected records with
their reasons), and is merged into the current table. That table is split by partition and by a hash of the key into buckets,
and keeps beside every live row its order columns, and of deleted keys a tombstone. So a batch reads and
rewrites the buckets its keys fall into and nothing else: the last change of every key, in source order, whatever order and
batches the changes arrived in. Late changes, replays and a lost executor or driver all end in the same table.

What a merge changes is kept with its version as signed rows: the old image of a row with weight -1, the new one with +1. The
gold tables follow these: they add signed sums to the sums they hold and read no silver day again.

Each table is written in one step and remembers the last batch it took, so a batch that died between two tables is
completed by its next attempt and never applied twice. No watermark bounds how late a change may come; the
retention limit does: what belongs to an expired partition is rejected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from faretide import schemas
from faretide.functions import clock
from faretide.operators import decode, quality, recon
from faretide.plans import gold
from faretide.schemas import ChangeSpec, TableSpec
from faretide.sources import tables
from faretide.sources.tables import Lake

CDC_TRIGGER = {"processingTime": "30 seconds"}
GOLD_TRIGGER = {"processingTime": "300 seconds"}

_POSITION = schemas.struct(
    _lsn=schemas.LONG, _ts_ms=schemas.LONG, _partition=schemas.INT, _offset=schemas.LONG, _rank=schemas.INT
)
# Where a change stands among all changes of its key, as one value that sorts. The number of the run and of the batch settle what
# the source left open; the rank comes after them, as it only tells within a batch.
_ORDER = schemas.struct(
    _lsn=schemas.LONG, _ts_ms=schemas.LONG, _partition=schemas.INT, _offset=schemas.LONG, _run=schemas.INT, _batch=schemas.LONG, _rank=schemas.INT
)
_LINEAGE = schemas.plus(
    schemas.struct(_processing_time=schemas.INSTANT, _operation=schemas.STRING),
    _POSITION,
    schemas.struct(_run=schemas.INT, _batch=schemas.LONG),
)
LIVE, GONE, CHANGED = "live", "gone", "changed"


@dataclass(frozen=True)
class Target:
    """The tables one change stream feeds. ``run`` names the stream's checkpoint: with a new checkpoint batch numbers start
    again, and a new name tells its batches from older ones. Runs are numbered in the order in which they first appear.
    ``buckets`` is fixed for the life of the table: enough that a bucket of a partition is a few hundred megabytes."""

    spec: ChangeSpec
    current_name: str
    log_name: str
    run: str = "main"
    buckets: int = 8

    def _split(self) -> schemas.T.StructType:
        return schemas.T.StructType([schemas.PARTITION_COLUMNS[self.spec.partition_unit]])

    @property
    def log(self) -> TableSpec:
        """Every accepted version of every row."""
        return TableSpec(self.log_name, schemas.plus(self.spec.payload, _LINEAGE, self._split()), (self.spec.partition,))

    @property
    def deletes(self) -> TableSpec:
        """Keys of deleted rows."""
        key = schemas.T.StructType([self.spec.payload[k] for k in self.spec.key])
        columns = schemas.plus(key, schemas.struct(_deleted_at=schemas.INSTANT), _LINEAGE, self._split())
        return TableSpec(f"{self.log_name}_deletes", columns, (self.spec.partition,))

    @property
    def rejects(self) -> TableSpec:
        """What was not applied, and why; ``_record`` is the text of what could not be read."""
        why = schemas.struct(reject_reasons=schemas.T.ArrayType(schemas.STRING), _record=schemas.STRING)
        return TableSpec(f"{self.log_name}_rejects", schemas.plus(self.spec.payload, why, _LINEAGE))

    @property
    def state(self) -> TableSpec:
        """Live rows, tombstones and the images of changed rows (``_weight`` -1 for the old, 1 for the new)."""
        columns = schemas.plus(
            self.spec.payload,
            schemas.struct(_processing_time=schemas.INSTANT, _operation=schemas.STRING, _order=_ORDER, _weight=schemas.INT),
            self._split(),
            schemas.struct(_bucket=schemas.INT, _kind=schemas.STRING),
        )
        sort = (self.spec.partition_source,) if self.spec.partition_source else ()
        return TableSpec(self.current_name, columns, (self.spec.partition, "_bucket", "_kind"), sort)

    def _kind(self, kind: str) -> TableSpec:
        names = (*self.spec.payload.names, "_processing_time", "_operation", "_weight", self.spec.partition)
        columns = schemas.T.StructType([self.state.schema[n] for n in names if n != "_weight" or kind == CHANGED])
        return replace(self.state, schema=columns, only=f"_kind={kind}")

    @property
    def current(self) -> TableSpec:
        """The live rows."""
        return self._kind(LIVE)

    @property
    def images(self) -> TableSpec:
        """The images of changed rows; they belong to single versions."""
        return self._kind(CHANGED)


TRIPS = Target(schemas.TRIP_CHANGES, "silver_taxi_trips", "taxi_prod")
WEATHER = Target(schemas.WEATHER_CHANGES, "nyc_weather", "nyc_weather_log")
LIVE_TRIPS = Target(schemas.LIVE_TRIP_CHANGES, "live_taxi_prod", "live_taxi_prod_log")
LIVE_WEATHER = Target(schemas.LIVE_WEATHER_CHANGES, "live_nyc_weather", "live_nyc_weather_log")
LIVE_ZONES = Target(schemas.LIVE_ZONE_CHANGES, "live_taxi_zones", "live_taxi_zones_log")


def partition_value(spec: ChangeSpec) -> Column:
    if spec.partition_unit == "day":
        return F.to_date(spec.partition_source)
    if spec.partition_unit == "month":
        return clock.month_key(F.col(spec.partition_source))
    return F.lit("all")


def checked_changes(raw: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Every record decoded, with ``reject_reasons``: empty for accepted upserts, and for deletes with a whole key."""
    changes = decode.decode_changes(raw, spec, keep_unreadable=True)
    missing = F.lit(False)
    for name in spec.key:
        missing = missing | F.col(name).isNull()
    gone = F.col("_is_delete")
    reasons = [
        F.when(gone.isNull(), F.lit(decode.NOT_A_CHANGE)),
        F.when(gone & missing, F.lit("key missing")) if spec.apply_deletes else F.when(gone, F.lit("deletes not applied")),
    ]
    rules = quality.RULES[spec.rules] if spec.rules else ()
    reasons += [F.when(~gone & quality.fails(rule), F.lit(rule.name)) for rule in rules]
    judged = changes.withColumns(
        {"reject_reasons": F.array_compact(F.array(*reasons)), "_record": F.when(gone.isNull(), F.col("_record"))}
    )
    if spec.zero_defaults:
        filled = decode.fill_defaults(judged, spec)
        judged = filled.withColumns({n: F.when(gone.isNotNull(), F.col(n)) for n in spec.payload.names})
    return judged.withColumn(spec.partition, partition_value(spec))


def _merged(stored: DataFrame, changes: DataFrame, target: Target) -> DataFrame:
    """Rows of ``target.state``: what the touched buckets hold afterwards, and the images of the rows that changed.

    Versions that tie even in their order are told apart by their values, so that a repeated attempt agrees.
    """
    spec = target.spec
    columns = [*spec.payload.names, "_processing_time", "_operation", "_order", spec.partition, "_bucket", "_is_delete", "_stored"]
    old = stored.withColumns({"_is_delete": F.col("_kind") == GONE, "_stored": F.lit(True)}).select(*columns)
    new = changes.withColumn("_stored", F.lit(False)).select(*columns)
    last = [F.col("_order").desc_nulls_last(), F.xxhash64(*spec.payload.names).desc(), F.col("_stored").desc()]
    # The hash comes first so that the sort behind the window mostly compares one number.
    place = F.row_number().over(Window.partitionBy(F.xxhash64(*spec.key), *spec.key).orderBy(*last))
    ranked = old.unionByName(new).withColumn("_place", place)
    wins, live, stored_row = F.col("_place") == 1, ~F.col("_is_delete"), F.col("_stored")
    kinds = F.array_compact(
        F.array(
            F.when(wins, F.when(live, F.lit(LIVE)).otherwise(F.lit(GONE))),
            F.when(live & (stored_row != wins), F.lit(CHANGED)),
        )
    )
    rows = ranked.withColumn("_kind", F.explode(kinds))
    weight = F.when(F.col("_kind") == CHANGED, F.when(stored_row, -1).otherwise(1))
    return rows.withColumn("_weight", weight).select(*target.state.schema.names)


def _leaf(target: Target, value: object, bucket: int) -> str:
    """The directory of one bucket; partition values are days, months or a fixed word, which need no escapes."""
    return f"{target.spec.partition}={tables.NULL_PARTITION if value is None else value}/_bucket={bucket}"


def _run_number(lake: Lake, target: Target) -> int:
    """The number of the target's run, from the current table, which is where a new run is entered."""
    runs = [name.removeprefix("run:") for name in lake.snapshot(target.state).marks if name.startswith("run:")]
    if target.run not in runs:
        lake.commit(target.state, {f"run:{target.run}": len(runs)})
        return len(runs)
    return int(lake.snapshot(target.state).marks[f"run:{target.run}"])


def apply_batch(lake: Lake, target: Target, most_writes: int = 16) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of a change stream. Partitions of a log made up of more than ``most_writes`` writes are
    compacted every ``most_writes`` batches."""
    spec = target.spec
    done_by = f"batch:{target.run}"

    def pending(table: TableSpec, batch_id: int) -> bool:
        return lake.snapshot(table).marks.get(done_by, -1) < batch_id

    def write(batch: DataFrame, batch_id: int) -> None:
        if not pending(target.state, batch_id):
            return
        done = {done_by: batch_id}
        stamp = {"_run": F.lit(_run_number(lake, target)), "_batch": F.lit(batch_id).cast("bigint"), "_processing_time": F.current_timestamp()}
        changes = batch.withColumns(stamp)
        bucket = F.pmod(F.xxhash64(*spec.key), F.lit(target.buckets)).cast("int")
        order = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in _ORDER.fields])
        fence = lake.snapshot(target.state).marks.get("fence")
        if fence:
            expired = F.coalesce(F.col(spec.partition).cast("string") < fence, F.lit(False))
            late = F.when(expired, F.array(F.lit("partition expired"))).otherwise(F.array().cast("array<string>"))
            changes = changes.withColumn("reject_reasons", F.concat("reject_reasons", late))
        good = F.size("reject_reasons") == 0
        changes = changes.withColumns({"_bucket": bucket, "_order": order}).persist()
        try:
            # Buckets of partitions that the batch touches, and its counts: never rows.
            unit = {"good": good, "v": F.when(good, F.col(spec.partition)), "b": F.when(good, F.col("_bucket"))}
            counts = changes.groupBy(*[c.alias(name) for name, c in unit.items()])
            units = counts.agg(F.count("*").alias("n"), F.count_if("_is_delete").alias("gone")).collect()
            touched = [_leaf(target, u.v, u.b) for u in units if u.good]
            rejected = sum(u.n for u in units if not u.good)
            read, gone = sum(u.n for u in units), sum(u.gone for u in units if u.good)
            if rejected and pending(target.rejects, batch_id):
                lake.append(changes.filter(~good), target.rejects, done)
            accepted = changes.filter(good)
            if read - rejected > gone and pending(target.log, batch_id):
                lake.append(accepted.filter("NOT _is_delete"), target.log, done)
            if gone and pending(target.deletes, batch_id):
                deleted = accepted.filter("_is_delete").withColumn("_deleted_at", F.col("_processing_time"))
                lake.append(deleted, target.deletes, done)
            done |= {"read": read, "accepted": read - rejected, "rejected": rejected}
            if touched:
                base = lake.snapshot(target.state)
                rows = _merged(lake.read_leaves(target.state, base, touched), accepted, target)
                lake.replace_leaves(rows, target.state, touched, base, f"_kind={CHANGED}", done)
            else:
                lake.commit(target.state, done)
        finally:
            changes.unpersist()
        if batch_id % most_writes == most_writes - 1:
            maintain(lake, target, most_writes)

    return write


def maintain(lake: Lake, target: Target, most_writes: int = 16, keep: int = 1000) -> None:
    """Keep the number of files and versions bounded: compact the logs, forget all but the last ``keep`` versions."""
    logs = (target.log, target.deletes, target.rejects)
    for log in logs:
        lake.compact(log, most_writes)
    for table in (*logs, target.state):
        lake.vacuum(table, keep)


def start_changes(raw: DataFrame, lake: Lake, target: Target, checkpoint: str, **trigger) -> StreamingQuery:
    """Run a change stream into its tables, every 30 seconds unless a trigger is given.

    Several targets may read the same source, each from its own ``raw`` frame and checkpoint.
    """
    for table in (target.log, target.deletes, target.rejects, target.state):
        lake.ensure(table)
    return (
        checked_changes(raw, target.spec)
        .writeStream.outputMode("append")
        .queryName(f"{target.current_name}-{target.run}")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or CDC_TRIGGER))
        .foreachBatch(apply_batch(lake, target))
        .start()
    )


def start_gold(
    lake: Lake,
    zones: Callable[[], DataFrame],
    checkpoint: str,
    target: Target = TRIPS,
    backfill: bool | None = None,
    min_rows: int = recon.MIN_SILVER_ROWS,
    **trigger,
) -> StreamingQuery:
    """Keep the gold tables up with silver, every 300 seconds unless a trigger is given.

    With ``backfill`` (by default: only where there is no gold yet) all of silver is summed up first, which needs
    ``min_rows`` rows to be there; after that the images of changed rows are added. The gold tables know which version of
    silver they hold, so a restart, with this checkpoint or a new one, goes on from there.
    """
    if backfill is None:
        backfill = not lake.exists(schemas.GOLD_HOURLY)
    if backfill:
        at = lake.snapshot(target.state)
        silver = lake.read(target.current, at=at)
        if not recon.is_ready(silver, min_rows):
            raise RuntimeError(f"{target.current_name} has fewer than {min_rows} rows")
        gold.refresh(lake, silver, zones(), version=at.version)

    def follow(batch: DataFrame, batch_id: int) -> None:
        follow_silver(lake, zones(), target)

    lake.ensure(target.state)
    return (
        lake.read_stream(target.state)
        .writeStream.queryName(f"gold-{target.run}")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or GOLD_TRIGGER))
        .foreachBatch(follow)
        .start()
    )


def follow_silver(lake: Lake, zones: DataFrame, target: Target = TRIPS) -> None:
    """Bring gold from the version of silver it holds to the latest one."""
    at = lake.snapshot(target.state)
    behind = gold.version(lake)
    if behind >= at.version:
        return
    versions = lake.versions(target.state).since(behind)
    if versions is None:  # vacuumed before gold had seen them
        gold.refresh(lake, lake.read(target.current, at=at), zones, version=at.version)
        return
    seen = gold.version(lake, schemas.GOLD_HOURLY)
    images = lake.read_images(target.images, [v for v in versions if v.number > seen])
    # Partitions that merely expired have no images, and their gold stays.
    days = {leaf.partition("/")[0].partition("=")[2] for v in versions for leaf in v.images}
    gold.apply_images(lake, images, zones, sorted(days), at.version)


def expire(lake: Lake, target: Target, days: int, as_of: datetime) -> list[str]:
    """Drop what is older than ``days`` from the current table and from the logs behind it; later changes to it are rejected."""
    return tables.expire(lake, target.state, days, as_of, (target.log, target.deletes))


def rebuild(lake: Lake, target: Target) -> None:
    """Form the current table anew from its logs, all partitions."""
    spec = target.spec
    base = lake.snapshot(target.state)
    columns = [*spec.payload.names, *_LINEAGE.names, spec.partition]
    changes = lake.read(target.log).select(*columns, F.lit(False).alias("_is_delete"))
    if spec.apply_deletes:
        gone = lake.read(target.deletes).withColumn("_is_delete", F.lit(True)).drop("_deleted_at")
        changes = changes.unionByName(gone, allowMissingColumns=True)
    order = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in _ORDER.fields])
    bucket = F.pmod(F.xxhash64(*spec.key), F.lit(target.buckets)).cast("int")
    rows = _merged(lake.read_leaves(target.state, base, ()), changes.withColumns({"_order": order, "_bucket": bucket}), target)
    # Every row would be its own new image; whoever follows the table reads it anew.
    rows = rows.filter(F.col("_kind") != CHANGED)
    lake.reload(rows, target.state, {"anew": base.version + 1})
