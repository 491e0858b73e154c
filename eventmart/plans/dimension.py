"""The versioned dimension as a table: built in full, or brought up to date load by load.

Any sequence of updates gives the table a full build gives. The versions in force are a partition of their own for
each bucket of entities; past ones are partitioned by the bucket and the month they open in. So an update
rewrites what is in force and the recent months of the entities it touches, not the whole history of a busy one, and
only where a version changes.

An update works per touched entity from `since`, the earliest time among all copies of the events
that came in, earlier copies included because a new copy may move an event. The version before that,
the anchor, tells the attributes in force, so events before `since` need not be read again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.keys import bucket_of
from eventmart.operators.scd2 import MAX_ROWS_PER_TASK, dimension, large_entities
from eventmart.operators.silver import entity_events, entity_events_of
from eventmart.schemas import ENTITY_ATTRIBUTES, Attribute, dimension_schema
from eventmart.sources import copies, files, progress
from eventmart.sources.bronze import part_of, read_loads, read_parts, read_raw_events
from eventmart.sources.layout import Layout
from eventmart.sources.progress import DIMENSION as NAME
from eventmart.sources.progress import EVERYTHING
from eventmart.sources.staging import dropped_after, stage

_PARTITION = ["state", "bucket", "valid_month"]
_IN_FORCE, _PAST = "in_force", "past"


def _partition() -> Column:
    return F.concat_ws("/", *_PARTITION)


@dataclass(frozen=True)
class DimensionTable:
    """The dimension below a layout. `buckets` must stay as it was when the table was built."""

    spark: SparkSession
    layout: Layout
    attributes: tuple[Attribute, ...] = ENTITY_ATTRIBUTES
    buckets: int = 64
    max_rows: int = MAX_ROWS_PER_TASK

    # -- reading

    def all_attributes(self) -> tuple[Attribute, ...]:
        """The declared attributes, then those earlier writes gave the table and this one lacks.

        The latter are kept in the rows that have them, and null in new ones, until a full build.
        """
        earlier = progress.columns(self.spark, self.layout, NAME)
        declared = {a.name for a in self.attributes}
        dropped = [
            Attribute(name, column["path"], column["type"], tracked=False)
            for name, column in earlier.items()
            if name not in declared
        ]
        return (*self.attributes, *dropped)

    def _note_columns(self, attributes: tuple[Attribute, ...]) -> None:
        columns = {a.name: {"type": a.type, "path": a.path} for a in attributes}
        progress.set_columns(self.spark, self.layout, NAME, columns, self.buckets)

    def _check_buckets(self) -> None:
        """A table is found, and updated, only by the number of buckets it was built with."""
        built = progress.buckets(self.spark, self.layout, NAME)
        if built is not None and built != self.buckets:
            raise ValueError(f"the table has {built} buckets, not {self.buckets}: pass that number, or build it anew")

    def _stored(self) -> DataFrame:
        kinds = {"state": T.StringType()}
        parts = [T.StructField(p, kinds.get(p, T.IntegerType())) for p in _PARTITION]
        schema = T.StructType(dimension_schema(self.all_attributes()).fields + parts)
        return self.spark.read.schema(schema).parquet(self.layout.dimension)

    def read(self) -> DataFrame:
        """The table. Columns that are newer than a row are null in it."""
        return self._stored().drop(*_PARTITION)

    def read_current(self) -> DataFrame:
        """The versions in force, from their partitions alone."""
        return self._stored().filter(F.col("state") == _IN_FORCE).drop(*_PARTITION)

    def high_water(self) -> datetime | None:
        """The latest time a version opens at, as noted when the table was last written."""
        return progress.high_water(self.spark, self.layout, NAME)

    def read_entity(self, name: str) -> DataFrame:
        """The versions of one entity, from its bucket alone."""
        self._check_buckets()
        in_bucket = F.col("bucket") == bucket_of(F.lit(name), self.buckets)
        return self._stored().filter(in_bucket & (F.col("repo_name") == name)).drop(*_PARTITION)

    # -- writing

    def _placed(self, rows: DataFrame) -> DataFrame:
        month = F.year("valid_from") * 100 + F.month("valid_from")
        in_force = F.col("valid_to").isNull()
        return rows.withColumns(
            {
                "state": F.when(in_force, _IN_FORCE).otherwise(_PAST),
                "bucket": bucket_of("repo_name", self.buckets),
                "valid_month": F.when(in_force, 0).otherwise(month),
            }
        )

    def _write(self, rows: DataFrame, mode: str) -> None:
        """Overwrite all partitions (static), or those that have rows (dynamic).

        Rebalancing gives each partition few files, and splits a large one over several tasks.
        """
        (
            rows.hint("rebalance", *_PARTITION)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", mode)
            .partitionBy(*_PARTITION)
            .parquet(self.layout.dimension)
        )

    def _find_high_water(self) -> None:
        """Note the latest time a version opens at: that version is in force."""
        latest = self.read_current().agg(F.max("valid_from")).first()[0]
        progress.set_high_water(self.spark, self.layout, NAME, latest)

    def _versions(self, events: DataFrame, attributes: tuple[Attribute, ...], sizes: DataFrame) -> DataFrame:
        """The dimension over some events. Whether any entity is large is asked first: few tables have one."""
        none_large = large_entities(sizes, self.max_rows).isEmpty()
        return dimension(events, attributes, sizes=sizes, max_rows=None if none_large else self.max_rows)

    def build(self, loads: list[str] | None = None) -> None:
        """Build the whole table from bronze. `loads` are logged as done."""
        # Listed before bronze is, so that no load is logged as done that was not read.
        done = loads if loads is not None else progress.pending(self.spark, self.layout, NAME)
        raw = read_raw_events(self.spark, self.layout)
        rows = self._versions(entity_events(raw, self.attributes), self.attributes, raw.select("repo_name"))
        progress.started(self.spark, self.layout, NAME, done, [EVERYTHING])
        self._note_columns(self.attributes)
        self._write(self._placed(rows), "static")
        self._find_high_water()
        progress.finished(self.spark, self.layout, NAME, done)

    def _rebuild_buckets(self, buckets: list[int], loads: list[str]) -> None:
        """Build some buckets again from bronze, whatever state they are in."""
        in_buckets = bucket_of("repo_name", self.buckets).isin(buckets)
        raw = read_raw_events(self.spark, self.layout)
        # Columns of an earlier schema are filled again as well.
        attributes = self.all_attributes()
        events = entity_events(raw, attributes).filter(in_buckets)
        rows = self._versions(events, attributes, raw.select("repo_name").filter(in_buckets))
        for bucket in buckets:
            for state in (_IN_FORCE, _PAST):
                files.delete(self.spark, f"{self.layout.dimension}/state={state}/bucket={bucket}")
        self._write(self._placed(rows), "dynamic")
        self._find_high_water()
        progress.finished(self.spark, self.layout, NAME, loads)

    def recover(self) -> None:
        """Repair what an update left behind that died while writing."""
        loads, scope = progress.interrupted(self.spark, self.layout, NAME)
        if EVERYTHING in scope:
            self.build(loads)
        elif scope:
            self._rebuild_buckets(scope, loads)

    def update(self, loads: list[str]) -> None:
        """Bring the table up to date with loads that are in bronze and not in the table yet."""
        if not files.exists(self.spark, self.layout.dimension):
            return self.build()
        self._check_buckets()
        with dropped_after(self.spark):
            return self._update(loads)

    def _update(self, loads: list[str]) -> None:
        self.recover()
        timed = F.col("repo_name").isNotNull() & F.col("event_created_at").isNotNull()
        touched = (
            copies.find(read_loads(self.spark, self.layout, loads), self.layout)
            .filter(timed)
            .groupBy("repo_name")
            .agg(F.min("event_created_at").alias("since"))
            .withColumn("bucket", bucket_of("repo_name", self.buckets))
        )
        own = F.collect_set(copies.bucket("repo_name", self.spark, self.layout))
        touched, seen = stage(touched, "touched", since=F.min("since"), index=own, buckets=F.collect_set("bucket"))
        if seen["since"] is None:
            progress.finished(self.spark, self.layout, NAME, loads)
            return None

        events = self._events_since(touched, seen["since"], seen["index"])
        self._replace(touched, sorted(seen["buckets"]), events, loads)
        return None

    def _events_since(self, touched: DataFrame, since: datetime, buckets: list[int]) -> DataFrame:
        """Silver events of the touched entities from `since` on.

        An event may have copies that name other entities or times, so first come the ids with any
        copy in reach, then all copies of those, then the dedup. The index tells the ids, and the folders of
        bronze their copies are in, which are the only ones opened.
        """
        ids, seen = copies.ids_of(copies.since(touched, self.layout, since, buckets), self.layout)
        # As many as there are folders at most.
        places = F.collect_set(F.struct("ingested_date", "load"))
        found = copies.find_ids(ids, seen, self.layout).agg(places).first()[0]
        parts = [part_of(p["ingested_date"], p["load"]) for p in found]
        raw = read_parts(self.spark, self.layout, sorted(parts))
        events = entity_events_of(raw, ids, seen["low"], seen["high"], self.attributes)
        same = (events["repo_name"] == touched["repo_name"]) & (events["event_created_at"] >= touched["since"])
        return stage(events.join(touched, same, "left_semi"), "events")[0]

    def _replace(self, touched: DataFrame, buckets: list[int], events: DataFrame, loads: list[str]) -> None:
        attributes = self.all_attributes()
        names = [a.name for a in attributes]
        stored = self._stored().filter(F.col("bucket").isin(buckets))

        before = stored.join(touched.select("repo_name", "since"), "repo_name").filter("valid_from < since")
        anchors = before.groupBy("repo_name").agg(
            F.max_by(F.struct("valid_from", *names), "valid_from").alias("anchor")
        )
        anchors, _ = stage(anchors, "anchors")
        seeds = anchors.select(
            "repo_name",
            F.col("anchor.valid_from").alias("event_created_at"),
            F.lit("").alias("event_id"),
            *[f"anchor.{n}" for n in names],
        )
        events = seeds.unionByName(events, allowMissingColumns=True)
        fresh = self._versions(events, attributes, events.select("repo_name"))
        fresh, newest = stage(self._placed(fresh), "fresh", at=F.max("valid_from"))

        # Stored versions from the anchor on are replaced, in the partitions where any of them changes.
        bounds = touched.join(anchors, "repo_name", "left").select(
            "repo_name", F.coalesce("anchor.valid_from", "since").alias("bound")
        )
        # Staged, so that its size is known where it is joined, and the stored versions are not shuffled for a small one.
        bounds, _ = stage(bounds, "bounds")
        replaced = (stored["repo_name"] == bounds["repo_name"]) & (stored["valid_from"] >= bounds["bound"])
        old = stored.join(bounds, replaced, "left_semi")
        parts = self._changed(old, fresh).collect()
        if not parts:
            self._note_columns(attributes)
            progress.finished(self.spark, self.layout, NAME, loads)
            return
        mark, opened = self.high_water(), newest["at"]
        is_newest = opened is not None and (mark is None or opened >= mark)
        # Only where the newest version may be gone is it asked whether it is.
        gone = not is_newest and old.agg(F.max("valid_from")).first()[0] == mark
        changed = [p["part"] for p in parts]
        fresh = fresh.filter(_partition().isin(changed))
        rewritten = stored.filter(_partition().isin(changed))
        replaced = (rewritten["repo_name"] == bounds["repo_name"]) & (rewritten["valid_from"] >= bounds["bound"])
        kept = rewritten.join(bounds, replaced, "left_anti")

        # A dynamic overwrite leaves a partition alone that gets no rows; such ones are deleted.
        emptied = {p["part"] for p in parts if not p["is_fresh"]}
        if emptied:
            still = kept.select(_partition().alias("part")).filter(F.col("part").isin(list(emptied))).distinct()
            emptied -= {r["part"] for r in still.collect()}

        self._note_columns(attributes)
        progress.started(self.spark, self.layout, NAME, loads, sorted({int(p.split("/")[1]) for p in changed}))
        self._write(kept.unionByName(fresh), "dynamic")
        for part in emptied:
            named = "/".join(f"{p}={v}" for p, v in zip(_PARTITION, part.split("/"), strict=True))
            files.delete(self.spark, f"{self.layout.dimension}/{named}")
        if is_newest:
            progress.set_high_water(self.spark, self.layout, NAME, opened)
        elif gone:
            self._find_high_water()
        progress.finished(self.spark, self.layout, NAME, loads)

    @staticmethod
    def _changed(old: DataFrame, new: DataFrame) -> DataFrame:
        """The partitions in which two sets of versions differ, nulls being equal, and whether the new one has rows there.

        Told by the number of versions and the sums of two hashes of them, 128 bits in all, which tasks add up: no
        version is shuffled.
        """
        # A hash passes over nulls, so it takes in where they are.
        values = [value for c in old.columns for value in (F.col(c), F.col(c).isNull())]
        hashes = {"_first": F.xxhash64(*values), "_second": F.xxhash64(F.lit(1), *values)}

        def told(rows: DataFrame, sign: int) -> DataFrame:
            sums = [(F.lit(sign) * column.cast("decimal(20,0)")).alias(name) for name, column in hashes.items()]
            return rows.select(_partition().alias("part"), F.lit(sign).alias("_one"), *sums)

        sums = told(old, -1).unionByName(told(new, 1)).groupBy("part").agg(
            *[F.sum(name).alias(name) for name in ("_one", *hashes)], (F.max("_one") == 1).alias("is_fresh")
        )
        differs = (F.col("_one") != 0) | (F.col("_first") != 0) | (F.col("_second") != 0)
        return sums.filter(differs).select("part", "is_fresh")
