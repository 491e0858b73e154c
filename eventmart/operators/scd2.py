"""Type-2 versions of entities from the snapshots their events carry.

A version opens where a tracked attribute differs from the previous event of the entity, and ends
where the next one opens. Two rules are offered:

* strict: the first event, or a real change. Events of one entity at the same time count as one, the
  last by event_id. Events without a time are left out.
* compatible: every event whose predecessor has no value in the first tracked attribute opens a
  version too, and events at the same time each count.

An ordered window puts an entity into one task. An entity too large for that is cut into pieces by the
hour: its rows are compared within each piece, and the pieces are joined up from one summary row per
piece. Which entities those are is a join with their counts, part of the same plan; the others are one
piece each and pass through the same windows. A caller that knows of no large one says so with `max_rows=None`:
then there is one shuffle of the events, on the entity, and no join.

That join must not put a large entity into one task either, nor leave its rows placed by the entity alone,
which would do for the windows as well. So it is on the entity and a salt: however Spark joins, rows reach the
windows by an exchange of their own, on the entity and its piece.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from eventmart.functions.keys import version_key
from eventmart.functions.time import trunc_hour
from eventmart.schemas import ENTITY_ATTRIBUTES, Attribute, dimension_schema

# Rows of one entity a single task may hold.
MAX_ROWS_PER_TASK = 2_000_000
# Tasks that the rows of one entity are dealt to where they are joined with the list of large ones.
SALTS = 64

# Pieces are named by their hour. One name is for whole entities, one for rows without a time, which
# come last.
_WHOLE, _NO_TIME = datetime(1, 1, 1), datetime(9999, 12, 31)


def large_entities(rows: DataFrame, max_rows: int) -> DataFrame:
    """Entities with more than `max_rows` rows."""
    counts = rows.filter(F.col("repo_name").isNotNull()).groupBy("repo_name").agg(F.count("*").alias("_rows"))
    return counts.filter(F.col("_rows") > max_rows).select("repo_name", F.lit(True).alias("_is_large"))


def _ascending() -> list[Column]:
    return [F.col("event_created_at").asc_nulls_last(), F.col("event_id").asc_nulls_first()]


def _opens(attributes: tuple[Attribute, ...], strict: bool) -> Column:
    """Does this event open a version? `_previous` is null on the first event of an entity."""
    tracked = [a.name for a in attributes if a.tracked]
    arms = [F.col("_previous").isNull() if strict else F.col(f"_previous.{tracked[0]}").isNull()]
    arms += [~F.col(name).eqNullSafe(F.col(f"_previous.{name}")) for name in tracked]
    condition = arms[0]
    for arm in arms[1:]:
        condition = condition | arm
    return condition


def _snapshot(attributes: tuple[Attribute, ...]) -> Column:
    """All attributes, so that every use of the events needs the same columns and shares their shuffle."""
    return F.struct(*[a.name for a in attributes])


def _in_pieces(events: DataFrame, large: DataFrame) -> DataFrame:
    """Events with the piece of their entity they are in."""

    def named(piece: datetime) -> Column:
        return F.lit(piece).cast("timestamp_ntz")

    hour = F.coalesce(trunc_hour("event_created_at"), named(_NO_TIME))
    piece = F.when(F.col("_is_large"), hour).otherwise(named(_WHOLE))
    salted = events.withColumn("_salt", F.pmod(F.xxhash64("event_id", "event_created_at"), F.lit(SALTS)))
    listed = large.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(listed, ["repo_name", "_salt"], "left").drop("_salt").withColumn("_piece", piece)


def _windows() -> tuple[WindowSpec, WindowSpec]:
    """Over the events of a piece, and over the pieces of an entity."""
    in_piece = Window.partitionBy("repo_name", "_piece").orderBy(*_ascending())
    return in_piece, Window.partitionBy("repo_name").orderBy("_piece")


def _last_at_each_time(events: DataFrame, window: WindowSpec) -> DataFrame:
    return (
        events.withColumn("_following", F.lead("event_created_at").over(window))
        .filter(~F.col("_following").eqNullSafe(F.col("event_created_at")))
        .drop("_following")
    )


def _opening(events: DataFrame, attributes: tuple[Attribute, ...], strict: bool) -> DataFrame:
    """The events that open versions."""
    in_piece, over_pieces = _windows()
    # Told by the window, not by the piece, so that no filter on it goes below the shuffle and keeps it from
    # being shared.
    in_pieces = F.coalesce(F.max("_is_large").over(in_piece), F.lit(False))
    events = events.withColumn("_in_pieces", in_pieces).drop("_is_large")
    if strict:
        # Events at one time are in one piece.
        events = _last_at_each_time(events, in_piece)
    position = F.struct(F.col("event_created_at").isNull(), "event_created_at", "event_id")
    carried = (
        events.filter("_in_pieces")
        .groupBy("repo_name", "_piece")
        .agg(F.max_by(_snapshot(attributes), position).alias("_tail"))
        .withColumn("_carried", F.lag("_tail").over(over_pieces))
        .drop("_tail")
    )
    return (
        events.withColumn("_previous", F.lag(_snapshot(attributes)).over(in_piece))
        .join(carried, ["repo_name", "_piece"], "left")
        .withColumn("_previous", F.coalesce("_previous", "_carried"))
        .filter(_opens(attributes, strict))
        .drop("_previous", "_carried")
    )


def _ended(opened: DataFrame) -> DataFrame:
    """Versions with where each ends."""
    in_piece, over_pieces = _windows()
    next_piece = (
        opened.filter("_in_pieces")
        .groupBy("repo_name", "_piece")
        .agg(F.min("event_created_at").alias("_first"))
        .withColumn("_next", F.lead("_first").over(over_pieces))
        .drop("_first")
    )
    valid_to = F.when(F.col("_within").isNotNull(), F.col("_within.event_created_at")).otherwise(F.col("_next"))
    return (
        opened.withColumn("_within", F.lead(F.struct("event_created_at")).over(in_piece))
        .join(next_piece, ["repo_name", "_piece"], "left")
        .withColumn("valid_to", valid_to)
        .drop("_within", "_next", "_piece", "_in_pieces")
    )


def _over_entity() -> WindowSpec:
    """Over all events of an entity."""
    return Window.partitionBy("repo_name").orderBy(*_ascending())


def _opened(
    events: DataFrame,
    strict: bool,
    attributes: tuple[Attribute, ...],
    sizes: DataFrame | None,
    max_rows: int | None,
) -> DataFrame:
    if strict:
        events = events.filter(F.col("event_created_at").isNotNull())
    if max_rows is None:
        if strict:
            events = _last_at_each_time(events, _over_entity())
        previous = F.lag(_snapshot(attributes)).over(_over_entity())
        return events.withColumn("_previous", previous).filter(_opens(attributes, strict)).drop("_previous")
    # The entity is null in no row of `events`.
    large = large_entities(events if sizes is None else sizes, max_rows)
    return _opening(_in_pieces(events, large), attributes, strict)


def versions(
    events: DataFrame,
    *,
    strict: bool = True,
    attributes: tuple[Attribute, ...] = ENTITY_ATTRIBUTES,
    sizes: DataFrame | None = None,
    max_rows: int | None = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Versions with `valid_from` and `valid_to`, from rows made by `entity_events`.

    `sizes` holds a `repo_name` per row, for counting rows per entity: `events` itself, or anything
    cheaper that has at least as many rows per entity. With `max_rows` None no entity is large.
    """
    names = [a.name for a in attributes]
    opened = _opened(events, strict, attributes, sizes, max_rows)
    if max_rows is None:
        found = opened.withColumn("valid_to", F.lead("event_created_at").over(_over_entity()))
    else:
        found = _ended(opened)
    return found.select("repo_name", *names, F.col("event_created_at").alias("valid_from"), "valid_to")


def change_log(
    events: DataFrame,
    *,
    strict: bool = True,
    attributes: tuple[Attribute, ...] = ENTITY_ATTRIBUTES,
    sizes: DataFrame | None = None,
    max_rows: int | None = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """The events that open versions, without looking for where these end. Options as for `versions`."""
    found = _opened(events, strict, attributes, sizes, max_rows)
    return found.select("repo_name", *[a.name for a in attributes], F.col("event_created_at").alias("valid_from"))


def dimension(events: DataFrame, attributes: tuple[Attribute, ...] = ENTITY_ATTRIBUTES, **options) -> DataFrame:
    """The versioned dimension: versions with their key and current flag."""
    found = versions(events, attributes=attributes, **options)
    return (
        found.withColumn("repo_version_key", version_key("repo_name", "valid_from"))
        .withColumn("is_current", F.col("valid_to").isNull())
        .select(*dimension_schema(attributes).fieldNames())
    )
