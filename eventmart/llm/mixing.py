"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents, shuffled by a hash, form a tape of words, begun again at its end, and cut into
blocks of equal length. The mix is a sequence of slots. Slot i has the point i times the golden ratio
modulo 1; the source whose part of the cumulative weights holds the point fills the slot, and the r-th
slot of a source takes the r-th block of its tape. All of this is done by joins: ranks of slots and offsets
of documents are running sums in two levels, so that no task holds a whole source.

A source's target is its share of all words by weight, at most `MOST` times its own words; what is cut
off goes to the others by weight. It takes its target rounded down: its last block is cut short, slots
it does not need are left out, and those the schedule has not given it follow at the end.

Defined cases: a null or empty text has no words and nothing of it is taken; a null source is a source of
its own, last in order; repeated rows are documents of their own, numbered among equals; without
documents or words the mix is empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.sources.staging import stage

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
# The mix has about so many blocks, none shorter than the second number of words.
BLOCKS = 1 << 20
LEAST_BLOCK = 64
# 2 ** 32 divided by the golden ratio, made odd: slot i has the point i * GOLDEN mod 2 ** 32.
GOLDEN = 2654435769
POINTS = 1 << 32
# Points are looked up by slices.
SLICES = 1024
# Running sums go over parts of about so many rows.
PART = 1 << 12

_SPACES = "\t\n\x0b\x0c\r"
_BEFORE = (Window.unboundedPreceding, -1)


def n_words(text: Column) -> Column:
    """Words of `[^\\x20\\x09-\\x0D]+` in a text; none in null."""
    plain = F.trim(F.translate(text, _SPACES, " " * len(_SPACES)))
    return F.when(F.length(plain) > 0, F.size(F.split(plain, " +"))).otherwise(0).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """(source, source_size, rank, target), from (source, source_size) with one row for each source.

    Sources in order of their names by code point, null last, have the weights in turn. In order of
    limit over weight, the first are at their limit, and the others share the rest by weight.
    """
    row = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    given = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("rank") - 1, len(weights)) + 1)
    row = row.withColumn("weight", given).withColumn("limit", F.col("source_size") * F.lit(float(MOST)))
    row = row.withColumn("need", F.col("limit") / F.col("weight"))
    order = Window.orderBy("need", "rank")
    rest = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(
        F.sum("limit").over(order.rowsBetween(*_BEFORE)), F.lit(0.0)
    )
    others = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    row = row.withColumn("level", rest / others)
    # The first source below its limit sets the level of all that follow it.
    first = F.min(F.when(F.col("level") <= F.col("need"), F.struct("need", "rank", "level"))).over(Window.partitionBy())
    row = row.withColumn("first", first)
    target = F.least("limit", F.col("first.level") * F.col("weight"))
    return row.select("source", "source_size", "rank", F.coalesce(target, F.col("limit")).alias("target"))


def _running(rows: DataFrame, part: str, order: list[str], value: str, name: str) -> DataFrame:
    """`rows` with the sum of `value` over all rows of the same rank before each.

    Parts are in order, and rows within a part.
    """
    sums = rows.groupBy("rank", part).agg(F.sum(value).alias("_sum"))
    earlier = F.sum("_sum").over(Window.partitionBy("rank").orderBy(part).rowsBetween(*_BEFORE))
    sums = sums.select("rank", part, F.coalesce(earlier, F.lit(0)).alias("_earlier"))
    within = F.sum(value).over(Window.partitionBy("rank", part).orderBy(*order).rowsBetween(*_BEFORE))
    rows = rows.withColumn("_within", F.coalesce(within, F.lit(0)))
    joined = rows.join(sums, ["rank", part])
    return joined.withColumn(name, F.col("_earlier") + F.col("_within")).drop("_earlier", "_within")


def mix(
    docs: DataFrame,
    id_: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[float] = WEIGHTS,
    seed: str = "",
) -> tuple[DataFrame, DataFrame]:
    """(documents, schedule).

    Documents: (id, copy, source, size, source_size, target, taken, first_slot), one row for each of
    `docs`. Schedule: (slot, source, block, id, copy, n_words), what each slot takes from each document
    of its block.
    """
    shuffled = F.sha2(F.concat_ws("|", F.lit(seed), F.col(f"`{id_}`").cast("string")), 256)
    rows = docs.select(
        F.col(f"`{id_}`").alias("id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        n_words(F.col(f"`{text}`").cast("string")).alias("size"),
        shuffled.alias("key"),
    )
    rows, seen = stage(rows, "mix-rows", total=F.coalesce(F.sum("size"), F.lit(0)), n=F.count(F.lit(1)))
    block = max(LEAST_BLOCK, -(-seen["total"] // BLOCKS))
    sources, slots = _sources(rows, block, weights)
    placed = _tapes(rows, sources, seen["n"])
    pieces = _pieces(placed, block)
    taken = _schedule(sources, slots).join(pieces, ["rank", "block"])
    schedule = taken.join(sources.select("rank", "source"), "rank")
    schedule = schedule.select("slot", "source", "block", "id", "copy", "n_words")
    sums = taken.groupBy("number").agg(F.sum("n_words").alias("taken"), F.min("slot").alias("first_slot"))
    documents = placed.join(sums, "number", "left").select(
        "id", "copy", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot",
    )
    return documents, schedule


def _sources(rows: DataFrame, block: int, weights: Sequence[float]) -> tuple[DataFrame, int]:
    """Each source with its target, its number of slots and its part of the points; slots in all."""
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    sources = sources.withColumn("words", F.floor("target")).withColumn("slots", F.ceil(F.col("words") / block))
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("words").over(Window.orderBy("rank").rowsBetween(*_BEFORE)), F.lit(0))
    share = before.cast("double") / F.greatest(F.sum("words").over(everything), F.lit(1))
    sources = sources.withColumn("low", F.floor(share * POINTS))
    sources = sources.withColumn("high", F.lead("low", 1, POINTS).over(Window.orderBy("rank")))
    sources, seen = stage(sources, "mix-sources", slots=F.coalesce(F.sum("slots"), F.lit(0)))
    return sources, seen["slots"]


def _tapes(rows: DataFrame, sources: DataFrame, count: int) -> DataFrame:
    """Documents with their offset on their source's tape and a number of their own."""
    named = sources.withColumnRenamed("source", "_name")
    placed = rows.join(named, F.col("source").eqNullSafe(F.col("_name"))).drop("_name")
    # Parts of the range of keys; rows with a null id, whose keys are all alike, are spread by size.
    high = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    placed = placed.withColumn("part", F.floor(high * max(1, count // PART) / POINTS))
    alike = Window.partitionBy("rank", "key", "size").orderBy("id")
    placed = placed.withColumn("copy", F.row_number().over(alike))
    placed = _running(placed, "part", ["key", "size", "copy"], "size", "offset")
    return stage(placed.withColumn("number", F.xxhash64("rank", "key", "size", "copy")), "mix-tapes")[0]


def _pieces(placed: DataFrame, block: int) -> DataFrame:
    """(rank, block, id, copy, number, n_words): what each document has of each block that is taken."""
    used = placed.filter((F.col("size") > 0) & (F.col("words") > 0))
    rounds = F.sequence(F.lit(0).cast("long"), F.floor((F.col("words") - 1) / F.col("source_size")))
    used = used.withColumn("round", F.explode(rounds))
    used = used.withColumn("begin", F.col("round") * F.col("source_size") + F.col("offset"))
    used = used.withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("words"))).filter("end > begin")
    blocks = F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block))
    used = used.withColumn("block", F.explode(blocks))
    own = F.least("end", (F.col("block") + 1) * block) - F.greatest("begin", F.col("block") * block)
    return used.select("rank", "block", "id", "copy", "number", own.alias("n_words"))


def _schedule(sources: DataFrame, count: int) -> DataFrame:
    """(slot, rank, block): the block of its source's tape that each slot takes."""
    spark = sources.sparkSession
    slots = spark.range(count).select(
        F.col("id").alias("slot"),
        F.pmod(F.col("id") * F.lit(GOLDEN), F.lit(POINTS)).alias("point"),
        F.floor(F.col("id") / PART).alias("part"),
    )
    used = sources.filter("slots > 0 and high > low").select("rank", "low", "high", "slots")
    width = POINTS // SLICES
    slices = F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))
    hits = slots.withColumn("slice", F.floor(F.col("point") / width))
    hits = hits.join(used.withColumn("slice", F.explode(slices)), "slice").filter("point >= low and point < high")
    hits = _running(hits.withColumn("one", F.lit(1)), "part", ["slot"], "one", "block")
    given = hits.groupBy("rank").agg(F.count(F.lit(1)).alias("given"))
    lacking = sources.join(given, "rank", "left").withColumn("given", F.coalesce("given", F.lit(0)))
    rest = F.sequence(F.col("given"), F.col("slots") - 1)
    lacking = lacking.filter("given < slots").select(
        (F.lit(count) + F.col("rank")).alias("slot"), "rank", F.explode(rest).alias("block")
    )
    return hits.filter("block < slots").select("slot", "rank", "block").unionByName(lacking)
