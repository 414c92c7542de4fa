"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source size`` times. The expected
copies are summed along an order of the source, one offset below 1 is added, and a
document is taken once for every whole number its sum crosses. Only DataFrame
functions are used.

The order goes by size first, so each stretch of equal documents gets its share and
the words taken come near the target. The place of a document is its rank within a
block of (size class, hash) plus the count of the blocks before: no window ever holds
a whole source, so a source may have any part of all rows.

Cases: a null text has size 0; a null source is a source of its own and comes last; a
source of size 0 has target 0 and is not taken; repeated rows are ranked one by one;
an empty table gives an empty result. Columns of the input that are named like a
result column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import Scratch, n_words, without

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
SEED = 20240315
ADDED = ("size", "source_size", "target", "copies", "taken")
INNER = ("_source", "_class", "_block")
HASH = "_hash"
MOST_BROADCAST = 200_000  # rows of rates, some 80 bytes each


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``(_source, source_size)`` with the ``target`` of every source.

    With weights w and caps ``most * size``, resharing the excess of the capped sources
    until none is above its cap ends at ``min(cap, w * level)``. Sources reach their
    cap in the order of cap / w, so the level follows from sums along that order: it is
    what the sources not yet capped share by weight, at the first source that does not
    reach its cap by it. One row per source goes through these windows.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1)
    cap = (most * F.col("source_size")).cast("double")
    weighed = sizes.select("_source", "source_size", weight.alias("w"), cap.alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("_source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything).cast("double") - F.coalesce(
        F.sum("cap").over(before), F.lit(0.0)
    )
    level = weighed.withColumn("level", left / F.sum("w").over(onward))
    open_level = F.when(F.col("w") * F.col("level") < F.col("cap"), F.col("level"))
    # Where every source ends at its cap, no level is left open.
    shared = F.min_by("level", F.when(open_level.isNotNull(), F.col("cap") / F.col("w"))).over(everything)
    target = F.least("cap", F.coalesce(F.col("w") * F.col("shared"), F.col("cap")))
    return level.withColumn("shared", shared).select("_source", "source_size", target.alias("target"))


def _size_class(size: Column) -> Column:
    """Eight classes per doubling of the size: its bit length and leading four bits."""
    bits = F.length(F.bin(size))
    lead = F.call_function("shiftright", size, F.greatest(bits - 4, F.lit(0)))
    return (16 * bits + lead).cast("int")


def systematic_copies(
    docs: DataFrame,
    scratch: Scratch,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (copies * size)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    sized = (
        without(docs, [*ADDED, *INNER, HASH])
        .withColumn("size", n_words(F.col(text)))
        .withColumn("_source", F.col(source))
        .withColumn("_class", _size_class(F.col("size")))
        .withColumn(HASH, digest)
        .withColumn("_block", F.substring(HASH, 1, 2))
    )
    # At most sources * size classes * 256 rows, however many documents there are.
    blocks = scratch.save(
        sized.groupBy(*INNER).agg(F.count("*").alias("n"), F.sum("size").alias("words")), "blocks"
    )
    sources = targets(
        blocks.groupBy("_source").agg(F.sum("words").alias("source_size")), weights, most
    )
    earlier = (
        Window.partitionBy("_source")
        .orderBy("_class", "_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = blocks.select(*INNER, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    rated = placed.join(
        sources.withColumnRenamed("_source", "_name"), F.col("_source").eqNullSafe(F.col("_name"))
    ).select(*INNER, "_before", "source_size", "target")
    rated = scratch.save(rated.select(*[F.col(c).alias(f"_r{c}") for c in rated.columns]), "rated")
    if rated.count() <= MOST_BROADCAST:  # else the join sorts whole rows once more
        rated = F.broadcast(rated)

    within = Window.partitionBy(*INNER).orderBy(
        "size", HASH, F.col(key), F.xxhash64(F.col(text))
    )
    ranked = sized.withColumn("_rank", F.row_number().over(within))
    same = (
        F.col("_source").eqNullSafe(F.col("_r_source"))
        & (F.col("_class") == F.col("_r_class"))
        & (F.col("_block") == F.col("_r_block"))
    )
    joined = ranked.join(rated, same, "left")
    rate = F.coalesce(F.col("_rtarget") / F.nullif(F.col("_rsource_size"), F.lit(0)), F.lit(0.0))
    drawn = F.substring(F.md5(F.concat_ws(":", F.lit(f"offset-{seed}"), F.col("_source"))), 1, 5)
    offset = F.conv(drawn, 16, 10).cast("double") / (16**5)
    place = F.col("_r_before") + F.col("_rank")
    copies = F.floor(place * rate + offset) - F.floor((place - 1) * rate + offset)
    return joined.select(
        *[F.col(f"`{c}`") for c in without(docs, [*ADDED, *INNER, HASH]).columns],
        "size",
        F.col("_rsource_size").alias("source_size"),
        F.col("_rtarget").alias("target"),
        F.least(copies, F.lit(most)).cast("long").alias("copies"),
    ).withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The mixture itself: every row of ``docs``, whole, as often as it is taken."""
    taken_names = {*ADDED, *INNER, HASH}
    inner = {c: f"_kept_{i}" if c.lower() in taken_names else c for i, c in enumerate(docs.columns)}
    counted = systematic_copies(docs.withColumnsRenamed(inner), scratch, **options)
    copy = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")
    rows = counted.where("copies > 0").select(*[F.col(f"`{n}`").alias(c) for c, n in inner.items()], copy)
    return rows.drop("_copy")
