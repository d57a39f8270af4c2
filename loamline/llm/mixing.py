"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

1. Targets: sources share the whole size by weight; a source stops at ``most`` times its size and
   the excess is reshared by weight (closed form over one row per source).
2. Expected copies of a document: in its source proportional to the bit length of its size, at most ``most``, so
   that the source's expected words meet its target (closed form over one row per source and length).
3. The whole part of the expected copies is allocated with certainty. For the fraction, the inclusion
   odds, documents are ranked by random odds divided by inclusion odds, and each source
   takes its ranking's head up to the words that its target still lacks.

The head of a ranking is found by counting words in slots of the rank, twice, so that a hot source is
never sorted in one task: only the last slot's documents are.

Rows that repeat a doc_id, text and source are numbered from 0, and the number is part of what their random odds are
drawn from: each of them is taken or left by itself. The numbering is dealt over parts, so a text that a third of all
rows repeat is not numbered in one task.

Defined results: a null text has size 0 and takes nothing; a null source is a source of its own, last
in order; repeated rows are mixed each by itself, ties of the rank are settled by doc_id, text hash and number; no
rows give no rows; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.scratch import materialize

SLOTS = 512
#: Repeated rows of one part that one task numbers, about.
PER_PART = 1_000_000
LEAST_PARTS = 64
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shares(parts: DataFrame, total: Column, weight: Column, cap: Column, group: list[str], key: str) -> DataFrame:
    """``parts`` with ``share``: min(cap, weight x level), the level such that a group's shares sum to its total.

    One row per part; ``key`` settles ties.
    """
    ratio = F.when(weight > 0, cap / weight).otherwise(F.lit(0.0))
    df = parts.withColumns({"_w": weight.cast("double"), "_cap": cap.cast("double"), "_total": total.cast("double")}).withColumn("_r", ratio)
    order = Window.partitionBy(*group).orderBy("_r", F.col(key).asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(onward)
    df = df.withColumn("_level", F.when(F.sum("_w").over(onward) > 0, level))
    # the first part that its level does not fill is where filling stops
    stop = F.min(F.when(F.col("_r") >= F.col("_level"), F.struct("_r", "_level"))).over(Window.partitionBy(*group))
    df = df.withColumn("_stop", stop["_level"])
    share = F.coalesce(F.least(F.col("_cap"), F.col("_w") * F.col("_stop")), F.col("_cap"))
    return df.withColumn("share", share).drop("_w", "_cap", "_total", "_r", "_level", "_stop")


def source_targets(sized: DataFrame, *, source: str, size: str, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """(source, source_size, target) for each source; weights repeat over sources by code point, null last."""
    each = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    # one row per source from here
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    each = each.withColumn("_weight", weight).withColumn("_one", F.lit(0))
    each = each.withColumn("_all", F.sum("source_size").over(Window.partitionBy("_one")))
    out = shares(each, F.col("_all"), F.col("_weight"), F.lit(most) * F.col("source_size"), ["_one"], "source")
    return out.select("source", "source_size", F.col("share").alias("target"))


def numbered(rows: DataFrame, keys: list[str], row: str, into: str) -> DataFrame | None:
    """(row, into): a number from 0 for each row of a written table that shares its keys with another; None if no row does."""
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    often = materialize(rows.groupBy(*keys).agg(F.count("*").alias("_times")).where("_times > 1"), "repeated")
    most = often.agg(F.max("_times")).first()[0]
    if most is None:
        return None
    parts = max(LEAST_PARTS, most // PER_PART + 1)
    again = rows.alias("a").join(often.alias("b"), same("a", "b"), "left_semi").withColumn("_part", F.pmod(F.xxhash64(row), F.lit(parts)))
    again = materialize(again, "repeats")
    sizes = again.groupBy(*keys, "_part").agg(F.count("*").alias("_in_part"))
    before = F.sum("_in_part").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(*keys, "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(row))
    inside = again.withColumn("_place", place).alias("a")
    met = inside.join(sizes.alias("b"), [*same("a", "b"), F.col("a._part") == F.col("b._part")])
    return met.select(F.col(f"a.{row}").alias(row), (F.col("_before") + F.col("_place") - 1).cast("long").alias(into))


def with_mix(docs: DataFrame, into: str, *, source: str = "source", text: str = "text", doc_id: str = "doc_id", seed: int = 7, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with a struct ``into``: size, source_size, target, copies (0 to ``most``) and taken = copies x size.

    ``keep`` names the columns of ``docs`` that the result has (all, if it is not given); others are not written on the way.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != into]
    q = lambda c: F.col(f"`{c}`")
    sized = docs.select(
        F.struct(*[q(c) for c in kept]).alias("_d"), word_count(q(text)).alias("_size"), q(source).alias("_source"), F.xxhash64(q(text)).alias("_h"), q(doc_id).alias("_id"), F.monotonically_increasing_id().alias("_row")
    )
    sized = materialize(sized, "sized")  # the row numbers are fixed from here
    again = numbered(sized.select("_id", "_h", "_source", "_row"), ["_id", "_h", "_source"], "_row", "_copy")
    # without repeated rows nothing is joined, and texts stay where they are
    sized = sized.withColumn("_copy", F.lit(0).cast("long")) if again is None else sized.join(again, "_row", "left").withColumn("_copy", F.coalesce("_copy", F.lit(0).cast("long")))
    keys = sized.select("_row", "_id", "_h", "_copy", "_size", "_source")
    keys = keys if again is None else materialize(keys, "sizes")
    targets = materialize(source_targets(keys, source="_source", size="_size", weights=weights, most=most), "targets")

    # expected copies by source and bit length of the size
    length = F.length(F.bin(F.col("_size")))
    bins = keys.where("_size > 0").groupBy("_source", length.alias("_bits")).agg(F.sum("_size").alias("_words"))
    bins = bins.join(targets, F.col("_source").eqNullSafe(F.col("source"))).drop("source")
    bins = shares(bins, F.col("target"), F.col("_bits") * F.col("_words"), F.lit(most) * F.col("_words"), ["_source"], "_bits")
    bins = bins.withColumn("_copies", F.col("share") / F.col("_words"))
    bins = materialize(
        bins.select(F.col("_source").alias("_s"), F.col("_bits").alias("_b"), F.floor("_copies").alias("_certain"), (F.col("_copies") - F.floor("_copies")).alias("_pi"),
                    (F.col("share") - F.floor("_copies") * F.col("_words")).alias("_lack")), "copies"
    )

    # rank = random odds over inclusion odds, as a number from 0 to 1 that keeps the order
    u = (F.shiftrightunsigned(F.xxhash64("_id", "_h", F.lit(seed), "_copy"), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    odds = u / (1 - u) * (1 - F.col("_pi")) / F.col("_pi")
    ranked = keys.where("_size > 0").withColumn("_bits", length).join(bins, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_bits") == F.col("_b")))
    ranked = ranked.where("_pi > 0").select("_row", "_id", "_h", "_copy", "_size", "_source", (odds / (1 + odds)).alias("_rank"))
    ranked = materialize(ranked, "ranked")
    lacking = bins.groupBy(F.col("_s").alias("source")).agg(F.sum("_lack").alias("lack"))

    # the slot of the rank in which a source's words reach what it lacks, found in two steps
    found = lacking.withColumns({"low": F.lit(0.0), "width": F.lit(1.0), "before": F.lit(0.0)})
    for _ in range(2):
        inside = ranked.join(found, ranked["_source"].eqNullSafe(found["source"]))
        slot = F.floor((F.col("_rank") - F.col("low")) / F.col("width") * SLOTS)
        inside = inside.where((F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("low") + F.col("width")))
        words = inside.groupBy("source", "lack", "low", "width", "before", slot.alias("slot")).agg(F.sum("_size").alias("words"))
        order = Window.partitionBy("source").orderBy("slot")
        words = words.withColumn("until", F.col("before") + F.sum("words").over(order))
        last = words.where(F.col("until") >= F.col("lack")).groupBy("source").agg(F.min(F.struct("slot", "lack", "low", "width", F.col("until").alias("u"), "words")).alias("x"))
        found = materialize(
            last.select("source", "x.lack", (F.col("x.low") + F.col("x.slot") * F.col("x.width") / SLOTS).alias("low"), (F.col("x.width") / SLOTS).alias("width"),
                        (F.col("x.u") - F.col("x.words")).alias("before")), "slots"
        )
    # the last slot's documents, in order, up to what is lacking; the gap is left to one document more
    found = found.select(*[F.col(c).alias(f"_{c}" if c != "source" else "_at") for c in found.columns])
    edge = ranked.join(found, F.col("_source").eqNullSafe(F.col("_at"))).where((F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_low") + F.col("_width")))
    order = Window.partitionBy("_source").orderBy("_rank", F.col("_id").asc_nulls_last(), "_h", "_copy").rowsBetween(Window.unboundedPreceding, 0)
    heads = edge.withColumn("_until", F.col("_before") + F.sum("_size").over(order)).where("_until <= _lack")
    heads = heads.groupBy(F.col("_at").alias("_at2")).agg(F.max(F.struct("_rank", "_until")).alias("x"))
    limits = found.join(heads, F.col("_at").eqNullSafe(F.col("_at2")), "left").select(
        "_at", F.coalesce("x._rank", "_low").alias("_cut"), F.col("x").isNotNull().alias("_closed"), (F.col("_lack") - F.coalesce("x._until", "_before")).alias("_gap")
    )
    limits = materialize(limits, "limits")
    beyond = (F.col("_rank") > F.col("_cut")) | ((F.col("_rank") == F.col("_cut")) & ~F.col("_closed"))
    # of the documents beyond, the one whose size comes nearest to the gap
    rest = ranked.join(limits, F.col("_source").eqNullSafe(F.col("_at"))).where(beyond & (F.col("_size") < 2 * F.col("_gap")))
    fill = rest.groupBy(F.col("_at").alias("_at2")).agg(F.min(F.struct(F.abs(F.col("_size") - F.col("_gap")).alias("d"), "_rank", "_id", "_h", "_copy", "_row")).alias("_fill"))
    limits = materialize(limits.join(fill, F.col("_at").eqNullSafe(F.col("_at2")), "left").select("_at", "_cut", "_closed", "_fill"), "filled")

    # every document again: certain copies, and one more at the head of its source's ranking
    t = targets.select(F.col("source").alias("_ts"), "source_size", "target")
    whole = sized.withColumn("_bits", length).join(t, F.col("_source").eqNullSafe(F.col("_ts")), "left")
    whole = whole.join(bins, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_bits") == F.col("_b")), "left")
    whole = whole.join(limits, F.col("_source").eqNullSafe(F.col("_at")), "left")
    rank = F.when(F.col("_pi") > 0, odds / (1 + odds))
    # a source without a limit lacks more than its ranking holds: it takes all of it
    inside = F.col("_cut").isNull() | (rank < F.col("_cut")) | ((rank == F.col("_cut")) & F.col("_closed"))
    head = F.coalesce(rank.isNotNull() & (inside | (F.col("_row") == F.col("_fill._row"))), F.lit(False))
    copies = F.when(F.col("_size") > 0, F.coalesce(F.col("_certain"), F.lit(0)) + head.cast("long")).otherwise(F.lit(0)).cast("long")
    result = F.struct(F.col("_size").alias("size"), "source_size", "target", copies.alias("copies"), (copies * F.col("_size")).alias("taken"))
    return whole.select("_d", result.alias("_mix")).select(*[F.col(f"_d.`{c}`") for c in kept], F.col("_mix").alias(into))
