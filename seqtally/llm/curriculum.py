"""Mixing sources to target weights along a time-varying curriculum, with
DataFrame operations only.

Every source has a *schedule*: knots (at, weight) over the training time 0..1,
linear in between.  Its integral is the source's weight; the weights share the
budget, a source takes at most ``CAP`` times its own words, and what is above is
shared again by weight until no source is above (``targets``).

A source's documents lie one after the other on a *tape*, in the order of a hash,
and the tape repeats when it is used up.  The words that the mix has demanded of
a source by time t are its target times the integral of its schedule up to t;
inverting that integral at the place where a document begins gives the time of
each of its passes, its training position.  Documents are range-sorted by
position.  The tape is cut at the target, so the last document may be taken in
part and a source's words come to its rounded target exactly.

The place on the tape is a prefix sum without a task per source: rows alike in
(source, doc_id, size) are one entry with a count, entries are dealt by (source,
slice of the hash), the slices' totals are summed up per source, and a window
runs within a slice only.  There are four slices for each shuffle partition, so
that a source with a third of all rows spreads evenly; neither their number nor
the partitioning changes the result.

Defined results: a null or blank text has size 0 and is taken with 0 words; a
null source is a source of its own; a source without a schedule, or with one that
weighs nothing, has target 0; rows alike share the tape one after the other, so
that they may be taken with different words; null and repeated doc_ids give a row
for each row; an empty table gives no rows; further columns play no part."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqtally.llm._files import staged
from seqtally.operators._util import broadcast_if_small
from seqtally.operators.index import with_index

#: A source gives at most so many times its own words.
CAP = 3
#: Copies of a document that one task makes rows of.
COPIES = 4096
#: Bits of the hash that orders a tape.
HASH_BITS = 60

KNOTS = "array<struct<at:double,weight:double>>"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """A source as a join key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def entries(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, key, place, n: the distinct rows of ``docs``
    (doc_id, source, text) with their number of copies, staged.  The texts are
    read once; a row of numbers per distinct row is shuffled."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    place = F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("long")
    one = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    return staged(one.withColumn("key", _key(F.col("source"))).withColumn("place", place), "tape-entries")


def cyclic_schedules(sources: DataFrame, weights=(5, 2, 1)) -> DataFrame:
    """source, knots: sources in code point order (null last) weigh ``weights``
    in turn.  The first of each turn fades from one and a half times its weight
    to a half, the last one grows likewise, the others are even; the integrals
    are the weights."""
    ranked = with_index(sources.select("source"), [F.col("source").asc_nulls_last()], "_rank")
    turn = (F.col("_rank") % len(weights)).cast("int")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn + 1)
    tilt = F.when(turn == 0, 0.5).when(turn == len(weights) - 1, -0.5).otherwise(0.0)
    knot = lambda at, share: F.struct(F.lit(at).alias("at"), (weight * share).alias("weight"))
    return ranked.select("source", F.array(knot(0.0, 1 + tilt), knot(1.0, 1 - tilt)).cast(KNOTS).alias("knots"))


def _segments(knots: Column) -> Column:
    """The pieces between knots with their areas and the area before them."""
    pieces = F.transform(F.slice(knots, 2, F.greatest(F.size(knots) - 1, F.lit(0))), lambda b, i: F.struct(
        F.get(knots, i)["at"].alias("t0"), F.get(knots, i)["weight"].alias("w0"),
        (b["at"] - F.get(knots, i)["at"]).alias("d"), b["weight"].alias("w1"),
        ((F.get(knots, i)["weight"] + b["weight"]) / 2 * (b["at"] - F.get(knots, i)["at"])).alias("area")))
    before = lambda i: F.aggregate(F.slice(pieces, 1, i), F.lit(0.0), lambda a, p: a + p["area"])
    return F.transform(pieces, lambda p, i: F.struct(
        p["t0"].alias("t0"), p["w0"].alias("w0"), p["d"].alias("d"), p["w1"].alias("w1"),
        p["area"].alias("area"), before(i).alias("before")))


def source_sizes(tape: DataFrame) -> DataFrame:
    """source, key, source_size of staged entries: a row per source, staged."""
    return staged(tape.groupBy("source", "key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")),
                  "source-sizes")


def targets(sizes: DataFrame, schedules: DataFrame, budget: int | None = None, cap: float = CAP) -> DataFrame:
    """source, key, source_size, segments, weight, target.  ``budget`` words
    (default: all sizes) are shared by weight; a source above ``cap`` times its
    size stops there and the excess is shared again.  Each turn is one aggregate
    over the sources, and two numbers come to the driver."""
    own = schedules.select(_key(F.col("source")).alias("key"), F.col("knots").cast(KNOTS).alias("knots"))
    planned = sizes.join(broadcast_if_small(own), "key", "left").select(
        "source", "key", "source_size", _segments(F.coalesce("knots", F.array().cast(KNOTS))).alias("segments"))
    weight = F.aggregate("segments", F.lit(0.0), lambda a, s: a + s["area"])
    most = F.col("source_size").cast("double") * cap
    planned = staged(planned.withColumn("weight", weight).withColumn("most", most), "source-targets")

    def above(rest: float, weights: float) -> Column:
        return F.col("weight") * F.lit(rest) > F.col("most") * F.lit(weights)
    start = planned.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget = float((start["size"] or 0) if budget is None else budget)
    rest, weights = budget, float(start["weight"] or 0)
    while weights > 0:
        over = above(rest, weights)
        r = planned.agg(F.sum(F.when(over, F.col("most"))).alias("full"),
                        F.sum(F.when(~over, F.col("weight"))).alias("weight")).first()
        now = (budget - (r["full"] or 0.0), r["weight"] or 0.0)
        if now == (rest, weights):
            break
        if now[1] == 0:
            rest, weights = math.inf, 1.0
            break
        rest, weights = now
    share = F.when(F.col("weight") == 0, 0.0)
    if weights > 0:
        share = (share.when(above(rest, weights), F.col("most"))
                 .otherwise(F.col("weight") * F.lit(rest) / F.lit(weights)))
    return planned.withColumn("target", F.coalesce(share, F.lit(0.0))).drop("most")


def _time(share: Column) -> Column:
    """The time by which ``share`` of a schedule's integral has passed; what
    lies beyond the whole integral follows behind 1."""
    area = share * F.col("weight")
    inside = F.filter("segments", lambda s: s["before"] <= area)
    s = F.element_at(inside, -1)
    more = F.greatest(area - s["before"], F.lit(0.0))
    slope = (s["w1"] - s["w0"]) / s["d"]
    root = F.sqrt(F.greatest(s["w0"] * s["w0"] + 2 * slope * more, F.lit(0.0)))
    u = F.when(more > 0, 2 * more / (s["w0"] + root)).otherwise(0.0)
    return F.when(share >= 1, share).otherwise(s["t0"] + F.least(u, s["d"]))


def mixing_plan(docs: DataFrame, schedules=cyclic_schedules, budget: int | None = None, cap: float = CAP) -> DataFrame:
    """A row per row of ``docs`` (doc_id, source, text), range-sorted by
    position: doc_id, source, size, source_size, target, taken (words that the
    mix takes of it, repeats counted), position (the time at which it first comes
    in; beyond 1: never), times (of each of its passes, at most ``cap`` and one).
    ``schedules``: source and knots, or a function of a table of sources."""
    tape = entries(docs)
    sizes = source_sizes(tape)
    share = targets(sizes, schedules(sizes) if callable(schedules) else schedules, budget, cap)
    bits = max(0, min(40, math.ceil(math.log2(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))))
    cut = F.shiftright("place", HASH_BITS - bits)
    tape = tape.withColumn("slice", cut).withColumn("words", F.col("size") * F.col("n"))

    before = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = (tape.groupBy("key", "slice").agg(F.sum("words").alias("total"))
              .select("key", "slice", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("begin")))
    offsets = staged(totals.join(broadcast_if_small(share.drop("source")), "key"), "tape-offsets")
    inside = (Window.partitionBy("key", "slice").orderBy("place", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    own = tape.withColumn("inside", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    placed = own.join(broadcast_if_small(offsets), ["key", "slice"])
    # copies of one entry: a row for each block of them, dealt out, then a row each
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long")))
    dealt = placed.withColumn("block", block).repartition("key", "place", "block")
    each = dealt.withColumn("copy", F.explode(F.sequence(
        F.col("block"), F.least(F.col("n"), F.col("block") + COPIES) - 1)))
    each = each.withColumn("start", F.col("begin") + F.col("inside") + F.col("copy") * F.col("size"))

    cut_at = F.floor(F.col("target") + 0.5).cast("long")
    each = each.withColumn("length", cut_at)
    whole = F.when(F.col("source_size") > 0, F.expr("length div source_size")).otherwise(0)
    each = each.withColumn("whole", whole).withColumn("over", F.expr("length - whole * source_size"))
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("over") - F.col("start")))
    passes = F.col("whole") + F.when(last > 0, 1).otherwise(0)
    demanded = lambda i: (i * F.col("source_size") + F.col("start")).cast("double") / F.col("length")
    unused = 2 + F.col("start").cast("double") / F.greatest("source_size", F.lit(1))
    position = F.when(F.col("length") > 0, _time(demanded(F.lit(0)))).otherwise(unused)
    times = F.when(passes > 0, F.transform(F.sequence(F.lit(0).cast("long"), passes - 1), lambda i: _time(demanded(i))))
    out = each.select("doc_id", "source", "size", "source_size", "target",
                      (F.col("whole") * F.col("size") + last).cast("long").alias("taken"), position.alias("position"),
                      F.coalesce(times, F.array().cast("array<double>")).alias("times"))
    return out.orderBy("position", "source", "doc_id", "size")


def training_order(plan: DataFrame) -> DataFrame:
    """The mix: a row for each pass of a document, range-sorted by its training
    position: position, doc_id, source, pass, words (the last pass of a source
    may end within a document)."""
    each = plan.filter("taken > 0").select("doc_id", "source", "size", "taken", F.posexplode("times").alias("pass", "position"))
    words = F.least("size", F.col("taken") - F.col("pass") * F.col("size"))
    return (each.select("position", "doc_id", "source", "pass", words.alias("words"))
            .orderBy("position", "source", "doc_id", "pass"))
