"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Each source has a target number of words.  Among all document rates between 0 and
``cap`` that take exactly that many words, the one nearest to the corpus (in
relative entropy) is an exponential tilt of the document's size, cut at the cap:

    rate(d) = min(cap, exp(lambda_s * size_d))

lambda solves the convex dual; its gradient is the source's words under the tilt
minus the target, its Hessian the size-weighted sum over the uncut documents.
Newton steps on it are kept inside a bracket that every evaluation narrows.

Rates depend on (source, size) alone, so the corpus is reduced once to counts of
(source, size, salt); every Newton step then aggregates that small table, with the
sums combined before the shuffle.  Each step is staged, and only one number (how
many sources are still off) reaches the driver.

Rounding into copies: within a source, by falling size, class totals are rounded
along the running sum of expected copies, and the words still off are then handed
out over ever smaller sizes, one copy a class.  A class's copies are dealt to its
documents by a hash.  Classes are split by a salt of the document's hash, so that
neither a hot source nor a hot size is ranked in one task.

Defined results: a null text has size 0 and nothing to take; a null source is a
source of its own, last in order; repeated rows stay and are dealt copies like
others; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, stage, text_or_empty

CAP = 3
SALTS = 64
STEPS = 40
TOLERANCE = 1e-6
FIXES = 8


def count_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``: pieces between white space, without the empty ones at the ends."""
    pieces = F.split(text, SPACES, -1)
    n = F.size(pieces)
    ends = F.when(F.element_at(pieces, 1) == "", 1).otherwise(0) + F.when((n > 1) & (F.element_at(pieces, -1) == ""), 1).otherwise(0)
    return (n - ends).cast("long")


def source_targets(sizes: DataFrame, cap: int = CAP) -> DataFrame:
    """(source, source_size, weight, target) from (source, words).

    Weights 1, 2, 3 repeat over the sources by code point, null last.  A target
    stops at ``cap`` times its source's size and its excess is shared by weight
    among the others.  The sources that stop are those with the least room for
    their weight, so one ordered running sum finds them without rounds.
    """
    # the ordering needs one row a source; the sums stay with it
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    room = F.col("source_size") * cap / F.col("weight")
    by_room = Window.orderBy(room, F.col("place"))
    whole = Window.partitionBy()
    t = sizes.select("source", F.col("words").alias("source_size")).withColumn("place", F.row_number().over(order))
    t = t.withColumn("weight", (F.pmod(F.col("place") - 1, F.lit(3)) + 1).cast("double")).withColumn("total", F.sum("source_size").over(whole).cast("double"))
    # before source k (by room) stopped sources take cap * size; the rest is shared by the weights from k on
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.col("total") - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * cap
    left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    t = t.withColumn("share", rest / left).withColumn("stops", F.col("share") * F.col("weight") > F.col("source_size") * cap)
    # once one source doesn't stop, none after it does
    t = t.withColumn("open_share", F.min(F.when(~F.col("stops"), F.struct(room.alias("r"), F.col("place"), F.col("share")))).over(whole)["share"])
    target = F.when(F.col("stops"), F.col("source_size") * F.lit(float(cap))).otherwise(F.col("open_share") * F.col("weight"))
    return t.select("source", "source_size", "weight", target.cast("double").alias("target"))


def exact(x: Column) -> Column:
    """Sum that doesn't depend on the order of the rows, so that reruns agree to the last bit."""
    return F.sum(x.cast("decimal(38,9)")).cast("double")


def solve_tilt(classes: DataFrame, targets: DataFrame, cap: int = CAP, steps: int = STEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """(source_key, tilt) by Newton's method on the dual; the tilt is for sizes in units of ``unit``.

    A target at the cap, at zero or without words has no finite tilt and gets none.
    """
    sums = classes.groupBy("source_key").agg(
        F.try_divide(F.sum(F.col("n") * F.col("size") * F.col("size")), F.sum(F.col("n") * F.col("size"))).alias("unit")
    )
    open_ = targets.where((F.col("source_size") > 0) & (F.col("target") < cap * F.col("source_size") * (1 - 1e-9)) & (F.col("target") > 0))
    state = stage(
        open_.join(sums, "source_key").select(
            "source_key", "target", "unit", F.lit(0.0).alias("tilt"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), F.lit(False).alias("done")
        ),
        "tilt",
    )
    rows = classes.where("size > 0").select("source_key", F.col("size").cast("double").alias("size"), F.col("n").cast("double").alias("n"))
    for _ in range(steps):
        z = F.col("tilt") * F.col("size") / F.col("unit")
        cut = z >= F.log(F.lit(float(cap)))
        rate = F.when(cut, F.lit(float(cap))).otherwise(F.exp(z))
        got = (
            rows.join(state.where(~F.col("done")).select("source_key", "tilt", "unit"), "source_key")
            .groupBy("source_key")
            .agg(
                exact(F.col("n") * F.col("size") * rate).alias("words"),
                exact(F.when(cut, 0.0).otherwise(F.col("n") * F.col("size") * F.col("size") / F.col("unit") * rate)).alias("slope"),
            )
        )
        off = F.col("words") - F.col("target")
        low = F.when(off < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(off >= 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - F.try_divide(off, F.col("slope"))
        inside = newton.isNotNull() & (F.col("lo").isNull() | (newton > F.col("lo"))) & (F.col("hi").isNull() | (newton < F.col("hi")))
        # without a bracket on the far side the step grows
        middle = (
            F.when(F.col("lo").isNull(), F.col("hi") * 2 - 1).when(F.col("hi").isNull(), F.col("lo") * 2 + 1).otherwise((F.col("lo") + F.col("hi")) / 2)
        )
        near = F.abs(off) <= tolerance * F.col("target")
        moved = (
            state.where(~F.col("done"))
            .join(got, "source_key")
            .withColumn("lo", low)
            .withColumn("hi", high)
            .select(
                "source_key", "target", "unit",
                F.when(near, F.col("tilt")).when(inside, newton).otherwise(middle).alias("tilt"),
                F.col("lo").alias("low"), F.col("hi").alias("high"), near.alias("done"),
            )
        )
        state = stage(moved.unionByName(state.where("done")), "tilt")
        if state.where(~F.col("done")).isEmpty():
            break
    return state.select("source_key", "tilt", "unit")


def round_classes(expected: DataFrame, cap: int = CAP, fixes: int = FIXES) -> DataFrame:
    """Whole copies for each (source, size) class from (n, rate); words come near the source's target.

    All windows run over a source's distinct sizes, so they are bounded by the
    longest document, not by the number of rows.
    """
    w = Window.partitionBy("source_key").orderBy(F.desc("size"))
    total = Window.partitionBy("source_key")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    t = expected.withColumn("upto", F.sum(F.col("n") * F.col("rate")).over(run))
    t = t.withColumn("copies", F.round("upto") - F.coalesce(F.lag(F.round("upto")).over(w), F.lit(0.0)))
    t = t.withColumn("copies", F.least(F.greatest("copies", F.lit(0.0)), F.col("n") * cap).cast("long")).drop("upto")
    for _ in range(fixes):
        off = F.col("target") - F.sum(F.col("copies") * F.col("size")).over(total)
        t = t.withColumn("off", off)
        room = F.when(F.col("off") > 0, F.col("copies") < F.col("n") * cap).otherwise(F.col("copies") > 0)
        use = room & (F.col("size") > 0) & (F.col("size") <= F.abs("off"))
        t = t.withColumn("use", F.when(use, F.col("size")).otherwise(0))
        t = t.withColumn("sum_use", F.sum("use").over(run))
        change = F.when((F.col("use") > 0) & (F.col("sum_use") <= F.abs("off")), F.signum("off").cast("long")).otherwise(F.lit(0))
        t = t.withColumn("copies", F.col("copies") + change).drop("off", "use", "sum_use")
    return t


def mix(docs: DataFrame, cap: int = CAP, source: str = "source", steps: int = STEPS, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """For every document: ``carry``, ``source``, ``size`` (words), ``source_size``, ``target``,
    ``rate`` (the tilt), ``copies`` and ``taken`` (words, repeats counted)."""
    # a null source and an empty one must not meet
    key = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source")))
    sized = stage(
        docs.select(*carry, F.col(source).cast("string").alias("source"), text_or_empty().alias("text"))
        .select(*carry, "source", count_words(F.col("text")).alias("size"), F.xxhash64(F.col("doc_id").cast("string"), "text").alias("order_key"))
        .withColumn("source_key", key)
        .withColumn("salt", F.pmod(F.col("order_key"), F.lit(SALTS)).cast("int")),
        "sizes",
    )
    salted = stage(sized.groupBy("source_key", "size", "salt").agg(F.count("*").alias("n"), F.first("source").alias("source")), "classes")
    classes = salted.groupBy("source_key", "size").agg(F.sum("n").alias("n"))
    words = salted.groupBy("source_key").agg(F.first("source").alias("source"), F.sum(F.col("n") * F.col("size")).alias("words"))
    targets = stage(source_targets(words.select("source", "words"), cap).withColumn("source_key", key), "targets")
    tilt = solve_tilt(classes, targets, cap, steps)
    rate = (
        F.when(F.col("target") <= 0, 0.0)
        .when(F.col("tilt").isNull(), F.lit(float(cap)))
        .otherwise(F.least(F.lit(float(cap)), F.exp(F.col("tilt") * F.col("size") / F.col("unit"))))
    )
    expected = classes.join(targets.select("source_key", "source_size", "target"), "source_key").join(tilt, "source_key", "left").withColumn("rate", rate)
    rounded = round_classes(expected.drop("tilt", "unit"), cap)
    # the class's copies, dealt over its salts: floor(copies / n) each, one more for the first of them
    by_salt = Window.partitionBy("source_key", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    dealt = (
        salted.select("source_key", "size", "salt", F.col("n").alias("mine"))
        .join(rounded.hint("merge"), ["source_key", "size"])  # both sides are dealt by the source and size anyway
        .withColumn("each", F.floor(F.col("copies") / F.col("n")))
        .withColumn("more", F.col("copies") - F.col("each") * F.col("n") - F.coalesce(F.sum("mine").over(by_salt), F.lit(0)))
        .select("source_key", "size", "salt", "source_size", "target", "rate", "each", "more")
    )
    nth = F.row_number().over(Window.partitionBy("source_key", "size", "salt").orderBy("order_key", *carry))
    # the ranks are dealt by these keys already, so a merge join moves only the class table; no broadcast
    out = sized.withColumn("nth", nth).join(dealt.hint("merge"), ["source_key", "size", "salt"])
    copies = (F.col("each") + F.when(F.col("nth") <= F.col("more"), 1).otherwise(0)).cast("int")
    out = out.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(1)))
    return out.select(*carry, "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def digest(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", "taken", "copies", "rate")
