"""Mixing sources to target weights by entropy balancing.

Documents get rates between 0 and 2. Of all rates that give each source its target number of words, the
ones closest to one copy each in (bounded) relative entropy have the form ``2 / (1 + exp(-b * x))``: an
exponential tilt by the document's size x over the mean size of its source, with one multiplier b per
source. The multipliers minimise a convex dual; Newton steps with exact derivatives, kept inside a shrinking
bracket, find them for all sources at once. Every step is one aggregate over the counts of (source, size).

Rates become copies by systematic rounding: documents of a source are lined up by size, and a document gets
one copy more wherever the running sum of the fractions passes a whole number. The words taken from a
source therefore miss its target by less than one document; of some starting values for the sum, each source takes
the one that misses least.

Sums are of decimals or whole numbers, which do not depend on the order of tasks, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.llm.common import fresh, staged, table, without

# Fixed values of the contract: weights by place of the source, words of the mix, copies of a document.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
WORD = "[^\\x20\\x09-\\x0D]+"

TOLERANCE = 1e-9
STEPS = 100
# Documents of one (source, size) that are ranked together, about.
RANKED = 256
UNIT = 10**6
# Places tried for the cut between documents with and without one copy more.
CUTS = 16


def word_count(text: Column) -> Column:
    """Number of maximal runs without white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target: the target words of each source, from ``source`` and ``size``.

    Sources in code point order, null last, weigh 5, 2, 1, 5, ... and share 1.5 times all words; a source
    stops at twice its size and its excess goes to the others by weight. With sources ordered by
    size over weight, those below the water level are exactly a prefix. One row per source is ranked.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(place) - 1, F.lit(len(WEIGHTS)))
    weight = F.lit(float(WEIGHTS[0]))
    for i, w in enumerate(WEIGHTS):
        weight = F.when(turn == i, float(w)).otherwise(weight)
    cap = F.col("source_size") * float(MOST)
    filled = Window.orderBy("level", F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ranked = (
        sums.withColumn("weight", weight)
        .withColumn("level", cap / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * SHARE)
        .withColumn("capped", F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
        .withColumn("try", (F.col("total") - F.col("capped")) / F.sum("weight").over(after))
    )
    # The water level: what the first source that is not capped would get per weight.
    level = F.min(F.when(F.col("level") >= F.col("try"), F.struct("level", "try"))).over(everything)["try"]
    water = F.coalesce(level, F.max("level").over(everything))
    return ranked.withColumn("water", water).select(
        "source", "source_size", F.least(cap, F.col("weight") * F.col("water")).alias("target")
    )


def _exact(value: Column) -> Column:
    return F.round(value, 6).cast("decimal(30,6)")


def _rate(b: Column, size: Column, mean: Column) -> Column:
    return MOST / (1 + F.exp(-b * size / mean))


def multipliers(groups: DataFrame, targets: DataFrame) -> DataFrame:
    """source, mean, full, b: the dual solution; ``full`` sources take every document twice.

    ``groups``: source, size, n. Sources without words keep b = 0.
    """
    means = groups.where("size > 0").groupBy("source").agg(
        (F.sum(F.col("n") * F.col("size")).cast("double") / F.sum("n")).alias("mean")
    )
    t, m = targets.alias("t"), means.alias("m")
    state = t.join(m, F.col("t.source").eqNullSafe(F.col("m.source")), "left").select(
        "t.source",
        "target",
        F.coalesce("mean", F.lit(1.0)).alias("mean"),
        (F.col("target") >= MOST * F.col("source_size") * (1 - 1e-12)).alias("full"),
        F.lit(0.0).alias("b"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        F.lit(1.0).alias("miss"),
    )
    state = staged(state, "dual")
    words = groups.where("size > 0")
    for _ in range(STEPS):
        g, s = words.alias("g"), state.where("NOT full").alias("s")
        x = F.col("g.size") / F.col("s.mean")
        rate = _rate(F.col("s.b"), F.col("g.size"), F.col("s.mean"))
        mass = (F.col("g.n") * F.col("g.size")).cast("double")
        sums = g.join(s, F.col("g.source").eqNullSafe(F.col("s.source"))).groupBy("g.source").agg(
            F.sum(_exact(mass * rate)).cast("double").alias("got"),
            F.sum(_exact(mass * x * rate * (1 - rate / MOST))).cast("double").alias("slope"),
        )
        a, q = state.alias("a"), sums.alias("q")
        low = F.when(F.col("got") <= F.col("target"), F.col("b")).otherwise(F.col("low"))
        high = F.when(F.col("got") > F.col("target"), F.col("b")).otherwise(F.col("high"))
        step = F.col("b") - (F.col("got") - F.col("target")) / F.col("slope")
        # Outside the bracket, or with a vanishing slope: halve it, or move on while one side is open.
        half = (
            F.when(F.col("nlow").isNull(), F.col("nhigh") - 1 - 2 * F.abs(F.col("nhigh")))
            .when(F.col("nhigh").isNull(), F.col("nlow") + 1 + 2 * F.abs(F.col("nlow")))
            .otherwise((F.col("nlow") + F.col("nhigh")) / 2)
        )
        inside = (
            F.col("slope").isNotNull() & (F.col("slope") > 0)
            & ((F.col("step") > F.col("nlow")) | F.col("nlow").isNull())
            & ((F.col("step") < F.col("nhigh")) | F.col("nhigh").isNull())
            & (F.abs(F.col("step") - F.col("b")) <= 1 + 2 * F.abs(F.col("b")))
        )
        miss = F.abs(F.col("got") - F.col("target")) / F.greatest(F.col("target"), F.lit(1.0))
        state = staged(
            a.join(q, F.col("a.source").eqNullSafe(F.col("q.source")), "left")
            .select(
                "a.source", "target", "mean", "full", "b", "slope",
                low.alias("nlow"), high.alias("nhigh"),
                F.when(F.col("slope") > 0, step).alias("step"), F.coalesce(miss, F.lit(0.0)).alias("miss"),
            )
            .select(
                "source", "target", "mean", "full",
                F.when(F.col("miss") <= TOLERANCE, F.col("b")).when(inside, F.col("step")).otherwise(half).alias("b"),
                F.col("nlow").alias("low"), F.col("nhigh").alias("high"), "miss",
            ),
            "dual",
        )
        if not (state.agg(F.max("miss")).first()[0] or 0.0) > TOLERANCE:
            break
    return state.select("source", "mean", "full", "b")


def _passed(offset: Column) -> Column:
    """How many whole units the running sum passes within a group, if it starts at the offset."""
    end = F.col("end") + offset
    return F.call_function("div", end, F.lit(UNIT)) - F.call_function("div", end - F.col("mass"), F.lit(UNIT))


def mix(docs: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """Size, source_size, target and copies of each row, by a row tag: see ``mix_documents``.

    ``docs``: tag, source, size and ``lot``, a hash that decides between documents of one size. Rows with
    the same lot are ordered by tag.
    """
    groups = staged(docs.groupBy("source", "size").agg(F.count("*").alias("n")), "groups")
    if targets is None:
        sizes = groups.select("source", (F.col("size") * F.col("n")).alias("size"))
        targets = source_targets(sizes)
    targets = staged(targets, "targets")
    solved = multipliers(groups, targets)
    g, s, t = groups.alias("g"), solved.alias("s"), targets.alias("t")
    rate = F.when(F.col("full"), float(MOST)).otherwise(_rate(F.col("b"), F.col("size"), F.col("mean")))
    rated = (
        g.join(s, F.col("g.source").eqNullSafe(F.col("s.source")))
        .join(t, F.col("g.source").eqNullSafe(F.col("t.source")))
        .select("g.source", "size", "n", "source_size", "target", rate.alias("rate"))
        .withColumn("least", F.floor("rate"))
        # Fractions as whole millionths, so that running sums are exact.
        .withColumn("part", F.round((F.col("rate") - F.col("least")) * UNIT).cast("long"))
        .withColumn("subs", F.ceil(F.col("n") / RANKED))
    )
    rated = staged(rated, "rated")
    r, d = rated.alias("r"), docs.alias("d")
    same = F.col("d.source").eqNullSafe(F.col("r.source")) & (F.col("d.size") == F.col("r.size"))
    # Large groups of one size are ranked in parts.
    sub = F.pmod(F.shiftright(F.col("d.lot"), 20), F.col("subs"))
    dealt = staged(
        d.join(r, same).select(
            "d.tag", "d.source", "d.size", "d.lot", "source_size", "target", "least", "part", sub.alias("sub")
        ),
        "dealt",
    )
    parts = dealt.groupBy("source", "size", "sub", "part").agg(F.count("*").alias("n"))
    line = Window.partitionBy("source").orderBy("size", "sub")
    mass = F.col("n") * F.col("part")
    lined = staged(parts.withColumn("mass", mass).withColumn("end", F.sum("mass").over(line)), "lined")
    # Of a few places where the line may be cut, each source takes the one nearest to its target.
    wanted = F.sum(F.col("mass").cast("decimal(19,0)") * F.col("size")) / UNIT
    cuts = [
        F.struct(
            F.abs(F.sum(_passed(F.lit(o)) * F.col("size")) - wanted).alias("miss"),
            F.lit(o).alias("cut"),
        )
        for o in range(UNIT // (2 * CUTS), UNIT, UNIT // CUTS)
    ]
    best = lined.groupBy("source").agg(F.array_min(F.array(*cuts))["cut"].alias("cut"))
    x, c = lined.alias("x"), best.alias("c")
    extra = x.join(c, F.col("x.source").eqNullSafe(F.col("c.source"))).select(
        F.col("x.source").alias("x_source"), F.col("size").alias("x_size"), F.col("sub").alias("x_sub"),
        _passed(F.col("cut")).alias("more"),
    )
    rank = F.row_number().over(Window.partitionBy("source", "size", "sub").orderBy("lot", "tag"))
    return (
        dealt.withColumn("rank", rank)
        .join(
            extra,
            F.col("source").eqNullSafe(F.col("x_source"))
            & (F.col("size") == F.col("x_size")) & (F.col("sub") == F.col("x_sub")),
        )
        .select(
            "tag", "size", "source_size", "target",
            (F.col("least") + (F.col("rank") <= F.col("more")).cast("long")).alias("copies"),
        )
    )


def _tagged(docs: DataFrame, tag: str) -> DataFrame:
    return docs.select(
        F.col(tag).alias("tag"),
        "source",
        word_count(F.col("text")).alias("size"),
        F.xxhash64("doc_id", "text", F.lit(10)).alias("lot"),
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as its copies say, with all its columns and no other.

    Null sources are a source; null and empty texts have no words and are kept once at the rate of their
    source; rows that are equal in all columns are interchangeable. An empty table gives no rows.
    """
    tag = fresh(docs, "row_tag")
    tagged = staged(docs.withColumn(tag, F.monotonically_increasing_id()), "tagged")
    copies = mix(staged(_tagged(tagged, tag), "sizes")).select(F.col("tag").alias(tag), "copies")
    times = fresh(tagged, "copy")
    mixed = tagged.join(copies.withColumnRenamed("copies", times), tag).where(F.col(times) > 0)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    again = F.explode(F.array_repeat(F.lit(0), F.col(times).cast("int")))
    return without(mixed.select(*columns, again.alias(times)), times)


def op10_mix_entropy(spark, sf_dir: str) -> DataFrame:
    """All documents with their source's target and the words that the mix takes of them."""
    docs = table(spark, sf_dir, "documents")
    narrow = staged(
        docs.select(
            F.monotonically_increasing_id().alias("tag"), "doc_id", "source",
            word_count(F.col("text")).alias("size"), F.xxhash64("doc_id", "text", F.lit(10)).alias("lot"),
        ),
        "sizes",
    )
    mixed = mix(narrow.drop("doc_id"))
    return narrow.select("tag", "doc_id").join(mixed, "tag").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )
