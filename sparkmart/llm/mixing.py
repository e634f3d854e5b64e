"""Mixing of sources to target weights, with DataFrame functions only.

Method: pivotal dependent rounding. Every document of a source starts with the same expected number of copies. Pairs of
documents pass words at random from one to the other until one of the two has a whole number of copies; the other
goes on with what is left. Chunks are rounded independently and their residuals are paired again, level by level, in a
reduction tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from sparkmart.llm.linking import join_checked
from sparkmart.session import durable, durable_counted

WEIGHTS = (1, 2, 3)
MOST = 3  # copies of a document at most, on the average of a source too
FAN = 256  # nodes that one step of the tree takes, on average
_CLASS_BITS = 4  # sizes of one class differ by less than 2 ** _CLASS_BITS
_WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Maximal runs of anything but ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def _uniform(seed: int, *of: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *of), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _pair_up(nodes: Column, seed: int) -> Column:
    """struct(held, done) of an array of struct(h, x, s, id): expected share x in 0..1 of one more copy, size s.

    Pairs keep the sum of x * s, so the words expected in all, and each x keeps its expectation. ``done`` has (id, up) of
    all nodes but one; ``held`` is the last one with what x it was left with.
    """

    def step(acc: Column, e: Column) -> Column:
        r = acc["held"]
        a, b = r["x"] * r["s"], e["x"] * e["s"]
        there, back = F.least(a, e["s"] - b), F.least(b, r["s"] - a)  # words that can pass to e and to r
        give = _uniform(seed, r["h"], e["h"]) * (there + back) < back
        r_done = (give & (there == a)) | (~give & (back != b))
        up = F.when(give == r_done, 0).otherwise(1)
        left = F.when(r_done, (b + F.when(give, there).otherwise(-back)) / e["s"])
        left = left.otherwise((a + F.when(give, -there).otherwise(back)) / r["s"])
        held = F.when(r_done, e).otherwise(r).withField("x", F.greatest(F.lit(0.0), F.least(F.lit(1.0), left)))
        whole = F.struct(F.when(r_done, r["id"]).otherwise(e["id"]).alias("id"), up.alias("up"))
        return F.struct(held.alias("held"), F.concat(acc["done"], F.array(whole)).alias("done"))

    none = F.slice(F.transform(nodes, lambda n: F.struct(n["id"].alias("id"), F.lit(0).alias("up"))), 1, 0)
    start = F.struct(F.get(nodes, F.lit(0)).alias("held"), none.alias("done"))
    return F.aggregate(F.slice(nodes, F.lit(2), F.size(nodes)), start, step)


def round_copies(nodes: DataFrame, most: int, seed: int = 0) -> DataFrame:
    """(src, id, up) for nodes (src, h, x, s, id): 0 or 1 for each, by the reduction tree.

    ``most`` is the largest number of nodes of one src. A step takes about ``FAN`` nodes, dealt by hash, so a hot src is
    cut into as many chunks as it needs; a level has one node for each chunk of the level before.
    """
    levels, chunks = [], max(1, -(-most // FAN))
    nodes = nodes.withColumn("g", F.pmod(F.xxhash64(F.lit(seed), "h"), F.lit(chunks)))
    while True:
        lists = nodes.groupBy("src", "g").agg(F.sort_array(F.collect_list(F.struct("h", "x", "s", "id"))).alias("nodes"))
        paired = lists.select("src", "g", _pair_up(F.col("nodes"), seed + len(levels)).alias("p")).select("src", "g", "p.*")
        levels.append(durable(paired, "mix-level"))
        if chunks == 1:
            break
        chunks = -(-chunks // FAN)
        nodes = levels[-1].select(
            "src", F.xxhash64("g", "held.h").alias("h"), F.col("held.x").alias("x"), F.col("held.s").alias("s"), F.col("g").alias("id")
        )
        nodes = nodes.withColumn("g", F.pmod("id", F.lit(chunks)))
    decided = levels[-1].select("src", "g", (_uniform(seed - 1, F.col("held.h")) < F.col("held.x")).cast("int").alias("up"))
    for level in reversed(levels):
        last = F.struct(F.col("held.id").alias("id"), F.col("up"))
        both = level.join(decided, ["src", "g"]).select("src", F.explode(F.concat("done", F.array(last))).alias("n"))
        decided = both.select("src", F.col("n.id").alias("g"), F.col("n.up").alias("up"))
    return decided.withColumnRenamed("g", "id")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(src, size, target) for sources (src, size), numbered in the order of src.

    Weights repeat along that order. Targets share the sum of all sizes by weight; one that is above ``most`` times
    its source's size stops there and the others share what it leaves, until none is above. There are at most as many
    rounds as sources, in practice a few.
    """
    ranged = durable(sizes.repartitionByRange("src").select("src", "size", F.spark_partition_id().alias("part")), "mix-sources")
    parts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row a partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    number = F.row_number().over(Window.partitionBy("part").orderBy("src")) + F.col("before") - 1
    ranged = ranged.join(F.broadcast(parts.select("part", before.alias("before"))), "part").withColumn("number", number)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    ranged = durable(ranged.select("src", "size", weight.cast("long").alias("weight")), "mix-weights")
    stops = F.lit(0) > 1
    level, count = 0.0, -1
    while True:
        total, stopped, free, n = ranged.agg(
            F.sum("size"), F.sum(F.when(stops, F.col("size") * most)), F.sum(F.when(~stops, F.col("weight"))), F.count(F.when(stops, 1))
        ).first()
        if n == count or not free:
            break
        level, count = ((total or 0) - (stopped or 0)) / free, n
        stops = F.col("weight") * F.lit(level) > F.col("size") * most
    target = F.least(F.col("weight") * F.lit(level), (F.col("size") * most).cast("double"))
    return ranged.select("src", "size", target.alias("target"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = 0,
) -> DataFrame:
    """How often the mix takes each document: doc_id, source, size, source_size, target, copies, taken.

    One row per row of ``docs``. Sizes are words. Sources are ordered by code point, NULL last and as a source of its own. A
    document's expected copies are the same all over its source, at most ``most``; its whole copies are taken, the rest is
    rounded by pairing. The largest documents are rounded first, class by class of size (each within a factor of
    16); what their rounding left over or took too much is shared by all smaller ones of the source, so a source
    misses its target by about its smallest documents, unless large ones hold nearly all its words.

    Rows with one id, source and text are rounded as one node of so many rows and share its copies evenly. Draws
    are hashes of what a row holds, so reruns and other partitionings agree. NULL and empty texts have size 0 and are not
    taken; NULL ids are ids like others; other columns are ignored; an empty table gives no rows.
    """
    src = F.concat(F.when(F.col(source).isNull(), "1").otherwise("0"), F.coalesce(F.col(source).cast("string"), F.lit("")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), src.alias("src"), F.xxhash64(F.col(text)).alias("hash"), n_words(F.col(text)).alias("size"))
    rows = rows.groupBy("doc_id", "src", "hash", "size").agg(F.count(F.lit(1)).alias("m"))
    kind = F.floor(F.log2(F.greatest("size", F.lit(1)).cast("double")) / _CLASS_BITS).cast("int")
    rows = durable(rows.withColumn("kind", F.when(F.col("size") > 0, kind).otherwise(-1)), "mix-rows")
    stats = rows.groupBy("src", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("size") * F.col("m")).alias("words"))
    stats = durable(stats, "mix-stats")
    sources = source_targets(stats.groupBy("src").agg(F.sum("words").alias("size")), weights, most)
    sources, n_sources = durable_counted(sources, "mix-targets")
    kinds = {r["kind"]: r["n"] for r in stats.groupBy("kind").agg(F.max("n").alias("n")).collect()}  # 17 at most
    state = sources.select("src", F.col("target").alias("open"), F.col("size").alias("left"))
    done = rows.filter("kind < 0").select("doc_id", "src", "size", "m", F.lit(0).cast("long").alias("copies"))
    for k in sorted((k for k in kinds if k >= 0), reverse=True):
        rate = F.when(F.col("left") > 0, F.greatest(F.lit(0.0), F.least(F.lit(float(most)), F.col("open") / F.col("left"))))
        rated = join_checked(rows.filter(F.col("kind") == k), state.select("src", rate.alias("rate")), ["src"], "inner", n_sources)
        wish = F.col("m") * F.col("rate")
        node = F.struct("doc_id", "hash", "size", "m", F.floor(wish).alias("whole"))
        nodes = rated.select(
            "src",
            F.xxhash64("doc_id", "hash", "size").alias("h"),
            (wish - F.floor(wish)).alias("x"),
            F.col("size").cast("double").alias("s"),
            node.alias("id"),
        )
        rounded = round_copies(nodes, kinds[k], seed + 1000 * (k + 1))
        now = rounded.select("id.doc_id", "src", "id.size", "id.m", (F.col("id.whole") + F.col("up")).alias("copies"))
        now = durable(now, "mix-copies")
        done = done.unionByName(now)
        took = now.groupBy("src").agg(F.sum(F.col("size") * F.col("copies")).alias("took"), F.sum(F.col("size") * F.col("m")).alias("held"))
        state = state.join(took, "src", "left").select(
            "src",
            (F.col("open") - F.coalesce("took", F.lit(0))).alias("open"),
            (F.col("left") - F.coalesce("held", F.lit(0))).alias("left"),
        )
        state = durable(state, "mix-state")
    each = F.posexplode(F.array_repeat("size", F.col("m").cast("int"))).alias("nth", "of_size")
    spread = done.select("doc_id", "src", "size", "m", "copies", each)
    extra = (F.col("nth") < F.pmod("copies", "m")).cast("long")
    spread = spread.select("doc_id", "src", "size", (F.floor(F.col("copies") / F.col("m")) + extra).alias("copies"))
    placed = join_checked(spread, sources.select("src", F.col("size").alias("source_size"), "target"), ["src"], "inner", n_sources)
    name = F.when(F.substring("src", 1, 1) == "0", F.expr("substring(src, 2)")).alias("source")
    return placed.select("doc_id", name, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
