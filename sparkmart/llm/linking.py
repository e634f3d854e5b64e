"""Groups of linked rows: connected components, and links found in buckets without all pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.session import durable

BROADCAST_ROWS = 1_000_000


def filter_here(df: DataFrame, condition: Column) -> DataFrame:
    """Filter above the columns computed so far.

    Pushed below them, the filter would compute its long expressions a second time. A condition that needs a
    numbering of the rows stays where it is.
    """
    return df.withColumn("__here", F.monotonically_increasing_id()).filter((F.col("__here") >= 0) & condition).drop("__here")


def join_checked(big: DataFrame, small: DataFrame, on: list[str], how: str, rows: int) -> DataFrame:
    """Join that broadcasts ``small`` only where its counted rows are few; otherwise Spark shuffles."""
    return big.join(F.broadcast(small) if rows <= BROADCAST_ROWS else small, on, how)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node reachable.

    Large-star and small-star steps alternate until nothing changes, about log of the longest path times. A step
    takes minima per node before it joins, so a hub is one row on one side and a splittable join on the other.
    Rounds are written to the shared folder, which cuts the lineage.
    """
    edges = durable(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = durable(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = durable(small.filter("u <> v").distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


CENTRES = 8


def both_ends(pairs: DataFrame) -> DataFrame:
    """(node, a, b): each pair once for either of its nodes."""
    return pairs.select(F.explode(F.array("a", "b")).alias("node"), "a", "b")


def shared_rows(buckets: DataFrame, key: str, early: Column) -> DataFrame:
    """Rows of buckets that hold several nodes, each once, with the number of rows (n) and the first row of its bucket beside it (node2, pos2, size2).

    One shuffle does it: part 0 is a whole bucket, and rows of a hot bucket have parts from 1 on, told by
    their node, so that no task holds all of it; their first row and number are those of the part, and all of them are kept.
    """
    inside = Window.partitionBy(key, "part")
    seen = buckets.withColumn("again", F.lag("node").over(inside.orderBy("node")))
    seen = seen.withColumns({"lo": F.min(early).over(inside), "n1": F.min("node").over(inside), "n2": F.max("node").over(inside)})
    seen = seen.withColumn("n", F.count(F.when(F.col("again").isNull() | (F.col("again") != F.col("node")), 1)).over(inside))
    seen = seen.filter("(part > 0 OR n1 < n2) AND (again IS NULL OR again <> node)")
    first = [F.col(f"lo.{c}").alias(f"{c}2") for c in ("node", "pos", "size")]
    return seen.select(key, "node", "pos", "size", "part", "n", *first)


def link_in_buckets(
    buckets: DataFrame,
    key: str,
    verify: Callable[[DataFrame], DataFrame],
    may_link: Callable[[Column, Column, Column, Column], Column] | None = None,
    across: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(links (a, b), roots (node, root)) over all pairs of nodes that share a bucket.

    ``buckets`` has the key column, ``node``, ``pos`` and ``size``, all long, and ``part`` (see ``shared_rows``).
    ``verify`` gets the pairs (a, b) of a round, as written, and keeps the true ones. ``may_link`` of the positions and sizes of both rows of a bucket tells whether that bucket has to try
    the pair; each true pair needs one bucket that does.

    Each node is first tried against the first node, by ``pos``, of each of its buckets, then, where a bucket still holds
    several groups, against those of up to ``CENTRES`` early nodes of the most populous such bucket that are not in its group.
    Both take as many pairs as there are rows, or a fixed multiple, and tie dense groups together. What is left, nodes of one bucket that are still in
    different groups, is tried pair by pair, so no link that would join two groups is lost. ``across`` does this last
    step by its own means, where pairs are too many to be written: it gets the rows left (key, node, pos, size, root)
    and returns the true pairs (a, b).
    """
    allowed = may_link or (lambda p, n, q, m: F.lit(True))

    def tried_pairs(both: DataFrame, condition: Column, label: str) -> DataFrame:
        """Pairs (a, b) from rows of one bucket side by side: node, pos, size and node2, pos2, size2."""
        both = both.filter(condition & allowed(F.col("pos"), F.col("size"), F.col("pos2"), F.col("size2")))
        return durable(both.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct(), label)

    early = F.struct("pos", "node", "size")
    shared = durable(shared_rows(buckets, key, early), "shared-buckets")

    first = tried_pairs(shared, F.col("node") != F.col("node2"), "star-pairs")
    links = durable(verify(first), "star-links")
    roots = components(links)

    def open_buckets(rows: DataFrame) -> DataFrame:
        """Rows of buckets still in several groups, but for the first row of a whole bucket, which has met all others."""
        rows = rows.filter("(n > 2 AND node <> node2) OR part > 0").drop("root")
        placed = join_checked(rows, roots, ["node"], "left", roots.count()).withColumn("root", F.coalesce("root", "node"))
        mixed = placed.groupBy(key).agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.count(F.lit(1)).alias("rows"))
        mixed = mixed.filter("r1 < r2").drop("r1", "r2")
        return durable(placed.drop("rows").join(mixed, key), "open-buckets")

    still = open_buckets(shared)
    if still.isEmpty():
        return links, roots
    kind = F.pmod(F.xxhash64("node"), F.lit(CENTRES))
    centres = still.groupBy(key).agg(*[F.min(F.when(kind == c, F.struct(early.alias("early"), "root"))).alias(f"c{c}") for c in range(CENTRES)])
    centres = centres.select(key, F.explode(F.array(*[f"c{c}" for c in range(CENTRES)])).alias("c")).filter("c IS NOT NULL")
    centres = centres.select(key, *[F.col(f"c.early.{c}").alias(f"{c}2") for c in ("node", "pos", "size")], F.col("c.root").alias("root2"))
    home = still.groupBy("node").agg(F.max_by(F.struct(key, "pos", "size", "root"), F.struct("rows", key)).alias("home")).select("node", "home.*")
    near = tried_pairs(home.join(centres, key), F.col("root") != F.col("root2"), "centre-pairs")
    links = links.union(durable(verify(near), "centre-links"))
    roots = components(links)
    still = open_buckets(still).select(key, "node", "pos", "size", "root")
    if still.isEmpty():
        return links, roots
    if across:
        more = durable(across(still), "cross-links")
    else:
        other = still.select(key, *[F.col(c).alias(f"{c}2") for c in ("node", "pos", "size", "root")])
        cross = tried_pairs(still.join(other, key), F.col("root") < F.col("root2"), "cross-pairs")
        more = durable(verify(cross), "cross-links")
    if more.isEmpty():
        return links, roots
    links = links.union(more)
    return links, components(links)
