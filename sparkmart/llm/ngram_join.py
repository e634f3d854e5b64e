"""Exact n-gram Jaccard join of documents.

Method: vertical partitioning. A global order of the n-grams (rare ones first) is cut into fragments; overlaps
are counted fragment by fragment and summed per pair. Candidates come from the head of each document's order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.arrow_text import chunks, releasing, split_words
from sparkmart.llm.linking import both_ends, join_checked, link_in_buckets
from sparkmart.session import durable

FRAGMENTS = 4
FREQUENT_PER_TASK = 20_000
FREQUENT = 200_000
SEEN_SLOTS = 1 << 24  # per task: which shingles an earlier chunk may have had
HOT_ROWS = 1_000_000  # a bucket of more rows is split by node
_LAST = (1 << 63) - 1  # stands for a NULL id


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the n-word shingles of each text.

    A to Z count as a to z; words lie between ASCII white space. A text of fewer words than ``n`` has its whole
    sequence as the one shingle; a text without words has none.
    """
    lowered = pc.ascii_lower(texts)
    codes, words, offsets = split_words(lowered)
    hashes = pd.util.hash_array(np.array(words.to_pylist(), dtype=object), categorize=False) if len(words) else np.zeros(0, np.uint64)
    flat = hashes[codes]
    counts = np.diff(offsets)
    with np.errstate(over="ignore"):
        full = len(flat) - n + 1
        rolled = np.zeros(max(full, 0), np.uint64)
        for k in range(n):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + flat[k : k + max(full, 0)] if full > 0 else rolled
        rolled = _mix(rolled)
        sets = []
        for a, c in zip(offsets[:-1].tolist(), counts.tolist()):
            if c >= n:
                sets.append(np.unique(rolled[a : a + c - n + 1]))
            elif c:
                h = np.uint64(c)
                for w in flat[a : a + c]:
                    h = h * np.uint64(0x9E3779B97F4A7C15) + w
                sets.append(_mix(np.array([h ^ np.uint64(0xA5A5A5A5A5A5A5A5)], np.uint64)))
            else:
                sets.append(np.zeros(0, np.uint64))
    return sets


def _node(shingles: np.ndarray) -> int | None:
    """One 64-bit name for a set: equal sets have equal names."""
    if not len(shingles):
        return None
    with np.errstate(over="ignore"):
        total = _mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
        return int(_mix(np.array([total + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def sketch(shingles: np.ndarray) -> np.ndarray:
    """One bit for each residue of the shingles, set where an odd number of them has it; as many bits, a power of two, as there
    are shingles or more, in whole longs. Bits in which two sketches differ are at most the shingles that only one set has.
    """
    bits = max(64, 1 << (len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def fewest_apart(x: Column, y: Column) -> Column:
    """How many shingles at least only one of two sets has, by their sketches; 0 where one is longer than twice the other."""

    def folded(s: Column) -> Column:
        half = F.floor(F.size(s) / 2).cast("int")
        return F.zip_with(F.slice(s, F.lit(1), half), F.slice(s, half + 1, half), lambda a, b: a.bitwiseXOR(b))

    def differ(s: Column, t: Column) -> Column:
        return F.aggregate(F.zip_with(s, t, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, bits: n + bits)

    n, m = F.size(x), F.size(y)
    return F.when(n == m, differ(x, y)).when(n == 2 * m, differ(folded(x), y)).when(m == 2 * n, differ(x, folded(y))).otherwise(0)


def survey(docs: DataFrame, n: int) -> DataFrame:
    """One pass: (doc_id, node, size, sketch) of every document, and (shingle, times) of each task's most frequent shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        earlier = np.zeros(SEEN_SLOTS, bool)
        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                sets = shingle_sets(texts, n)
                size = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array([_node(s) for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([sketch(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                        pa.nulls(size, pa.int64()),
                        pa.nulls(size, pa.int64()),
                    ],
                    names=["doc_id", "node", "size", "sketch", "shingle", "times"],
                )
                values, counts = np.unique(np.concatenate(sets), return_counts=True)
                slots = (values % np.uint64(SEEN_SLOTS)).astype(np.int64)
                often = (counts > 1) | earlier[slots]
                earlier[slots] = True
                values, counts = values[often], counts[often]
                merged, where = np.unique(np.concatenate((seen, values)), return_inverse=True)
                total = np.bincount(where, np.concatenate((times, counts)), len(merged)).astype(np.int64)
                top = np.argsort(-total, kind="stable")[:FREQUENT_PER_TASK]
                seen, times = merged[top], total[top]
        blank = pa.nulls(len(seen), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [blank, blank, blank, pa.nulls(len(seen), pa.list_(pa.int64())), pa.array(seen.view(np.int64)), pa.array(times)],
            names=["doc_id", "node", "size", "sketch", "shingle", "times"],
        )

    return docs.select("doc_id", "text").mapInArrow(releasing(run), "doc_id long, node long, size long, sketch array<long>, shingle long, times long")


def _ordered(shingles: np.ndarray, frequent: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set in global order, and the fragment of each: the frequent ones, by times, are the last fragment."""
    at = np.minimum(np.searchsorted(frequent, shingles), max(len(frequent) - 1, 0))
    often = np.where(frequent[at] == shingles, times[at], 0) if len(frequent) else np.zeros(len(shingles), np.int64)
    order = np.argsort(often, kind="stable")  # shingles come sorted, so ties are by hash
    often, shingles = often[order], shingles[order]
    part = np.where(often > 0, FRAGMENTS - 1, (shingles >> np.uint64(32)).astype(np.int64) * (FRAGMENTS - 1) >> 32)
    return shingles, part


def component_table(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    Two documents link when 100 * |A and B| >= percent * |A or B| over their sets of n-word shingles; component_id is
    the smallest doc_id reachable. NULL or wordless text has an empty set and links with nothing. Rows with equal ids are
    rows of their own; a row with a NULL id never names a component unless it is alone or all ids in it are
    NULL. Other columns are ignored; an empty table gives no rows.

    Equal sets are one node. A linked pair must share a shingle among the first size - ceil(percent * size / 100) + 1 of
    both in any common order. The order used puts the frequent shingles, as far as each task has counted
    them in a bounded list, last; how good that list is changes the work and not the result. Buckets of that list beyond
    ``HOT_ROWS`` rows are split by node. The first shingle a pair shares
    bounds its overlap by what stands behind it in both, so a bucket tries only pairs that this bound allows. Within a bucket nodes
    are first tried against one of them and then only across groups, so a dense group costs as many pairs as it has rows.
    Sketches of a bit a shingle settle most tried pairs that are not linked; only the shingles of the rest are moved.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark = docs.sparkSession
    seen = durable(survey(docs, n), "shingle-survey")
    members = seen.filter("size IS NOT NULL").select("doc_id", "node", "size")
    listed = (
        seen.filter("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "shingle").limit(FREQUENT)
    ).toPandas()
    listed = listed.sort_values("shingle", key=lambda s: s.astype(np.int64).to_numpy().view(np.uint64)) if len(listed) else listed
    frequent = spark.sparkContext.broadcast(
        (listed["shingle"].to_numpy(np.int64).view(np.uint64), listed["times"].to_numpy(np.int64))
    )

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, times = frequent.value
        parts = -(-times // HOT_ROWS)
        hot, parts = names[parts > 1], parts[parts > 1]
        told: set[int] = set()  # nodes of this task: copies say nothing new
        for batch in batches:
            for _, texts in chunks(batch, "text"):
                nodes, tokens, places, sizes, split = [], [], [], [], []
                for s in shingle_sets(texts, n):
                    node = _node(s)
                    if node is not None and node not in told:
                        told.add(node)
                        ordered, _ = _ordered(s, names, times)
                        head = ordered[: len(s) - -(-percent * len(s) // 100) + 1]
                        part = np.zeros(len(head), np.int32)
                        if len(hot):
                            at = np.minimum(np.searchsorted(hot, head), len(hot) - 1)
                            part = np.where(hot[at] == head, 1 + node % parts[at], 0).astype(np.int32)
                        tokens.append(head)
                        nodes.append(np.full(len(head), node))
                        places.append(np.arange(len(head)))
                        sizes.append(np.full(len(head), len(s)))
                        split.append(part)
                if nodes:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(tokens).view(np.int64)),
                            pa.array(np.concatenate(nodes)),
                            pa.array(np.concatenate(places)),
                            pa.array(np.concatenate(sizes)),
                            pa.array(np.concatenate(split)),
                        ],
                        names=["token", "node", "pos", "size", "part"],
                    )

    buckets = docs.mapInArrow(releasing(heads), "token long, node long, pos long, size long, part int")
    known = seen.filter("node IS NOT NULL").groupBy("node")
    firsts = durable(known.agg(F.min("doc_id").alias("first"), F.max("size").alias("size"), F.first("sketch").alias("sketch")), "shingle-nodes")
    texts = docs.withColumn("key", F.coalesce("doc_id", F.lit(_LAST)))

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, times = frequent.value
        for batch in batches:
            for _, column in chunks(batch, "text"):
                rows = []
                for s in shingle_sets(column, n):
                    if len(s):
                        ordered, part = _ordered(s, names, times)
                        node = _node(s)
                        for f in range(FRAGMENTS):
                            rows.append((node, f, len(s), ordered[part == f].view(np.int64)))
                if rows:
                    node, f, size, shingles = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(node, pa.int64()),
                            pa.array(f, pa.int32()),
                            pa.array(size, pa.int64()),
                            pa.array(shingles, pa.list_(pa.int64())),
                        ],
                        names=["node", "fragment", "size", "shingles"],
                    )

    def segments(nodes: DataFrame) -> DataFrame:
        wanted = durable(nodes.join(firsts, "node").select(F.coalesce("first", F.lit(_LAST)).alias("key")).distinct(), "wanted")
        few = join_checked(texts, wanted, ["key"], "left_semi", wanted.count())
        return few.select("text").mapInArrow(releasing(fragments), "node long, fragment int, size long, shingles array<long>")

    def may_link(p: Column, n: Column, q: Column, m: Column) -> Column:
        """If this is the first shared shingle in the common order, all shared ones stand at or behind it in both."""
        return F.least(n - p, m - q) * (100 + percent) >= (n + m) * percent

    def close(pairs: DataFrame) -> DataFrame:
        """Pairs whose sketches leave the overlap possible: with few shingles apart, which is the same as a large overlap."""
        told = join_checked(firsts.select("node", "size", "sketch"), both_ends(pairs), ["node"], "inner", 2 * pairs.count())
        side = F.struct("size", "sketch")
        told = told.groupBy("a", "b").agg(F.min(side).alias("x"), F.max(side).alias("y"))
        apart = fewest_apart(F.col("x.sketch"), F.col("y.sketch")).cast("long")
        return told.filter(apart * (100 + percent) <= (F.col("x.size") + F.col("y.size")) * (100 - percent)).select("a", "b")

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = durable(close(pairs), "close-pairs")
        ends = both_ends(pairs)
        held = join_checked(segments(ends.select("node").distinct()), ends, ["node"], "inner", 2 * pairs.count())
        # a node may be held more than once where ids repeat; its rows are equal then
        sides = [F.first(F.when(F.col("node") == F.col(c), F.struct("size", "shingles")), ignorenulls=True).alias(c * 2) for c in "ab"]
        parts = held.groupBy("a", "b", "fragment").agg(*sides)
        overlap = F.size(F.array_intersect("aa.shingles", "bb.shingles")).cast("long")
        total = parts.select("a", "b", F.col("aa.size").alias("na"), F.col("bb.size").alias("nb"), overlap.alias("overlap"))
        total = total.groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("both"))
        return total.filter(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent).select("a", "b")

    _, roots = link_in_buckets(buckets, "token", verify, may_link)
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component"))
    return placed.join(smallest, "root", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs``, with all its columns, of each group of linked texts.

    It is the row with the smallest doc_id, NULL ids after all others, then the smallest hash of the text. Each row
    is judged by its own text: rows with equal ids and different texts do not decide for each other. Rows without
    words link with nothing and stay.
    """
    numbered = durable(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    table = component_table(numbered.select(F.col("__row").alias("doc_id"), "text"), n, percent)
    groups = table.select(F.col("doc_id").alias("__row"), "component_id")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("hash"), "__row")
    placed = numbered.select("__row", place.alias("place")).join(groups, "__row")
    kept = durable(placed.groupBy("component_id").agg(F.min("place").alias("place")).select("place.__row"), "kept-rows")
    return join_checked(numbered, kept, ["__row"], "left_semi", kept.count()).drop("__row")
