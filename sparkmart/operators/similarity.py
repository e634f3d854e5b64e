"""Cosine neighbours: exact top-k for every row, approximate top-k, and single lookups.

The exact join scores all pairs only where nothing rules them out. Unit vectors are placed in cells of a k-d tree and
packed, in the order of the cells, into blocks of bounded size. Each row first finds its best k inside its own block, and the
k-th score found there bounds how far a better neighbour can be, so a row meets only blocks whose box lies within that
bound. A task multiplies two blocks at a time and hands on at most k rows per query row, whatever the size of a cell. Exact
copies are reduced to one vector first: copies are each other's neighbours without any comparison.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.exprs import money_text, percent_text
from sparkmart.operators.features import FEATURE_COLS, complete_rows, standard_scale
from sparkmart.operators.marts import keep_best
from sparkmart.operators.ordering import ROWS_PER_RANGE, attach_by_value
from sparkmart.session import durable, durable_counted
from sparkmart.sources.sinks import overwrite, read_current

CHUNK = 2048  # rows of one block
SEGMENT = 256  # rows of a block multiplied at once
SAMPLE = 32_768  # vectors that the tree is fitted on
DIGITS = 6
MARGIN = 2 * 10.0**-DIGITS  # two rounded scores that tie may differ by this much
MEETS = 16  # blocks that a block may meet for each hash table, or else a quarter of them, before buckets are searched one by one
CELLS = 4_000_000  # numbers of one table of distances between rows and boxes


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.vstack(vectors.to_numpy()).astype(float)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Dimension and cut of every node of a k-d tree, in heap order: the widest dimension at its median."""
    dims, cuts = np.zeros(2**depth - 1, int), np.zeros(2**depth - 1)
    held = {0: sample}
    for node in range(2**depth - 1):
        x = held.pop(node)
        if len(x):
            dims[node] = np.argmax(x.max(0) - x.min(0))
            cuts[node] = np.median(x[:, dims[node]])
        right = x[:, dims[node]] > cuts[node]
        held[2 * node + 1], held[2 * node + 2] = x[~right], x[right]
    return dims, cuts


def _place(distinct: DataFrame, tree: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Add the unit vector, its cell and the score of a copy."""
    dims, cuts = tree

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if rows.empty:
                continue
            u = _unit(rows["_vec"])
            node, each = np.zeros(len(u), int), np.arange(len(u))
            while len(dims) and node[0] < len(dims):  # all leaves are equally deep
                node = 2 * node + 1 + (u[each, dims[node]] > cuts[node])
            yield rows.drop(columns="_vec").assign(
                _u=list(u), _cell=(node - len(dims)).astype("int32"), _self=np.round((u * u).sum(axis=1), DIGITS)
            )

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema if f.name != "_vec")
    return distinct.mapInPandas(place, f"{kept}, _u array<double>, _cell int, _self double")


def _matrix(data: pa.Scalar, rows: int) -> np.ndarray:
    return np.frombuffer(data.as_py(), float).reshape(rows, -1)


def _codes(data: pa.Scalar, rows: int) -> np.ndarray | None:
    """The buckets of every row, one a hash table; None where any two rows may be neighbours."""
    return np.frombuffer(data.as_py(), np.int64).reshape(rows, -1) if len(data.as_py()) else None


def _apart(codes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which pairs of rows have no bucket in common."""
    out = np.ones((len(codes), len(others)), bool)
    for t in range(codes.shape[1]):
        out &= codes[:, t, None] != others[None, :, t]
    return out


def _runs(names: pa.Scalar, starts: pa.Scalar, rows: int) -> dict:
    """Value of ``_b`` -> (first, end) of its rows in a block."""
    at = [*starts.as_py(), rows]
    return {b: (at[i], at[i + 1]) for i, b in enumerate(names.as_py())}


def _blocks(placed: DataFrame, total: int, chunk: int) -> DataFrame:
    """Blocks of at most ``chunk`` rows in order of (_b, cell): ids, copies, unit vectors, the runs of equal ``_b`` and, for the
    first and the last run, the box around it. A value of ``_b`` in several blocks is a first or last run in each of them. Where
    rows have buckets (``_h``, see ``cosine_topk_lsh``), those go along as ``codes``."""
    types = {f.name: f.dataType.simpleString() for f in placed.schema}
    schema = (
        f"block long, ids {types['_ids']}, copies array<{types['_ids']}>, units binary, codes binary, names array<string>, starts array<int>, "
        "ends array<struct<name:string,lo:array<double>,hi:array<double>>>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, count = TaskContext.get().partitionId() << 32, [], 0

        def block(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            b = np.array(rows["_b"].to_pylist(), object)
            units = rows["_u"].combine_chunks().flatten().to_numpy().reshape(len(b), -1)
            starts = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
            at = [*starts, len(b)]
            ends = [
                {"name": b[at[i]], "lo": units[at[i] : at[i + 1]].min(0).tolist(), "hi": units[at[i] : at[i + 1]].max(0).tolist()}
                for i in sorted({0, len(starts) - 1})
            ]
            ids, copies = rows["_id"].combine_chunks(), rows["_ids"].combine_chunks()
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            box = pa.list_(pa.struct([("name", pa.string()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64()))]))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    one(ids),
                    one(copies),
                    pa.array([np.ascontiguousarray(units).tobytes()], pa.binary()),
                    pa.array([rows["_h"].combine_chunks().flatten().to_numpy().tobytes() if "_h" in rows.column_names else b""], pa.binary()),
                    pa.array([b[starts].tolist()], pa.list_(pa.string())),
                    pa.array([starts.tolist()], pa.list_(pa.int32())),
                    pa.array([ends], box),
                ],
                names=["block", "ids", "copies", "units", "codes", "names", "starts", "ends"],
            )

        for batch in batches:
            held.append(batch)
            count += len(batch)
            while count >= chunk:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, chunk))
                held, count, number = table.slice(chunk).to_batches(), count - chunk, number + 1
        if count:
            yield block(pa.Table.from_batches(held))

    parts = max(1, min(256, math.ceil(total / (4 * chunk))))
    order = ["_b", "_cell", "_id"]
    rows = placed.select(*order, "_ids", "_u", *[c for c in ("_h",) if c in placed.columns]).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return rows.mapInArrow(run, schema)


def _gaps(lo: np.ndarray, hi: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Distances between boxes [lo, hi] and [low, high], squared; rows are boxes without extent."""
    gap = np.maximum(np.maximum(low[None] - hi[:, None], lo[:, None] - high[None]), 0.0)
    return np.einsum("ijk,ijk->ij", gap, gap)


def _limit(kth: np.ndarray) -> np.ndarray:
    """How far a neighbour with at least that rounded score can be, a hair wider."""
    return np.where(np.isfinite(kth), np.sqrt(np.maximum(2.0 - 2.0 * (kth - MARGIN), 0.0)) + 1e-9, np.inf)


def _open(blocks: DataFrame, k: int) -> DataFrame:
    """Add the k-th score of every row inside its block (``floors``) and the blocks that may hold a better one (``near``)."""
    index: dict = {}
    for r in blocks.select("block", "ends").collect():  # one small row per block
        for e in r["ends"]:
            index.setdefault(e["name"], []).append((r["block"], e["lo"], e["hi"]))
    index = {b: tuple(np.array(x) for x in zip(*found)) for b, found in index.items() if len(found) > 1}
    shared = blocks.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors, nears = [], []
            for i in range(len(batch)):
                here = batch.column("block")[i].as_py()
                rows = len(batch.column("ids")[i].values)
                u, codes = _matrix(batch.column("units")[i], rows), _codes(batch.column("codes")[i], rows)
                floor, near = np.full(rows, -np.inf), {here}
                for b, (s, e) in _runs(batch.column("names")[i], batch.column("starts")[i], rows).items():
                    x = u[s:e]
                    if e - s > k:
                        scores = x @ x.T
                        np.fill_diagonal(scores, -np.inf)
                        if codes is not None:
                            scores[_apart(codes[s:e], codes[s:e])] = -np.inf
                        floor[s:e] = np.round(np.partition(scores, e - s - k, axis=1)[:, e - s - k], DIGITS) + 0.0
                    if b not in shared.value:
                        continue
                    names, lo, hi = shared.value[b]
                    limit = _limit(floor[s:e])
                    at = np.flatnonzero(_gaps(x.min(0)[None], x.max(0)[None], lo, hi)[0] <= limit.max() ** 2)
                    step = max(1, CELLS // (len(at) * x.shape[1]))
                    for j in range(0, e - s, step):
                        part = x[j : j + step]
                        met = (_gaps(part, part, lo[at], hi[at]) <= limit[j : j + step, None] ** 2).any(0)
                        near.update(names[at[met]].tolist())
                        at = at[~met]
                        if not len(at):
                            break
                floors.append(floor.tobytes())
                nears.append(sorted(near))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(floors, pa.binary()), pa.array(nears, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "floors", "near"],
            )

    kept = blocks.drop("ends")
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{types}, floors binary, near array<bigint>")


class _Best:
    """The best k candidates so far of every row of one block."""

    def __init__(self, row: pa.RecordBatch, k: int):
        self.k, self.block = k, row.column("q_block")[0].as_py()
        self.ids = row.column("q_ids")[0].values
        self.units = _matrix(row.column("q_units")[0], len(self.ids))
        self.codes = _codes(row.column("q_codes")[0], len(self.ids))
        self.runs = _runs(row.column("q_names")[0], row.column("q_starts")[0], len(self.ids))
        self.floor = np.frombuffer(row.column("q_floors")[0].as_py(), float).copy()
        self.rows, self.scores = np.zeros(0, int), np.zeros(0)
        self.names, self.copies = None, None
        self.new = 0

    def meet(self, row: pa.RecordBatch) -> None:
        ids, copies = row.column("ids")[0].values, row.column("copies")[0].values
        units, codes = _matrix(row.column("units")[0], len(ids)), _codes(row.column("codes")[0], len(ids))
        own = row.column("block")[0].as_py() == self.block
        for b, (s, e) in _runs(row.column("names")[0], row.column("starts")[0], len(ids)).items():
            if b not in self.runs:
                continue
            first, last = self.runs[b]
            x = self.units[first:last]
            live = np.arange(last - first)
            if not own:
                box = units[s:e].min(0)[None], units[s:e].max(0)[None]
                live = np.flatnonzero(_gaps(x, x, *box)[:, 0] <= _limit(self.floor[first:last]) ** 2)
            # rows of a block go by cell, so a segment of them has a smaller box
            for at in range(s, e if len(live) else s, SEGMENT):
                end = min(e, at + SEGMENT)
                self._score(first, live, ids, copies, units[at:end], None if codes is None else codes[at:end], at, own)
            if self.new > len(self.ids):
                self.settle()

    def _score(
        self, first: int, live: np.ndarray, ids: pa.Array, copies: pa.Array, c: np.ndarray, codes: np.ndarray | None, at: int, own: bool
    ) -> None:
        """Take in what rows ``first + live`` find among candidates ``c``, the rows of the other block from ``at`` on."""
        rows = first + live
        x, floor = self.units[rows], self.floor[rows]
        near = _gaps(x, x, c.min(0)[None], c.max(0)[None])[:, 0] <= _limit(floor) ** 2
        rows, x, floor = rows[near], x[near], floor[near]
        if not len(rows):
            return
        scores = x @ c.T
        if own:
            scores[rows[:, None] == at + np.arange(len(c))[None, :]] = -np.inf
        bound = floor - MARGIN
        fresh = np.flatnonzero(~np.isfinite(bound))
        if codes is not None and len(fresh):
            scores[fresh] = np.where(_apart(self.codes[rows[fresh]], codes), -np.inf, scores[fresh])
        if len(fresh) and len(c) > self.k:
            bound[fresh] = np.partition(scores[fresh], len(c) - self.k, axis=1)[:, len(c) - self.k] - MARGIN
        i, j = np.nonzero((scores >= bound[:, None]) & (scores > -np.inf))
        if codes is not None:
            meet = (self.codes[rows[i]] == codes[j]).any(axis=1)
            i, j = i[meet], j[meet]
        found = np.round(scores[i, j], DIGITS) + 0.0
        keep = found >= floor[i]
        i, j, found = i[keep], j[keep], found[keep]
        if not len(i):
            return
        taken = pa.array(at + j)
        self.rows, self.scores = np.append(self.rows, rows[i]), np.append(self.scores, found)
        names, copied = ids.take(taken), copies.take(taken)
        self.names = names if self.names is None else pa.concat_arrays([self.names, names])
        self.copies = copied if self.copies is None else pa.concat_arrays([self.copies, copied])
        self.new += len(i)

    def settle(self) -> None:
        """Keep k candidates a row, ties to the smaller id, and lift the floors to the k-th of them."""
        names = self.names.to_numpy(zero_copy_only=False)
        order = np.lexsort((names.astype(str) if names.dtype == object else names, -self.scores, self.rows))
        rows = self.rows[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        last = order[place == self.k - 1]
        self.floor[self.rows[last]] = np.maximum(self.floor[self.rows[last]], self.scores[last])
        order = order[place < self.k]
        self.rows, self.scores = self.rows[order], self.scores[order]
        self.names, self.copies = self.names.take(pa.array(order)), self.copies.take(pa.array(order))
        self.new = 0

    def result(self) -> Iterator[pa.RecordBatch]:
        if not len(self.rows):
            return
        self.settle()
        values = np.empty(len(self.ids), object)
        for b, (s, e) in self.runs.items():
            values[s:e] = b
        yield pa.RecordBatch.from_arrays(
            [pa.array(values[self.rows], pa.string()), self.ids.take(pa.array(self.rows)), pa.array(self.scores), self.names, self.copies],
            names=["_b", "_id", "_s", "_cid", "_ids"],
        )


def _opened(placed: DataFrame, total: int, k: int, chunk: int) -> DataFrame:
    blocks = durable(_blocks(placed, total, chunk), "vector-blocks")
    return durable(_open(blocks, k), "opened-blocks")


def _found(placed: DataFrame, opened: DataFrame, k: int) -> DataFrame:
    """(_b, _id, _s, _cid, _ids): candidates of the same ``_b``, among them the best k of every row."""
    mine = opened.select(*[F.col(c).alias(f"q_{c}") for c in ("block", "ids", "units", "codes", "names", "starts", "floors")], "near")
    other = opened.select("block", "ids", "copies", "units", "codes", "names", "starts")
    pairs = mine.join(other, F.array_contains("near", F.col("block"))).drop("near")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                if best is None or row.column("q_block")[0].as_py() != best.block:
                    if best is not None:
                        yield from best.result()
                    best = _Best(row, k)
                best.meet(row)
        if best is not None:
            yield from best.result()

    types = {f.name: f.dataType.simpleString() for f in placed.schema}
    return pairs.mapInArrow(run, f"_b string, _id {types['_id']}, _s double, _cid {types['_id']}, _ids {types['_ids']}")


def _distinct(rows: DataFrame, k: int) -> tuple[DataFrame, int]:
    """One row per distinct vector of (_b, _id, _vec) with its count and k + 1 smallest ids, and the number of such rows.

    Both steps keep only that much of a group before the shuffle.
    """
    group = ["_b", "_vec"]
    first = Window.partitionBy(*group).orderBy("_id")
    few = rows.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= k + 1)
    members = few.groupBy(*group).agg(F.sort_array(F.collect_list("_id")).alias("_ids"))
    counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    return durable_counted(
        members.join(counts, group).select("_b", F.col("_ids")[0].alias("_id"), "_ids", "_n", "_vec"), "vectors"
    )


def _placed(distinct: DataFrame, total: int, cells: int | None, chunk: int) -> DataFrame:
    """``_place`` by a tree of about ``cells`` cells, fitted on a bounded sample; by default four cells a block."""
    depth = math.ceil(math.log2(max(1, cells or 4 * total // chunk)))
    depth = min(depth, int(math.log2(SAMPLE // 8)))
    sample = distinct.orderBy(F.xxhash64("_id"), "_id").select("_vec").limit(SAMPLE if depth else 1).toPandas()
    none = np.zeros(0, int), np.zeros(0)
    return durable(_place(distinct, _tree(_unit(sample["_vec"]), depth) if len(sample) else none), "placed")


def _answers(rows: DataFrame, distinct: DataFrame, placed: DataFrame, top: DataFrame, k: int, id_column: str) -> DataFrame:
    """Neighbours of every row from those of its vector: its copies, then the best vectors' ids."""
    entries = lambda ids, n: F.transform(ids, lambda i: F.struct(n.alias("n"), i.alias("i")))
    others = F.coalesce(F.flatten(F.transform("_top", lambda t: entries(t["ids"], t["n"]))), F.array())
    ranked = F.slice(F.array_sort(F.concat(entries(F.col("_ids"), -F.col("_self")), others)), 1, k + 1)
    answers = durable(placed.join(top, ["_b", "_id"], "left").select("_b", "_id", "_ids", "_n", ranked.alias("_near")), "neighbours")
    # Up to k + 1 copies are all named in the list; only larger groups are matched back to their rows.
    few = F.col("_n") <= k + 1
    joined = answers.where(few).select(F.explode("_ids").alias("_id"), "_near")
    many = answers.where(~few)
    if not many.isEmpty():
        key = F.struct("_b", "_vec").alias("_key")
        vectors = distinct.where(~few).select("_b", "_id", "_vec")
        table = durable(many.join(vectors, ["_b", "_id"]).select(key, "_n", "_near"), "copies")
        matched = attach_by_value(rows.select("_id", key), table, "_key", "_n", ROWS_PER_RANGE)
        joined = joined.unionByName(matched.select("_id", "_near"))
    others = F.slice(F.filter("_near", lambda x: x["i"] != F.col("_id")), 1, k)
    return joined.select(F.col("_id").alias(id_column), F.posexplode(others).alias("_pos", "_x")).select(
        id_column,
        F.col("_x.i").alias("neighbour_id"),
        (-F.col("_x.n") + F.lit(0.0)).alias("score"),
        (F.col("_pos") + 1).cast("bigint").alias("rank"),
    )


def _rows(df: DataFrame, id_column: str, vector: str, block: Column) -> DataFrame:
    rows = df.select(F.col(id_column).alias("_id"), block.alias("_b"), F.col(vector).cast("array<double>").alias("_vec"))
    return rows.where(F.col("_b").isNotNull() & F.col("_vec").isNotNull())


def _entry() -> Column:
    return F.struct((-F.col("_s")).alias("n"), F.col("_cid").alias("i"), F.col("_ids").alias("ids"))


def prepare(df: DataFrame, k: int, id_column: str, vector: str, chunk: int = CHUNK) -> tuple[DataFrame, int, DataFrame]:
    """Distinct vectors, their number, and their places, for several searches of one table with the same ``k``."""
    distinct, total = _distinct(_rows(df, id_column, vector, F.lit("")), k)
    return distinct, total, _placed(distinct, total, None, chunk)


def cosine_topk(
    df: DataFrame,
    k: int,
    id_column: str,
    vector: str,
    within: Column | None = None,
    pivots: int | None = None,
    chunk: int = CHUNK,
    prepared: tuple[DataFrame, int, DataFrame] | None = None,
) -> DataFrame:
    """(id, neighbour_id, score, rank): the k most similar other rows of every row, exactly.

    Scores are rounded to six digits, ties go to the smaller id, a zero vector scores 0 with
    everything. ``within`` limits neighbours to rows with the same value. ``pivots`` is the number
    of cells, taken up to a power of two, and ``chunk`` the rows of a block. ``prepared`` is what ``prepare`` made of the
    same table, for a search without ``within`` and ``pivots``.
    """
    rows = _rows(df, id_column, vector, within.cast("string") if within is not None else F.lit(""))
    if prepared:
        distinct, total, placed = prepared
    else:
        distinct, total = _distinct(rows, k)
        placed = _placed(distinct, total, pivots, chunk)
    found = _found(placed, _opened(placed, total, k, chunk), k)
    top = found.groupBy("_b", "_id").agg(F.slice(F.array_sort(F.collect_list(_entry())), 1, k).alias("_top"))
    return _answers(rows, distinct, placed, top, k, id_column)


def cosine_topk_lsh(
    df: DataFrame,
    k: int,
    id_column: str,
    vector: str,
    tables: int = 16,
    projections: int = 8,
    width: float = 2.0,
    seed: int = 42,
    chunk: int = CHUNK,
    prepared: tuple[DataFrame, int, DataFrame] | None = None,
) -> DataFrame:
    """Approximate top-k: rows are compared only where all ``projections`` of a hash table put
    their unit vectors into the same slot, in at least one of ``tables`` tables.

    ``width`` is the slot length in units of 1/sqrt(dimension), the spread of a projection. More
    projections prune more, more tables find more; neighbours that are not close (in 64 random
    dimensions, say) are missed. Copies are hashed once. Rows meet the blocks that may hold one of their best k, as in the
    exact operator, and take only neighbours from a bucket of their own, so a row is held once and not once a table. Where that is
    too many blocks, buckets take the place of ``within`` in the exact operator. Both find the same pairs.
    """
    rows = _rows(df, id_column, vector, F.lit(""))
    distinct, total, placed = prepared or prepare(df, k, id_column, vector, chunk)
    some = placed.select(F.size("_u").alias("n")).first()
    length = width / math.sqrt(some["n"]) if some else width
    units = placed.withColumn("_v", array_to_vector("_u"))
    model = BucketedRandomProjectionLSH(
        inputCol="_v", outputCol="_h", bucketLength=length, numHashTables=tables * projections, seed=seed
    ).fit(units)
    slots = F.concat_ws(",", F.transform("_h", lambda v: v.cast("string")))
    hashes = F.split("_slots", ",")
    bucket = F.transform(
        F.sequence(F.lit(0), F.lit(tables - 1)),
        lambda i: F.concat_ws(":", i.cast("string"), F.slice(hashes, i * projections + 1, projections)),
    )
    slotted = model.transform(units).withColumn("_slots", slots)
    # One row a vector meets the blocks around it, and only pairs with a bucket in common count.
    codes = F.array(*[F.xxhash64(F.slice("_h", i * projections + 1, projections)) for i in range(tables)])
    coded = durable(model.transform(units).select("_b", "_id", "_ids", "_u", "_cell", codes.alias("_h")), "hashed")
    opened = _opened(coded, total, k, chunk)
    met = opened.agg(F.sum(F.size("near")).alias("pairs"), F.count(F.lit(1)).alias("blocks")).first()
    if (met["pairs"] or 0) <= max(MEETS * tables, met["blocks"] / 4) * met["blocks"]:
        top = _found(coded, opened, k).groupBy("_id").agg(F.slice(F.array_sort(F.collect_list(_entry())), 1, k).alias("_top"))
        return _answers(rows, distinct, placed, top.withColumn("_b", F.lit("")), k, id_column)
    # Blocks around a row are too many where vectors have no structure: then each bucket is searched for itself.
    hashed = durable(slotted.select(F.explode(bucket).alias("_b"), "_id", "_ids", "_u", "_cell"), "hashed")
    # The same neighbour may come from several tables: at most tables * k entries per id.
    found = _found(hashed, _opened(hashed, total * tables, k, chunk), k)
    top = found.groupBy("_id").agg(F.slice(F.array_sort(F.collect_set(_entry())), 1, k).alias("_top"))
    return _answers(rows, distinct, placed, top.withColumn("_b", F.lit("")), k, id_column)


def recall(found: DataFrame, exact: DataFrame, id_column: str) -> DataFrame:
    """Share of the exact neighbours an approximate result contains."""
    hits = exact.join(found.select(id_column, "neighbour_id"), [id_column, "neighbour_id"], "left_semi")
    total = exact.agg(F.count(F.lit(1))).scalar()
    return hits.agg(F.try_divide(F.count(F.lit(1)).cast("double"), total).alias("recall"))


# --- recommendations ------------------------------------------------------------------------


def scaled_features(features: DataFrame, columns: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """Complete rows, one per product, with z-scores next to the features."""
    once = keep_best(complete_rows(features, columns).withColumn("_one", F.lit(0.0)), "product_id", "_one", "product_id")
    return standard_scale(durable(once.drop("_one"), "features"), columns)


def feature_neighbours(scaled: DataFrame, k: int, within: Column | None = None, **options) -> DataFrame:
    """Exact top-k neighbours of every product by its scaled features."""
    rows = scaled.withColumn("_f", F.array(*(f"{c}_z" for c in FEATURE_COLS)))
    return cosine_topk(rows, k, "product_id", "_f", within=within, **options)


def similar_to(scaled: DataFrame, product_id, within: str | None = None) -> DataFrame:
    """All other products with their similarity to one product; none when the id is unknown.

    The product's own vector is one row, read as a scalar subquery; the rest is column arithmetic.
    """
    z = [f"{c}_z" for c in FEATURE_COLS]
    wanted = scaled.where(F.col("product_id") == F.lit(product_id))
    target = wanted.agg(F.first(F.struct(*z, *([within] if within else [])))).scalar()
    rows = scaled.where(F.col("product_id") != F.lit(product_id)).withColumn("_q", target).where(F.col("_q").isNotNull())
    if within:
        rows = rows.where(F.col(within) == F.col(f"_q.{within}"))
    total = lambda terms: sum(terms[1:], terms[0])
    dot = total([F.col(c) * F.col(f"_q.{c}") for c in z])
    norms = F.sqrt(total([F.col(c) * F.col(c) for c in z]) * total([F.col(f"_q.{c}") * F.col(f"_q.{c}") for c in z]))
    score = F.coalesce(F.try_divide(dot, norms), F.lit(0.0))
    return rows.withColumn("similarity", F.round(score, 9) + F.lit(0.0)).drop("_q")


def recommend(scaled: DataFrame, product_id, top_n: int = 5, within: str | None = None) -> DataFrame:
    """The most similar products. With ``within`` only products of the same label count; a frame
    without that column falls back to all products."""
    label = within if within in scaled.columns else None
    best = similar_to(scaled, product_id, label).orderBy(F.desc("similarity"), "product_id").limit(top_n)
    return best.select(
        "product_id",
        "product_name",
        "brand",
        F.round("listing_price", 2).alias("listing_price"),
        F.round("rating", 2).alias("rating"),
        F.round("revenue", 2).alias("revenue"),
        F.round("similarity", 4).alias("similarity_score"),
    )


def recommend_names(scaled: DataFrame, product_id, top_n: int = 5, within: str | None = None) -> DataFrame:
    """Recommendations for display: the best product of each name, then the first ``top_n`` of those; revenue
    back on its own scale. There are ``top_n`` names whenever that many exist."""
    label = within if within in scaled.columns else None
    best = keep_best(similar_to(scaled, product_id, label), "product_name", "similarity", "product_id", top_n)
    return best.select(
        "product_name",
        "brand",
        F.format_string("%.0f", "listing_price").alias("price"),
        F.format_string("%.2f", "rating").alias("rating"),
        money_text(F.expm1("revenue")).alias("revenue"),
        percent_text(F.col("similarity")).alias("similarity"),
    )


def with_cluster_label(features: DataFrame, clusters: DataFrame | None, default: str = "Unknown") -> DataFrame:
    """Features with their cluster label; the default where a product, or the whole table, is missing."""
    if clusters is None:
        return features.withColumn("cluster_label", F.lit(default))
    labelled = features.join(clusters.select("product_id", "cluster_label"), "product_id", "left")
    return labelled.withColumn("cluster_label", F.coalesce("cluster_label", F.lit(default)))


# --- stored neighbours -----------------------------------------------------------------------


def _bucket(product_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(product_id), F.lit(buckets)).cast("int")


def save_neighbours(neighbours: DataFrame, path: str, buckets: int = 64) -> DataFrame:
    """Top-k pairs in folders by product bucket, so serving one product reads one folder."""
    rows = neighbours.withColumn("bucket", _bucket(F.col("product_id"), buckets))
    return overwrite(rows.repartition("bucket"), path, partition_by=["bucket"])


def stored_neighbours(spark, path: str, product_id, features: DataFrame, top_n: int = 5, buckets: int = 64) -> DataFrame:
    """Recommendations of one product from the stored pairs."""
    table = read_current(spark, path)
    if table is None:
        raise FileNotFoundError(f"no stored neighbours below {path}: run save_neighbours first")
    key = F.lit(product_id)
    mine = table.where(
        (F.col("bucket") == _bucket(key, buckets)) & (F.col("product_id") == key) & (F.col("rank") <= top_n)
    )
    about = features.select(F.col("product_id").alias("neighbour_id"), "product_name", "brand")
    return mine.join(about, "neighbour_id").select("neighbour_id", "product_name", "brand", "score", "rank").orderBy("rank")
