"""Exact top-k search by inner product.

Method: vectors are processed by falling length. Rotated by the SVD of all vectors, the leading coordinates of a pair give a
partial sum, and the Cauchy-Schwarz bound on the rest prunes what cannot reach the query's k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.session import durable

BLOCK = 4096
QUERIES = 1024
_BLOCKS = "block long, top double, ids binary, rows binary, vectors binary, dims int"


def whole_numbers(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id, v: floor(scale * x) of every component; rows without an id, or whose vector is NULL, empty or not finite, go."""
    x = F.col("embedding")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)).filter(~bad)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v"))


def _packed(table: np.ndarray) -> bytes:
    """The whole numbers of a table in as few bytes each as its largest one takes."""
    low, high = int(table.min()), int(table.max())
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return table.astype(kind).tobytes()


def _matrix(data: bytes, rows: int, dims: int) -> np.ndarray:
    return np.frombuffer(data, f"i{len(data) // (rows * dims)}").reshape(rows, dims).astype(np.int64)


def blocks_by_length(rows: DataFrame) -> DataFrame:
    """Blocks of at most ``BLOCK`` vectors in order of falling length, numbered in that order.

    Ranges of (length, id) go to tasks, so equal vectors are split too. Shorter vectors are filled up with zeros
    to the longest of their block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held_ids, held = TaskContext.get().partitionId() << 32, [], []

        def block() -> pa.RecordBatch:
            dims = max(len(v) for v in held)
            table = np.zeros((len(held), dims), np.int64)
            for k, v in enumerate(held):
                table[k, : len(v)] = v
            top = float(np.sqrt((table[0].astype(float) ** 2).sum()))
            names = (number << 13) + np.arange(len(held))
            row = (number, top, np.array(held_ids, np.int64).tobytes(), names.tobytes(), _packed(table), dims)
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, (pa.int64(), pa.float64(), pa.binary(), pa.binary(), pa.binary(), pa.int32()))],
                names=["block", "top", "ids", "rows", "vectors", "dims"],
            )

        for batch in batches:
            lists = batch.column(1)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy(zero_copy_only=False)
            ends = ends - ends[0]
            for k, name in enumerate(batch.column(0).to_pylist()):
                held_ids.append(name)
                held.append(flat[ends[k] : ends[k + 1]])
                if len(held) == BLOCK:
                    yield block()
                    number, held_ids, held = number + 1, [], []
        if held:
            yield block()

    length = F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))
    placed = rows.withColumn("length", -length).repartitionByRange("length", "vec_id").sortWithinPartitions("length", "vec_id")
    return placed.select("vec_id", "v").mapInArrow(run, _BLOCKS)


def rotation(blocks: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of all vectors, strongest first, from their second moments added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            for data, rows, d in zip(*(batch.column(k).to_pylist() for k in range(3))):
                v = _matrix(data, len(rows) // 8, d).astype(float)
                total[:d, :d] += v.T @ v
        i, j = np.divmod(np.arange(dims * dims), dims)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "s"])

    sums = blocks.select("vectors", "rows", "dims").mapInArrow(run, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    out = np.zeros((dims, dims))
    for r in sums.collect():  # dims x dims numbers
        out[r["i"], r["j"]] = r["s"]
    return np.linalg.eigh((out + out.T) / 2)[1][:, ::-1]


def query_blocks(blocks: DataFrame, is_query) -> DataFrame:
    """The vectors of the blocks whose id is a query, in blocks of at most ``QUERIES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, tables, count = [], [], [], 0
        number = TaskContext.get().partitionId() << 32

        def block() -> pa.RecordBatch:
            dims = max(t.shape[1] for t in tables)
            table = np.concatenate([np.pad(t, ((0, 0), (0, dims - t.shape[1]))) for t in tables])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                    pa.array([np.concatenate(rows).tobytes()], pa.binary()),
                    pa.array([_packed(table)], pa.binary()),
                    pa.array([dims], pa.int32()),
                ],
                names=["part", "q_ids", "q_rows", "q_vectors", "q_dims"],
            )

        for batch in batches:
            for name, row, data, dims in zip(batch.column(0), batch.column(1), batch.column(2), batch.column(3).to_pylist()):
                name, row = np.frombuffer(name.as_py(), np.int64), np.frombuffer(row.as_py(), np.int64)
                use = np.flatnonzero(is_query(name))
                for at in range(0, len(use), QUERIES):
                    part = use[at : at + QUERIES]
                    if count + len(part) > QUERIES:
                        yield block()
                        ids, rows, tables, count, number = [], [], [], 0, number + 1
                    ids.append(name[part])
                    rows.append(row[part])
                    tables.append(_matrix(data.as_py(), len(row), dims)[part])
                    count += len(part)
        if count:
            yield block()

    return blocks.select("ids", "rows", "vectors", "dims").mapInArrow(
        run, "part long, q_ids binary, q_rows binary, q_vectors binary, q_dims int"
    )


def best_of_block(
    q: np.ndarray, q_rows: np.ndarray, floor: np.ndarray, c: np.ndarray, c_ids: np.ndarray, c_rows: np.ndarray, basis: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of each query's k best in one block that reach its floor; candidates go by falling length."""
    dims = max(q.shape[1], c.shape[1])
    q, c = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in (q, c))
    qf, cf = q.astype(float), c.astype(float)
    q_len, c_len = np.sqrt((qf**2).sum(axis=1)), np.sqrt((cf**2).sum(axis=1))
    live = np.flatnonzero(q_len * c_len[0] * (1 + 1e-9) + 1e-6 >= floor)
    none = np.zeros(0, np.int64)
    if not len(live):
        return none, none, none
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(q_len[live] > 0, floor[live] / np.maximum(q_len[live], 1e-300), np.where(floor[live] > 0, np.inf, -np.inf)).min()
    reach = int(np.searchsorted(-c_len, -(need * (1 - 1e-9) - 1e-6), side="right")) if need > 0 else len(c)
    if not reach:
        return none, none, none
    basis = basis[:dims, :] if basis.shape[0] >= dims else np.eye(dims)
    head = max(1, basis.shape[1] // 4)
    qr, cr = qf[live] @ basis[:, :head], cf[:reach] @ basis[:, :head]
    q_rest = np.sqrt(np.maximum(q_len[live] ** 2 - (qr**2).sum(axis=1), 0) + 1e-6 * q_len[live] ** 2)
    c_rest = np.sqrt(np.maximum(c_len[:reach] ** 2 - (cr**2).sum(axis=1), 0) + 1e-6 * c_len[:reach] ** 2)
    may = qr @ cr.T + q_rest[:, None] * c_rest[None, :] + 1e-3 >= floor[live][:, None]
    use = np.flatnonzero(may.any(axis=0))
    use = use[np.argsort(c_ids[use], kind="stable")]  # ties: smaller id first
    if not len(use):
        return none, none, none
    exact = q_len.max() * c_len[0] < 2**53
    scores = qf[live] @ cf[use].T if exact else (q[live].astype(object) @ c[use].T.astype(object))
    allowed = may[:, use] & (q_rows[live][:, None] != c_rows[use][None, :]) & (scores >= floor[live][:, None]).astype(bool)
    if not exact:
        out = [(live[a], use[b], int(scores[a, b])) for a in range(len(live)) for b in sorted(np.flatnonzero(allowed[a]), key=lambda b: -scores[a, b])[:k]]
        return tuple(np.array(x) for x in zip(*out)) if out else (none, none, none)
    if np.count_nonzero(allowed) > 8 * k * len(live) and scores.shape[1] > k:  # fewer are sorted as they are
        scores = np.where(allowed, scores, -np.inf)
        cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        allowed &= scores >= cut[:, None]
    a, b = np.nonzero(allowed)
    order = np.lexsort((b, -scores[a, b], a))
    a, b = a[order], b[order]
    nth = np.arange(len(a)) - np.searchsorted(a, a, side="left")
    a, b = a[nth < k], b[nth < k]
    return live[a], use[b], scores[a, b].astype(np.int64)


def _floor(q_rows: np.ndarray, floors: list | None) -> np.ndarray:
    known = {f["q_row"]: f["floor"] for f in floors or ()}
    return np.array([known.get(x, -np.inf) for x in q_rows.tolist()], float)


def reachable(queries: DataFrame, blocks: DataFrame) -> DataFrame:
    """(part, block) of those query blocks and blocks in which the longest vector may reach the floor of some query.

    Only numbers take part: the vectors are joined to what is left. ``blocks`` is one small row per 4,096 vectors here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                q_rows = np.frombuffer(r["q_rows"], np.int64)
                length = np.sqrt((_matrix(r["q_vectors"], len(q_rows), r["q_dims"]).astype(float) ** 2).sum(axis=1))
                floor = _floor(q_rows, r["floors"])
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where(length > 0, (floor - 1e-6) / (length * (1 + 1e-9)), np.where(floor > 1e-6, np.inf, -np.inf))
                out.append(need.min())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["part", "need"])

    needs = queries.select("part", "q_rows", "q_vectors", "q_dims", "floors").mapInArrow(run, "part long, need double")
    return needs.join(F.broadcast(blocks.select("block", "top")), F.col("top") >= F.col("need") * (1 - 1e-9) - 1e-9).select("part", "block")


def _scan(pairs: DataFrame, basis: np.ndarray, k: int, floors: bool) -> DataFrame:
    shared = pairs.sparkSession.sparkContext.broadcast(basis)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q_rows, q_ids = np.frombuffer(r["q_rows"], np.int64), np.frombuffer(r["q_ids"], np.int64)
                c_ids, c_rows = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["rows"], np.int64)
                q, c = _matrix(r["q_vectors"], len(q_rows), r["q_dims"]), _matrix(r["vectors"], len(c_rows), r["dims"])
                floor = _floor(q_rows, r["floors"] if floors else None)
                a, b, s = best_of_block(q, q_rows, floor, c, c_ids, c_rows, shared.value, k)
                part = np.full(len(a), r["part"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array(q_rows[a]), pa.array(q_ids[a]), pa.array(c_ids[b]), pa.array(c_rows[b]), pa.array(s, pa.int64())],
                    names=["part", "q_row", "query_id", "vec_id", "c_row", "score"],
                )

    return pairs.mapInArrow(run, "part long, q_row long, query_id long, vec_id long, c_row long, score long")


def top_products(vectors: DataFrame, is_query=lambda ids: ids % 20 == 0, k: int = 20, scale: int = 64) -> DataFrame:
    """The k largest inner products of each query with all other rows: query_id, rank, vec_id, score.

    Components are floor(scale * x). Ties go to the smaller vec_id. Rows whose id or vector is NULL, empty or not finite take no part;
    vectors of unlike dimension are filled up with zeros; a repeated row is a row of its own, as a candidate and as a
    query, so it is found by its copy; other columns are ignored; an empty table, or one without queries, gives no rows.

    Queries and candidates meet block by block. Each query first meets the block of the longest vectors, which gives its floor;
    after that blocks too short for all queries of a query block are left out before any vector is moved, and whole
    blocks, the short end of a block, and pairs by their partial sums are skipped by it.
    """
    blocks = durable(blocks_by_length(whole_numbers(vectors, scale)), "vector-blocks")
    heads = blocks.agg(F.min("block").alias("first"), F.max("dims").alias("dims")).first()
    queries = durable(query_blocks(blocks, is_query), "query-blocks")
    basis = rotation(blocks, heads["dims"] or 1)
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "c_row")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    is_first = F.col("block") == F.lit(heads["first"] if heads["first"] is not None else -1)
    start = queries.crossJoin(F.broadcast(blocks.filter(is_first)))  # one block
    opening = durable(_scan(start, basis, k, False), "first-block")
    floors = best(opening).groupBy("part", "q_row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")).filter(F.col("n") == k)
    floors = floors.groupBy("part").agg(F.collect_list(F.struct("q_row", "floor")).alias("floors"))  # at most QUERIES each
    opened = durable(queries.join(floors.hint("merge"), "part", "left"), "opened-queries")
    chosen = durable(reachable(opened, blocks.filter(~is_first)), "block-pairs")
    # a query block goes to many blocks: files say nothing of that size, so no side may be broadcast for the size of its files
    pairs = opened.join(chosen.hint("merge"), "part").join(blocks.hint("merge"), "block")
    found = opening.unionByName(_scan(pairs, basis, k, True))
    return best(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
