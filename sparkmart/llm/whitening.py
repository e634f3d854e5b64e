"""Whitening of integer-scaled embeddings along their leading principal components.

Method: mixed-precision refinement. float32 eigenvectors of the distributed covariance are corrected by Ogita-Aishima
iterations, which take only matrix products in higher precision; clusters of eigenvalues are told apart by
sub-solves of their own small matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.session import durable

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
_MOST = float(1 << 61)  # scaled entries stop here
_BYTES = 8 << 20  # of doubles that are worked on at once
_WIDE = np.longdouble


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x array<long>) of the rows whose vector has entries, none of them NULL or non-finite."""
    vector = F.col(embedding)
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    rows = df.select(F.col(vec_id).alias("vec_id"), vector.alias("e")).filter(F.col("e").isNotNull() & (F.size("e") > 0) & whole)
    scaled = F.transform("e", lambda c: F.greatest(F.lit(-_MOST), F.least(F.lit(_MOST), F.floor(c.cast("double") * SCALE))).cast("long"))
    return rows.select("vec_id", F.transform(scaled, lambda x: x + SHIFT).alias("x"))


def _blocks(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(dimension, rows, matrix) for slices of each batch that hold about ``_BYTES``, one dimension each."""
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index(name))
        dims = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        for d in np.unique(dims).tolist():
            rows = batch if (dims == d).all() else batch.filter(pa.array(dims == d))
            step = max(1, _BYTES // (8 * d))
            for k in range(0, rows.num_rows, step):
                part = rows.slice(k, step)
                values = part.column(part.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)
                yield d, part, values.reshape(-1, d)


def fit_sums(vectors: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """{dimension: (n, exact sum of each entry)}, added by Spark as decimals of 38 digits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[int, np.ndarray]] = {}
        for d, _, x in _blocks(batches, "x"):
            n, sums = total.get(d, (0, np.zeros(d, object)))
            high, low = x >> 31, x & 0x7FFFFFFF  # parts whose sums over a block fit
            total[d] = n + len(x), sums + low.sum(0).astype(object) + high.sum(0).astype(object) * (1 << 31)
        for d, (n, sums) in total.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(d, d, np.int32)),
                    pa.array(np.arange(d, dtype=np.int32)),
                    pa.array(np.full(d, n, np.int64)),
                    pa.array([Decimal(int(s)) for s in sums], pa.decimal128(38, 0)),
                ],
                names=["dim", "entry", "n", "s"],
            )

    parts = vectors.select("x").mapInArrow(run, "dim int, entry int, n long, s decimal(38,0)")
    sums: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("dim", "entry").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("dim", "entry").collect():
        sums.setdefault(r["dim"], (r["n"], []))[1].append(int(r["s"]))  # a row an entry
    return sums


def covariances(df: DataFrame, column: str, means: dict[int, np.ndarray] | None = None) -> DataFrame:
    """(dim, n, cov array<double>) of the vectors in ``column``, divisor n, row by row.

    Every block is centred before it is multiplied: on the given means, else on its own mean, in which case blocks are put
    together by the squares of the distances of their means. One square matrix leaves each task and dimension; they are
    added in two levels.
    """

    def merge(parts: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray] | None:
        held = None
        for n, mean, moment in parts:
            if held is None:
                held = n, mean, moment
                continue
            m, old, sums = held
            gap, all_rows = mean - old, n + m
            held = all_rows, old + gap * (n / all_rows), sums + moment + np.outer(gap, gap) * (n * m / all_rows)
        return held

    def block(d: int, x: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        x = x.astype(np.float64)
        mean = x.mean(0) if means is None else means[d]
        x -= mean
        if means is None:  # what rounding left of the mean
            rest = x.mean(0)
            mean, x = mean + rest, x - rest
        return len(x), mean, x.T @ x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        total: dict[int, tuple] = {}
        for d, _, x in _blocks(batches, column):
            total[d] = merge(iter([total[d], block(d, x)] if d in total else [block(d, x)]))
        rows = [(d, n, mean, moment.ravel()) for d, (n, mean, moment) in total.items()]
        if rows:
            dim, n, mean, moment = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(dim, pa.int32()), pa.array(n, pa.int64()), *(pa.array([v.tolist() for v in c], pa.list_(pa.float64())) for c in (mean, moment))],
                names=["dim", "n", "mean", "moment"],
            )

    def add(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(["n"], kind="stable")
        d = int(table["dim"].iloc[0])
        parts = ((int(n), np.asarray(m, float), np.asarray(v, float).reshape(d, d)) for n, m, v in zip(table["n"], table["mean"], table["moment"]))
        n, mean, moment = merge(parts)
        return pd.DataFrame({"dim": [d], "n": [n], "mean": [mean.tolist()], "moment": [moment.ravel().tolist()]})

    schema = "dim int, n long, mean array<double>, moment array<double>"
    parts = df.select(column).mapInArrow(run, schema).withColumn("part", F.spark_partition_id() % 64)
    some = parts.groupBy("dim", "part").applyInPandas(lambda t: add(t), schema)
    whole = some.groupBy("dim").applyInPandas(lambda t: add(t), schema)
    return whole.select("dim", "n", F.transform("moment", lambda v: v / F.col("n")).alias("cov"))


def refine(a: np.ndarray, x: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors) of symmetric ``a``, falling, by Ogita-Aishima iterations from approximate vectors ``x``.

    One iteration takes matrix products only, here in extended precision: R = I - X'X, S = X'AX, eigenvalues
    s / (1 - r), then X + XE with e_ij = (s_ij + l_j r_ij) / (l_j - l_i). Where two eigenvalues are closer than
    the error bound that division says nothing, so e_ij = r_ij / 2 only restores orthogonality; such clusters are solved
    on their own: the small matrix X_J' (A - m I) X_J, with the common part m taken off first, has well separated
    eigenvalues again, and its eigenvectors turn X_J.
    """
    a, x = a.astype(_WIDE), x.astype(_WIDE)
    eye, size, last = np.eye(len(a), dtype=_WIDE), np.abs(a).sum(0).max(), np.inf
    if not size:
        return np.zeros(len(a)), np.eye(len(a))
    tiny = np.finfo(np.float64).eps * size

    def products() -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        r, s = eye - x.T @ x, x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        return r, s, values, float(2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum())))

    for _ in range(rounds):
        r, s, values, bound = products()
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= max(bound, float(tiny))
        e = np.where(near, r / 2, (s + r * values[None, :]) / np.where(near, 1, gap))
        x = x + x @ e
        order = np.argsort(-values, kind="stable")
        x, values = x[:, order], values[order]
        split = np.flatnonzero(-np.diff(values) > max(bound, float(tiny))) + 1
        for group in np.split(np.arange(len(a)), split):
            if len(group) > 1:
                x[:, group] = _sub_solve(a, x[:, group], values[group].mean())
        change = float(np.abs(e).max())
        if change < np.finfo(np.float64).eps / 8 or (change >= last and change < 1e-14):
            break
        last = change
    x = x @ ((3 * eye - x.T @ x) / 2)
    _, _, values, _ = products()
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    return values[order].astype(np.float64), (x / np.sqrt((x * x).sum(0))).astype(np.float64)


def _sub_solve(a: np.ndarray, x: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """Vectors of one cluster, orthonormal, turned to the eigenvectors of their own small matrix."""
    for _ in range(2):  # one step of (3 - X'X) / 2 squares the distance from orthonormal
        x = x @ ((3 * np.eye(x.shape[1], dtype=_WIDE) - x.T @ x) / 2)
    small = x.T @ (a @ x - middle * x)
    scale = float(np.abs(small).max())
    if not scale:
        return x
    small = ((small + small.T) / (2 * scale)).astype(np.float64)
    _, turn = np.linalg.eigh(small)
    return x @ turn[:, ::-1].astype(_WIDE)


def leading(cov: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, vectors as columns, trace) of the k leading components, from a float32 solve refined."""
    _, start = np.linalg.eigh((cov / max(np.abs(cov).max(), 1e-300)).astype(np.float32))
    values, vectors = refine(cov, start[:, ::-1])
    return values[:k], vectors[:, :k], float(np.trace(cov))


def whiten(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error; a row for each vector and component.

    Entries become floor(1024 c) + 100000. Components are unit eigenvectors of their covariance V, by falling eigenvalue
    e; explained is e over the trace of V, deviation the exact sum of (n x - S)^2 over the entries, identity_error the
    largest entry of the whitened vectors' covariance minus the identity.

    Rows whose vector is NULL, empty, or holds NULL or non-finite entries go. Vectors of different length are different
    tables: each length is fitted on its own. Repeated rows count as often as they come and NULL ids are ids like others.
    Entries beyond 2^61 stop there; a deviation beyond long is NULL. A component without variance (eigenvalue not above
    rounding, so also every one of a single row) has whitened NULL and does not count for identity_error, which is NULL
    without any other; explained is NULL where the trace is 0. Other columns are ignored; an empty table gives no rows.

    Four passes over narrow rows: sums, covariance, projection (written), covariance of the written result. Only sums and
    eigenvectors reach the driver.
    """
    spark = df.sparkSession
    vectors = durable(integer_vectors(df, vec_id, embedding), "integer-vectors")
    sums = fit_sums(vectors)
    means = {d: np.array([s / n for s in total]) for d, (n, total) in sums.items()}

    def solve(table: pd.DataFrame) -> pd.DataFrame:
        out = []
        for d, cov in zip(table["dim"], table["cov"]):
            values, axes, trace = leading(np.asarray(cov, float).reshape(d, d), components)
            out.append((d, values.tolist(), axes.T.ravel().tolist(), trace))
        return pd.DataFrame(out, columns=["dim", "values", "axes", "trace"])

    solved = covariances(vectors, "x", means).groupBy("dim").applyInPandas(
        lambda t: solve(t), "dim int, values array<double>, axes array<double>, trace double"
    )
    model = {}
    for r in solved.collect():  # k vectors for each length
        d, values = r["dim"], np.array(r["values"])
        n, total = sums[d]
        real = values > d * np.finfo(np.float64).eps * max(values[0], 0) if len(values) else np.zeros(0, bool)
        axes = np.array(r["axes"]).reshape(-1, d)
        scaled = axes[real] / np.sqrt(values[real])[:, None]
        explained = [float(v / r["trace"]) if r["trace"] > 0 else None for v in values]
        model[d] = (n, total, scaled.T, real, explained)
    held = spark.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for d, rows, x in _blocks(batches, "x"):
            n, total, scaled, real, explained = held.value[d]
            spread = max(abs(int(x.max()) * n - min(total)), abs(int(x.min()) * n - max(total)), 1)
            if spread * spread * d < 1 << 62:
                apart = x * n - np.array(total, np.int64)
                deviation = (apart * apart).sum(1).tolist()
            else:
                apart = x.astype(object) * n - np.array(total, object)
                deviation = [v if v < 1 << 63 else None for v in (apart * apart).sum(1).tolist()]
            exact = apart.astype(np.float64) / n  # x - S/n, rounded once
            white = exact @ scaled
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(rows.schema.get_field_index("vec_id")),
                    pa.array(np.full(len(x), d, np.int32)),
                    pa.array(deviation, pa.int64()),
                    pa.array(white.tolist(), pa.list_(pa.float64())),
                ],
                names=["vec_id", "dim", "deviation", "white"],
            )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    white = durable(vectors.mapInArrow(project, f"vec_id {kind}, dim int, deviation long, white array<double>"), "whitened")
    errors = {}
    for d, (_, _, _, real, _) in model.items():  # one length of vectors, as a rule
        k = int(real.sum())
        if k:
            cov = covariances(white.filter(F.col("dim") == d), "white").first()["cov"]
            errors[d] = float(np.abs(np.array(cov).reshape(k, k) - np.eye(k)).max())
    facts = []
    for d, (n, _, _, real, explained) in model.items():
        place = np.where(real, np.cumsum(real), 0).tolist()  # of a component's value among the whitened ones
        facts.append((d, n, errors.get(d), [(c + 1, place[c], explained[c]) for c in range(len(explained))]))
    table = spark.createDataFrame(facts, "dim int, n long, identity_error double, parts array<struct<component:int,place:int,explained:double>>")
    both = white.join(F.broadcast(table), "dim").withColumn("part", F.explode("parts"))
    value = F.when(F.col("part.place") > 0, F.try_element_at("white", F.greatest(F.col("part.place"), F.lit(1))))
    return both.select("vec_id", "part.component", "n", "deviation", value.alias("whitened"), "part.explained", "identity_error")
