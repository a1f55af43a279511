"""Embedding near-dedup: spherical k-means cells, blocked cosine products within them.

A vector belongs to the cell of its nearest centre. It visits every other cell
that may hold a vector linked with it: a link's ends are at most sqrt(2 - 2 cos)
apart, and a vector lies as far from another cell as from the plane between the
two centres. So the ends of every link visit each other's cells, and the result
is exact; the centres only decide how much is compared. Cells lie in slices as
large as a task holds, every pair of slices is a task, and equal vectors are one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.common import table, unite, written
from panelweave.llm.components import components

COSINE = 0.9
#: Vectors of a cell aimed at, cells at least and at most, vectors the centres are fitted on, rounds, vectors of a slice at
#: least, and bytes of their numbers at most.
LEAST_CELLS, HELD = 4, 1 << 24
CELL, MOST_CELLS, SAMPLE, ROUNDS, SLICE = 2_000, 4_096, 20_000, 6, 2_048
CELLS = 1 << 20


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): rows with an id and a vector of finite numbers that are not all zero."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    )


def centres(classes: DataFrame, size: int, rows: int, seed: int = 7) -> np.ndarray:
    """Unit centres of spherical k-means on at most SAMPLE vectors of ``size`` numbers, drawn by a hash of the id."""
    cells = min(MOST_CELLS, max(LEAST_CELLS, -(-rows // CELL)))
    if rows <= cells:
        return np.eye(1, size)
    sample = classes.where(F.size("v") == size).orderBy(F.xxhash64(F.lit(seed), "node"), "node").limit(SAMPLE)
    sample = written(sample.select(array_to_vector("v").alias("features")), "embedding-sample")
    model = KMeans(
        k=cells, distanceMeasure="cosine", initMode="random", maxIter=ROUNDS, seed=seed
    ).fit(sample)
    found = np.array(model.clusterCenters())
    norm = np.linalg.norm(found, axis=1, keepdims=True)
    found = np.unique(found[norm[:, 0] > 0] / norm[norm[:, 0] > 0], axis=0)
    return found if len(found) else np.eye(1, size)


def _unit(column: pa.Array, size: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _reached(unit: np.ndarray, home: np.ndarray, cells: np.ndarray, middles: np.ndarray, reach: float) -> np.ndarray:
    """For each vector and each of ``cells`` whether the cell may hold a vector linked with it; its own cell does."""
    own = middles[home]
    top = (unit * own).sum(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * (own @ middles[cells].T), 0))
    far = (top[:, None] - unit @ middles[cells].T) > (reach + 1e-9) * apart
    return ~far | (home[:, None] == cells[None, :])


def homes_of(classes: DataFrame, size: int, middles: np.ndarray) -> DataFrame:
    """(home, node, n, v) of vectors of ``size`` numbers: the cell of the nearest centre."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                home = (_unit(part.column(2), size) @ middles.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(home.astype(np.int64)), *part.columns], names=["home", "node", "n", "v"]
                )

    rows = classes.where(F.size("v") == size).select("node", "n", "v")
    return rows.mapInArrow(assign, "home long, node long, n long, v array<double>")


def slices_of(rows_of: dict[int, int], cells: int, slice_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, slices) of each cell: cells share a slice of ``slice_rows`` vectors, larger ones are cut into several."""
    first, many = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
    at, held = -1, slice_rows
    for cell in sorted(rows_of):
        n = rows_of[cell]
        if held + n > slice_rows:
            at, held = at + 1, 0
        first[cell], many[cell] = at, max(1, -(-n // slice_rows))
        at, held = at + many[cell] - 1, held + n
    return first, many


def _packed(x: np.ndarray) -> bytes:
    """The numbers as they are, in single precision where that loses nothing."""
    short = x.astype(np.float32)
    return (short if np.array_equal(short, x) else x).tobytes()


def _pairs(homes: DataFrame, size: int, middles: np.ndarray, cosine: float) -> DataFrame:
    """(src, dst, n): dst null for a count of links of src, or a link of a spanning forest with n 0.

    A vector lies in one slice, and goes to the tasks of that slice and of each slice
    with a cell that may hold a vector linked with it. So it is dealt once for each
    slice at most, however many cells it visits, and every two vectors meet once.
    """
    rows_of = {r[0]: r[1] for r in homes.groupBy("home").agg(F.count(F.lit(1))).collect()}
    rows = sum(rows_of.values())
    # slices as large as a task holds, but enough pairs of them for all cores
    sides = int(np.ceil(np.sqrt(8 * homes.sparkSession.sparkContext.defaultParallelism)))
    slice_rows = max(SLICE, min(HELD // (8 * size), -(-rows // sides)))
    first, many = slices_of(rows_of, len(middles), slice_rows)
    cells = np.array(sorted(rows_of), np.int64)
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-6
    spread = np.concatenate([np.arange(first[c], first[c] + many[c]) for c in cells]) if len(cells) else cells
    cell_of = np.repeat(np.arange(len(cells)), many[cells])
    starts = np.flatnonzero(np.diff(spread, prepend=-1))

    def pack(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [pa.concat_arrays([b.column(k) for b in batches]) for k in range(4)]
        home, node, n = (c.to_numpy(zero_copy_only=False) for c in columns[:3])
        x = columns[3].flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        with np.errstate(over="ignore"):
            mix = (node.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        own = first[home] + mix.astype(np.int64) % many[home]
        goes = np.zeros((len(node), len(starts)), bool)
        for at in range(0, len(node), 1024):
            some = slice(at, at + 1024)
            visits = _reached(_unit(columns[3].slice(at, 1024), size), home[some], cells, middles, reach)
            goes[some] = np.logical_or.reduceat(visits[:, cell_of], starts, axis=1)
        for s in np.unique(own).tolist():
            for t in range(len(starts)):
                picked = np.flatnonzero((own == s) & goes[:, t])
                if len(picked):
                    blobs = [home[picked].tobytes(), node[picked].tobytes(), n[picked].tobytes(), _packed(x[picked])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([min(s, t) << 32 | max(s, t)]), pa.array([s > t]), *(pa.array([b]) for b in blobs)],
                        names=["task", "upper", "home", "node", "n", "v"],
                    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list[pa.RecordBatch] = []
        for batch in batches:
            some.append(batch)
            if sum(b.num_rows for b in some) * size * 8 >= HELD // 2:
                yield from pack(some)
                some = []
        if some:
            yield from pack(some)

    def side(rows: pa.Table, upper: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(home, node, n, unit vectors) of a side, by cell."""
        rows = rows.filter(pc.equal(rows["upper"], upper))
        home, node, n = (
            np.concatenate([np.empty(0, np.int64), *(np.frombuffer(b.as_buffer(), np.int64) for b in rows[c])])
            for c in ("home", "node", "n")
        )
        x, at = np.empty((len(node), size)), 0
        for blob, ids in zip(rows["v"], rows["node"]):
            m = len(ids.as_buffer()) // 8
            data = blob.as_buffer()
            kind = np.float32 if len(data) == 4 * m * size else np.float64
            x[at : at + m] = np.frombuffer(data, kind).reshape(m, size)
            at += m
        order = np.argsort(home, kind="stable")
        for a in range(0, len(order), 1024):
            x[a : a + 1024] /= np.abs(x[a : a + 1024]).max(axis=1, keepdims=True)
            x[a : a + 1024] /= np.linalg.norm(x[a : a + 1024], axis=1, keepdims=True)
        return home[order], node[order], n[order], x[order]

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        same = key[0].as_py() >> 32 == key[0].as_py() & 0xFFFFFFFF
        left = side(rows, False)
        right = left if same else side(rows, True)
        offset = 0 if same else len(left[1])
        node = left[1] if same else np.concatenate((left[1], right[1]))
        weight = left[2] if same else np.concatenate((left[2], right[2]))
        unit = left[3], right[3]
        counts, label = np.zeros(len(node), np.int64), np.arange(len(node))
        there, here = np.unique(right[0]), np.unique(left[0])
        to, back = (
            np.concatenate(
                [np.empty((0, len(c)), bool)]
                + [_reached(u[a : a + 1024], h[a : a + 1024], c, middles, reach) for a in range(0, len(h), 1024)]
            )
            for u, h, c in ((left[3], left[0], there), (right[3], right[0], here))
        )
        for p, c in enumerate(here.tolist()):
            own = slice(*np.searchsorted(left[0], [c, c + 1]))
            for q, d in enumerate(there.tolist()):
                if same and d < c:
                    continue
                other = slice(*np.searchsorted(right[0], [d, d + 1]))
                a = own.start + np.flatnonzero(to[own, q])
                b = other.start + np.flatnonzero(back[other, p])
                if not len(a) or not len(b):
                    continue
                others, step = unit[1][b].T, max(1, CELLS // len(b))
                for at in range(0, len(a), step):
                    some = a[at : at + step]
                    i, j = np.nonzero(unit[0][some] @ others >= cosine)
                    i, j = some[i], offset + b[j]
                    linked = (i < j if same and c == d else i != j) & (node[i] != node[j])
                    i, j = i[linked], j[linked]
                    np.add.at(counts, i, weight[j])
                    np.add.at(counts, j, weight[i])
                    unite(label, i, j)
        some = np.flatnonzero(counts)
        forest = np.flatnonzero(node != node[label])
        return pa.table(
            {
                "src": pa.array(np.concatenate((node[some], node[forest]))),
                "dst": pa.array(
                    np.concatenate((np.zeros(len(some), np.int64), node[label[forest]])),
                    mask=np.arange(len(some) + len(forest)) < len(some),
                ),
                "n": pa.array(np.concatenate((counts[some], np.zeros(len(forest), np.int64)))),
            }
        )

    dealt = homes.mapInArrow(deal, "task long, upper boolean, home binary, node binary, n binary, v binary")
    return dealt.groupBy("task").applyInArrow(compare, "src long, dst long, n long")


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """(id, n_links, component, kept) of each row.

    Links are pairs of vectors with a cosine of at least ``cosine``, in double
    precision; all are found. Vectors that are null, all zero, or hold nulls or
    numbers that are not finite link with nothing, and vectors of different
    lengths do not link. Rows that repeat an id and its vector are one vector; a
    row without an id links with nothing and has no component, and is kept.
    """
    rows = usable(vectors, id_col, vector_col).distinct()
    classes = rows.groupBy("v").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n"))
    classes = written(classes, "embedding-classes")
    sizes = {r[0]: r[1] for r in classes.groupBy(F.size("v")).agg(F.count(F.lit(1))).collect()}
    found = None
    for size, count in sorted(sizes.items()):
        middles = centres(classes, size, count)
        homes = written(homes_of(classes, size, middles), "embedding-homes")
        part = _pairs(homes, size, middles, cosine)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "src long, dst long, n long")
    found = written(found, "embedding-links")
    linked = found.where("dst is null").groupBy(F.col("src").alias("node")).agg(F.sum("n").alias("links"))
    whole = components(found.where("dst is not null").select("src", "dst"), "embedding-components")
    member = rows.join(classes, "v").select("id", "node", "n")
    result = (
        member.join(linked, "node", "left")
        .join(whole, "node", "left")
        .select(
            F.col("id").alias("__id"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    ids = vectors.select(F.col(id_col).cast("long").alias("id"))
    return ids.join(result, ids["id"] == result["__id"], "left").select(
        "id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component"),
        F.coalesce(F.col("component") == F.col("id"), F.lit(True)).alias("kept"),
    )


def op4_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors(table(spark, sf, "embeddings")).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept"
    )
