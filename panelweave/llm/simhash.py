"""SimHash fingerprints of word shingles, and near-duplicate groups by tiled exact comparison.

Fingerprints are dealt into tiles by the bit counts of their two halves. Two
fingerprints within the radius have half counts whose differences add up to at
most the radius, so tile pairs farther apart are skipped; the rest are compared
completely with numpy's exclusive-or and bit count. A tile of many rows is cut
into slices, so what a task holds is bounded whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.common import scalar_rows, table, unite, utf8, words_of, written
from panelweave.llm.components import components

WIDTH, SEED, RADIUS = 4, 42, 4
#: Fingerprints of a slice, and cells of a comparison that are held at once.
SLICE, CELLS = 16_384, 1 << 18


def shingle_hashes(text: bytes | None, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of ``width`` words, lower-cased in ASCII; of all words if there are fewer."""
    words = words_of(text.lower()) if text else []
    if not words:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-width])).tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], np.uint64)


def fold(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes; 0 for no hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the 64-bit fingerprint, as a signed long, of each row's whole text (null: no words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fold(shingle_hashes(t)) for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps, pa.int64())], names=["id", "fp"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


def _near_tiles(slices: dict[int, int], radius: int) -> dict[int, list[int]]:
    """Tile -> tiles at or above it whose half counts differ by ``radius`` at most in all."""
    out: dict[int, list[int]] = {}
    for tile in slices:
        hi, lo = divmod(tile, 33)
        out[tile] = sorted(
            t
            for t in slices
            if t >= tile and abs(t // 33 - hi) + abs(t % 33 - lo) <= radius
        )
    return out


def _compare(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of a and b within the radius, a bounded block of cells at a time."""
    if not len(a) or not len(b):
        return
    step = max(1, CELLS // len(b))
    wide = min(len(b), CELLS)
    for x in range(0, len(a), step):
        left = a[x : x + step, None]
        for y in range(0, len(b), wide):
            near = np.bitwise_count(left ^ b[None, y : y + wide]) <= radius
            if near.any():
                i, j = np.nonzero(near)
                yield i + x, j + y


def links(reps: DataFrame, radius: int = RADIUS, slice_rows: int = SLICE) -> DataFrame:
    """(src, dst): links that join all nodes of ``reps(fp, node)`` within the radius of each other.

    Every tile pair that can hold a link is compared in full. Of the links found
    in a task only a spanning forest is handed on, so a large group of near
    copies gives one row for each member and task, not one for each pair.
    """
    top = F.bit_count(F.shiftrightunsigned("fp", 32))
    low = F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    slices = {
        k: -(-n // slice_rows)
        for k, n in scalar_rows(reps.select((top * 33 + low).alias("tile")), "tile").items()
    }
    above = _near_tiles(slices, radius)
    below: dict[int, list[int]] = {t: [] for t in slices}
    for t, others in above.items():
        for other in others:
            below[other].append(t)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row once for each group it is compared in: (home tile, its slice, slice of the others)."""
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            node = batch.column(1).to_numpy(zero_copy_only=False)
            tile = np.bitwise_count(fp >> np.uint64(32)).astype(np.int64) * 33 + np.bitwise_count(
                fp & np.uint64(0xFFFFFFFF)
            )
            spread = ((fp * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
            for t in np.unique(tile).tolist():
                rows = np.flatnonzero(tile == t)
                own = spread[rows] % slices[t]
                for s in range(slices[t]):
                    picked = rows[own == s]
                    if not len(picked):
                        continue
                    goes = [(t, s, o, 0) for o in range(max(slices[x] for x in above[t]))]
                    goes += [
                        (h, k, s, 1)
                        for h in below[t]
                        for k in range(slices[h])
                        if h != t or k < s
                    ]
                    n = len(goes)
                    columns = np.repeat(np.array(goes, np.int64), len(picked), axis=0)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array((columns[:, 0] << 40) | (columns[:, 1] << 20) | columns[:, 2]),
                            pa.array(columns[:, 3].astype(np.int8)),
                            pa.array(np.tile(fp[picked].view(np.int64), n)),
                            pa.array(np.tile(node[picked], n)),
                        ],
                        names=["task", "side", "fp", "node"],
                    )

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        task = key[0].as_py()
        same = (task >> 20) & 0xFFFFF == task & 0xFFFFF
        side = rows["side"].to_numpy()
        fp = rows["fp"].to_numpy().view(np.uint64)
        node = rows["node"].to_numpy()
        first = np.bitwise_count(fp >> np.uint64(48)).astype(np.int64)
        high = np.bitwise_count(fp >> np.uint64(32)).astype(np.int64)
        down = np.bitwise_count(fp & np.uint64(0xFFFFFFFF)).astype(np.int64)
        tile = high * 33 + down
        order = np.lexsort((first, tile, side))
        side, fp, node, first, high, down, tile = (
            x[order] for x in (side, fp, node, first, high, down, tile)
        )
        m = int(np.searchsorted(side, 1))
        label = np.arange(len(fp))
        starts = [0] if same and m else []
        if m < len(fp):
            starts += [m, *(m + 1 + np.flatnonzero(np.diff(tile[m:]))).tolist()]
        blocks = np.searchsorted(first[:m], np.arange(18))
        for at in starts if m else []:
            end = m if at < m else at + int(np.searchsorted(tile[at:], tile[at], "right"))
            rise, rest = int(high[at] - high[0]), radius - abs(int(down[at] - down[0]))
            steps = [d for d in range(-radius, radius + 1) if abs(d) + abs(rise - d) <= rest]
            for q in range(17) if steps else []:
                a, z = int(blocks[q]), int(blocks[q + 1])
                if a == z:
                    continue
                b = at + int(np.searchsorted(first[at:end], q + steps[0]))
                y = at + int(np.searchsorted(first[at:end], q + steps[-1], "right"))
                for i, j in _compare(fp[a:z], fp[b:y], radius):
                    unite(label, i + a, j + b)
        other = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"src": node[other], "dst": node[label[other]]})

    return (
        reps.select("fp", "node")
        .mapInArrow(deal, "task long, side byte, fp long, node long")
        .groupBy("task")
        .applyInArrow(compare, "src long, dst long")
    )


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = RADIUS,
    slice_rows: int = SLICE,
) -> DataFrame:
    """(id, fp, component): fingerprint and near-duplicate group of each row.

    Equal fingerprints are one node, named by its smallest id, so exact copies
    cost one comparison. A null or empty text has fingerprint 0 and is linked
    like any other. Rows that repeat an id and its text repeat the result; rows
    without an id get a fingerprint, link with nothing and have no component.
    Other columns of ``docs`` are not read. An empty table gives an empty table.
    """
    rows = written(fingerprints(docs, id_col, text_col), "simhash")
    reps = rows.where("id is not null").groupBy("fp").agg(F.min("id").alias("node"))
    reps = written(reps, "simhash-nodes")
    joined = components(links(reps, radius, slice_rows), "simhash-links")
    return (
        rows.join(reps, "fp", "left")
        .join(joined, "node", "left")
        .select(
            "id",
            "fp",
            F.expr("if(id is null, null, coalesce(component, node))").alias("component"),
        )
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups: DataFrame | None = None
) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id, once.

    ``groups(id, component)`` says which; without it they are those of ``near_groups``.
    Rows without an id belong to no group and stay.
    """
    if groups is None:
        groups = near_groups(docs, id_col, text_col)
    drop = groups.where("id <> component").select(F.col("id").alias(id_col)).distinct()
    stays = docs.join(drop, id_col, "left_anti").select(docs.columns)
    return stays.where(F.col(id_col).isNotNull()).dropDuplicates([id_col]).unionByName(
        docs.where(F.col(id_col).isNull())
    )


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    groups = near_groups(table(spark, sf, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
