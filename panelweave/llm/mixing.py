"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Texts are cut into blocks of words. Each pass over a source is a random
permutation of its blocks, and a source's quota is the exact number of blocks
its passes draw. A binary tree divides the quotas of all sources among the
output shards: a node draws how many blocks of each source go left, without
replacement, so every shard is an exact random sample of the whole mix. A node's
draw depends on its place in the tree alone, so each task works out just the
branches that its own blocks lead through. Blocks are shuffled within a shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelweave.llm.common import WORD, few_rows, fresh, table, written

WEIGHTS, MOST_REPEATS, SEED = (1, 2, 3), 3, 17
#: Words of a block, blocks of a shard, and blocks of one sorted bucket.
BLOCK, SHARD, BUCKET = 256, 4096, 2000
#: numpy draws hypergeometric numbers exactly up to this population.
EXACT = 10**9


def targets(sizes: list[int], weights: list[float], most: float = MOST_REPEATS) -> list[float]:
    """Shares of all sizes by weight; none above ``most`` times its size, the excess shared again by weight."""
    left, open_ = float(sum(sizes)), [i for i, s in enumerate(sizes) if s]
    out = [0.0] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def _draw(pool: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """How many of ``n`` blocks drawn without replacement come from each source.

    Beyond the population that numpy draws exactly, a source's number is the
    normal limit, rounded and held to what can be drawn, so counts stay exact in all.
    """
    if pool.sum() < EXACT:
        return rng.multivariate_hypergeometric(pool, n, method="marginals")
    out, rest = np.zeros_like(pool), int(pool.sum())
    for k, good in enumerate(pool.tolist()):
        bad = rest - good
        share = good / rest if rest else 0.0
        spread = np.sqrt(max(0.0, n * share * (1 - share) * (rest - n) / max(1, rest - 1)))
        x = int(round(n * share + spread * rng.standard_normal()))
        out[k] = min(max(x, n - bad, 0), good, n)
        n, rest = n - int(out[k]), bad
    return out


class Tree:
    """Which shard the block with a given rank in its source's draws goes to."""

    def __init__(self, quotas: list[int], shard: int, seed: int):
        self.quotas, self.seed = np.array(quotas, np.int64), seed
        total = int(self.quotas.sum())
        self.shards = max(1, -(-total // shard))
        #: Shards are equal but for one block.
        self.ends = lambda k: total * k // self.shards
        self.left = lru_cache(maxsize=100_000)(self._left)

    def _left(self, low: int, high: int, pool: tuple[int, ...]) -> tuple[int, ...]:
        middle = (low + high) // 2
        rng = np.random.default_rng([self.seed, low, high])
        n = self.ends(middle) - self.ends(low)
        return tuple(_draw(np.array(pool, np.int64), n, rng).tolist())

    def shard_of(self, source: int, ranks: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ranks), np.int64)
        todo = [(0, self.shards, tuple(self.quotas.tolist()), 0, np.arange(len(ranks)))]
        while todo:
            low, high, pool, first, rows = todo.pop()
            if high - low == 1:
                out[rows] = low
                continue
            left = self.left(low, high, pool)
            middle, cut = (low + high) // 2, first + left[source]
            goes = ranks[rows] < cut
            if goes.any():
                todo.append((low, middle, left, first, rows[goes]))
            if not goes.all():
                rest = tuple(a - b for a, b in zip(pool, left))
                todo.append((middle, high, rest, cut, rows[~goes]))
        return out


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(row, id, source, size): words of each row's text; ``row`` tells equal rows apart."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"), size.alias("size")
    )
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")


def plan(
    rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_REPEATS
) -> list[tuple[str | None, int, int, float]]:
    """(source, number, size, target) in order of code points, null last.

    One row for each source reaches the driver; sources are labels, and few.
    """
    found = rows.groupBy("source").agg(F.sum("size")).collect()
    sources = sorted(found, key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [int(r[1]) for r in sources]
    aims = targets(sizes, [weights[k % len(weights)] for k in range(len(sizes))], most)
    return [(s[0], k, sizes[k], aims[k]) for k, s in enumerate(sources)]


def draws(
    rows: DataFrame,
    sources: list[tuple[str | None, int, int, float]],
    seed: int = SEED,
    block: int = BLOCK,
    shard: int = SHARD,
    bucket: int = BUCKET,
) -> DataFrame:
    """(row, id, number, turn, block, words, shard, place): each drawn block, its shard and place in it.

    ``turn`` numbers a source's passes. In its last pass the blocks are taken in
    permuted order until the target is met, the last of them in part. A hot
    source's blocks are sorted in as many buckets as its size asks for.
    """
    spark = rows.sparkSession
    known = few_rows(
        spark,
        [(s, k, size, round(aim), -(-round(aim) // size) if size else 0) for s, k, size, aim in sources],
        "source string, number int, total long, aim long, passes long",
    )
    pieces = (
        rows.where("size > 0")
        .join(known, rows["source"].eqNullSafe(known["source"]))
        .where("passes > 0")
        .select(
            "row", "id", "size", "number", "total", "aim",
            F.explode(F.expr("sequence(0L, passes - 1)")).alias("turn"),
        )
        .select("*", F.explode(F.expr(f"sequence(0L, (size - 1) div {block})")).alias("block"))
        .withColumn("words", F.expr(f"least({block}L, size - block * {block})"))
        .withColumn("draw", F.xxhash64(F.lit(seed), "number", "turn", "id", "block"))
    )
    # A bucket is a range of draws; unsigned order by the upper 31 bits keeps ranges even.
    many = F.expr(f"1 + total div ({block} * {bucket})")
    pieces = pieces.withColumn("upper", F.shiftrightunsigned("draw", 33)).withColumn(
        "bucket", F.floor(F.col("upper") * many / F.lit(2.0**31)).cast("long")
    )
    pieces = written(pieces.select("row", "id", "number", "total", "aim", "turn", "block", "words", "draw", "upper", "bucket"), "mix-pieces")
    per = pieces.groupBy("number", "turn", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("words").alias("w")
    )
    before = Window.partitionBy("number", "turn").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        "number", "turn", "bucket",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w0"),
    )
    order = Window.partitionBy("number", "turn", "bucket").orderBy("upper", "draw", "id", "block", "row")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        pieces.withColumn("nth", F.row_number().over(order) - 1)
        .withColumn("w1", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
        .join(per, ["number", "turn", "bucket"])
        .select(
            "row", "id", "number", "turn", "block", "draw",
            (F.col("n0") + F.col("nth")).alias("rank"),
            F.expr("least(words, aim - turn * total - w0 - w1)").alias("words"),
        )
        .where("words > 0")
    )
    ranked = written(ranked, "mix-ranked")
    counts = {
        (r[0], r[1]): r[2] for r in ranked.groupBy("number", "turn").agg(F.count(F.lit(1))).collect()
    }
    quotas, base = [0] * len(sources), {}
    for number, turn in sorted(counts):
        base[number, turn] = quotas[number]
        quotas[number] += counts[number, turn]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(quotas, shard, seed)
        for batch in batches:
            number, turn, rank = (
                batch.column(name).to_numpy(zero_copy_only=False) for name in ("number", "turn", "rank")
            )
            out = np.zeros(batch.num_rows, np.int64)
            for pass_ in np.unique(np.stack([number, turn]), axis=1).T.tolist():
                at = np.flatnonzero((number == pass_[0]) & (turn == pass_[1]))
                out[at] = tree.shard_of(pass_[0], rank[at] + base[tuple(pass_)])
            names = ["row", "id", "number", "turn", "block", "words"]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array(out), batch.column("draw")], names=[*names, "shard", "draw"]
            )

    placed = ranked.mapInArrow(
        place,
        "row long, id long, number int, turn long, block long, words long, shard long, draw long",
    )
    local = Window.partitionBy("shard").orderBy(F.xxhash64("draw", "shard"), "id", "block", "turn", "row")
    return placed.withColumn("place", F.row_number().over(local) - 1).drop("draw")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **options,
) -> DataFrame:
    """(id, size, source_size, target, taken, n_shards, first_shard, placement) of each row.

    The last three tell where the drawn blocks of a document go: how many shards, the first of them, and
    the exclusive-or of the hashes of each block's shard and place there (nothing taken: 0, null, null).
    A null text has size 0 and nothing is taken of it; a null source is a source
    of its own, the last. Texts of any length are counted whole; equal draws go by id, block and row. Repeated rows are documents of their own. Reruns give
    the same rows; an empty table gives an empty one.
    """
    rows = sized(docs, id_col, text_col, source_col)
    sources = plan(rows)
    taken = draws(rows, sources, **options).groupBy("row").agg(
        F.sum("words").alias("taken"),
        F.size(F.collect_set("shard")).cast("long").alias("n_shards"),
        F.min("shard").alias("first_shard"),
        F.bit_xor(F.xxhash64("turn", "block", "shard", "place")).alias("placement"),
    )
    known = few_rows(
        rows.sparkSession, [(s, size, aim) for s, _, size, aim in sources], "source string, source_size long, target double"
    )
    return (
        rows.join(known, rows["source"].eqNullSafe(known["source"]))
        .join(taken, "row", "left")
        .select(
            "id", "size", "source_size", "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
            F.coalesce("n_shards", F.lit(0)).cast("long").alias("n_shards"),
            "first_shard", "placement",
        )
    )


def mixed_docs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **options,
) -> DataFrame:
    """``docs`` as the mix takes them: a row for each pass that draws of a document.

    A row's text is what the pass draws of it: all of it, unchanged, or its drawn
    blocks in their order. ``n_chars``, if there is such a column, follows the text.
    Other columns are kept, whatever their names.
    """
    block = options.get("block", BLOCK)
    row_col, turn_col, words_col, blocks_col = fresh(docs, "__row", "__turn", "__words", "__blocks")
    numbered = written(docs.withColumn(row_col, F.monotonically_increasing_id()), "mix-docs")
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = numbered.select(
        F.col(row_col).alias("row"),
        F.col(id_col).cast("long").alias("id"),
        F.col(source_col).alias("source"),
        size.alias("size"),
    )
    rows = written(rows, "mix-sizes")
    drawn = (
        draws(rows, plan(rows), **options)
        .groupBy(F.col("row").alias(row_col), F.col("turn").alias(turn_col))
        .agg(F.sum("words").alias(words_col), F.collect_list(F.struct("block", "words")).alias(blocks_col))
    )

    at = docs.columns.index(text_col)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, words, blocks = batch.columns
            texts = []
            for text, n, parts in zip(columns[at], words.to_pylist(), blocks):
                t = text.as_py()
                all_words = t.encode().split()
                if n < len(all_words):
                    runs = sorted((p["block"] * block, p["words"]) for p in parts.as_py())
                    t = b" ".join(b" ".join(all_words[a : a + k]) for a, k in runs).decode()
                texts.append(t)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-2])

    joined = numbered.join(drawn, row_col).select(*docs.columns, words_col, blocks_col)
    out = joined.mapInArrow(pick, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mix(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")
