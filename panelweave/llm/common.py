"""What several operators share: words, written cuts, blobs of numbers."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from panelweave.session import new_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCHES, BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", 2_000
#: Words as the contracts have them: runs of anything but a space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """From now on the session hands tasks texts in batches of ``BATCH`` rows, which bounds what a worker holds."""
    spark.conf.set(BATCHES, str(BATCH))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back; its shuffle files go once it is written."""
    spark = df.sparkSession
    path = new_path(spark, name)
    settings = {CLEANUP: "true", BATCHES: str(BATCH)}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def few_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A short list as a table, handed over by Arrow: from a list of rows Spark starts Python workers of a second kind."""
    kinds = to_arrow_schema(StructType.fromDDL(schema))
    columns = [pa.array([r[k] for r in rows], field.type) for k, field in enumerate(kinds)]
    return spark.createDataFrame(pa.table(columns, schema=kinds), schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` with as many underscores after them as it takes to clash with no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column as bytes, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def words_of(text: bytes | None) -> list[bytes]:
    """``WORD`` matches of a text: bytes.split() parts at exactly those six bytes."""
    return text.split() if text else []


def scalar_rows(df: DataFrame, by: str) -> dict[int, int]:
    """Rows for each value of a column that has few values, whatever the rows."""
    return {r[0]: r[1] for r in df.groupBy(by).agg(F.count(F.lit(1))).collect()}


def release() -> None:
    """Gives memory that a task has freed back to the machine, before its worker takes the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Memo(dict):
    """word -> value by a function, in two generations of at most ``most`` words each.

    Words used since the last change of generation are kept, so frequent ones
    stay and memory is bounded; words above ``longest`` are not remembered.
    """

    def __init__(self, fn, most: int = 250_000, longest: int = 256):
        super().__init__()
        self.fn, self.most, self.longest, self.old = fn, most, longest, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.fn(word)
        if len(word) > self.longest:
            return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value


def unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the sets of i[k] and j[k]; label maps each element to the smallest index of its set."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label[:] = further
