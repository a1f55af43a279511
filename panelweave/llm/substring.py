"""Substring dedup: words of long passages that an earlier document already has are removed.

Every document is cut into non-overlapping blocks of half a window, the index,
and every rolling run of a block's length probes it. A window that repeats
elsewhere holds a whole block of each document it stands in, so the probes that
hit an earlier document's block, with that block itself, lie in every repeat.
Each hit is then extended: all windows around it are told apart by 96 bits of
two rolling hashes, and overlapping repeated windows make up the maximal exact
repeats.

Hits are settled for each hash by the smallest document that indexes it, never
by pairs, so a passage in many documents costs one row for each place it stands
in. Both rounds settle first what a task's own documents decide and shuffle the
rest as sorted arrays.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from panelweave.llm.common import Memo, fresh, release, table, utf8, words_of, written

WINDOW = 50
#: Words that are hashed together, and the bits that number them behind a hash.
CHUNK, BITS = 1 << 19, 20
#: Bytes of text for each partition of the hashes.
PART_BYTES = 8 << 20
#: Word hashes that a task remembers.
MEMO = 50_000
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
LAST = np.iinfo(np.int64).max


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


class Rolling:
    """Hashes of all runs of ``length`` words, by a polynomial over 64 bits, then mixed."""

    def __init__(self, base: int, most: int):
        self.up = _powers(base, most)
        self.down = _powers(pow(base, -1, 1 << 64), most)

    def __call__(self, words: np.ndarray, length: int) -> np.ndarray:
        n = len(words)
        if n < length:
            return np.empty(0, np.uint64)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * self.up[:n], out=sums[1:])
        out = (sums[length:] - sums[:-length]) * self.down[: n - length + 1]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
        out *= np.uint64(0x94D049BB133111EB)
        return out


def word_hashes(text: bytes | None, memo: Memo) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def _by_bucket(doc: np.ndarray, pos: np.ndarray, buckets: int) -> pa.Table:
    """Places as packed arrays, a row for each bucket of documents."""
    mixed = doc.view(np.uint64) * np.uint64(BASES[0])
    bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, doc, pos = bucket[order], doc[order], pos[order].astype(np.uint32)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    full = np.flatnonzero(np.diff(cuts)).tolist()
    cut = lambda x: pa.array([x[cuts[k] : cuts[k + 1]].tobytes() for k in full], pa.binary())
    return pa.table({"bucket": pa.array(full, pa.int64()), "ids": cut(doc), "pos": cut(pos)})


PLACES = "bucket long, ids binary, pos binary"


def gathered(places: DataFrame) -> DataFrame:
    """(id, hits): one row for each document of packed places, ``hits`` an array of 32-bit numbers."""

    def regroup(rows: pa.Table) -> pa.Table:
        doc = np.concatenate([np.frombuffer(b, np.int64) for b in rows["ids"].to_pylist()])
        pos = np.concatenate([np.frombuffer(b, np.uint32) for b in rows["pos"].to_pylist()])
        order = np.argsort(doc, kind="stable")
        doc, pos = doc[order], np.ascontiguousarray(pos[order])
        starts = np.concatenate(([0], 1 + np.flatnonzero(np.diff(doc))))
        ends = np.append(starts, len(doc)).astype(np.int32) * 4
        packed = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(pos)]
        )
        return pa.table({"id": pa.array(doc[starts]), "hits": packed})

    return places.groupBy("bucket").applyInArrow(regroup, "id long, hits binary")


def _narrow(x: np.ndarray) -> bytes:
    return x.astype(np.uint16 if not len(x) or int(x.max()) < 1 << 16 else np.uint32).tobytes()


def _widen(b: bytes, n: int) -> np.ndarray:
    return np.frombuffer(b, np.uint16 if len(b) == 2 * n else np.uint32).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], memo: Memo, overlap: int):
    """Lists of (doc, start, word hashes) of about CHUNK words, in order of doc; long texts in parts."""
    items, total = [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            if doc is None:
                continue
            hashes = word_hashes(text, memo)
            for start in range(0, max(1, len(hashes) - overlap), CHUNK // 2):
                part = hashes[start : start + CHUNK // 2 + overlap]
                items.append((doc, start, part))
                total += len(part)
                if total >= CHUNK:
                    yield sorted(items, key=lambda x: x[:2])
                    items, total = [], 0
    if items:
        yield sorted(items, key=lambda x: x[:2])


def _starts(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return 1 + size // PART_BYTES


BLOBS = "part long, keys binary, second binary, doc binary, pos binary, docs binary"


def _blob(part: int, *columns: bytes) -> list:
    return [part, *columns]


def _own_key(parts: int, turn: int) -> int:
    """A key behind the ``parts`` hashed ones for what a task settles itself, spread over tasks and their turns."""
    task = TaskContext.get().partitionId()
    return parts + xxhash.xxh3_64_intdigest(b"%d %d" % (task, turn)) % parts


def _emit(rows: list[list]) -> pa.RecordBatch:
    names = [c.split()[0] for c in BLOBS.split(", ")]
    kinds = [pa.int64()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names
    )


def _settled(rows: pa.Table, buckets: int) -> pa.Table:
    """What a task decided by itself, which only passes through."""
    doc = np.concatenate([np.frombuffer(b, np.int64) for b in rows["docs"].to_pylist()])
    pos = np.concatenate([np.frombuffer(b, np.uint32) for b in rows["pos"].to_pylist()])
    return _by_bucket(doc, pos, buckets)


def block_hits(docs: DataFrame, window: int, parts: int) -> DataFrame:
    """Packed places where runs of half a window stand that another document's block repeats."""
    block = window // 2
    mask = np.uint64((1 << BITS) - 1)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, rolling = Memo(xxhash.xxh3_64_intdigest, MEMO), Rolling(BASES[0], 1 << BITS)
        for turn, items in enumerate(_chunks(batches, memo, window - 1)):
            lens = np.array([len(x[2]) for x in items], np.int64)
            off = np.cumsum(lens) - lens
            ids = np.array([x[0] for x in items], np.int64)
            first = np.array([x[1] for x in items], np.int64)
            split = (first > 0) | (lens >= CHUNK // 2 + window - 1)
            piece = np.repeat(np.arange(len(items)), lens)
            hashes = rolling(np.concatenate([x[2] for x in items]), block)
            at = np.arange(len(hashes))
            within = at - off[piece[: len(hashes)]]
            at = at[within <= (lens - block)[piece[: len(hashes)]]]
            keys = (hashes[at] & ~mask) | at.astype(np.uint64)
            keys.sort()
            if not len(keys):
                continue
            at = (keys & mask).astype(np.int64)
            piece = piece[at]
            doc, pos = ids[piece], first[piece] + at - off[piece]
            high = keys >> np.uint64(BITS)
            heads = np.concatenate(([True], high[1:] != high[:-1]))
            starts, group = np.flatnonzero(heads), np.cumsum(heads) - 1
            aligned = pos % block == 0
            least = np.minimum.reduceat(np.where(aligned, doc, LAST), starts)[group]
            most = doc[np.append(starts[1:], len(doc)) - 1][group]
            sure = (doc > least) | (aligned & (doc < most))
            rows = [
                _blob(
                    _own_key(parts, turn),
                    b"", b"", b"",
                    pos[sure].astype(np.uint32).tobytes(),
                    doc[sure].tobytes(),
                )
            ]
            # A split document may have the run in another chunk too, which must learn of a larger document.
            goes = doc <= least
            goes[np.append(starts[1:], len(doc))[np.logical_or.reduceat(split[piece], starts)] - 1] = True
            keys, high = keys[goes], high[goes]
            part = (high * np.uint64(parts)) >> np.uint64(64 - BITS)
            cuts = np.searchsorted(part, np.arange(parts + 1))
            table_ = ids.tobytes(), first.tobytes() if first.any() else b"", off.astype(np.int32).tobytes()
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                rows.append(_blob(p, keys[cuts[p] : cuts[p + 1]].tobytes(), b"", table_[1], table_[2], table_[0]))
            yield _emit(rows)
        release()

    def settle(key: tuple, rows: pa.Table) -> pa.Table:
        if key[0].as_py() >= parts:
            return _settled(rows, parts)
        highs, docs_, poss = [], [], []
        for keys, first, off, ids in zip(
            *(rows[c].to_pylist() for c in ("keys", "doc", "pos", "docs"))
        ):
            keys, off = np.frombuffer(keys, np.uint64), np.frombuffer(off, np.int32)
            ids, first = np.frombuffer(ids, np.int64), np.frombuffer(first, np.int64)
            first = first if len(first) else np.zeros(len(ids), np.int64)
            at = (keys & mask).astype(np.int64)
            piece = np.searchsorted(off, at, "right") - 1
            highs.append(keys >> np.uint64(BITS))
            docs_.append(ids[piece])
            poss.append((first[piece] + at - off[piece]).astype(np.uint32))
        high, doc, pos = map(np.concatenate, (highs, docs_, poss))
        order = np.argsort(high, kind="stable")
        high, doc, pos = high[order], doc[order], pos[order]
        heads = np.concatenate(([True], high[1:] != high[:-1]))
        starts, group = np.flatnonzero(heads), np.cumsum(heads) - 1
        aligned = pos % block == 0
        least = np.minimum.reduceat(np.where(aligned, doc, LAST), starts)[group]
        most = np.maximum.reduceat(doc, starts)[group]
        hit = (doc > least) | (aligned & (doc < most))
        out = _by_bucket(doc[hit], pos[hit], parts)
        del high, doc, pos, order, heads, starts, group, aligned, least, most, hit
        release()
        return out

    return docs.mapInArrow(probe, BLOBS).groupBy("part").applyInArrow(settle, PLACES)


def repeated_windows(docs: DataFrame, window: int, parts: int) -> DataFrame:
    """Packed starts of windows that also start in a smaller document, from (id, text, hits)."""
    block = window // 2

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, turn = Memo(xxhash.xxh3_64_intdigest, MEMO), 0
        rolls = [Rolling(b, CHUNK) for b in BASES]
        held: list[tuple] = []
        total = 0

        def flush() -> pa.RecordBatch:
            doc = np.concatenate([np.full(len(x[1]), x[0], np.int64) for x in held])
            pos, one, two = (np.concatenate([x[k] for x in held]) for k in (1, 2, 3))
            two = (two >> np.uint64(32)).astype(np.uint32)
            order = np.lexsort((doc, two, one))
            doc, pos, one, two = doc[order], pos[order], one[order], two[order]
            heads = np.concatenate(
                ([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1]))
            )
            least = doc[np.flatnonzero(heads)][np.cumsum(heads) - 1]
            sure = doc > least
            rows = [
                _blob(
                    _own_key(parts, turn),
                    b"", b"", b"",
                    pos[sure].astype(np.uint32).tobytes(),
                    doc[sure].tobytes(),
                )
            ]
            doc, pos, one, two = doc[~sure], pos[~sure], one[~sure], two[~sure]
            part = ((one >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            cuts = np.searchsorted(part, np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                x = slice(cuts[p], cuts[p + 1])
                ids, index = np.unique(doc[x], return_inverse=True)
                rows.append(
                    _blob(p, one[x].tobytes(), two[x].tobytes(), _narrow(index), _narrow(pos[x]), ids.tobytes())
                )
            return _emit(rows)

        for batch in batches:
            for doc, text, hits in zip(
                batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist()
            ):
                hashes = word_hashes(text, memo)
                near = np.zeros(max(0, len(hashes) - window + 1) + 1, np.int64)
                p = np.frombuffer(hits, np.uint32).astype(np.int64)
                np.add.at(near, np.clip(p - (window - block), 0, len(near) - 1), 1)
                np.add.at(near, np.clip(p + 1, 0, len(near) - 1), -1)
                starts = np.flatnonzero(np.cumsum(near)[:-1] > 0)
                for at in range(0, len(hashes) if len(starts) else 0, CHUNK - window):
                    part = hashes[at : at + CHUNK]
                    s = starts[(starts >= at) & (starts < at + CHUNK - window)]
                    if len(s):
                        one, two = (roll(part, window) for roll in rolls)
                        held.append((doc, s, one[s - at], two[s - at]))
                        total += len(s)
                if total >= CHUNK:
                    yield flush()
                    held, total, turn = [], 0, turn + 1
        if held:
            yield flush()
        release()

    def settle(key: tuple, rows: pa.Table) -> pa.Table:
        if key[0].as_py() >= parts:
            return _settled(rows, parts)
        ones, twos, docs_, poss = [], [], [], []
        for one, two, index, pos, ids in zip(
            *(rows[c].to_pylist() for c in ("keys", "second", "doc", "pos", "docs"))
        ):
            ones.append(np.frombuffer(one, np.uint64))
            twos.append(np.frombuffer(two, np.uint32))
            docs_.append(np.frombuffer(ids, np.int64)[_widen(index, len(ones[-1]))])
            poss.append(_widen(pos, len(ones[-1])))
        one, two, doc, pos = map(np.concatenate, (ones, twos, docs_, poss))
        order = np.lexsort((doc, two, one))
        doc, pos, one, two = doc[order], pos[order], one[order], two[order]
        heads = np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
        again = doc > doc[np.flatnonzero(heads)][np.cumsum(heads) - 1]
        out = _by_bucket(doc[again], pos[again], parts)
        del one, two, doc, pos, order, heads, again
        release()
        return out

    return docs.mapInArrow(probe, BLOBS).groupBy("part").applyInArrow(settle, PLACES)


def repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """(id, hits): for each document with repeats the starts of its repeated windows.

    A window is repeated if its word sequence also starts in a document with a
    smaller id. Windows are judged on the given texts. Rows without an id or
    without words repeat nothing; rows that repeat an id are to repeat its text,
    and are no repeats of each other. ``hits`` is an array of 32-bit numbers. Other columns of ``docs`` are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    parts = _starts(docs)
    near = written(gathered(block_hits(docs, window, parts)), "substring-blocks")
    again = repeated_windows(docs.join(near, "id").select("id", "text", "hits"), window, parts)
    return written(gathered(again), "substring-windows")


def covered(n: int, hits: bytes, window: int) -> np.ndarray:
    """Which of ``n`` words a repeated window covers."""
    marks = np.zeros(n + 1, np.int64)
    at = np.frombuffer(hits, np.uint32).astype(np.int64)
    np.add.at(marks, at, 1)
    np.add.at(marks, np.minimum(at + window, n), -1)
    return np.cumsum(marks)[:-1] > 0


def kept_text(text: str, hits: bytes, window: int) -> str:
    """``text`` without its covered words; what is left keeps its own white space."""
    raw = text.encode()
    spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    gone = np.concatenate(([True], covered(len(spans), hits, window), [True]))
    turns = np.flatnonzero(np.diff(gone.astype(np.int8)))
    runs = [raw[spans[a][0] : spans[b - 1][1]] for a, b in zip(turns[::2], turns[1::2])]
    return b"\n".join(runs).decode()


def dedup_text(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """``docs`` with repeated passages cut out of its texts.

    Texts without a repeat stay as they are; documents of which no word is left
    go. ``n_chars``, if there is such a column, follows the text.
    Other columns are kept, whatever their names.
    """

    at = docs.columns.index(text_col)
    own_col, hits_col, cut_col = fresh(docs, "__id", "__hits", "__cut")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, hits = batch.columns
            rows = hits.is_valid()
            if rows.true_count:
                columns[at] = pa.array(
                    [
                        t.as_py() if h is None or not t.is_valid else kept_text(t.as_py(), h, window)
                        for t, h in zip(columns[at], hits.to_pylist())
                    ],
                    pa.string(),
                )
            yield pa.RecordBatch.from_arrays([*columns, rows], names=[*batch.schema.names[:-1], cut_col])
        release()

    hits = repeats(docs, id_col, text_col, window).select(
        F.col("id").alias(own_col), F.col("hits").alias(hits_col)
    )
    joined = docs.join(hits, docs[id_col] == hits[own_col], "left").select(*docs.columns, hits_col)
    out = joined.mapInArrow(cut, StructType([*docs.schema, StructField(cut_col, BooleanType())]))
    out = out.where(~F.col(cut_col) | (F.col(text_col) != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn(
            "n_chars",
            F.when(F.col(cut_col), F.length(text_col).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")),
        )
    return out.select(docs.columns)


def digest(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of each row; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, hits in zip(utf8(batch.column(1)), batch.column(2).to_pylist()):
                words = words_of(text)
                kept = words
                if hits:
                    gone = covered(len(words), hits, window)
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                sha = hashlib.sha256(b" ".join(kept)).hexdigest()
                out.append((len(words), len(words) - len(kept), sha))
            n, removed, sha = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
                names=["id", "n_words", "n_removed", "kept_sha256"],
            )

    hits = repeats(docs, id_col, text_col, window)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.join(hits, "id", "left").select("id", "text", "hits").mapInArrow(
        run, "id long, n_words long, n_removed long, kept_sha256 string"
    )


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return digest(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")
