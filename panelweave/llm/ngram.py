"""LM scoring: an n-gram trie in Elias-Fano levels with quantised smoothed probabilities.

Level one holds the hashes of all training tokens in rising order, cut by ranges
into files, with their counts. Level two is dealt into shards by context, the
contexts of very frequent words over several; a shard's trie has the contexts,
monotone pointers to where the words behind each begin, and those words as
numbers that rise through the whole level, as each context's words are stored
relative to the last number before them. A query looks its word up relative to
its context. Each shard is one memory-mapped file in the shared folder.

The model is a bigram with Dirichlet smoothing: a word behind a context has
(count of both + PULL * p) / (count of the context + PULL), p being the unigram
(count + 1) / (all + distinct + 1), in which all unknown words are one. What is stored is the
logarithm in steps of STEP. Texts begin behind a context of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.common import Memo, release, table, utf8, words_of, written
from panelweave.llm.elias_fano import EliasFano, load, save
from panelweave.session import new_path

#: Tokens read at once, tokens of a shard, tokens from which a context is split.
CHUNK, SHARD, HOT = 1 << 19, 2_000_000, 250_000
PULL, STEP = 200.0, 24 / 65535
MEMO = 150_000
#: The hash of the end of a text; no word holds a space.
END = xxhash.xxh3_64_intdigest(b" ")
#: Stands for a row: 96 bits of its id and text, so that only equal rows share one.
ROW = np.dtype([("key", "<i8"), ("tag", "<i4")])


def hashes_of(text: bytes | None, memo: Memo) -> np.ndarray:
    """Hashes of the lower-cased words and of the end."""
    words = words_of(text.lower()) if text else []
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    out[-1] = END
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[tuple[int, int], bool, int, np.ndarray]]]:
    """Lists of (row, held out, start, hashes) of about CHUNK tokens; long texts in parts."""
    memo = Memo(xxhash.xxh3_64_intdigest, MEMO)
    items, total = [], 0
    for batch in batches:
        key, tag, held = (batch.column(k).to_pylist() for k in range(3))
        for row, out, text in zip(zip(key, tag), held, utf8(batch.column(3))):
            hashes = hashes_of(text, memo)
            for start in range(0, len(hashes), CHUNK):
                # from the second part on with the token before it
                part = hashes[max(0, start - 1) : start + CHUNK]
                items.append((row, out, start, part))
                total += len(part)
                if total >= CHUNK:
                    yield items
                    items, total = [], 0
    if items:
        yield items


def _spread(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)


class Vocabulary:
    """Level one: ids of token hashes in rising order, and their counts."""

    def __init__(self, files: list[tuple[str, int, int]], total: int):
        """``files`` are (path, tokens, first id) in order of their ranges of hashes."""
        self.files, self.total = files, total
        self.size = sum(n for _, n, _ in files)
        self.parts = len(files)
        self.open: dict[int, tuple[EliasFano, np.ndarray]] = {}

    def _file(self, part: int) -> tuple[EliasFano, np.ndarray]:
        if part not in self.open:
            arrays = load(self.files[part][0])
            self.open[part] = EliasFano.of(arrays, "hashes"), arrays["counts"]
        return self.open[part]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, -1 for unknown tokens, and counts of distinct hashes in rising order."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        cuts = np.searchsorted(part_of(hashes, self.parts), np.arange(self.parts + 1))
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            path, n, first = self.files[part]
            if not n:
                continue
            level, stored = self._file(part)
            x = slice(cuts[part], cuts[part + 1])
            at = level.find(hashes[x])
            ids[x] = np.where(at >= 0, at + first, -1)
            counts[x] = np.where(at >= 0, stored[np.maximum(at, 0)], 0)
        return ids, counts


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _train_rows(docs: DataFrame, id_col: str, text_col: str, modulus: int, remainder: int) -> DataFrame:
    text_of_id = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    row = F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        row[0].alias("id"),
        F.xxhash64(*row).alias("key"),
        F.hash(*row).alias("tag"),
        (F.crc32(text_of_id) % modulus == remainder).alias("held"),
        F.col(text_col).alias("text"),
    )


def build_vocabulary(rows: DataFrame, folder: str, parts: int) -> Vocabulary:
    """Level one of (key, tag, held, text): the rows that are not held out, all of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for items in _chunks(batches):
            tokens = [p[1:] if start else p for _, held, start, p in items if not held]
            if not tokens:
                continue
            found, n = np.unique(np.concatenate(tokens), return_counts=True)
            cuts = np.searchsorted(part_of(found, parts), np.arange(parts + 1))
            full = np.flatnonzero(np.diff(cuts)).tolist()
            cut = lambda x: pa.array([x[cuts[k] : cuts[k + 1]].tobytes() for k in full], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int64()), cut(found), cut(n.astype(np.uint32))], names=["part", "hashes", "n"]
            )

    def level(key: tuple, blobs: pa.Table) -> pa.Table:
        hashes = np.concatenate([np.frombuffer(b, np.uint64) for b in blobs["hashes"].to_pylist()])
        n = np.concatenate([np.frombuffer(b, np.uint32) for b in blobs["n"].to_pylist()])
        found, where = np.unique(hashes, return_inverse=True)
        counts = np.bincount(where, n).astype(np.int64)
        path = f"{folder}/tokens-{uuid.uuid4().hex}"
        save(path, EliasFano.build(found, 1 << 64).arrays("hashes") | {"counts": counts})
        return pa.table({"part": [key[0].as_py()], "path": [path], "tokens": [len(found)], "total": [int(counts.sum())]})

    blobs = rows.where("not held").select(*TEXTS).mapInArrow(count, "part long, hashes binary, n binary")
    made = written(
        blobs.groupBy("part").applyInArrow(level, "part long, path string, tokens long, total long"), "lm-tokens"
    )
    by_part = {r["part"]: r for r in made.collect()}
    files, first = [], 0
    for part in range(parts):
        r = by_part.get(part)
        files.append((r["path"], r["tokens"], first) if r else ("", 0, first))
        first += files[-1][1]
    return Vocabulary(files, sum(r["total"] for r in by_part.values()))


class Shard:
    """A trie of contexts and the words behind them, with quantised log probabilities."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.contexts = EliasFano.of(arrays, "contexts")
        self.pointers = EliasFano.of(arrays, "pointers")
        self.words = EliasFano.of(arrays, "words")
        self.codes = arrays["codes"]

    @staticmethod
    def arrays(context: np.ndarray, word: np.ndarray, score: np.ndarray, size: int) -> dict[str, np.ndarray]:
        """Of distinct pairs in rising order with log10 probabilities; ids lie below ``size``."""
        starts = np.concatenate(([0], 1 + np.flatnonzero(np.diff(context)))) if len(context) else np.array([], int)
        lasts = np.append(starts[1:], len(context)) - 1 if len(context) else starts
        # a context's words go on from the last number of the one before
        steps = word[lasts] + 1
        base = np.cumsum(steps) - steps
        lens = lasts - starts + 1
        rising = word + np.repeat(base, lens)
        codes = np.round(np.minimum(-score, 24) / STEP).astype(np.uint16)
        return (
            EliasFano.build(context[starts], size).arrays("contexts")
            | EliasFano.build(np.append(starts, len(context)), len(context) + 1).arrays("pointers")
            | EliasFano.build(rising, int(rising[-1]) + 1 if len(rising) else 1).arrays("words")
            | {"codes": codes}
        )

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 probability of each word behind its context, nan where the pair was never seen."""
        out = np.full(len(context), np.nan)
        distinct, where = np.unique(context, return_inverse=True)
        at = self.contexts.find(distinct)
        begin, end, base = (np.zeros(len(distinct), np.int64) for _ in range(3))
        known = np.flatnonzero(at >= 0)
        begin[known] = self.pointers.access(at[known])
        end[known] = self.pointers.access(at[known] + 1)
        after = known[begin[known] > 0]
        base[after] = self.words.access(begin[after] - 1).astype(np.int64) + 1
        rows = np.flatnonzero(at[where] >= 0)
        c = where[rows]
        place = self.words.find(base[c] + word[rows], begin[c], end[c])
        hit = place >= 0
        out[rows[hit]] = -STEP * self.codes[place[hit]].astype(np.float64)
        return out


TEXTS = ("key", "tag", "held", "text")
SUMS = "bucket long, chunk long, keys binary, docs binary, sums binary"
FIELDS = ("rows", "n_tokens", "n_known", "base_score", "score")


def _numbers(x: np.ndarray, below: int) -> bytes:
    """Numbers below a bound, in two bytes each where that does."""
    return x.astype(np.uint16 if below <= 1 << 16 else np.uint32).tobytes()


def _back(blob: bytes, n: int) -> np.ndarray:
    """The n numbers of ``_numbers``."""
    return np.frombuffer(blob, np.uint16 if len(blob) == 2 * n else np.uint32).astype(np.int64)


def scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    modulus: int = 7,
    remainder: int = 2,
    folder: str | None = None,
    shard_tokens: int = SHARD,
    hot: int = HOT,
) -> DataFrame:
    """(id, held, n_tokens, n_known, train_tokens, base_score, score) of each row.

    The model learns from all rows but those whose crc32 of the id as text leaves
    ``remainder``. A null text is empty and has the end as its one token; a row
    without an id counts as one whose id is an empty text. Each row is scored by
    its own text, also where ids are null or repeated; repeated rows are learnt
    from each and get the same scores. Very long texts are read whole, in parts.
    The levels are left in ``folder``.
    Other columns of ``docs`` are not read; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "lm")
    rows = _train_rows(docs, id_col, text_col, modulus, remainder)
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    vocabulary = build_vocabulary(rows, folder, 1 + size // (24 << 20))
    files, total = vocabulary.files, vocabulary.total
    shards = 1 + total // shard_tokens
    words = vocabulary.size
    start, unknown = words, words + 1
    wide = -(-2 * max(1, (words + 2).bit_length()) // 8)
    bits = np.uint64(max(1, (words + 2).bit_length()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = Vocabulary(files, total)
        _, ends = level.find(np.array([END], np.uint64))
        for items in _chunks(batches):
            items.sort(key=lambda item: item[1])  # those held out last
            learnt = sum(not h for _, h, *_ in items)
            lens = np.array([len(p) for *_, p in items], np.int64)
            found, where = np.unique(np.concatenate([p for *_, p in items]), return_inverse=True)
            ids, counts = level.find(found)
            ids = np.where(ids < 0, unknown, ids)
            token, n = ids[where], counts[where]
            doc = np.repeat(np.arange(len(items)), lens)
            opens = np.cumsum(lens) - lens
            first = np.array([s == 0 for _, _, s, _ in items])
            before, n_before = np.roll(token, 1), np.roll(n, 1)
            before[opens[first]], n_before[opens[first]] = start, ends[0]
            own = np.ones(len(token), bool)
            own[opens[~first]] = False  # the token before a later part
            token, n, doc, before, n_before = (x[own] for x in (token, n, doc, before, n_before))
            base = np.log10((n + 1) / (total + words + 1))
            # what no shard can know: unknown words, and words behind unknown ones
            alone = (token == unknown) | (before == unknown) | (n_before == 0)
            own_score = np.where(alone, base + np.log10(PULL / (n_before + PULL)), 0.0)
            keys = np.array([k for k, *_ in items], ROW)
            # the same keys may be those of two chunks, whose sums then are added up for each of them
            chunk = xxhash.xxh3_64_intdigest(keys.tobytes()) >> 1
            values = [first.astype(float)] + [
                np.bincount(doc, v, len(items)) for v in (np.ones(len(doc)), n > 0, base, own_score)
            ]
            out = [(shards + chunk % shards, chunk, 0, b"", b"", b"", keys.tobytes(), np.stack(values, axis=1).tobytes())]
            token, n, doc, before, n_before = (x[~alone].astype(np.uint64) for x in (token, n, doc, before, n_before))
            ways = np.uint64(1) + n_before // np.uint64(hot)
            shard = (_spread(before) + _spread(token) % ways) % np.uint64(shards)
            pair = (before << bits) | token
            order = np.lexsort((doc, pair, shard))
            shard, pair, doc, n, n_before = (x[order] for x in (shard, pair, doc, n, n_before))
            new = np.concatenate(([True], (np.diff(pair) != 0) | (np.diff(doc) != 0))) if len(pair) else np.array([], bool)
            at = np.flatnonzero(new)
            times = np.diff(np.append(at, len(pair)))
            shard, pair, doc = shard[at], pair[at], doc[at]
            cuts = np.searchsorted(shard, np.arange(shards + 1))
            packed = pair.view(np.uint8).reshape(-1, 8)[:, :wide]
            for s in np.flatnonzero(np.diff(cuts)).tolist():
                x = slice(cuts[s], cuts[s + 1])
                kind = np.uint8 if times[x].max() < 256 else np.uint32
                out.append(
                    (s, chunk, learnt, packed[x].tobytes(), _numbers(doc[x], len(items)), times[x].astype(kind).tobytes(), b"", b"")
                )
            names = ("part", "chunk", "learnt", "pairs", "doc", "times", "keys", "values")
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], pa.int64() if k < 3 else pa.binary()) for k in range(8)], names=names
            )
        release()

    def settle(key: tuple, blobs: pa.Table) -> pa.Table:
        part = key[0].as_py()
        if part >= shards:
            n = len(blobs)
            return pa.table({
                "bucket": np.full(n, part - shards), "chunk": blobs["chunk"], "keys": blobs["keys"],
                "docs": pa.array([b""] * n, pa.binary()), "sums": blobs["values"],
            })
        pairs, rows_, times, held, cuts = [], [], [], [], [0]
        for p, d, t, n in zip(*(blobs[c].to_pylist() for c in ("pairs", "doc", "times", "learnt"))):
            raw = np.zeros((len(p) // wide, 8), np.uint8)
            raw[:, :wide] = np.frombuffer(p, np.uint8).reshape(-1, wide)
            pairs.append(raw.view(np.uint64)[:, 0])
            rows_.append(_back(d, len(raw)))
            held.append(rows_[-1] >= n)
            times.append(np.frombuffer(t, np.uint8 if len(t) == len(raw) else np.uint32).astype(np.int64))
            cuts.append(cuts[-1] + len(raw))
        pairs, times, held = map(np.concatenate, (pairs, times, held))
        found, where = np.unique(pairs, return_inverse=True)
        seen = np.bincount(where, times * ~held, len(found))
        before, token = (found >> bits).astype(np.int64), (found & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        level = Vocabulary(files, total)
        n_of = _counts(level, start)
        one = (n_of(token) + 1) / (total + words + 1)
        behind = n_of(before)
        score = np.log10((seen + PULL * one) / (behind + PULL))
        learnt = seen > 0
        path = f"{folder}/pairs-{part}-{uuid.uuid4().hex}"
        save(path, Shard.arrays(before[learnt], token[learnt], score[learnt], words + 2))
        looked = Shard(load(path)).find(before, token)
        score = np.where(np.isnan(looked), np.log10(PULL * one / (behind + PULL)), looked)
        # of each chunk the places of its rows and what this shard adds to their scores; only the chunk knows their keys
        chunk, docs_, sums_ = blobs["chunk"].to_pylist(), [], []
        for k, doc in enumerate(rows_):
            used, index = np.unique(doc, return_inverse=True)
            x = slice(cuts[k], cuts[k + 1])
            docs_.append(_numbers(used, int(used[-1]) + 1))
            sums_.append(np.bincount(index, score[where[x]] * times[x], len(used)).tobytes())
        return pa.table({
            "bucket": pa.array([c % shards for c in chunk], pa.int64()), "chunk": pa.array(chunk, pa.int64()),
            "keys": pa.array([b""] * len(chunk), pa.binary()), "docs": pa.array(docs_, pa.binary()),
            "sums": pa.array(sums_, pa.binary()),
        })

    def finish(sums: pa.Table) -> pa.Table:
        """The rows of each chunk with their sums; a row that lies in several chunks comes with each."""
        of: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        blobs = list(zip(*(sums[c].to_pylist() for c in ("chunk", "keys", "docs", "sums"))))
        for chunk, k, _, v in blobs:
            if k:
                own = np.frombuffer(v, float).reshape(-1, 5)
                of[chunk] = np.frombuffer(k, ROW), of[chunk][1] + own if chunk in of else own.copy()
        for chunk, k, d, v in blobs:
            if not k:
                part = np.frombuffer(v, float)
                of[chunk][1][_back(d, len(part)), 4] += part
        keys, total_ = (np.concatenate(x) for x in zip(*of.values()))
        return pa.table({c: np.ascontiguousarray(keys[c]) for c in ROW.names} | {
            f: np.ascontiguousarray(total_[:, k]) for k, f in enumerate(FIELDS)
        })

    names = "part long, chunk long, learnt long, pairs binary, doc binary, times binary, keys binary, values binary"
    sums = rows.select(*TEXTS).mapInArrow(deal, names).groupBy("part").applyInArrow(settle, SUMS)
    kinds = ", ".join(f"{f} double" for f in FIELDS)
    found = sums.groupBy("bucket").applyInArrow(finish, f"key long, tag int, {kinds}")
    found = found.groupBy(*ROW.names).agg(*[F.sum(f).alias(f) for f in FIELDS]).select(
        *ROW.names,
        *[F.round(F.col(f) / F.col("rows")).cast("long").alias(f) for f in FIELDS[1:3]],
        *[(F.col(f) / F.col("rows")).alias(f) for f in FIELDS[3:]],
    )
    found = written(found, "lm-scores")
    return rows.select("id", "key", "tag", "held").join(found, [*ROW.names]).select(
        "id", "held", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score",
    )


def _counts(level: Vocabulary, start: int):
    """Counts by id; the context of a text's start has as many as there are ends."""
    firsts = np.array([first for _, _, first in level.files], np.int64)
    _, ends = level.find(np.array([END], np.uint64))

    def of(ids: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), np.int64)
        out[ids == start] = ends[0]
        known = np.flatnonzero(ids < start)
        part = np.searchsorted(firsts, ids[known], "right") - 1
        for p in np.unique(part).tolist():
            rows = known[part == p]
            out[rows] = level._file(p)[1][ids[rows] - firsts[p]]
        return out

    return of


def op8_lm(spark: SparkSession, sf: str) -> DataFrame:
    return scores(table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"),
        F.col("held").alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )
