"""Byte-level BPE: encoding by a streaming transducer with bounded lookahead, and incremental decoding.

Merges run in the order of the merge list, so what is read later can change what
stands before it only through a chain of merges of rising rank, each of which
reaches over the left part of its pair. The heaviest such chain is the merge
list's sufficient lookahead: tokens that end at least so many bytes before the
end of what has been read are stable and are emitted; the transducer keeps the
rest. Short pieces of text have their tokens remembered in a bounded memo.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from panelweave.llm.common import Memo, release, table

#: Fixed value: the pattern by which byte-level vocabularies of this kind part a text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of a text that are parted at once, and bytes of a piece that is remembered whole.
SLICE, SHORT, BUFFER = 1 << 16, 64, 4096
#: Rows whose ids are held at once, and words that a task remembers beside them.
ROWS, WORDS = 500, 100_000
NEVER = 1 << 60
#: Letters and numbers newer than the Unicode of the tokenizers library, which takes them as other signs.
NEWER = """
558-558 58B-58C 88F-88F C5C-C5C CDC-CDC 208F-208F 209D-209F A7CE-A7CF A7D2-A7D2 A7D4-A7D4 A7DD-A7DD A7E2-A7E2
A7F1-A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A-11B0A 11DB0-11DDB 11DE0-11DE9
11DF1-11DF1 1246F-1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA
18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168-1B168 1D6A6-1D6A6 1DF1F-1DF24 1DF2B-1DF81
1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F
2B81E-2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
""".split()


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the bytes: Latin-1 print characters stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """The tables of a tokenizer file in JSON, as plain values that travel with a task."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, alphabet = data["model"], byte_alphabet()
        kinds = model["type"], data["pre_tokenizer"]["type"], data["decoder"]["type"]
        plain = not (
            data["normalizer"]
            or data["pre_tokenizer"]["add_prefix_space"]
            or model.get("ignore_merges")
            or any(t[k] for t in data["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if kinds != ("BPE", "ByteLevel", "ByteLevel") or not plain:
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        raw = lambda token: bytes(alphabet[c] for c in token)
        self.ids = {raw(t): i for t, i in model["vocab"].items()}
        self.merges = [(raw(a), raw(b)) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.lookahead = sufficient_lookahead(self.merges)


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after a token's end that settle it, whatever follows them.

    Two texts with a common start are merged alike but for a region at its end.
    A merge that happens in one of them only moves the region's start to the start
    of the merged pair (x, y): by the length of x. y begins there, so it is, or
    has grown by merges on its right from, the token that the region's last
    change left at its start; later merges have higher ranks. The longest way
    over all such chains is found in one pass over the list.
    """
    parts: dict[bytes, tuple[bytes, bytes]] = {}
    for x, y in merges:
        for part in (x, y):
            if len(part) > 1 and part not in parts:
                raise ValueError("a merge uses a token before it is made")
        if x + y in parts:
            raise ValueError("two merges make the same token")
        parts[x + y] = (x, y)
    best: dict[bytes, int] = {}
    longest = 0
    for x, y in merges:
        reach, head = 0, y
        while True:
            reach = max(reach, best.get(head, 0))
            if head not in parts:
                break
            head = parts[head][0]
        reach += len(x)
        best[x] = max(best.get(x, 0), reach)
        longest = max(longest, reach)
    return longest


class Encoder:
    """Whole texts to token ids, a stable token at a time."""

    def __init__(self, vocabulary: Vocabulary, words: int = 200_000):
        ids = vocabulary.ids
        self.first = [ids.get(bytes([b]), -1) for b in range(256)]
        self.rank = {(ids[x], ids[y]): rank for rank, (x, y) in enumerate(vocabulary.merges)}
        self.made = [ids[x + y] for x, y in vocabulary.merges]
        self.lookahead = vocabulary.lookahead
        self.size = {i: len(t) for t, i in ids.items()}
        self.special = vocabulary.special
        newer = "".join(f"{chr(int(a, 16))}-{chr(int(b, 16))}" for a, b in (r.split("-") for r in NEWER))
        pattern = PIECES.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{newer}])")
        pattern = pattern.replace(r"\p{L}+|", rf"[\p{{L}}--[{newer}]]+|").replace(r"\p{N}+|", rf"[\p{{N}}--[{newer}]]+|")
        self.pieces = regex.compile("(?V1)" + pattern)
        self.twice = regex.compile(r"\s\s")
        self.edge = regex.compile(r"(?<=\S)\s")
        found = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, found)) + ")") if found else None
        self.memo = Memo(self._piece, words // 2)
        #: The same for whole words behind a space, and behind a line end.
        self.spaced = Memo(lambda word: self._parted(" " + word), words)
        self.lined = Memo(lambda word: self._parted("\n" + word), words // 10)

    def forget(self) -> None:
        """Drops what is remembered; the memos know their encoder, so it does not go by itself when its last user does."""
        for memo in (self.memo, self.spaced, self.lined):
            memo.clear()
            memo.old = {}

    def _parted(self, text: str) -> bytes:
        return b"".join(map(self.memo.__getitem__, self.pieces.findall(text)))

    def _words(self, text: str) -> Iterator[bytes]:
        """No piece reaches from a sign into the white space behind it. Where no two white
        spaces meet, a text is therefore parted word by word, each with the one before it."""
        if self.twice.search(text):
            yield self._parted(text)
            return
        spaced = self.spaced.__getitem__
        for k, line in enumerate(text.split("\n")):
            first, *rest = line.split(" ")
            yield self.lined[first] if k else self._parted(first)
            yield b"".join(map(spaced, rest))

    def _piece(self, piece: str) -> bytes:
        if len(piece) <= BUFFER:
            return array("I", self._merge(piece.encode())).tobytes()
        raw = (piece[k : k + BUFFER].encode() for k in range(0, len(piece), BUFFER))
        return b"".join(array("I", ids).tobytes() for ids in self.stream(raw))

    def _merge(self, raw: bytes) -> list[int]:
        """Tokens of some bytes: the pair of least rank is merged first, the leftmost of equals."""
        ids = list(map(self.first.__getitem__, raw))
        if -1 in ids:  # bytes without a token are left out, and part what stands around them
            ids = [i for i in ids if i >= 0]
        if len(ids) > SHORT:
            return self._merge_long(ids)
        rank, made = self.rank.get, self.made
        ranks = [rank(p, NEVER) for p in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == NEVER:
                break
            k = ranks.index(low)
            new = ids[k] = made[low]
            del ids[k + 1], ranks[k]
            if k:
                ranks[k - 1] = rank((ids[k - 1], new), NEVER)
            if k < len(ranks):
                ranks[k] = rank((new, ids[k + 1]), NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n, rank = len(ids), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p], k, p) for k, p in enumerate(zip(ids, ids[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            low, k, pair = heapq.heappop(heap)
            j = after[k] if ids[k] >= 0 else n
            if j >= n or (ids[k], ids[j]) != pair:
                continue
            ids[k], ids[j] = self.made[low], -1
            after[k] = after[j]
            if after[j] < n:
                before[after[j]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < n and (ids[a], ids[b]) in rank:
                    heapq.heappush(heap, (rank[ids[a], ids[b]], a, (ids[a], ids[b])))
        return [i for i in ids if i >= 0]

    def stream(self, parts: Iterable[bytes]) -> Iterator[list[int]]:
        """Tokens of one piece that comes in parts; holds a buffer and the lookahead, no more."""
        held = b""
        for part in parts:
            held += part
            if len(held) < BUFFER + self.lookahead:
                continue
            end, stable = 0, []
            for i in self._merge(held):
                if end + self.size[i] > len(held) - self.lookahead:
                    break
                end += self.size[i]
                stable.append(i)
            held = held[end:]
            yield stable
        if held:
            yield self._merge(held)

    def _slices(self, text: str) -> Iterator[str]:
        """Parts of a text that end before white space, where no piece can cross."""
        at = 0
        while at < len(text):
            edge = self.edge.search(text, at + SLICE) if len(text) - at > SLICE else None
            end = edge.start() if edge else len(text)
            yield text[at:end]
            at = end

    def __call__(self, text: str | None) -> bytes:
        """Ids of the text as little-endian 32-bit numbers; a null text has none."""
        if not text:
            return b""
        out: list[bytes] = []
        for k, part in enumerate(self.split.split(text) if self.split else [text]):
            if k % 2:
                out.append(array("I", [self.special[part]]).tobytes())
                continue
            for some in self._slices(part):
                out.extend(self._words(some))
        return b"".join(out)


class Decoder:
    """Ids to text as they come: a state machine that holds the bytes of an unfinished character."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes = [vocabulary.bytes.get(i, b"") for i in range(max(vocabulary.bytes) + 1)]

    def stream(self, ids: bytes, step: int = 1 << 16) -> Iterator[str]:
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        numbers = np.frombuffer(ids, "<u4")
        for at in range(0, len(numbers), step):
            part = numbers[at : at + step]
            part = part[part < len(self.bytes)]  # ids outside the vocabulary stand for nothing
            yield machine.decode(b"".join(map(self.bytes.__getitem__, part.tolist())))
        yield machine.decode(b"", True)

    def __call__(self, ids: bytes) -> str:
        return "".join(self.stream(ids))


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of each whole text in place of a column ``ids_col``; null texts have none."""
    return _with(docs, text_col, ids_col, "array<int>", lambda v=vocabulary: _ids_of(Encoder(v)))


def decode(rows: DataFrame, vocabulary: Vocabulary, ids_col: str = "token_ids", text_col: str = "text") -> DataFrame:
    """``rows`` with the text of each list of ids in ``text_col``; a null list has none."""

    def text_of(decoder: Decoder):
        def run(column: pa.Array) -> pa.Array:
            texts = (decoder(np.array(ids or [], "<u4").tobytes()) for ids in column.to_pylist())
            return pa.array(texts, pa.string())

        return run

    return _with(rows, ids_col, text_col, "string", lambda v=vocabulary: text_of(Decoder(v)))


def _ids_of(encoder: Encoder):
    def run(column: pa.Array) -> pa.Array:
        ids = [encoder(t) for t in column.to_pylist()]
        ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
        values = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    return run


def _with(docs: DataFrame, source: str, target: str, kind: str, make) -> DataFrame:
    columns = [c for c in docs.columns if c != target]
    at = columns.index(source)
    fields = [docs.schema[c] for c in columns]
    schema = StructType([*fields, StructField(target, DataType.fromDDL(kind))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = make()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, convert(batch.column(at))], names=[*batch.schema.names, target]
            )

    return docs.select(columns).mapInArrow(run, schema)


def digest(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each row; each text is encoded, then decoded from its ids.

    Null and empty texts have no ids. Repeated rows repeat their result; other
    columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
        for batch in batches:
            out = []
            for text in batch.column(1):
                ids = encoder(text.as_py())
                out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), _text_sha(decoder, ids)))
            n, ids_sha, text_sha = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        encoder.forget()
        release()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens, token_ids and the SHA-256 of the text decoded from them in place of the text."""
    new = {"n_tokens": "bigint", "token_ids": "array<int>", "decoded_sha256": "string"}
    columns = [c for c in docs.columns if c not in (text_col, *new)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(vocabulary, WORDS), Decoder(vocabulary)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                ids = [encoder(t.as_py()) for t in batch.column(0)]
                n = [len(x) // 4 for x in ids]
                values = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), values)
                sha = [_text_sha(decoder, x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], pa.array(n, pa.int64()), lists, pa.array(sha, pa.string())],
                    names=[*columns, *new],
                )
        encoder.forget()
        release()

    schema = StructType([docs.schema[c] for c in columns])
    for name, kind in new.items():
        schema = schema.add(StructField(name, DataType.fromDDL(kind)))
    return docs.select(text_col, *columns).mapInArrow(run, schema)


def _text_sha(decoder: Decoder, ids: bytes) -> str:
    found = hashlib.sha256()
    for part in decoder.stream(ids):
        found.update(part.encode())
    return found.hexdigest()


def op5_bpe(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary = Vocabulary(vocabulary_path())
    return digest(table(spark, sf, "documents"), vocabulary).withColumnRenamed("id", "doc_id")
