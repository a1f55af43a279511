"""Elias-Fano sequences over numpy arrays that may be memory-mapped, and the files that hold them."""

from __future__ import annotations

import json

import numpy as np
from pyarrow.fs import FileSystem, LocalFileSystem

ONE, SIX, LOW6 = np.uint64(1), np.uint64(6), np.uint64(63)


def _select(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit number ``rank`` in each word."""
    at = np.zeros(len(word), np.uint64)
    rank = rank.astype(np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count((word >> at) & np.uint64((1 << width) - 1)).astype(np.int64)
        beyond = rank >= below
        rank -= below * beyond
        at += np.uint64(width) * beyond.astype(np.uint64)
    return at.astype(np.int64)


class EliasFano:
    """A rising sequence of n numbers below a bound in about 2 + log2(bound / n) bits each.

    The upper parts are a bit vector in unary with counts of ones before each
    word; the lower parts are packed side by side.
    """

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.width, self.low, self.high, self.ones = n, width, low, high, ones

    @classmethod
    def build(cls, values: np.ndarray, bound: int) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        width = min(62, max(0, (bound // max(1, n)).bit_length() - 1))
        mask = np.uint64((1 << width) - 1)
        index = np.arange(n, dtype=np.uint64)
        low = np.zeros(n * width // 64 + 2, np.uint64)
        if width:
            part, at = values & mask, index * np.uint64(width)
            word, shift = (at >> SIX).astype(np.int64), at & LOW6
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(width) > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        at = (values >> np.uint64(width)) + index
        high = np.zeros((((bound - 1) >> width) + n) // 64 + 2 if bound > 0 else 2, np.uint64)
        np.bitwise_or.at(high, (at >> SIX).astype(np.int64), ONE << (at & LOW6))
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high).astype(np.int64))))
        return cls(n, width, low, high, ones)

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        head = np.array([self.n, self.width], np.int64)
        return {f"{name}.head": head, f"{name}.low": self.low, f"{name}.high": self.high, f"{name}.ones": self.ones}

    @classmethod
    def of(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        n, width = arrays[f"{name}.head"].tolist()
        return cls(n, width, *(arrays[f"{name}.{k}"] for k in ("low", "high", "ones")))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.width)
        word, shift = (at >> SIX).astype(np.int64), at & LOW6
        out = self.low[word] >> shift
        over = shift + np.uint64(self.width) > 64
        out[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return out & np.uint64((1 << self.width) - 1)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the zero number k in the upper bits."""
        zeros = np.arange(len(self.ones)) * 64 - self.ones
        word = np.searchsorted(zeros, k, "right") - 1
        return word * 64 + _select(~self.high[word], k - zeros[word])

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at places ``i``."""
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.ones, i, "right") - 1
        at = word * 64 + _select(self.high[word], i - self.ones[word])
        return ((at - i).astype(np.uint64) << np.uint64(self.width)) | self._low(i)

    def find(self, values: np.ndarray, first: np.ndarray | int = 0, last: np.ndarray | None = None) -> np.ndarray:
        """Place of each value among the places from ``first`` to before ``last``, or -1."""
        values = values.astype(np.uint64)
        out = np.full(len(values), -1, np.int64)
        if not self.n or not len(values):
            return out
        high = (values >> np.uint64(self.width)).astype(np.int64)
        known = high < len(self.high) * 64 - self.n
        rows = np.flatnonzero(known)
        high, low = high[rows], values[rows] & np.uint64((1 << self.width) - 1)
        begin = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) - high + 1, 0)
        end = self._zero(high) - high
        begin = np.maximum(begin, np.broadcast_to(first, len(values))[rows])
        end = np.minimum(end, np.broadcast_to(self.n if last is None else last, len(values))[rows])
        while len(rows):
            going = begin < end
            rows, low, begin, end = rows[going], low[going], begin[going], end[going]
            middle = (begin + end) // 2
            there = self._low(middle)
            out[rows[there == low]] = middle[there == low]
            begin = np.where(there < low, middle + 1, begin)
            end = np.where(there > low, middle, np.where(there == low, begin, end))
        return out


def save(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Arrays behind a head that says where they are, each from a multiple of eight bytes on."""
    head, at = {}, 0
    for name, x in arrays.items():
        head[name] = [str(x.dtype), len(x), at]
        at += -(-x.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    store, where = FileSystem.from_uri(path)
    store.create_dir(where.rpartition("/")[0], recursive=True)
    with store.open_output_stream(where, compression=None) as file:
        file.write(len(text).to_bytes(8, "little") + text)
        for x in arrays.values():
            file.write(x.tobytes() + b"\0" * (-x.nbytes % 8))


def load(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped where its folder is mounted, else read."""
    store, where = FileSystem.from_uri(path)
    if isinstance(store, LocalFileSystem):
        raw = np.memmap(where, np.uint8, "r")
    else:
        with store.open_input_file(where) as file:
            raw = np.frombuffer(file.read(), np.uint8)
    n = int.from_bytes(raw[:8].tobytes(), "little")
    head = json.loads(raw[8 : 8 + n].tobytes())
    out = {}
    for name, (kind, length, at) in head.items():
        at += 8 + n
        out[name] = raw[at : at + length * np.dtype(kind).itemsize].view(kind)
    return out
