"""Periodic runs of words: suffix-tree extensions of Lyndon-root candidates.

A run is a maximal stretch with smallest period q. Its Lyndon roots are longest
Lyndon words at their places, under one of the two orders of the alphabet, so
2n candidates hold every run. Each is extended to the right in the suffix tree of
the text and to the left in that of its reversal: Ukkonen builds both, and the
longest common extension of two places is the depth of their lowest common
ancestor, a range minimum over the Euler tour between two leaves.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.common import small_batches, table, utf8, words_of


def ukkonen(text: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffix tree of a text whose last symbol is nowhere else: (parent, first symbol, start, end) of each node but the root, 0."""
    n, width = len(text), max(text) + 1 if text else 1
    start, end, link = [-1], [-1], [0]  # end -1: a leaf, which reaches to the text's end
    child: dict[int, int] = {}
    node, edge, length, waiting = 0, 0, 0, 0
    for i, symbol in enumerate(text):
        waiting += 1
        last = 0
        while waiting:
            if length == 0:
                edge = i
            key = node * width + text[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(start)
                start.append(i), end.append(-1), link.append(0)
                if last:
                    link[last] = node
                    last = 0
            else:
                low, high = start[below], end[below]
                size = (i + 1 if high < 0 else high) - low
                if length >= size:
                    edge += size
                    length -= size
                    node = below
                    continue
                if text[low + length] == symbol:
                    if last and node:
                        link[last] = node
                    length += 1
                    break
                fork = len(start)
                child[key] = fork
                start.append(low), end.append(low + length), link.append(0)
                child[fork * width + symbol] = fork + 1
                start.append(i), end.append(-1), link.append(0)
                start[below] = low + length
                child[fork * width + text[low + length]] = below
                if last:
                    link[last] = fork
                last = fork
            waiting -= 1
            if node == 0:
                if length:
                    length -= 1
                    edge = i - waiting + 1
            else:
                node = link[node]
    keys = np.fromiter(child.keys(), np.int64, len(child))
    nodes = np.fromiter(child.values(), np.int64, len(child))
    parent, first = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    parent[nodes], first[nodes] = keys // width, keys % width
    ends = np.array(end, np.int64)
    ends[ends < 0] = n
    ends[0] = 0
    starts = np.array(start, np.int64)
    starts[0] = 0
    return parent, first, starts, ends


class Extensions:
    """Longest common extensions to the right of any two places of a text, in constant time each."""

    def __init__(self, text: list[int]):
        self.n = len(text)
        self.tree = ukkonen(text)
        leaves, low = self.tour(self.tree[1])
        self.rank = np.empty(self.n, np.int64)
        self.rank[leaves] = np.arange(self.n)
        # sparse table of minima of the tour's depths between leaves
        self.minima = [low.astype(np.int32)]
        while len(self.minima[-1]) > 1 << (len(self.minima) - 1):
            half = 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(self.minima[-1][:-half], self.minima[-1][half:]))

    def tour(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves (as the places of their suffixes) of the Euler tour with children in ``order``, and its least depth before each."""
        parent, _, start, end = self.tree
        count = len(parent)
        inner = np.zeros(count, bool)
        inner[parent] = True
        ranked = np.lexsort((order[1:], parent[1:]))[::-1] + 1
        first = np.searchsorted(-parent[ranked], -np.arange(count), side="left").tolist()
        past = np.searchsorted(-parent[ranked], -np.arange(count), side="right").tolist()
        ranked, size, above = ranked.tolist(), (end - start).tolist(), parent.tolist()
        is_inner, depth = inner.tolist(), [0] * count
        leaves, lows, low, stack = [], [], 0, [0]
        total = self.n
        while stack:
            node = stack.pop()
            if node:
                at = depth[above[node]]
                if at < low:
                    low = at
                depth[node] = at = at + size[node]
            else:
                at = 0
            if is_inner[node]:
                stack.extend(ranked[first[node] : past[node]])
            elif node:
                leaves.append(total - at)
                lows.append(low)
                low = total
        return np.array(leaves, np.int64), np.array(lows[1:], np.int64)

    def between(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i[k] and j[k] on are equal; i[k] != j[k]."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        power = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for level in np.unique(power).tolist():
            at = np.flatnonzero(power == level)
            row = self.minima[level]
            out[at] = np.minimum(row[a[at]], row[b[at] - (1 << level)])
        return out


def longest_lyndon(rank: list[int]) -> np.ndarray:
    """Length of the longest Lyndon word from each place on: up to the next smaller suffix."""
    n = len(rank)
    length, stack = [0] * n, []
    for i in range(n - 1, -1, -1):
        here = rank[i]
        while stack and rank[stack[-1]] > here:
            stack.pop()
        length[i] = (stack[-1] if stack else n) - i
        stack.append(i)
    return np.array(length, np.int64)


def all_runs(pieces: list[np.ndarray], least: int, times: int) -> np.ndarray:
    """(start, length, period) rows of the runs of length >= max(least, times * period) of the pieces, laid end to end with one place between."""
    if not pieces:
        return np.empty((0, 3), np.int64)
    # every piece ends with a symbol of its own, smaller than all words under either order
    count = len(pieces)
    _, words = np.unique(np.concatenate(pieces), return_inverse=True)
    ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
    text = np.empty(int(ends[-1]) + 1, np.int64)
    marks = np.zeros(len(text), bool)
    marks[ends] = True
    text[~marks] = words + count
    text[ends] = np.arange(count)
    right = Extensions(text.tolist())
    left = Extensions([*text[:-1][::-1].tolist(), int(text[-1])])
    symbols = right.tree[1]
    found, n = [], len(text)
    for order in (symbols, np.where(symbols < count, symbols, -symbols + 2 * (text.max() + 1))):
        leaves, _ = right.tour(order)
        rank = np.empty(n, np.int64)
        rank[leaves] = np.arange(n)
        period = longest_lyndon(rank.tolist())
        i = np.flatnonzero(~marks)
        p = period[i]
        i, p = i[(p > 0) & (i + p < n)], p[(p > 0) & (i + p < n)]
        ahead = right.between(i, i + p)
        # place x of the text is place n - 2 - x of its reversal
        back = np.zeros(len(i), np.int64)
        inner = np.flatnonzero(i > 0)
        back[inner] = left.between(n - 2 - (i[inner] - 1), n - 2 - (i[inner] + p[inner] - 1))
        length = back + p + ahead
        keep = length >= np.maximum(least, times * p)
        found.append(np.stack([(i - back)[keep], length[keep], p[keep]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def repeating_pieces(words: np.ndarray, doc: np.ndarray, times: int, least: int) -> list[tuple[int, int]]:
    """Maximal stretches [low, high) of one document in which every word comes ``times`` times: runs lie in them, with both their ends.

    In a run of so many periods every word comes so often, and a word beside it that kept
    its period would too; so a stretch can be cut at rarer words, again and again.
    """
    part = doc.astype(np.int64)
    alive = np.ones(len(words), bool)
    while alive.any():
        at = np.flatnonzero(alive)
        keys = part[at] * (int(words.max()) + 1) + words[at]
        _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
        rare = count[inverse] < times
        new = np.empty(len(at), bool)
        new[0] = True
        kept = at[~rare]
        alive[at[rare]] = False
        if len(kept):
            split = np.empty(len(kept), bool)
            split[0] = True
            split[1:] = (np.diff(kept) > 1) | (np.diff(part[kept]) != 0)
            label = np.cumsum(split)
            size = np.bincount(label)
            short = size[label] < least
            part[kept] = label
            alive[kept[short]] = False
            if not rare.any() and not short.any():
                break
    at = np.flatnonzero(alive)
    if not len(at):
        return []
    cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(part[at]) != 0))
    return list(zip(at[np.r_[0, cut + 1]].tolist(), (at[np.r_[cut, len(at) - 1]] + 1).tolist()))


#: Words of stretches that share one pair of trees; a longer stretch has its own.
TOGETHER = 20_000


def runs_of(texts: list[list[bytes]], times: int = 4, least: int = 6) -> list[np.ndarray]:
    """Of each text the (start, length, period) rows of its runs, by start, then period."""
    ids: dict[bytes, int] = {}
    words = np.array([ids.setdefault(w, len(ids)) for text in texts for w in text], np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    offsets = np.r_[0, np.cumsum(sizes)]
    found: list[list[np.ndarray]] = [[] for _ in texts]
    pieces = repeating_pieces(words, doc, times, least) if len(words) else []
    k = 0
    while k < len(pieces):
        chosen, size = [], 0
        while k < len(pieces) and (not chosen or size + pieces[k][1] - pieces[k][0] <= TOGETHER):
            chosen.append(pieces[k])
            size += pieces[k][1] - pieces[k][0]
            k += 1
        rows = all_runs([words[a:b] for a, b in chosen], least, times)
        laid = np.cumsum([0, *[b - a + 1 for a, b in chosen]])
        owner = np.searchsorted(laid, rows[:, 0], side="right") - 1
        lows = np.array([a for a, _ in chosen])
        start = lows[owner] + rows[:, 0] - laid[owner]
        of = doc[start] if len(start) else start
        for d in np.unique(of).tolist():
            mine = of == d
            found[d].append(np.stack([start[mine] - offsets[d], rows[mine, 1], rows[mine, 2]], axis=1))
    empty = np.empty((0, 3), np.int64)
    out = [np.concatenate(f) if f else empty for f in found]
    return [rows[np.lexsort((rows[:, 2], rows[:, 0]))] for rows in out]


def collapsed(words: list[bytes], rows: np.ndarray) -> list[bytes]:
    """The words outside every run's places beyond its first period."""
    if not len(rows):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 0] + rows[:, 1], -1)
    return [w for w, gone in zip(words, (np.cumsum(change[:-1]) > 0).tolist()) if not gone]


def planted(doc_id, words: list[bytes]) -> list[bytes]:
    """The words of a document, every tenth one (by the hash of its id) made periodic from a place on; those without an id stay."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


RESULT = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)
NAMES = [part.split()[0] for part in RESULT.split(", ")]


def _result(words: list[bytes], rows: np.ndarray) -> tuple:
    best = rows[np.lexsort((rows[:, 2], rows[:, 0], -rows[:, 1]))[0]].tolist() if len(rows) else None
    listed = "".join(f"{s},{m},{p}\n" for s, m, p in rows.tolist())
    return (
        len(rows),
        *(best + [1000 * best[1] // best[2]] if best else [None] * 4),
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(b" ".join(collapsed(words, rows))).hexdigest(),
    )


#: Bytes of texts that are looked at together.
CHUNK = 1 << 20


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change=None, times: int = 4, least: int = 6) -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of each row.

    Runs have a length of at least ``least`` words and ``times`` periods. The longest one is
    described; of equal ones that with the smallest start, then period. Null and empty texts
    have no words and no run. Rows stand for themselves: repeated rows repeat their result;
    other columns are not read. ``change(id, words)`` may alter the words first. Texts are
    read whole; trees are built over the stretches of words that come ``times`` times there,
    so memory grows with the longest such stretch (about 1 KB a word while its trees are built).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
            done, k = [], 0
            while k < len(ids):
                some, size = [], 0
                while k < len(ids) and (not some or size + len(texts[k] or b"") <= CHUNK):
                    words = words_of(texts[k])
                    some.append(change(ids[k], words) if change else words)
                    size += len(texts[k] or b"")
                    k += 1
                done += map(_result, some, runs_of(some, times, least))
            columns = list(zip(*done)) if done else [[] for _ in NAMES]
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, kinds)], names=["id", *NAMES])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, {RESULT}")


def op13_runs(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    return detect(table(spark, sf, "documents"), change=planted).withColumnRenamed("id", "doc_id")
