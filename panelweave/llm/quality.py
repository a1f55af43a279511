"""Quality classifier: overlapping heuristic labellers, a label model, and a hashed linear scorer.

Each labeller votes bad, good or not at all on each document. Expectation
maximisation over the counts of vote patterns, of all documents, estimates how
often each labeller is right for bad and for good documents. The posterior
labels then train a linear scorer on hashed words, word beginnings and shapes,
which alone decides. This is done once for low quality and once for toxicity.
Rows of a table of judgements, where there is one, are one more labeller.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.common import Memo, release, table, written

GOOD, BAD, NONE = 0, 1, 2
#: Weights of the scorer, passes over the sample, step size, and rows of the sample at most.
WIDTH, PASSES, STEP, SAMPLE = 1 << 18, 8, 1.0, 10_000
#: Deviations from chance beyond which a feature counts, and beyond that at most.
SURE, MOST = 3.0, 15.0
#: Weights nearer to zero are left out.
LEAST = 2e-3
ROUNDS, PRIOR, JUDGED = 50, 20.0, 0.999
BEGINNINGS = (4, 5, 6, 7)
#: Common words of English, French, Spanish and German, and English insults.
ENGLISH = frozenset("a an and are as at be by for from has he in is it its of on that the this to was were will with".split())
COMMON = ENGLISH | frozenset(
    """au aux ce des du elle en est et il la le les par pas pour qui que sur un une
    con de del el ella es las lo los no por se su una y
    das dem den der die ein eine im ist mit nicht sich sie und von zu""".split()
)
INSULTS = frozenset(
    "idiot moron stupid trash pathetic disgusting worthless clown loser scum dumb filthy vermin imbecile jerk".split()
)


EDGE = b"#$%&*@^~|<>{}[]\\=+_!.,;:?\"'()-"
#: Bytes to strike out so that letters, capitals and odd signs are left; a letter beyond ASCII counts by its first byte.
NO_LETTER = bytes(b for b in range(256) if not (chr(b).isascii() and chr(b).isalpha() or b >= 0xC0))
NO_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)
NO_ODD = bytes(b for b in range(256) if b not in b"#$%&*@^~|<>{}[]\\=+_!")
COMMON_BYTES = frozenset(w.encode() for w in COMMON)
ENGLISH_BYTES = frozenset(w.encode() for w in ENGLISH)
INSULT_BYTES = {w.encode(): re.compile(rb"\b" + w.encode() + rb"\b") for w in sorted(INSULTS)}


class Shape:
    """What the labellers and the scorer look at in one text."""

    def __init__(self, text: str | None):
        raw, low = (text or "").encode(), (text or "").lower().encode()
        tokens = low.split()
        self.tokens = counts = Counter(tokens)
        self.n = n = len(tokens)
        letters, capitals, odd = (len(raw.translate(None, no)) for no in (NO_LETTER, NO_CAPITAL, NO_ODD))
        self.insults = sum(len(whole.findall(low)) for w, whole in INSULT_BYTES.items() if w in low)
        lines = [line for line in raw.split(b"\n") if line.strip()]
        pairs = sum(map(eq, tokens, islice(tokens, 1, None)))
        self.capitals = capitals / max(1, letters)
        self.odd = odd / max(1, letters + odd)
        self.bars = counts[b"|"] / max(1, n)
        self.common = sum(counts[w] for w in COMMON_BYTES & counts.keys()) / max(1, n)
        self.english = sum(counts[w] for w in ENGLISH_BYTES & counts.keys()) / max(1, n)
        self.same_next = pairs / max(1, n - 1)
        self.same_line = 1 - len(set(lines)) / len(lines) if lines else 0.0
        self.distinct = len(counts) / max(1, n)

    def bins(self) -> list[str]:
        out = [f"insults {min(self.insults, 3)}", f"size {self.n.bit_length()}"]
        for name in ("capitals", "odd", "bars", "common", "same_next", "same_line"):
            value = getattr(self, name)
            out += [f"{name} over {x}" for x in (0.01, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6) if value > x]
        out += [f"distinct under {x} {self.n > 50}" for x in (0.1, 0.2, 0.3, 0.4, 0.5) if self.distinct < x]
        return out


def _bad_if(found: bool) -> int:
    return BAD if found else NONE


def _no_insult(s: Shape) -> int:
    """The insults are English, so their absence says something of English texts only."""
    return GOOD if not s.insults and s.english > 0.6 * s.common else NONE


def _clean(s: Shape) -> int:
    fine = s.capitals < 0.1 and s.odd < 0.02 and s.bars < 0.01 and s.same_next < 0.05 and s.same_line < 0.1
    return GOOD if fine and (s.n < 50 or s.distinct > 0.25) else NONE


LABELLERS = {
    "low": {
        "capitals": lambda s: _bad_if(s.n > 10 and s.capitals > 0.25),
        "signs": lambda s: _bad_if(s.odd > 0.06),
        "bars": lambda s: _bad_if(s.bars > 0.08),
        "no common words": lambda s: _bad_if(s.n > 20 and s.common < 0.04),
        "same word again": lambda s: _bad_if(s.n > 20 and s.same_next > 0.2),
        "same line again": lambda s: _bad_if(s.same_line > 0.4),
        "few words": lambda s: _bad_if(s.n > 50 and s.distinct < 0.15),
        "clean": _clean,
    },
    "toxic": {
        "an insult": lambda s: _bad_if(s.insults == 1),
        "insults": lambda s: _bad_if(s.insults > 1),
        "no insult": _no_insult,
    },
}
HEADS = tuple(LABELLERS)
#: Probabilities from which a document is rejected.
LIMITS = {"low": 0.5, "toxic": 0.4}


def _slot(feature: str) -> int:
    return crc32(feature.encode()) & (WIDTH - 1)


def _slots(token: bytes) -> tuple[int, ...]:
    """Slots of the bare word and of its beginnings, in bytes, by one running checksum."""
    core = token.strip(EDGE)
    out, at, running = [crc32(core, 1) & (WIDTH - 1)], 0, 2
    for k in BEGINNINGS:
        if len(core) >= k:
            running = crc32(core[at:k], running)
            out.append(running & (WIDTH - 1))
            at = k
    return tuple(out)


def features(shape: Shape, memo: Memo) -> np.ndarray:
    """Slots of the features a text has, each once; ``memo`` gives a token's."""
    found: set[int] = set()
    found.update(*map(memo.__getitem__, shape.tokens))
    found.update(map(_slot, shape.bins()))
    return np.fromiter(found, np.int32, len(found))


def votes(docs: DataFrame, id_col: str, text_col: str, judged: DataFrame | None) -> DataFrame:
    """(id, low, toxic): the votes on each row as a string with a digit for each labeller, the judged last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list[str]] = {h: [] for h in HEADS}
            for text in batch.column(1):
                shape = Shape(text.as_py())
                for head in HEADS:
                    out[head].append("".join(str(vote(shape)) for vote in LABELLERS[head].values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(out[h], pa.string()) for h in HEADS)], names=["id", *HEADS]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    cast = rows.mapInArrow(run, "id long, " + ", ".join(f"{h} string" for h in HEADS))
    if judged is None:
        return cast.select("id", *(F.concat(h, F.lit(str(NONE))).alias(h) for h in HEADS))
    told = judged.groupBy("id").agg(
        *(F.max(h).alias(f"told_{h}") for h in HEADS)
    )
    return cast.join(told, "id", "left").select(
        "id", *(F.concat(h, F.coalesce(F.col(f"told_{h}").cast("string"), F.lit(str(NONE)))).alias(h) for h in HEADS)
    )


class LabelModel:
    """How often independent labellers vote bad and good on bad and on good documents, by expectation maximisation.

    ``patterns`` are the vote patterns with their counts over all documents, at
    most three to the power of the labellers, whatever the corpus. Not to vote
    says nothing. Labellers start as ten times likelier to be right than wrong,
    which counts as ``PRIOR`` documents of each kind. The judged, who vote last,
    start as right in ``JUDGED`` of their votes, which counts as much as all they judged.
    """

    def __init__(self, patterns: dict[str, int]):
        seen = sorted(patterns)
        self.cast = cast = np.array([[int(c) for c in p] for p in seen], np.int64).reshape(len(seen), -1 if seen else 1)
        self.n = n = np.array([patterns[p] for p in seen], float)
        # rates[class, labeller, vote]: share of the class's documents with this vote
        start = np.full((2, cast.shape[1], 2), 0.03)
        start[GOOD, :, GOOD] = start[BAD, :, BAD] = 0.3
        prior = np.full(cast.shape[1], PRIOR)
        told = float(n[cast[:, -1] != NONE].sum())
        share = told / max(1.0, n.sum())
        if told:
            start[GOOD, -1] = share * JUDGED, share * (1 - JUDGED)
            start[BAD, -1] = share * (1 - JUDGED), share * JUDGED
            prior[-1] = n.sum()
        self.rates, self.bad = start.copy(), 0.1
        for _ in range(ROUNDS if len(seen) else 0):
            p = self._posterior()
            self.bad = float((n * p).sum() + 1) / (n.sum() + 10)
            for k, share in ((GOOD, 1 - p), (BAD, p)):
                for vote in (GOOD, BAD):
                    hits = ((cast == vote) * (n * share)[:, None]).sum(axis=0)
                    self.rates[k, :, vote] = (hits + prior * start[k, :, vote]) / ((n * share).sum() + prior)
        self.labels = dict(zip(seen, self._posterior().tolist()))

    def _posterior(self) -> np.ndarray:
        odds = np.full(len(self.cast), np.log(self.bad) - np.log1p(-self.bad))
        for s in range(self.cast.shape[1] if len(self.cast) else 0):
            for vote in (GOOD, BAD):
                step = np.log(self.rates[BAD, s, vote]) - np.log(self.rates[GOOD, s, vote])
                odds += np.where(self.cast[:, s] == vote, step, 0.0)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def accuracies(self) -> np.ndarray:
        """For each labeller the share of its votes that are right, good and bad."""
        share = np.array([1 - self.bad, self.bad])[:, None, None] * self.rates
        return np.stack([share[k, :, k] / share[:, :, k].sum(axis=0) for k in (GOOD, BAD)], axis=1)


def fit_scorer(rows: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Logistic regression over present features; the last weight is the constant.

    A feature counts by how many deviations more (or fewer) bad rows have it than
    chance would give, beyond ``SURE`` and up to ``MOST``, so that rare accidents
    count nothing beside what marks many rows. A step is relative to a row's features.
    """
    bad, seen = np.zeros(WIDTH), np.zeros(WIDTH)
    for slots, y in zip(rows, labels.tolist()):
        bad[slots] += y
        seen[slots] += 1
    chance = seen * (labels.mean() if len(labels) else 0.0)
    apart = (bad - chance) / np.sqrt(chance + 0.5)
    ratio = np.sign(apart) * np.clip(np.abs(apart) - SURE, 0, MOST)
    w, constant = np.zeros(WIDTH), 0.0
    if len(labels) and not weights.any():  # nothing to learn but how many are bad
        constant = float(np.log(labels.mean()) - np.log1p(-labels.mean()))
    order = np.random.default_rng(5)
    for k in range(PASSES):
        step = STEP / (1 + k)
        for k in order.permutation(len(rows)).tolist():
            slots = rows[k]
            x = ratio[slots]
            z = x @ w[slots] + constant
            g = weights[k] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[k])
            if abs(g) > 1e-3:
                move = step * g / (1 + x @ x) * 4
                w[slots] -= move * x
                constant -= move
    w *= ratio
    w[np.abs(w) < LEAST] = 0.0
    return np.append(w, constant)


class Classifier:
    """The scorers' weights, one row for each head."""

    def __init__(self, weights: np.ndarray, labels: dict[str, LabelModel]):
        self.weights, self.labels = weights.astype(np.float32), labels

    def scorer(self):
        """A function from a text to the log odds of each head; remembers the tokens it meets."""
        weights = self.weights
        used = weights.any(axis=0)
        slots = Memo(lambda token: tuple(s for s in _slots(token) if used[s]), 100_000)

        def odds(text: str | None) -> np.ndarray:
            x = features(Shape(text), slots)
            return weights[:, x].sum(axis=1, dtype=np.float64) + weights[:, -1]

        return odds

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, low, toxic): the probability of each, for each row; a null text counts as an empty one."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            odds = self.scorer()
            for batch in batches:
                z = np.array([odds(t.as_py()) for t in batch.column(1)], np.float64).reshape(-1, len(HEADS))
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(p[:, k]) for k in range(len(HEADS)))], names=["id", *HEADS]
                )
            release()

        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        kind = docs.schema[id_col].dataType.simpleString()
        return rows.mapInArrow(run, f"id {kind}, " + ", ".join(f"{h} double" for h in HEADS))


def fit(
    docs: DataFrame,
    judged: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> Classifier:
    """Fits label models on the votes of all rows, and the scorers on a sample with posterior labels.

    ``judged`` has (id, low, toxic) with 1 for bad, 0 for good. By a hash of the id
    at most ``sample`` rows are drawn of those it has, and as many of the others
    (``sample`` where it has none), so that judgements keep their weight.
    A row on which no labeller votes counts for what chance gives alone, so that
    texts of which labellers know less do not look worse for it.
    An empty table gives scorers that reject nothing.
    """
    cast = written(votes(docs, id_col, text_col, judged), "quality-votes")
    models = {h: LabelModel({r[0]: r[1] for r in cast.groupBy(h).count().collect()}) for h in HEADS}
    is_told = F.lit(False)
    for h in HEADS:
        is_told = is_told | ~F.col(h).endswith(str(NONE))
    known = cast.where("id is not null")
    told = min(sample, known.where(is_told).count())
    drawn = [
        known.where(pool).orderBy(F.xxhash64(F.lit(11), "id"), "id").limit(most)
        for pool, most in ((is_told, told), (~is_told, told or sample))
    ]
    chosen = written(drawn[0].unionByName(drawn[1]).dropDuplicates(["id"]), "quality-sample")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    labelled = texts.join(chosen, "id").select(F.lit(0).alias("one"), "id", "text", *HEADS)
    labels = {h: m.labels for h, m in models.items()}

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = Memo(_slots, 100_000)
        for batch in batches:
            one, id_, text, *cast = batch.columns
            x = pa.array([features(Shape(t.as_py()), slots).tobytes() for t in text], pa.binary())
            yield pa.RecordBatch.from_arrays([one, id_, x, *cast], names=["one", "id", "slots", *HEADS])
        del slots
        release()

    def train(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        x = [np.frombuffer(s.as_buffer(), np.int32) for s in rows["slots"]]
        w = []
        for h in HEADS:
            cast = rows[h].to_pylist()
            y = np.array([labels[h][p] for p in cast])
            voted = np.array([bool(p.strip(str(NONE))) for p in cast])
            w.append(fit_scorer(x, y, np.abs(2 * y - 1) * voted))
        out = pa.table({"weights": [np.stack(w).astype(np.float32).tobytes()]})
        del x, rows
        release()
        return out

    kinds = "one int, id long, slots binary, " + ", ".join(f"{h} string" for h in HEADS)
    found = labelled.mapInArrow(described, kinds).groupBy("one").applyInArrow(train, "weights binary").collect()
    if found:
        weights = np.frombuffer(found[0][0], np.float32).reshape(len(HEADS), -1)
    else:
        weights = np.zeros((len(HEADS), WIDTH + 1), np.float32)
        weights[:, -1] = -5
    return Classifier(weights, models)


def judgements(labels: DataFrame) -> DataFrame:
    """(id, low, toxic) from a table of (doc_id, quality, toxic); null judgements are no votes."""
    return labels.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("id"),
        (1 - F.col("quality")).cast("int").alias("low"),
        F.col("toxic").cast("int").alias("toxic"),
    )


def keep_good(docs: DataFrame, classifier: Classifier, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that reach a limit of ``LIMITS``; columns stay as they are."""
    most = np.array([np.log(LIMITS[h] / (1 - LIMITS[h])) for h in HEADS])

    at = docs.columns.index(text_col)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds = classifier.scorer()
        for batch in batches:
            yield batch.filter(pa.array([bool((odds(t.as_py()) < most).all()) for t in batch.column(at)], pa.bool_()))
        release()

    return docs.mapInArrow(good, docs.schema)


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, p_low, p_toxic, kept) of each document."""
    docs = table(spark, sf, "documents")
    classifier = fit(docs, judgements(table(spark, sf, "labels")))
    scores = classifier.score(docs)
    return scores.select(
        F.col("id").alias("doc_id"),
        F.col("low").alias("p_low"),
        F.col("toxic").alias("p_toxic"),
        ((F.col("low") < LIMITS["low"]) & (F.col("toxic") < LIMITS["toxic"])).alias("kept"),
    )
