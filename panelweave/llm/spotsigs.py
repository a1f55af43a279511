"""SpotSigs fingerprints: chains of content words that follow common words.

Each common word (an anchor) starts a signature of itself and the next content
words, so headings, lists and menus, which have few anchors, leave few traces.
A document's fingerprint is the set of its signatures. Sets are partitioned by
length, as Jaccard similarity is at most the ratio of the lengths, and pairs
that share one of their rarest signatures are compared. All of it is DataFrame
expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelweave.llm.common import table, written

#: Common words of English, French, Spanish and German.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au aux ce dans des du elle est et il la le les par pas pour qui que sur un une "
    "con de del el en ella es las lo los no por se su una y "
    "das dem den der die ein eine im ist mit nicht sich sie und von zu"
).split()
CHAIN = 2
#: Rows of a bucket of neighbouring ids.
BUCKET = 1500


def with_signatures(
    df: DataFrame, text: str, out: str, anchors: list[str] = ANCHORS, chain: int = CHAIN
) -> DataFrame:
    """``df`` with the sorted set of 32-bit signatures of a whole text in ``out``.

    Words are runs of letters and digits in lower case. A text with words but
    without a signature has one signature of all its words; a text without words, or null, has none.
    """
    words, content, spots = (f"__{out}_{k}" for k in ("words", "content", "spots"))
    keep = [c for c in df.columns if c != out]
    common = list(dict.fromkeys(anchors))
    df = df.withColumn(
        words, F.expr(rf"regexp_extract_all(lower(coalesce({text}, '')), '[\\p{{L}}\\p{{N}}]+', 0)")
    )
    df = df.withColumn(content, F.filter(words, lambda w: ~w.isin(common))).withColumn(
        spots, F.filter(F.transform(words, lambda w, i: F.when(w.isin(common), i)), lambda i: i.isNotNull())
    )
    chains = F.transform(
        spots,
        lambda i, j: F.when(
            i - j + chain <= F.size(content),
            F.hash(F.get(words, i), *(F.get(F.col(content), i - j + k) for k in range(chain))),
        ),
    )
    found = F.sort_array(F.array_distinct(F.filter(chains, lambda s: s.isNotNull())))
    df = df.withColumn(out, found)
    whole = F.when(F.size(words) > 0, F.array(F.hash(F.array_join(words, " ")))).otherwise(
        F.array().cast("array<int>")
    )
    return df.withColumn(out, F.when(F.size(out) > 0, F.col(out)).otherwise(whole)).select(*keep, out)


def fingerprint(signatures: str) -> Column:
    """The set as a string: eight hexadecimal digits for each signature, in order."""
    return F.array_join(
        F.transform(signatures, lambda s: F.lower(F.lpad(F.hex(s.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0"))), ""
    )


def jaccard(a: str, b: str) -> Column:
    """Jaccard similarity of two sets; 1 for two empty ones. An empty set prunes the comparison."""
    shared = F.size(F.array_intersect(a, b))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .otherwise(shared / (F.size(a) + F.size(b) - shared))
    )


def near_pairs(sets: DataFrame, least: float = 0.8, id_col: str = "id", set_col: str = "signatures") -> DataFrame:
    """(left, right, likeness): classes of equal sets that are alike by ``least`` or more, by their smallest ids.

    Equal sets are one class. Lengths are cut into partitions of the ratio
    ``least``, so alike sets lie in one or in neighbouring partitions. Of each set
    only its rarest signatures, as many as alike sets cannot all lack, are
    matched, and only in such partitions. Empty sets and rows without an id link
    with nothing.
    """
    classes = (
        sets.where(F.col(id_col).isNotNull() & (F.size(set_col) > 0))
        .groupBy(F.col(set_col).alias("s"))
        .agg(F.min(F.col(id_col)).alias("id"))
    )
    classes = written(classes.withColumn("n", F.size("s")), "spotsigs-classes")
    each = classes.select("id", "n", F.explode("s").alias("sig"))
    often = each.groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    ranked = each.join(often, "sig").groupBy("id", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("by_rarity")
    )
    kept = F.col("n") - F.ceil(F.col("n") * F.lit(least) - 1e-9) + 1
    part = F.floor(F.log("n") / F.lit(-1.0) / F.log(F.lit(least)) + 1e-9).cast("int")
    probes = ranked.select(
        "id", "n", part.alias("part"), F.explode(F.slice("by_rarity", F.lit(1), kept.cast("int"))["sig"]).alias("sig")
    )
    index = probes.select(
        F.col("id").alias("other"), F.col("n").alias("m"), "sig", F.explode(F.array("part", F.col("part") + 1)).alias("part")
    )
    pairs = (
        probes.join(index, ["sig", "part"])
        .where((F.col("id") != F.col("other")) & (F.col("m") <= F.col("n")) & (F.col("m") >= F.col("n") * least - 1e-9))
        .select(F.least("id", "other").alias("left"), F.greatest("id", "other").alias("right"))
        .distinct()
    )
    a = classes.select(F.col("id").alias("left"), F.col("s").alias("a"))
    b = classes.select(F.col("id").alias("right"), F.col("s").alias("b"))
    return (
        pairs.join(a, "left").join(b, "right").select("left", "right", jaccard("a", "b").alias("likeness"))
        .where(F.col("likeness") >= least - 1e-12)
    )


def _bucket(edges: list, id_col: str) -> Column:
    """How many of the sorted edges are at or below the id, found in two steps."""
    if not edges:
        return F.lit(0)
    step = max(1, int(len(edges) ** 0.5))
    groups = [edges[k : k + step] for k in range(0, len(edges), step)]
    coarse = F.array(*(F.lit(g[0]) for g in groups))
    fine = F.array(*(F.array(*map(F.lit, g)) for g in groups))
    at = F.size(F.filter(coarse, lambda e: e <= F.col(id_col)))
    within = F.size(F.filter(F.get(fine, at - 1), lambda e: e <= F.col(id_col)))
    return F.when(at > 0, (at - 1) * step + within).otherwise(0)


def with_next(df: DataFrame, id_col: str, text: str, signatures: str, bucket_rows: int = BUCKET) -> DataFrame:
    """``df`` with next_text and next_signatures: those of the row with the next id, after the last the first.

    Rows are dealt by ranges of ids, so texts are shuffled once; a range's last
    row takes the first row of the range behind it. Rows without an id come
    first; equal ids are in order of a hash of the text.
    """
    rows = df.count()
    many = rows // bucket_rows
    edges = []
    if many:
        shares = [k / (many + 1) for k in range(1, many + 1)]
        found = df.agg(F.percentile_approx(id_col, shares, max(10_000, 10 * many))).first()[0]
        edges = sorted(set(found or []))
    df = df.withColumn("__bucket", _bucket(edges, id_col)).withColumn("__order", F.xxhash64(text))
    order = Window.partitionBy("__bucket").orderBy(id_col, "__order")
    lead = df.select(
        "*",
        F.lead(text).over(order).alias("__text"),
        F.lead(signatures).over(order).alias("__signatures"),
        F.lead(F.lit(1)).over(order).isNull().alias("__last"),
    )
    starts = df.groupBy("__bucket").agg(F.min(id_col).alias("__id"))
    ring = Window.partitionBy(F.lit(0)).orderBy("__bucket")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = starts.select(
        "__bucket", F.coalesce(F.lead("__id").over(ring), F.first("__id").over(whole)).alias("__id")
    )
    # a row for each bucket: small beside the rows, and broadcast only below a checked number
    follows = F.broadcast(follows) if many < 100_000 else follows
    firsts = (
        df.select(F.col(id_col).alias("__id"), F.col(text).alias("__first_text"),
                  F.col(signatures).alias("__first_signatures"), "__order")
        .join(follows, "__id")
        .groupBy("__bucket")
        .agg(F.min_by(F.struct("__first_text", "__first_signatures"), "__order").alias("__first"))
    )
    return lead.join(firsts, "__bucket", "left").select(
        *(c for c in df.columns if not c.startswith("__")),
        F.when(F.col("__last"), F.col("__first.__first_text")).otherwise(F.col("__text")).alias("next_text"),
        F.when(F.col("__last"), F.col("__first.__first_signatures")).otherwise(F.col("__signatures")).alias("next_signatures"),
    )


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The fingerprint of each text, of its edited text, and their likeness, with the next text's.

    A null text is an empty one; an empty text has an empty fingerprint. The
    edited text has its last half replaced by as much of the next document's
    beginning. Repeated rows are documents of their own; an empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(with_signatures(rows, "text", "signatures"), "id", "text", "signatures")
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn(
        "edited_text",
        F.concat(
            F.substring(F.col("text"), F.lit(1), F.length("text") - half),
            F.substring(F.col("next_text"), F.lit(1), half),
        ),
    )
    rows = with_signatures(rows, "edited_text", "edited_signatures")
    return rows.select(
        "id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        fingerprint("signatures").alias("fingerprint"),
        fingerprint("edited_signatures").alias("edited_fingerprint"),
        jaccard("signatures", "edited_signatures").alias("near_edited"),
        jaccard("signatures", "next_signatures").alias("near_next"),
    )


def op9_spotsigs(spark: SparkSession, sf: str) -> DataFrame:
    return edited(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")
