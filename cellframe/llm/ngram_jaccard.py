"""Near-duplicate documents by a set-similarity join with several token orders.

The set of a text holds its distinct 5-word shingles (its whole word sequence where it
has fewer words). Two texts link when ``intersection / union`` reaches the threshold.

Method. Under any fixed order of all shingles, two linked sets share a token among
their first ``n - ceil(threshold * n) + 1``. The join runs on the prefixes of one
order, rare shingles first, so a passage that many texts share falls behind their own
words; every candidate must then also share prefix tokens under the other orders, and
only those are verified on their whole sets. Rarity comes from counts over all texts
in a table of fixed size; a collision there changes the order, never the result.

Large groups. Every shared token has a center, one of its texts. Each text is first
compared with the center that it shares the most tokens with. Texts already connected are never paired again, so a group of near copies
gives about one pair per member, and all remaining pairs are compared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import session_settings
from .common import Scratch, components, mixed, query, table, texts, word_hashes

WORDS = 5
PERCENT = 75
BUCKETS = 1 << 16

# What makes the orders differ, one per order.
SALTS = (np.uint64(0x51ED270B9F5C1A37), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; empty without words."""
    hashes = word_hashes((text or "").encode().lower())
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    rolled = np.full(len(hashes) - size + 1, np.uint64(size))
    for place in range(size):
        rolled = mixed(rolled * _STEP + hashes[place:len(hashes) - size + 1 + place])
    return np.unique(rolled)


def needed(size, percent: int):
    """``ceil(percent * size / 100)``: the overlap a set of this size needs at least."""
    return -(-percent * size // 100)


def prefixes(tokens: np.ndarray, rank: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The tokens among which a linked set must share one, rarest first."""
    length = len(tokens) - needed(len(tokens), percent) + 1
    if order == 0:
        rarity = rank[(tokens & np.uint64(BUCKETS - 1)).astype(np.int64)]
    elif order == 1:
        rarity = np.int64(np.log2(1 + rank[(tokens & np.uint64(BUCKETS - 1)).astype(np.int64)]))
    else:
        rarity = np.zeros(len(tokens), np.int64)
    return tokens[np.lexsort((mixed(tokens ^ SALTS[order]), rarity))[:length]]


def shares_prefix(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, percent: int) -> bool:
    """Whether two prefixes of one order share a token early enough for a link."""
    _, at_a, at_b = np.intersect1d(a, b, return_indices=True)
    return bool(((100 + percent) * np.minimum(n_a - at_a, n_b - at_b) >= percent * (n_a + n_b)).any())


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """A bit per token, at its hash modulo a power of two of at least eight bits per token."""
    size = 64 << max(0, (8 * len(tokens) - 1).bit_length() - 6) if len(tokens) else 64
    bits = np.zeros(size, bool)
    bits[(tokens >> np.uint64(20)) & np.uint64(size - 1)] = True
    return np.packbits(bits, bitorder="little")


def may_overlap(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, percent: int) -> bool:
    """Whether sets with these bitmaps can link: a bit of one alone is a token of it alone."""
    while len(a) != len(b):  # the larger one modulo the smaller size
        if len(a) > len(b):
            a = a[:len(a) // 2] | a[len(a) // 2:]
        else:
            b = b[:len(b) // 2] | b[len(b) // 2:]
    most = min(n_a - int(np.bitwise_count(a & ~b).sum()), n_b - int(np.bitwise_count(b & ~a).sum()))
    return (100 + percent) * most >= percent * (n_a + n_b)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _bucket_counts(docs: DataFrame, words: int) -> np.ndarray:
    """How many shingles of all texts fall in each bucket: an array of fixed size."""
    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch["text"]:
                np.add.at(total, (shingles(text, words) & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
        hit = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": hit, "n": total[hit]})

    rows = docs.select("text").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, np.int64)
    for bucket, n in rows.collect():  # at most BUCKETS rows
        counts[bucket] = n
    return counts


def _verified(files: Scratch, docs: DataFrame, pairs: DataFrame, rank, words: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` that link: bitmaps and prefixes of the other orders first, then whole sets of what all let through."""
    pairs = files.store(pairs.distinct(), "pairs")
    wanted = files.store(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")

    def sets(batches):
        for batch in batches:
            tokens = [shingles(text, words) for text in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "n": [len(t) for t in tokens], "bits": [bitmap(t).tobytes() for t in tokens],
                "tokens": [t.tobytes() for t in tokens],
                # Half of each token is enough for a filter: a false match only lets a pair through.
                **{f"prefix_{k}": [prefixes(t, rank.value, k, percent).astype(np.uint32).tobytes() for t in tokens] for k in (1, 2)}})

    schema = "doc_id long, n int, bits binary, tokens binary, prefix_1 binary, prefix_2 binary"
    found = files.store(docs.join(wanted, "doc_id", "left_semi").mapInPandas(sets, schema), "sets")

    def checked(left: DataFrame, columns: tuple[str, ...], test) -> DataFrame:
        """The pairs of ``left`` that pass a test of both sides' columns."""
        for side in ("b", "a"):
            own = found.join(left.select(F.col(side).alias("doc_id")).distinct(), "doc_id", "left_semi")
            left = left.join(own.select(F.col("doc_id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns)), side)

        def rows(batches):
            for batch in batches:
                kept = [test(row) for row in batch.itertuples(index=False)]
                yield batch.loc[np.array(kept, bool), ["a", "b"]]
        return left.mapInPandas(rows, "a long, b long")

    def close(row) -> bool:
        orders = ((row.prefix_1_a, row.prefix_1_b), (row.prefix_2_a, row.prefix_2_b))
        return may_overlap(np.frombuffer(row.bits_a, np.uint8), np.frombuffer(row.bits_b, np.uint8), row.n_a, row.n_b, percent) and all(
            shares_prefix(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), row.n_a, row.n_b, percent) for x, y in orders)

    def links(row) -> bool:
        return linked(np.frombuffer(row.tokens_a, np.uint64), np.frombuffer(row.tokens_b, np.uint64), percent)

    passed = files.store(checked(pairs, ("n", "bits", "prefix_1", "prefix_2"), close), "passed")
    edges = files.store(checked(passed, ("tokens",), links), f"edges-{files.count}")
    files.drop("passed", "sets", "wanted", "pairs")
    return edges


def _may_link(a: Column, b: Column, percent: int) -> Column:
    """Length and position filter on the rows ``n, left`` of two texts with a shared token."""
    return ((100 * F.least(a["n"], b["n"]) >= percent * F.greatest(a["n"], b["n"]))
            & ((100 + percent) * F.least(a["left"], b["left"]) >= percent * (a["n"] + b["n"])))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document id.

    The component is named by the smallest id reachable over links. Empty and NULL
    texts have no shingles and stand alone. Rows that repeat an id count as one
    document (the largest set gives ``n_shingles``); rows without an id are left out;
    other columns are ignored; an empty table gives an empty result.
    """
    # Rows with whole sets are several KB; tasks hold a batch of them at a time. Every step is
    # written before the next one starts, so its shuffle files can go when it has ended.
    with session_settings(docs.sparkSession, {
            "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
            "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        return _near_duplicates(docs, words, percent)


def _near_duplicates(docs: DataFrame, words: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    files = Scratch(spark, "ngram-jaccard")
    docs = texts(docs)
    ids = files.store(docs.select("doc_id", F.md5("text").alias("digest")), "ids")
    first = ids.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    copies = files.store(ids.join(first, "digest").where("doc_id <> rep").select("doc_id", "rep").distinct(), "copies")
    # Copies of an earlier text are left out of the join. An id that also has another
    # text stays: it is a copy and a document of its own.
    single = ids.groupBy("doc_id").agg(F.count_distinct("digest").alias("n")).where("n = 1")
    skipped = files.store(copies.join(single, "doc_id", "left_semi").select("doc_id").distinct(), "skipped")
    firsts = docs.join(skipped, "doc_id", "left_anti")
    rank = spark.sparkContext.broadcast(_bucket_counts(firsts, words))  # BUCKETS numbers

    def emit(batches):
        for batch in batches:
            sets = [shingles(text, words) for text in batch["text"]]
            yield pd.DataFrame({
                "doc": batch["doc_id"], "n": [len(own) for own in sets],
                "prefix": [(prefixes(own, rank.value, 0, percent) if len(own) else own).view(np.int64) for own in sets]})

    sized = files.store(firsts.mapInPandas(emit, "doc long, n int, prefix array<long>"), "prefixes")
    rows = sized.select("doc", "n", F.posexplode("prefix").alias("at", "token")).select(
        "token", "doc", "n", (F.col("n") - F.col("at")).alias("left"))
    same = Window.partitionBy("token")
    shared = files.store(
        rows.withColumn("center", F.min(F.struct("doc", "n", "left")).over(same)).withColumn("most", F.max("doc").over(same))
        .where("center.doc <> most").drop("most"), "shared")
    sized = files.store(sized.select("doc", "n"), "sizes")
    files.drop("prefixes")

    # Each text with the center that it shares the most tokens with.
    near = shared.where("doc <> center.doc").where(_may_link(F.struct("n", "left"), F.col("center"), percent))
    counts = near.groupBy("doc", F.col("center.doc").alias("center")).agg(F.count(F.lit(1)).alias("times"))
    best = counts.groupBy("doc").agg(F.max_by("center", F.struct("times", -F.col("center"))).alias("center"))
    edges = _verified(files, firsts, best.select(F.col("center").alias("a"), F.col("doc").alias("b")), rank, words, percent)

    # Then all pairs of texts that share a token and are not connected yet.
    labels = components(edges)
    known = shared.select("token", "doc", "n", "left").join(labels.withColumnRenamed("node", "doc"), "doc", "left")
    known = known.withColumn("component", F.coalesce("component", "doc"))
    still = files.store(
        known.withColumn("least", F.min("component").over(same)).withColumn("most", F.max("component").over(same))
        .where("least <> most").drop("least", "most"), "open")
    a, b = still.alias("a"), still.alias("b")
    pairs = a.join(b, F.expr("a.token = b.token AND a.doc < b.doc AND a.component <> b.component")
                   & _may_link(F.struct("a.n", "a.left"), F.struct("b.n", "b.left"), percent))
    pairs = pairs.select(F.col("a.doc").alias("a"), F.col("b.doc").alias("b"))
    edges = edges.unionByName(_verified(files, firsts, pairs, rank, words, percent))
    files.drop("shared", "open")

    # A copy is a link to the first text, unless the text has no words.
    sizes = sized.groupBy(F.col("doc").alias("rep")).agg(F.max("n").cast("long").alias("n_shingles"))
    same_text = copies.join(sizes, "rep").where("n_shingles > 0")
    labels = components(edges.unionByName(same_text.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))))
    counts = sizes.withColumnRenamed("rep", "doc_id").unionByName(same_text.select("doc_id", "n_shingles"))
    counts = counts.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    return (ids.select("doc_id").distinct().join(counts, "doc_id", "left")
            .join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", F.coalesce("n_shingles", F.lit(0).cast("long")).alias("n_shingles"),
                    F.coalesce("component", "doc_id").alias("component_id")))


@query("op3_ngram_jaccard")
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
