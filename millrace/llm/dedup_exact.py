"""Exact deduplication over an extendible-hash index on shared files.

Every text has a 64-bit key. The index holds one entry per key; a directory that doubles until no bucket is
overfull assigns key ranges (hash prefixes) to buckets, and the task that owns a bucket writes its entries to
the shared folder. Rows with a common key are a chain: their bytes are compared with the chain's head, and rows
that differ start a further link, so equal keys alone never make two texts equal.

A group of copies is one entry per task before the first shuffle, and the comparison is a join of rows with
their heads whose row side AQE splits, so a text that makes up a third of all rows is no task of its own.

Defined results: null text counts as empty, and all empty texts are one group; rows that repeat a ``doc_id``
are rows of their own, one of which may stay; a null ``doc_id`` is the smallest; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import load, query, text_of
from millrace.session import settle

BUCKET_CAPACITY = 4096


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def _prefix(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def build_directory(keys: DataFrame, capacity: int = BUCKET_CAPACITY) -> tuple[DataFrame, int]:
    """``(slot, local_depth)`` and the global depth, for distinct 64-bit ``key`` values.

    The directory starts with as many slots as the mean load asks for and doubles while a bucket holds more than
    ``capacity`` keys; only overfull buckets get a new local depth. It stays a DataFrame, since it grows with the
    number of keys.
    """
    n = keys.count()
    depth = max(0, math.ceil(math.log2(max(n, 1) / capacity)))
    buckets = settle(
        keys.groupBy(_prefix(F.col("key"), depth).alias("bucket")).agg(F.count("*").alias("n"))
        .withColumn("local_depth", F.lit(depth)),
        "directory",
    )
    while depth < 48 and not buckets.filter(F.col("n") > capacity).isEmpty():
        # Double: overfull buckets, all of which have the global depth, split by one more bit; the others are
        # reached from twice as many slots.
        over = buckets.filter(F.col("n") > capacity).select(F.col("bucket").alias("parent"))
        halves = (
            keys.select(_prefix(F.col("key"), depth + 1).alias("bucket"), _prefix(F.col("key"), depth).alias("parent"))
            .join(over, "parent", "left_semi").groupBy("bucket").agg(F.count("*").alias("n"))
        )
        rest = buckets.filter(F.col("n") <= capacity)
        depth += 1
        buckets = settle(rest.unionByName(halves.withColumn("local_depth", F.lit(depth))), "directory")
    # A bucket of local depth d owns 2^(depth - d) consecutive slots, i.e. one key range.
    span = F.expr(f"shiftleft(1L, {depth} - local_depth)")
    slots = buckets.select(
        F.explode(F.sequence(F.col("bucket") * span, F.col("bucket") * span + span - 1)).alias("slot"), "local_depth"
    )
    return slots, depth


def build_index(entries: DataFrame, capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """One entry per key on shared files: ``(key, head, n, bucket)``; ``head`` is the last row of the chain."""
    chains = settle(
        entries.groupBy("key").agg(F.max(F.struct("doc_id", "row")).alias("head"), F.count("*").alias("n")), "chains"
    )
    slots, depth = build_directory(chains.select("key"), capacity)
    # The first slot of its range names a bucket.
    placed = chains.withColumn("slot", _prefix(F.col("key"), depth)).join(slots, "slot").withColumn(
        "bucket", F.expr(f"shiftleft(shiftrightunsigned(slot, {depth} - local_depth), {depth} - local_depth)")
    ).drop("local_depth")
    return settle(placed.repartition("bucket").sortWithinPartitions("bucket", "key").drop("slot"), "index")


def exact_groups(
    docs: DataFrame, key: Callable[[Column], Column] = text_key, capacity: int = BUCKET_CAPACITY
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256, text_key, chain)``, one row per row of ``docs``."""
    text = text_of(docs)
    entries = settle(
        docs.select(
            F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("doc_id"),
            key(text).alias("key"), F.sha2(text, 256).alias("text_sha256"),
        ),
        "entries",
    )
    index = build_index(entries, capacity)
    chained = index.filter("n > 1")
    # Only rows whose key has company carry their text on. Equal ids with equal keys differ in text alone.
    members = settle(
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), key(text).alias("key"), text.alias("text"))
        .join(chained.select("key", F.col("head.doc_id").alias("head_id")), "key"),
        "members",
    )
    rest, chain, later = members, 0, None
    while True:
        # Settled, so that the comparison is a plain join whose row side can be split.
        heads = settle(_heads(rest, chain == 0), "heads")
        compared = rest.select("key", "doc_id", "text").join(heads, "key")
        differ = compared.filter(F.col("text") != F.col("head_text"))
        rest = settle(differ.select("key", "doc_id", "text"), "chain")
        if rest.isEmpty():
            break
        chain += 1
        found = rest.select("key", F.sha2("text", 256).alias("text_sha256")).distinct()
        later = found if later is None else later.unionByName(found)
    if later is None:
        return _result(entries.join(index.select("key", "head", "n"), "key").withColumn("chain", F.lit(0)))
    # Some keys hold several texts: their links are told apart by their bytes, here by their digest.
    split = settle(entries.join(later.select("key").distinct(), "key", "left_semi"), "split")
    links = split.groupBy("key", "text_sha256").agg(F.max(F.struct("doc_id", "row")).alias("head"), F.count("*").alias("n"))
    number = F.row_number().over(_by_key())
    plain = entries.join(later.select("key").distinct(), "key", "left_anti").join(index.select("key", "head", "n"), "key")
    return _result(
        plain.withColumn("chain", F.lit(0)).unionByName(
            split.join(links.withColumn("chain", number - 1), ["key", "text_sha256"])
        )
    )


def _by_key():
    from pyspark.sql import Window

    return Window.partitionBy("key").orderBy("text_sha256")


def _heads(rest: DataFrame, first: bool) -> DataFrame:
    """``(key, head_text)``: the text every remaining row of a key is compared with."""
    own = rest.filter(F.col("doc_id").eqNullSafe(F.col("head_id"))) if first else rest
    return own.groupBy("key").agg(F.max("text").alias("head_text"))


def _result(joined: DataFrame) -> DataFrame:
    return joined.select(
        "doc_id", F.col("head.doc_id").alias("keep_id"), F.col("n").cast("long").alias("group_size"),
        (F.col("row") == F.col("head.row")).alias("kept"), "text_sha256", F.col("key").alias("text_key"), "chain",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text another, kept row has; columns as they were."""
    names = docs.columns
    groups = settle(exact_groups(docs), "groups")
    kept = groups.filter("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("text_key").alias("_kept_key"), F.col("text_sha256").alias("_kept_sha")
    )
    text = text_of(docs)
    same = (
        (text_key(text) == kept["_kept_key"]) & docs["doc_id"].cast("long").eqNullSafe(kept["_kept_id"])
        & (F.sha2(text, 256) == kept["_kept_sha"])
    )
    joined = docs.join(kept, same)
    # Rows that repeat the kept row's id and text would all come through.
    if not groups.filter("NOT kept AND doc_id <=> keep_id").isEmpty():
        joined = joined.dropDuplicates(["_kept_id", "_kept_key", "_kept_sha"])
    return joined.select(*[docs[f"`{c}`"] for c in names])


@query(
    "op5_exact_dedup",
    """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
         g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
    FROM d JOIN g USING (text)
    """,
)
def op5_exact_dedup(spark, sf_dir):
    return exact_groups(load(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )
