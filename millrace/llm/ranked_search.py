"""Ranked lexical search by K2-treaps over shards of a term-document grid.

Building. Documents are gathered, within their partition, into shards of about ``SHARD_BYTES`` of text. A shard is a
grid: a row per term, frequent ones first, a column per document in order of ids, and in each cell a term's impact in
a document, which depends on both counts and on the average length over all documents (a first pass). The shard's
quadtree halves rows and columns at each step; empty quadrants have no node, one with a single posting is a leaf at
once, and every node stores its quadrant's greatest impact, as the difference from its parent's. Children stand side
by side in order of levels, so that pointers follow from the 4-bit masks by running sums and are not stored. Shards
are rows of a Parquet table in the shared folder: a lost executor's shards are read again. A task holds a shard or two
at a time, in row groups and Arrow batches of about ``BATCH_BYTES``, however many its file has.

Searching. Document frequencies are sums over the shards' rows. An item descends the paths of all its terms' rows
jointly over ranges of columns: a range's bound is the weighted sum of its nodes' maxima; ranges with the greatest
bounds are halved first, and those that cannot enter the item's best ``TOP`` any more are dropped. A range of one
column is a document with its exact score. A task goes on with what earlier shards have found, and hands on at most
``TOP`` documents an item; these are combined in two levels, so no task sees more than a share of the shards' rows.
Items are taken in blocks of about ``BLOCK_TERMS`` terms, chosen by hash; only a block is ever on the driver.

Terms are told apart by 64-bit hashes. Defined results: null or empty texts and those without a term are in no
result and count nowhere; rows that repeat an id are documents of their own; a null id ranks after all others of its
score; rows that repeat an item's id (null too) are one item with the terms of all of them; an item without a term,
or whose terms all weigh 0, has no rows; empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.bytewords import byte_chunks, word_hashes
from millrace.llm.common import load, query
from millrace.session import batches_within, new_folder, settle

TOP = 10
SHARD_BYTES = 4 << 20
SHARD_DOCS = 1 << 15
# Of an Arrow batch and a row group, which end with the row that reaches it; of text that is hashed at once.
BATCH_BYTES = 4 << 20
HASHED_BYTES = 1 << 19
BLOCK_TERMS = 1 << 20
# Ranges halved at once; bounds are looked at again after each round.
WIDTH = 128
BUCKETS = 64

# Bytes that end a term: ASCII other than letters and digits.
ENDS = np.zeros(256, bool)
ENDS[:128] = True
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    ENDS[ord(_first):ord(_last) + 1] = False

_MASK_BITS = np.array([bin(m).count("1") for m in range(16)], np.int8)
# Children that stand before quadrant q under mask m.
_BEFORE = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], np.int64)

SHARD = (
    "doc_ids array<bigint>, terms binary, frequencies binary, side int, masks binary, maxima binary, leaf_rows binary, leaf_columns binary"
)


def terms_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, term hashes, each text's place in them)`` for runs of texts."""
    for i, j, data, offsets in byte_chunks(column, HASHED_BYTES):
        yield i, j, *word_hashes(data, offsets, ENDS)


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def impacts(tf: np.ndarray, length: np.ndarray, documents: int, total: int) -> np.ndarray:
    m = 10 + 90 * length * documents // total
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of 32-bit numbers, each moved to twice its place."""
    x = x.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)
    ):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


# --- one shard --------------------------------------------------------------------------------------------------


class Treap:
    """The quadtree over postings ``(row, column, impact)``; node 0 is the root, a mask of 0 says leaf."""

    def __init__(self, side: int, masks: np.ndarray, maxima: np.ndarray, rows: np.ndarray, columns: np.ndarray):
        self.side, self.masks, self.rows, self.columns = side, masks, rows, columns
        counts = _MASK_BITS[masks]
        leaf = masks == 0
        # The first child of a node; of a leaf, its place among leaves.
        self.first = np.cumsum(counts, dtype=np.int32)
        self.first -= counts
        self.first += 1
        self.first[leaf] = np.arange(np.count_nonzero(leaf), dtype=np.int32)
        self.maxima = maxima

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, impact: np.ndarray) -> Treap:
        """Built level by level from the root; at least one posting."""
        side = max(int(rows.max()), int(columns.max())).bit_length()
        codes = (_spread(rows) << np.uint64(1)) | _spread(columns)
        order = np.argsort(codes)
        codes, impact = codes[order], impact[order]
        masks, maxima, leaves = [], [np.array([impact.max()])], []
        points, parent = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        if len(codes) == 1:
            masks, leaves, points = [np.zeros(1, np.uint8)], [points], points[:0]
        else:
            nodes = 1
        level = side
        while len(points):
            # The quadrants of this level's inner nodes, in order; all their postings are still among ``points``.
            level -= 1
            quadrant = codes[points] >> np.uint64(2 * level)
            starts = np.flatnonzero(np.append(True, quadrant[1:] != quadrant[:-1]))
            sizes = np.diff(np.append(starts, len(points)))
            bits = 1 << (quadrant[starts] & np.uint64(3)).astype(np.int64)
            masks.append(np.bincount(parent[starts], bits, nodes).astype(np.uint8))
            maxima.append(np.maximum.reduceat(impact[points], starts))
            inner = (sizes > 1) if level else np.zeros(len(sizes), bool)
            leaves.append(np.where(inner, -1, points[starts]))
            nodes = int(inner.sum())
            kept = np.repeat(inner, sizes)
            parent = np.repeat(np.cumsum(inner) - 1, sizes)[kept]
            points = points[kept]
        return cls._woven(side, masks, maxima, leaves, rows[order], columns[order])

    @classmethod
    def _woven(cls, side, masks, maxima, leaves, rows, columns) -> Treap:
        """Inner nodes' masks and leaves brought into the order of all nodes."""
        if len(masks[0]) == 1 and masks[0][0] == 0:
            return cls(side, masks[0], maxima[0], rows, columns)
        places = np.concatenate(leaves)
        every = np.zeros(1 + len(places), np.uint8)
        inner = np.append(True, places < 0)
        every[inner] = np.concatenate(masks)
        places = places[places >= 0]
        return cls(side, every, np.concatenate(maxima), rows[places], columns[places])

    def parents(self) -> np.ndarray:
        return np.repeat(np.flatnonzero(self.masks), _MASK_BITS[self.masks[self.masks > 0]])

    def search(self, rows: np.ndarray, weights: np.ndarray, ids: np.ndarray, best: list[tuple[int, int]], top: int) -> list[tuple[int, int]]:
        """``best`` with this shard's documents: at most ``top`` pairs ``(-score, id)``, in order.

        ``ids`` are the columns' ids, ascending. A range is a level, its first column, a bound, and a node (or -1)
        for each row.
        """
        width = max(1, min(WIDTH, (WIDTH << 8) // len(rows)))
        levels, columns = np.array([self.side]), np.zeros(1, np.int64)
        nodes = np.zeros((1, len(rows)), np.int64)
        if not self.masks[0]:
            nodes[0, self.rows[0] != rows] = -1
        bounds = self._bounds(nodes, weights)
        while True:
            if len(best) == top:
                least, last = -best[-1][0], best[-1][1]
                stay = bounds > least
                tied = np.flatnonzero(bounds == least)
                stay[tied] = (ids[columns[tied]] < last).astype(bool)
                levels, columns, bounds, nodes = levels[stay], columns[stay], bounds[stay], nodes[stay]
            if not len(bounds):
                return best
            single = levels == 0
            if single.any():
                found = zip((-bounds[single]).tolist(), ids[columns[single]].tolist())
                best = sorted([*best, *found])[:top]
                levels, columns, bounds, nodes = levels[~single], columns[~single], bounds[~single], nodes[~single]
                continue
            if len(bounds) > width:
                cut = np.argpartition(-bounds, width)
                now, later = cut[:width], cut[width:]
            else:
                now, later = np.arange(len(bounds)), np.zeros(0, np.int64)
            halves = self._halves(levels[now] - 1, columns[now], nodes[now], rows, weights, len(ids))
            levels, columns, bounds, nodes = (
                np.concatenate([old[later], *new]) for old, new in zip((levels, columns, bounds, nodes), zip(*halves))
            )

    def _bounds(self, nodes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return np.where(nodes < 0, 0, self.maxima[nodes]) @ weights

    def _halves(self, levels, columns, nodes, rows, weights, n_columns):
        """Both halves of ranges, ``levels`` being theirs; those without a document or a posting are left out."""
        masks, first = self.masks[nodes], self.first[nodes]
        leaf = (masks == 0) & (nodes >= 0)
        inner = (masks > 0) & (nodes >= 0)
        lower = (rows[None, :] >> levels[:, None]) & 1
        at = self.columns[np.where(leaf, first, 0)]
        for half in (0, 1):
            quadrant = 2 * lower + half
            child = np.where(inner & ((masks >> quadrant) & 1 == 1), first + _BEFORE[masks, quadrant], -1)
            # A child that is a leaf may be another row's.
            ends = (child >= 0) & (self.masks[child] == 0)
            child[ends & (self.rows[np.where(ends, self.first[child], 0)] != rows[None, :])] = -1
            child = np.where(leaf & ((at >> levels[:, None]) & 1 == half), nodes, child)
            start = columns + (half << levels)
            bounds = self._bounds(child, weights)
            held = (bounds > 0) & (start < n_columns)
            yield levels[held], start[held], bounds[held], child[held]


def _order(ids: pa.Array) -> np.ndarray:
    """Places of ids in ascending order, nulls last."""
    null = ids.is_null().to_numpy(zero_copy_only=False)
    return np.lexsort((ids.fill_null(0).to_numpy(), null))


def shard_of(ids: pa.Array, texts: pa.Array, documents: int, total: int) -> dict | None:
    """The row of ``SHARD`` for some documents; None where no text has a term."""
    hashes, lengths = [], []
    for _, _, h, places in terms_of(texts):
        hashes.append(h)
        lengths.append(np.diff(places))
    hashes, lengths = np.concatenate(hashes), np.concatenate(lengths)
    if not len(hashes):
        return None
    order = _order(ids)
    order = order[lengths[order] > 0]
    column = np.zeros(len(ids), np.int64)
    column[order] = np.arange(len(order))
    terms, of = np.unique(hashes, return_inverse=True)
    cells, tf = np.unique(np.repeat(column, lengths) * len(terms) + of, return_counts=True)
    columns, of = np.divmod(cells, len(terms))
    frequencies = np.bincount(of)
    by_frequency = np.argsort(-frequencies, kind="stable")
    row = np.empty(len(terms), np.int64)
    row[by_frequency] = np.arange(len(terms))
    impact = impacts(tf.astype(np.int64), lengths[order].astype(np.int64)[columns], documents, total)
    treap = Treap.of(row[of], columns, impact)
    maxima = treap.maxima.copy()
    maxima[1:] = treap.maxima[treap.parents()] - treap.maxima[1:]
    return {
        "doc_ids": ids.take(pa.array(order)), "terms": terms[by_frequency].tobytes(),
        "frequencies": frequencies[by_frequency].astype(np.int32).tobytes(), "side": treap.side, "masks": treap.masks.tobytes(),
        "maxima": maxima.astype(np.int32).tobytes(), "leaf_rows": treap.rows.astype(np.int32).tobytes(),
        "leaf_columns": treap.columns.astype(np.int32).tobytes(),
    }


def treap_of(row: dict) -> Treap:
    masks = np.frombuffer(row["masks"], np.uint8)
    maxima, rows, columns = (np.frombuffer(row[c], np.int32) for c in ("maxima", "leaf_rows", "leaf_columns"))
    maxima = maxima.copy()
    # From differences to maxima, level by level: a level's children are the next level.
    first, last = 0, 1
    while last < len(masks):
        above = np.repeat(maxima[first:last], _MASK_BITS[masks[first:last]])
        first, last = last, last + len(above)
        maxima[first:last] = above - maxima[first:last]
    return Treap(row["side"], masks, maxima, rows, columns)


# --- the index --------------------------------------------------------------------------------------------------


class Index:
    """A table of shards, the number of documents with a term, and that of their terms with repeats."""

    def __init__(self, shards: DataFrame, documents: int, total: int):
        self.shards, self.documents, self.total = shards, documents, total


def _counts(docs: DataFrame) -> tuple[int, int]:
    def count(batches):
        documents = total = 0
        for batch in batches:
            for _, _, data, offsets in byte_chunks(batch.column(0)):
                inside = ~ENDS[data]
                begun = np.zeros(len(data) + 1, bool)
                begun[1:] = inside
                begun[offsets] = False
                own = np.diff(np.append(0, np.cumsum(inside & ~begun[:-1]))[offsets])
                documents += int((own > 0).sum())
                total += int(own.sum())
        yield pa.RecordBatch.from_arrays([pa.array([documents]), pa.array([total])], ["documents", "total"])

    sums = docs.select(docs["text"].cast("string").alias("text")).mapInArrow(count, "documents bigint, total bigint")
    with batches_within(docs.sparkSession, BATCH_BYTES):
        found = sums.agg(F.sum("documents"), F.sum("total")).first()
    return found[0] or 0, found[1] or 0


# A shard's columns are looked at after each row, not after 100; no two of their values are alike.
_ROW_GROUPS = {
    "compression": "zstd", "parquet.block.size": str(BATCH_BYTES), "parquet.page.size.row.check.min": "1",
    "parquet.block.size.row.check.min": "1", "parquet.enable.dictionary": "false",
}


def build(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> Index:
    """Index all rows of ``docs (doc_id, text)``; the shards are written to the shared folder."""
    documents, total = _counts(docs)
    fields = pa.schema(
        [("doc_ids", pa.list_(pa.int64())), ("terms", pa.binary()), ("frequencies", pa.binary()), ("side", pa.int32())]
        + [(c, pa.binary()) for c in ("masks", "maxima", "leaf_rows", "leaf_columns")]
    )

    def flush(held):
        table = pa.Table.from_batches(held).combine_chunks()
        row = shard_of(table.column(0).combine_chunks(), table.column(1).combine_chunks(), documents, total)
        if row is not None:
            lists = pa.ListArray.from_arrays(pa.array([0, len(row["doc_ids"])], pa.int32()), row.pop("doc_ids"))
            yield pa.RecordBatch.from_arrays([lists, *[pa.array([v], fields.field(c).type) for c, v in row.items()]], schema=fields)

    def work(batches):
        held, size, n = [], 0, 0
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1).fill_null("").cast(pa.large_string())], ["doc_id", "text"]
            )
            for i, j, data, _ in byte_chunks(batch.column(1)):
                held.append(batch.slice(i, j - i))
                size, n = size + len(data), n + j - i
                if size >= shard_bytes or n >= SHARD_DOCS:
                    yield from flush(held)
                    held, size, n = [], 0, 0
        if held:
            yield from flush(held)

    shards = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(work, SHARD)
    folder = new_folder(docs.sparkSession, "treaps")
    with batches_within(docs.sparkSession, BATCH_BYTES):
        shards.write.options(**_ROW_GROUPS).parquet(folder)
    return Index(docs.sparkSession.read.schema(SHARD).parquet(folder), documents, total)


def _item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term)``: each item's distinct terms."""

    def work(batches):
        for batch in batches:
            for i, j, hashes, places in terms_of(batch.column(1)):
                at = np.repeat(np.arange(i, j), np.diff(places))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(hashes.view(np.int64))], ["item_id", "term"])

    kind = items.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("term", T.LongType())])
    return items.select(items["item_id"].alias("item_id"), items["text"].cast("string").alias("text")).mapInArrow(work, schema).distinct()


def _frequencies(index: Index, wanted: np.ndarray) -> dict[int, int]:
    """Documents that hold each of these terms, over all shards; terms in none are left out."""
    shared = index.shards.sparkSession.sparkContext.broadcast(np.sort(wanted))  # a block's terms

    def work(batches):
        for batch in batches:
            for terms, frequencies in zip(batch.column(0), batch.column(1)):
                terms = np.frombuffer(terms.as_buffer(), np.uint64).view(np.int64)
                held = np.isin(terms, shared.value)
                own = np.frombuffer(frequencies.as_buffer(), np.int32)[held].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(terms[held]), pa.array(own)], ["term", "n"])

    sums = index.shards.select("terms", "frequencies").mapInArrow(work, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    with batches_within(index.shards.sparkSession, BATCH_BYTES):
        return {r["term"]: r["n"] for r in sums.collect()}


def _block(index: Index, rows: list, top: int) -> DataFrame:
    """``(item, rank, doc_id, score)`` for the items of one block, by their places in it."""
    of: dict = {}
    for item_id, term in rows:
        of.setdefault(item_id, []).append(term)
    frequency = _frequencies(index, np.array([term for _, term in rows], np.int64))
    items = []
    for terms in of.values():
        weights = [(t, weight(index.documents, frequency[t])) for t in sorted(terms) if t in frequency]
        kept = np.array([(t, w) for t, w in weights if w > 0], np.int64).reshape(-1, 2)
        items.append((kept[:, 0].view(np.uint64), kept[:, 1]))
    shared = index.shards.sparkSession.sparkContext.broadcast(items)  # a block's terms and weights

    def work(batches):
        best: list[list[tuple[int, float]]] = [[] for _ in shared.value]
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at] for c in batch.schema.names}
                row = {c: v.as_buffer() if isinstance(v, pa.BinaryScalar) else v.as_py() for c, v in row.items()}
                treap = treap_of(row)
                # A null id ranks last: above every id, as a float that no id reaches.
                ids = np.array([math.inf if i is None else i for i in row["doc_ids"]], object)
                terms = np.frombuffer(row["terms"], np.uint64)
                by_hash = np.argsort(terms)
                for k, (wanted, weights) in enumerate(shared.value):
                    place = by_hash[np.minimum(np.searchsorted(terms, wanted, sorter=by_hash), len(terms) - 1)]
                    held = terms[place] == wanted
                    if held.any():
                        best[k] = treap.search(place[held], weights[held], ids, best[k], top)
        out = [(k, None if i == math.inf else i, -s) for k, own in enumerate(best) for s, i in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*out) if out else ([], [], []), (pa.int32(), pa.int64(), pa.int64()))],
            ["item", "doc_id", "score"],
        )

    found = index.shards.mapInArrow(work, "item int, doc_id bigint, score bigint")
    # Written out: what follows looks at a few rows of each task.
    with batches_within(index.shards.sparkSession, BATCH_BYTES):
        found = settle(found.withColumn("bucket", F.spark_partition_id() % BUCKETS), "found")
    for keys in (["item", "bucket"], ["item"]):
        ranked = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    names = index.shards.sparkSession.createDataFrame(
        [(k, item_id) for k, item_id in enumerate(of)], T.StructType([T.StructField("item", T.IntegerType()), _ITEM_ID])
    )
    return found.join(names, "item").select("item_id", "rank", "doc_id", "score")


_ITEM_ID = T.StructField("item_id", T.LongType())


def search(index: Index, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``top`` highest-scoring documents of the index."""
    terms = settle(_item_terms(items.select(items["item_id"].cast("bigint").alias("item_id"), "text")), "items")
    blocks = max(1, -(-terms.count() // block_terms))
    found = []
    for b in range(blocks):
        rows = terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        if rows:
            found.append(_block(index, [(r["item_id"], r["term"]) for r in rows], top))
    if not found:
        return items.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


@query(
    "op13_ranked_search",
    r"""
    WITH held AS (
        SELECT doc_id, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM documents
    ), tf AS (
        SELECT doc_id, term, count(*) AS tf FROM held GROUP BY ALL
    ), sizes AS (
        SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id
    ), totals AS (
        SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes
    ), weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM tf, totals GROUP BY term
    ), wanted AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ), scored AS (
        SELECT item_id, doc_id,
               CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
        FROM wanted JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals
        GROUP BY item_id, doc_id
    ), ranked AS (
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place, doc_id, score
        FROM scored WHERE score > 0
    )
    SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
    """,
)
def op13_ranked_search(spark, sf_dir):
    return search(build(load(spark, sf_dir, "documents")), load(spark, sf_dir, "benchmark"))
