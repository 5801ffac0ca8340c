"""N-gram Jaccard self-join by vertical partitioning.

A document's set is its distinct word n-grams as 64-bit hashes; the hash is also the global order, which is cut
into fragments (ranges). Fragments are worked on separately and only counts are summed:

1. *Which documents can have a partner at all?* Every fragment counts, per set, how many of its n-grams another set
   has too. A set with a link lacks at most a fifth of its n-grams in its partner, so after summing, a set that
   lacks more is done. The first half of the fragments is enough for this (the bound is on the number lacking).
   Tasks combine before the shuffle: an n-gram that many texts hold is sent once per chunk of texts.
2. *Candidates among the survivors*: each set's n-grams that another survivor holds, rarest first. The rest count
   as lacking, so some sets end here; two linked sets share one of the first n-grams, as many as may be lacking and
   one more. Rows of one n-gram are paired with a single pivot only.
3. *Partial overlaps*: for each candidate pair, each fragment's overlap is counted separately; the sums decide.
4. Components of the links so far; n-grams whose rows are not all in one component then pair the rest, across
   components only, so groups of near copies never give all their pairs.

Texts with equal sets are one set from the start. A pair's overlap counts equal 64-bit hashes.

Defined results: null text and texts without words have the empty set, which links with nothing; fewer words than
``n`` are one n-gram; rows that repeat a ``doc_id`` get the results of its texts taken together; rows with a null
``doc_id`` are left alone (their component is null); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytewords import byte_chunks, mix, word_hashes
from millrace.llm.common import load, query
from millrace.llm.components import components
from millrace.session import settle

N = 5
PERCENT = 80
FRAGMENT_NGRAMS = 2_000_000
OVERLAP_FRAGMENTS = 4
COUNT_BITS = 4
BUCKET_SETS = 200_000
_HALF = np.uint64(1 << 63)
_ODD = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def lacking(n, percent: int = PERCENT):
    """The most n-grams of a set of ``n`` that a linked set can lack: overlap >= t * union >= t * n."""
    return n - -(-n * percent // 100)


def ngram_sets(data: np.ndarray, offsets: np.ndarray, n: int = N) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    words, places = word_hashes(data, offsets)
    grams = np.zeros(len(words), np.uint64)
    if len(words) >= n:
        k = len(words) - n + 1
        for j in range(n):
            grams[:k] += words[j:j + k] * _ODD[j]
        grams[:k] = mix(grams[:k])
    found = []
    for a, b in zip(places[:-1].tolist(), places[1:].tolist()):
        if b - a >= n:
            own = np.sort(grams[a:b - n + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            found.append(own[keep])
        elif b > a:
            short = (words[a:b] * _ODD[:b - a]).sum(keepdims=True) + _ODD[63:] * np.uint64(b - a)
            found.append(mix(short))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def _tag(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _set_rows(n):
    """Per text: the size of its set and of the part in the order's first half, and a 128-bit name of the set as two numbers."""

    def work(batches):
        for batch in batches:
            sizes, halves, names = [], [], []
            for _, _, data, offsets in byte_chunks(batch.column(1)):
                for own in ngram_sets(data, offsets, n):
                    sizes.append(len(own))
                    halves.append(int(np.searchsorted(own, _HALF)))
                    names.append(_tag(own))
            pair = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(halves, pa.int64()), pa.array(pair[:, 0]), pa.array(pair[:, 1])],
                ["doc_id", "n", "half", "set_a", "set_b"],
            )

    return work


_PART = pa.schema([("fragment", pa.int32()), ("grams", pa.binary()), ("owner", pa.binary()), ("sets", pa.binary()), ("many", pa.binary())])


def _fragment_rows(n, fragments):
    """Per chunk of texts and fragment of the order's first half: n-grams (32 bits within the fragment) and their sets.

    An n-gram of several sets of the chunk goes out once, marked; what it counts for these sets is sent as counts
    (fragment rows with ``owner`` empty).
    """

    def work(batches):
        chunk_no = 0
        for batch in batches:
            for _, _, data, offsets in byte_chunks(batch.column(1)):
                own = {}
                for s in ngram_sets(data, offsets, n):
                    if len(s):
                        own.setdefault(_tag(s), s)
                if not own:
                    continue
                chunk_no += 1
                tags = np.frombuffer(b"".join(own), np.int64)[::2].copy()
                low = [s[:np.searchsorted(s, _HALF)] for s in own.values()]
                of = np.repeat(np.arange(len(low), dtype=np.int32), [len(s) for s in low])
                grams = np.concatenate(low)
                order = np.argsort(grams, kind="stable")
                grams, of = grams[order], of[order]
                if not len(grams):
                    continue
                same = grams[1:] == grams[:-1]
                many = np.zeros(len(grams), bool)
                many[1:] |= same
                many[:-1] |= same
                local = np.bincount(of[many], minlength=len(tags))
                first = np.ones(len(grams), bool)
                first[1:] = ~same
                grams, of, many = grams[first], of[first], many[first]
                # The order's first half, cut into equal ranges.
                width = (1 << 63) // fragments + 1
                place = grams // np.uint64(width)
                within = ((grams - place * np.uint64(width)) // np.uint64(max(1, -(-width // (1 << 32))))).astype(np.uint32)
                cuts = np.searchsorted(place, np.arange(fragments + 1, dtype=np.uint64))
                rows = []
                for f in np.flatnonzero(np.diff(cuts)).tolist():
                    a, b = cuts[f], cuts[f + 1]
                    used, back = np.unique(of[a:b], return_inverse=True)
                    rows.append((f, within[a:b].tobytes(), back.astype(np.uint32).tobytes(), tags[used].tobytes(), np.packbits(many[a:b]).tobytes()))
                seen = np.flatnonzero(local)
                if len(seen):
                    rows.append((int(tags[0]) % fragments, local[seen].astype(np.int64).tobytes(), b"", tags[seen].tobytes(), b""))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), _PART.types)], schema=_PART
                )

    return work


def _shared_counts(buckets):
    """One fragment: for each set, how many of its n-grams another set holds too (never too few).

    Counts leave in packed rows, one per bucket of sets, so that there are no more rows than fragments times buckets.
    """

    def work(table: pa.Table) -> pa.Table:
        sets, counts = _count_shared(table)
        bucket = (mix(sets.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sets, counts, bucket = sets[order], counts[order], bucket[order]
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        used = np.flatnonzero(np.diff(cuts)).tolist()
        return pa.table({
            "bucket": pa.array(used, pa.int32()),
            "sets": pa.array([sets[cuts[k]:cuts[k + 1]].tobytes() for k in used], pa.binary()),
            "counts": pa.array([counts[cuts[k]:cuts[k + 1]].astype(np.int32).tobytes() for k in used], pa.binary()),
        })

    return work


def _sum_counts(table: pa.Table) -> pa.Table:
    """One bucket of sets: the sums over all fragments."""
    sets = np.frombuffer(b"".join(table.column("sets").to_pylist()), np.int64)
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.int32)
    named, place = np.unique(sets, return_inverse=True)
    return pa.table({"set_a": pa.array(named), "shared": pa.array(np.bincount(place, counts, len(named)).astype(np.int64))})


def _count_shared(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    grams, sets, many, out_sets, out_counts = [], [], [], [], []
    for g, o, s, m in zip(*(table.column(c).to_pylist() for c in ("grams", "owner", "sets", "many"))):
        named = np.frombuffer(s, np.int64)
        if not o:
            out_sets.append(named)
            out_counts.append(np.frombuffer(g, np.int64))
            continue
        g = np.frombuffer(g, np.uint32)
        grams.append(g)
        sets.append(named[np.frombuffer(o, np.uint32)])
        many.append(np.unpackbits(np.frombuffer(m, np.uint8), count=len(g)).astype(bool))
    if grams:
        grams, sets, many = np.concatenate(grams), np.concatenate(sets), np.concatenate(many)
        order = np.argsort(grams, kind="stable")
        grams, sets, many = grams[order], sets[order], many[order]
        starts = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
        shared = np.maximum.reduceat(sets, starts) != np.minimum.reduceat(sets, starts)
        shared |= np.logical_or.reduceat(many, starts)
        shared = np.repeat(shared, np.diff(np.r_[starts, len(grams)])) & ~many
        pairs = np.unique(np.stack([sets[shared], grams[shared].astype(np.int64)], 1), axis=0) if shared.any() else np.zeros((0, 2), np.int64)
        found, counts = np.unique(pairs[:, 0], return_counts=True)
        out_sets.append(found)
        out_counts.append(counts.astype(np.int64))
    if not out_sets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    named, place = np.unique(np.concatenate(out_sets), return_inverse=True)
    return named, np.bincount(place, np.concatenate(out_counts), len(named)).astype(np.int64)


def _overlap_rows(n):
    """Per wanted set and fragment (of a fixed number) its n-grams, with the size of the set."""

    def work(batches):
        for batch in batches:
            nodes, wanted = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, _, data, offsets in byte_chunks(batch.column(2)):
                rows = []
                for k, own in enumerate(ngram_sets(data, offsets, n)):
                    if wanted[i + k] != int.from_bytes(_tag(own)[:8], "little", signed=True):
                        continue
                    place = (own >> np.uint64(62)).astype(np.int64)
                    cuts = np.searchsorted(place, np.arange(OVERLAP_FRAGMENTS + 1))
                    for f in np.flatnonzero(np.diff(cuts)).tolist():
                        rows.append((nodes[i + k], len(own), f, own[cuts[f]:cuts[f + 1]].view(np.int64)))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())))],
                        ["id", "n", "fragment", "grams"],
                    )

    return work


def _linked(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that link: partial overlaps per fragment, summed per pair."""
    left = parts.select(F.col("id").alias("a"), F.col("n").alias("n_a"), "fragment", F.col("grams").alias("grams_a"))
    right = parts.select(F.col("id").alias("b"), F.col("n").alias("n_b"), "fragment", F.col("grams").alias("grams_b"))
    # Always by shuffle: both sides grow with the input.
    partial = pairs.select("a", "b").hint("merge").join(right, "b").hint("merge").join(left, ["a", "fragment"]).select(
        "a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).alias("overlap")
    )
    summed = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    return summed.filter((100 + percent) * F.col("overlap") >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _may_link(x: str, y: str, percent: int):
    """Whether two rows of one n-gram can belong to linked sets, by size and by their places in the order."""
    n_x, n_y = F.col(f"{x}.n"), F.col(f"{y}.n")
    most = F.least(f"{x}.place", f"{y}.place") + F.least(
        F.col(f"{x}.m") - F.col(f"{x}.place"), F.col(f"{y}.m") - F.col(f"{y}.place")
    )
    # In each fragment they share no more than the fewer of what either shares with anybody.
    within = F.aggregate(
        F.zip_with(F.col(f"{x}.by_part"), F.col(f"{y}.by_part"), lambda a, b: F.least(a, b)), F.lit(0), lambda s, v: s + v
    )
    return (
        (100 * F.least(n_x, n_y) >= percent * F.greatest(n_x, n_y)) & ((100 + percent) * most >= percent * (n_x + n_y))
        & ((100 + percent) * within >= percent * (n_x + n_y))
    )


def _prefixes(parts: DataFrame, percent: int) -> DataFrame:
    """``(gram, id, n, m, by_part, place)``: each set's rarest n-grams among the ``m`` that other sets hold, too.

    ``by_part`` counts the m by fragment of the order, of ``2 ** COUNT_BITS`` equal ones.
    """
    rows = parts.select("id", "n", F.explode("grams").alias("gram"))
    shared = settle(rows.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1"), "shared")
    known = rows.join(shared, "gram").groupBy("id", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("order")
    ).withColumn("m", F.size("order")).withColumn(
        "_parts", F.transform("order", lambda e: F.shiftrightunsigned(e["gram"], 64 - COUNT_BITS).cast("int"))
    ).withColumn("by_part", F.transform(
        F.sequence(F.lit(0), F.lit((1 << COUNT_BITS) - 1)), lambda f: F.size(F.filter("_parts", lambda p: p == f))
    ))
    # A partner holds at least `needed` of the m; so it holds one of any m - needed + 1.
    needed = F.ceil(F.col("n") * percent / 100)
    return (
        known.filter(F.col("m") >= needed)
        .withColumn("prefix", F.slice("order", F.lit(1), (F.col("m") - needed + 1).cast("int")))
        .select("id", "n", "m", "by_part", F.posexplode("prefix").alias("place", "e"))
        .select(F.col("e.gram").alias("gram"), "id", "n", "m", "by_part", "place")
    )


def _pivot_pairs(prefixes: DataFrame, percent: int) -> DataFrame:
    """Each row of an n-gram with the n-gram's pivot: the set that lacks the fewest n-grams of its own elsewhere.

    In a group of modified copies that is the least modified one, to which all others are nearest.
    """
    best = F.min(F.struct((F.col("n") - F.col("m")).alias("lack"), "id", "n", "m", "by_part", "place"))
    pivots = prefixes.groupBy("gram").agg(best.alias("p"), F.count("*").alias("rows"))
    pivots = settle(pivots.filter("rows > 1").select("gram", "p.*"), "pivots").alias("x")
    met = pivots.join(prefixes.alias("y"), "gram").filter("x.id != y.id").filter(_may_link("x", "y", percent))
    return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def _other_pairs(prefixes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs that share an n-gram and are not in one component yet."""
    known = prefixes.join(labels.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left").select(
        "gram", "id", "n", "m", "by_part", "place", F.coalesce("component", "id").alias("component")
    )
    known = settle(known, "known")
    mixed = known.groupBy("gram").agg(F.min("component").alias("main"), F.max("component").alias("top")).filter("main < top")
    rows = settle(known.join(mixed.select("gram", "main"), "gram"), "mixed")
    # One side without the n-gram's first component: its rows are in one component with each other.
    met = rows.filter("component > main").alias("x").join(rows.alias("y"), "gram").filter(
        "x.component != y.component AND (y.component = y.main OR x.id < y.id)"
    ).filter(_may_link("x", "y", percent))
    return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def similarity_components(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    sets = settle(texts.mapInArrow(_set_rows(n), "doc_id long, n long, half long, set_a long, set_b long"), "sets")
    filled = sets.filter("n > 0 AND doc_id IS NOT NULL")
    reps = settle(
        filled.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("half").alias("half"))
        .withColumn("id", F.monotonically_increasing_id()),
        "reps",
    )
    # 1. Sets of whose n-grams enough are held by another set, too.
    total = reps.agg(F.sum("half")).first()[0] or 0
    fragments = max(1, math.ceil(total / FRAGMENT_NGRAMS))
    parts = texts.mapInArrow(
        _fragment_rows(n, fragments), "fragment int, grams binary, owner binary, sets binary, many binary"
    )
    buckets = max(1, math.ceil(reps.count() / BUCKET_SETS))
    shared = (
        parts.groupBy("fragment").applyInArrow(_shared_counts(buckets), "bucket int, sets binary, counts binary")
        .groupBy("bucket").applyInArrow(_sum_counts, "set_a long, shared long")
    )
    # A set that shares nothing in the first half has no row there, but may lack as many as it has there.
    survivors = settle(
        reps.join(shared, "set_a", "left")
        .filter(F.coalesce("shared", F.lit(0)) >= F.col("half") - (F.col("n") - F.ceil(F.col("n") * percent / 100)))
        .select("rep", "set_a", "id"),
        "survivors",
    )
    # 2. Their n-grams, by fragment.
    theirs = (
        texts.join(survivors.hint("merge"), F.col("doc_id") == F.col("rep"))
        .select("doc_id", "id", "set_a", "text", F.xxhash64("text").alias("h"))
        .dropDuplicates(["doc_id", "id", "h"]).select("id", "set_a", "text")
    )
    grams = settle(theirs.mapInArrow(_overlap_rows(n), "id long, n long, fragment int, grams array<long>"), "grams")
    prefixes = settle(_prefixes(grams, percent), "prefixes")
    # 3. and 4. Links to pivots, then links across the components these give.
    tried = settle(_pivot_pairs(prefixes, percent), "pairs")
    links = settle(_linked(tried, grams, percent), "linked")
    labels = components(links)
    others = settle(_other_pairs(prefixes, labels, percent).join(tried, ["a", "b"], "left_anti"), "pairs")
    if not others.isEmpty():
        labels = components(settle(links.unionByName(_linked(others, grams, percent)), "linked"))
    placed = reps.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    names = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_set = settle(placed.join(names, "component").select("set_a", "set_b", "component_id"), "classes")
    found = filled.join(of_set, ["set_a", "set_b"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = sets.filter("n = 0 OR doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.unionByName(alone)


def keep_one_of_each(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document (the smallest id) of each component; columns as they were.

    Documents without words or id are alone and stay.
    """
    found = similarity_components(docs, n, percent)
    gone = found.filter("component_id != doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")


@query("op3_ngram_jaccard")
def op3_ngram_jaccard(spark, sf_dir):
    return similarity_components(load(spark, sf_dir, "documents"))
