"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words. As many whole copies of all its documents as fit below it are certain. The words
left are drawn with inclusion probabilities ``p`` in proportion to a document's importance (by default the binary
digits of its size, so that longer texts are likelier): a document whose share is 1 or more is certain, too, and the
others share what it leaves, which sums over a source's distinct importances settle without iterating. The rest is
ranked by ``(u / (1 - u)) / (p / (1 - p))`` with ``u`` a random number that the id fixes, and the first ones are taken
until the source's remaining words are reached. The size of the sample is thus fixed in words, and misses its target
by half of the document at the cut at most.

The cut needs no sorted source: two rounds of 4,096 bins of the rank, summed map-side, narrow it to the rows of one
bin in 2^24, so a source with a third of all rows is summed by all tasks.

Defined results: null text has size 0; a null source is a source of its own, the last one; a source without words
has target 0; rows that repeat a ``doc_id`` share ``u``, and with equal importance are taken together or not at all;
with a null ``doc_id`` it is that of the text ``null``; importances are rounded down and kept within 1 and 1,024, null
counts as 1; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, load, query, text_of
from millrace.session import settle

BIN_BITS = 12
RANK_BITS = 36
MAX_COPIES = 3
MAX_IMPORTANCE = 1024
MAX_P = 0.999999999999
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, max_copies: int = MAX_COPIES, cycle: int = 3) -> DataFrame:
    """``(source, source_size, target)``: weights 1, 2, … ``cycle`` in order of the sources.

    A target stops at ``max_copies`` times its source. Sources stop in the order of size by weight, so one running
    sum over the sources (a table of a row each) finds those that do, without iterating.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = totals.withColumn("w", ((F.row_number().over(order) - 1) % cycle + 1).cast("long"))
    # UTF-8 text compares by code point in Spark, which is the order asked for.
    by_fill = Window.orderBy(
        (F.col("source_size") / F.col("w")).asc(), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    before = weighted.select(
        "*", F.sum("source_size").over(whole).alias("total"), F.sum("w").over(whole).alias("all_w"),
        F.coalesce(F.sum("source_size").over(by_fill), F.lit(0)).alias("s_before"),
        F.coalesce(F.sum("w").over(by_fill), F.lit(0)).alias("w_before"),
    )
    left = F.col("total") - max_copies * F.col("s_before")
    # Stopped if its fair share of what those before it leave is more than its most.
    stopped = left * F.col("w") >= max_copies * F.col("source_size") * (F.col("all_w") - F.col("w_before"))
    marked = before.withColumn("stopped", stopped)
    free_w = F.sum(F.when(~F.col("stopped"), F.col("w"))).over(whole)
    free_words = F.col("total") - max_copies * F.coalesce(
        F.sum(F.when(F.col("stopped"), F.col("source_size"))).over(whole), F.lit(0)
    )
    target = F.when(F.col("stopped"), (max_copies * F.col("source_size")).cast("double")).otherwise(
        (free_words * F.col("w")).cast("double") / free_w
    )
    return marked.select("source", "source_size", target.alias("target"))


def pareto_rank(doc_id: Column, p: Column, typical: Column, seed: str = SEED) -> Column:
    """Random odds over inclusion odds, as a whole number below 2^36 in the same order; null where ``p`` is 0.

    ``typical`` is a probability that is the same for the whole source: it only spreads the ranks evenly.
    """
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 9)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << RANK_BITS)
    q = (u / (1 - u)) / (p / (1 - p)) * (typical / (1 - typical))
    top = (1 << RANK_BITS) - 1
    return F.when(p > 0, F.least(F.floor(q / (1 + q) * float(1 << RANK_BITS)), F.lit(top)).cast("long"))


def _with_source(rows: DataFrame, per_source: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with their source's values; the table of sources is small, its size known, and null is a source."""
    other = per_source.withColumnRenamed("source", "_source")
    return rows.join(other, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _narrow(rows: DataFrame, cuts: DataFrame, bin_of: Column, name: str) -> DataFrame:
    """Narrow each source's cut to one bin: adds ``name``, the bin, and brings ``base``, the words before it, up to date."""
    bins = rows.groupBy("source", bin_of.alias("bin")).agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(
        Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ends = _with_source(bins.withColumn("upto", upto), cuts.select("source", "rest", "base")).withColumn(
        "upto", F.col("upto") + F.col("base")
    )
    # Bins that end at or below the target are wholly taken; the cut lies in the first that does not.
    full = F.col("upto") <= F.col("rest")
    found = ends.groupBy("source").agg(
        F.max(F.when(full, F.col("upto"))).alias("below"), F.min(F.when(~full, F.col("bin"))).alias(name)
    )
    return settle(
        _with_source(cuts, found, "left").withColumns({
            "base": F.coalesce("below", "base"), name: F.coalesce(name, F.lit(1 << BIN_BITS).cast("long")),
        }).drop("below"),
        "cuts",
    )


def inclusion(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, least, odds)``: the importance from which on a document is certain, and ``p`` per unit of importance below.

    With R words to draw and weights w over sizes s, ``p = min(1, c * w)`` and ``sum(s * p) = R``. By falling
    importance a class is certain if R less the words above it, times its w, is at least the sum of s * w from it on.
    """
    classes = _with_source(
        sizes.groupBy("source", "importance").agg(F.sum("size").alias("words")), targets.select("source", "rest")
    )
    falling = Window.partitionBy("source").orderBy(F.desc("importance"))
    above = F.coalesce(F.sum("words").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    from_it = F.sum(F.col("words") * F.col("importance")).over(falling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    marked = classes.withColumn(
        "certain", (F.col("rest") > 0) & ((F.col("rest") - above) * F.col("importance") >= from_it)
    )
    open_weight = F.sum(F.when(~F.col("certain"), F.col("words") * F.col("importance")))
    left = F.max("rest") - F.coalesce(F.sum(F.when(F.col("certain"), F.col("words"))), F.lit(0))
    return marked.groupBy("source").agg(
        F.min(F.when(F.col("certain"), F.col("importance"))).alias("least"), left.alias("left"), open_weight.alias("open_weight"),
    ).select("source", "least", F.when(F.col("open_weight") > 0, F.col("left") / F.col("open_weight")).alias("odds"))


def mix_plan(
    docs: DataFrame, max_copies: int = MAX_COPIES, seed: str = SEED, importance: Column | None = None
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)``, one row per row of ``docs``.

    ``importance`` (whole numbers from 1 to 1,024) makes inclusion unequal within a source; ``F.lit(1)`` makes it
    equal, None takes the binary digits of the size.
    """
    size = word_count(text_of(docs))
    given = F.length(F.bin(size)) if importance is None else F.coalesce(importance, F.lit(1))
    kept = F.least(F.greatest(given.cast("long"), F.lit(1)), F.lit(MAX_IMPORTANCE)).cast("long")
    sizes = settle(docs.select("doc_id", "source", size.alias("size"), kept.alias("importance")), "sizes")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor("ratio").cast("long")
    targets = source_targets(sizes.select("source", "size"), max_copies).select(
        "source", "source_size", "target", ratio.alias("ratio")
    ).withColumn("rest", F.col("target") - whole * F.col("source_size"))
    targets = settle(targets, "targets")
    drawn = settle(_with_source(targets, inclusion(sizes, targets)), "drawn")
    certain_too = F.coalesce(F.col("importance") >= F.col("least"), F.lit(False))
    p = F.when(certain_too, F.lit(0.0)).otherwise(F.least(F.col("odds") * F.col("importance"), F.lit(MAX_P)))
    rank = pareto_rank(F.col("doc_id"), F.col("p"), F.greatest(F.lit(1e-9), F.col("ratio") - F.floor("ratio")), seed)
    ranked = settle(
        _with_source(sizes, drawn).withColumn("p", p)
        .select("doc_id", "source", "size", (whole + certain_too.cast("long")).alias("whole"), rank.alias("rank")),
        "ranked",
    )
    certain = ranked.groupBy("source").agg(F.sum(F.col("whole") * F.col("size")).alias("certain"))
    cuts = _with_source(targets, certain).select(
        "source", (F.col("target") - F.col("certain")).alias("rest"), F.lit(0).cast("long").alias("base")
    )
    open_rows = ranked.filter(F.col("rank").isNotNull())
    first = F.shiftright("rank", RANK_BITS - BIN_BITS)
    second = F.shiftright("rank", RANK_BITS - 2 * BIN_BITS).bitwiseAND((1 << BIN_BITS) - 1)
    cuts = _narrow(open_rows, cuts, first, "bin1")
    cuts = _narrow(_with_source(open_rows, cuts.select("source", "bin1")).filter(first == F.col("bin1")), cuts, second, "bin2")
    # The cut's own cell, a 2^24th of a source, is ordered exactly.
    in_cell = (first == F.col("bin1")) & (second == F.col("bin2"))
    cell = _with_source(open_rows, cuts).filter(in_cell)
    # Rows that repeat an id are one item of the cell, however many they are.
    cell = cell.groupBy("source", "rank", "doc_id", "base", "rest").agg(F.sum("size").alias("size"))
    upto = F.col("base") + F.sum("size").over(Window.partitionBy("source").orderBy("rank", "doc_id"))
    last = (
        cell.withColumn("upto", upto).filter(F.col("upto") * 2 - F.col("size") <= F.col("rest") * 2)
        .groupBy("source").agg(F.max(F.struct("rank", "doc_id")).alias("last"))
    )
    spec = settle(
        _with_source(_with_source(targets.select("source", "source_size", "target"), cuts), last, "left"), "spec"
    )
    more = F.coalesce(
        (first < F.col("bin1")) | ((first == F.col("bin1")) & (second < F.col("bin2")))
        | (in_cell & (F.struct("rank", "doc_id") <= F.col("last"))),
        F.lit(False),
    )
    copies = F.col("whole") + more.cast("long")
    return _with_source(ranked, spec).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mix(
    docs: DataFrame, max_copies: int = MAX_COPIES, seed: str = SEED, importance: Column | None = None
) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``.

    Copies are planned per ``doc_id``, so rows that repeat an id are each taken that often.
    """
    names = docs.columns
    plan = mix_plan(docs, max_copies, seed, importance).filter("copies > 0").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max("copies").alias("_copies")
    )
    joined = docs.join(plan, docs["doc_id"].eqNullSafe(plan["_id"]))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(
        *[docs[f"`{c}`"] for c in names]
    )


@query(
    "op6_mixing",
    f"""
    WITH d AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size
        FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM s),
    b AS (
        SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
               coalesce(sum(source_size) OVER f, 0) AS s_before, coalesce(sum(w) OVER f, 0) AS w_before
        FROM w WINDOW f AS (ORDER BY source_size / w, source NULLS LAST
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    m AS (SELECT *, (total - 3 * s_before) * w >= 3 * source_size * (all_w - w_before) AS stopped FROM b),
    t AS (
        SELECT source, source_size,
               CASE WHEN stopped THEN CAST(3 * source_size AS DOUBLE)
                    ELSE CAST((total - 3 * coalesce(sum(CASE WHEN stopped THEN source_size END) OVER (), 0)) * w
                              AS DOUBLE) / sum(CASE WHEN NOT stopped THEN w END) OVER () END AS target
        FROM m),
    r AS (
        SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS ratio FROM t),
    e AS (
        SELECT *, CAST(floor(ratio) AS BIGINT) AS whole,
               target - CAST(floor(ratio) AS BIGINT) * source_size AS rest FROM r),
    i AS (SELECT *, CAST(length(bin(size)) AS BIGINT) AS importance FROM d),
    c AS (SELECT source, importance, CAST(sum(size) AS BIGINT) AS words FROM i GROUP BY source, importance),
    f AS (
        SELECT c.*, e.rest,
               e.rest > 0 AND (e.rest - coalesce(sum(words) OVER (
                   PARTITION BY c.source ORDER BY importance DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   * importance
               >= sum(words * importance) OVER (
                   PARTITION BY c.source ORDER BY importance DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
               AS certain
        FROM c JOIN e ON c.source IS NOT DISTINCT FROM e.source),
    g AS (
        SELECT source, min(CASE WHEN certain THEN importance END) AS least,
               (max(rest) - coalesce(sum(CASE WHEN certain THEN words END), 0))
               / CAST(nullif(sum(CASE WHEN NOT certain THEN words * importance END), 0) AS DOUBLE) AS odds
        FROM f GROUP BY source),
    k AS (
        SELECT i.doc_id, i.source, i.size, e.source_size, e.target, e.ratio,
               e.whole + CASE WHEN i.importance >= g.least THEN 1 ELSE 0 END AS whole,
               CASE WHEN i.importance >= g.least THEN 0.0::DOUBLE
                    WHEN g.odds IS NOT NULL THEN least(g.odds * i.importance, 0.999999999999::DOUBLE) END AS p,
               (CAST('0x' || substr(md5('mix:' || coalesce(CAST(i.doc_id AS VARCHAR), 'null')), 1, 9) AS BIGINT) + 0.5::DOUBLE)
               / 68719476736::DOUBLE AS u
        FROM i JOIN e ON i.source IS NOT DISTINCT FROM e.source JOIN g ON i.source IS NOT DISTINCT FROM g.source),
    -- The odds u / (1 - u) over the odds p / (1 - p), scaled to a whole number.
    q AS (
        SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p))
                      * (greatest(1e-9::DOUBLE, ratio - floor(ratio)) / (1 - greatest(1e-9::DOUBLE, ratio - floor(ratio)))) END AS q
        FROM k),
    o AS (
        SELECT *, least(CAST(floor(q / (1 + q) * 68719476736::DOUBLE) AS BIGINT), 68719476735) AS rank,
               target - sum(whole * size) OVER (PARTITION BY source) AS rest
        FROM q),
    t2 AS (
        SELECT *, sum(size) OVER (PARTITION BY source, rank IS NOT NULL ORDER BY rank, doc_id) AS upto FROM o)
    SELECT doc_id, size, source_size, target,
           (whole + CASE WHEN rank IS NOT NULL AND upto * 2 - size <= rest * 2 THEN 1 ELSE 0 END) * size AS taken
    FROM t2
    """,
)
def op6_mixing(spark, sf_dir):
    return mix_plan(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
