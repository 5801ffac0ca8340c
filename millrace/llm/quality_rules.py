"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a condition that rejects a document. On a sample, rows whose ids hash lowest, the cost (its work on each
text, in characters passed over) and the selectivity (share rejected) of each rule are measured in one aggregation;
rules then run in order of rejections per cost, ties by name, so the order is the same in each run. They are the
branches of one CASE expression, in which what a rule looks for in the text stands itself, so a document pays only for
the rules up to the one that rejects it. Measures that are returned are computed for every document. The verdict is
that of all rules together and so the same in any order.

Repeats: every 8-word window has a 64-bit hash, built by doubling (pairs, fours, eights). A text whose hashes are
all distinct has no repeat, which settles most texts without sorting; in the others the hashes are sorted with
their positions and the words under windows found twice or more are counted once each. Windows count as equal when
their hashes are.

Defined results: null text is empty, has no words and fails the base rule; an empty table gives no rows; ratios over
no words are 0.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SPACE, load, query, text_of

WINDOW = 8
SAMPLE_ROWS = 2000
SYMBOLS = "[#*$%&|<>]"
SPLITTER = f"[{SPACE}]+"


@dataclass(frozen=True)
class Rule:
    """``rejects`` is SQL over measures, ``text`` and its words, ``_words``; ``needs`` names the measures it reads.

    ``cost`` is SQL, too: the rule's work on a document, about the time of one character in a regular expression.
    """

    name: str
    rejects: str
    needs: tuple[str, ...]
    cost: str = "length(text)"


_LETTER = r"[A-Za-z\x{80}-\x{10FFFF}]"
_BULLET = r"(?:^|\n)[ \t]*[-*•]"
_CUT_OFF = r"(?:\.\.\.|…)(?:\n|\z)"

# The rules of the query: conservative, so that ordinary prose passes.
RULES = (
    Rule("few_words", "n_words < 20", ("n_words",), "2 * length(text)"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words", ("n_repeat_words", "n_words"), "2 * length(text) + 50 * n_words"),
    Rule("symbols", "2 * n_symbols > n_words", ("n_symbols", "n_words"), "3 * length(text)"),
    Rule("word_length", "word_chars > 25 * n_words OR word_chars < 2 * n_words", ("word_chars", "n_words"), "3 * length(text)"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines", ("n_dup_lines", "n_lines"), "3 * length(text)"),
    # What these look for is no returned measure, and is looked for only where no rule before them rejects.
    Rule("few_kinds", "20 * size(array_distinct(_words)) < n_words", ("n_words",), "2 * length(text) + 10 * n_words"),
    Rule("few_letters", f"3 * regexp_count(text, r'{_LETTER}') < word_chars", ("word_chars",), "3 * length(text)"),
    Rule("bullets", f"n_lines > 2 AND 10 * regexp_count(text, r'{_BULLET}') > 9 * n_lines", ("n_lines",), "2 * length(text)"),
    Rule("cut_off_lines", f"n_lines > 2 AND 2 * regexp_count(text, r'{_CUT_OFF}') > n_lines", ("n_lines",), "2 * length(text)"),
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPLITTER), lambda w: w != "")


def with_window_hashes(df: DataFrame) -> DataFrame:
    """Adds ``_hashes``: 64-bit hashes of all 8-word windows of ``_words``, in order; empty below 8 words.

    Each doubling is a column of its own, so that it is computed once.
    """
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):
        n = F.greatest(F.size("_hashes") - step, F.lit(0))
        df = df.withColumn("_hashes", F.zip_with(
            F.slice("_hashes", F.lit(1), n), F.slice("_hashes", F.lit(step + 1), n), lambda a, b: F.xxhash64(a, b)
        ))
    return df


def with_repeated_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words under windows whose hash occurs twice or more.

    Only texts with fewer distinct hashes than windows go on; there, windows are sorted by hash, and those with an
    equal neighbour keep their place.
    """
    pair = "array<struct<h:bigint,i:int>>"
    none = F.array(F.struct(F.lit(None).cast("bigint").alias("h"), F.lit(-1).alias("i")))
    df = with_window_hashes(df)
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    placed = F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i"))))
    df = df.withColumn("_placed", F.when(repeats, placed).otherwise(F.array().cast(pair)))
    n = F.greatest(F.size("_placed") - 1, F.lit(0))
    df = df.withColumn("_before", F.zip_with(
        "_placed", F.concat(none, F.slice("_placed", F.lit(1), n)),
        lambda a, b: F.struct(a["i"].alias("i"), a["h"].alias("h"), (a["h"] == b["h"]).alias("e")),
    ))
    df = df.withColumn("_places", F.array_sort(F.filter(F.zip_with(
        "_before", F.slice("_placed", F.lit(2), n),
        lambda a, b: F.when(F.coalesce(a["e"], F.lit(False)) | F.coalesce(a["h"] == b["h"], F.lit(False)), a["i"]),
    ), lambda i: i.isNotNull())))
    counted = F.aggregate(
        "_places", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(i - s["last"], F.lit(WINDOW))).alias("n")),
        lambda s: s["n"],
    )
    return df.withColumn("n_repeat_words", counted).drop("_hashes", "_placed", "_before", "_places")


def measures(text: Column) -> dict[str, Column]:
    """Measures of a non-null text, over a column ``_words`` with its words."""
    words = F.col("_words")
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(f"[^{SPACE}]")))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def measured(docs: DataFrame, names: list[str] | None = None) -> DataFrame:
    """``docs`` with the measures (all of them, or those named)."""
    return _measured(docs, names).drop("_words", "_text")


def _measured(docs: DataFrame, names: list[str] | None = None) -> DataFrame:
    """As ``measured``, with the text, null as empty, in ``_text`` and its words in ``_words``."""
    kept = docs.withColumn("_text", text_of(docs)).withColumn("_words", words_of(F.col("_text")))
    if names is None or "n_repeat_words" in names:
        kept = with_repeated_words(kept)
    return kept.withColumns({n: c for n, c in measures(F.col("_text")).items() if names is None or n in names})


def _expr(sql: str) -> Column:
    return F.expr(re.sub(r"\btext\b", "_text", sql))


def _hit(rule: Rule) -> Column:
    return F.coalesce(_expr(rule.rejects), F.lit(False))


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    cost: float
    rejected: float


def estimate(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Cost and selectivity of each rule on about ``sample_rows`` rows, those whose ids hash lowest (all, if fewer).

    The sample is summed where it lies, so its size needs no bound but this.
    """
    total = docs.count()
    sample = docs.select("doc_id", "text")
    if total > sample_rows:
        bits = 32
        sample = sample.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << bits)) < int(sample_rows / total * (1 << bits)))
    sums = [F.count("*").alias("n")]
    for i, rule in enumerate(rules):
        sums += [F.sum(_expr(rule.cost)).alias(f"cost{i}"), F.count_if(_hit(rule)).alias(f"rejected{i}")]
    row = _measured(sample).agg(*sums).first()
    n = max(row["n"], 1)
    return [Estimate(rule, (row[f"cost{i}"] or 0) / n, row[f"rejected{i}"] / n) for i, rule in enumerate(rules)]


def cascade(estimates: list[Estimate]) -> tuple[list[Rule], Column]:
    """The rules by rejection per cost, and the name of the first that rejects (null: kept)."""
    order = [e.rule for e in sorted(estimates, key=lambda e: (-e.rejected / max(e.cost, 1e-9), e.cost, e.rule.name))]
    first = None
    for rule in order:
        first = F.when(_hit(rule), F.lit(rule.name)) if first is None else first.when(_hit(rule), F.lit(rule.name))
    return order, F.lit(None).cast("string") if first is None else first


def apply_rules(docs: DataFrame, estimates: list[Estimate]) -> DataFrame:
    """``docs`` with all measures, ``rejected_by`` (null: kept; the first rule of the order that rejects) and ``kept``."""
    _, first = cascade(estimates)
    return _measured(docs).withColumn("rejected_by", first).withColumn("kept", F.col("rejected_by").isNull()).drop("_words", "_text")


def judge(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``apply_rules`` with estimates from ``docs``."""
    return apply_rules(docs, estimate(docs, rules, sample_rows))


def keep_good(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects: a filter for each rule, in order, which computes what that rule needs."""
    names = docs.columns
    order, _ = cascade(estimate(docs, rules, sample_rows))
    kept = docs
    for rule in order:
        kept = _measured(kept, list(rule.needs)).filter(~_hit(rule)).select(*[F.col(f"`{c}`") for c in names])
    return kept


@query(
    "op7_quality_rules",
    f"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
    w AS (
        SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS win
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM d WHERE len(words) >= 8)),
    r AS (SELECT *, count(*) OVER (PARTITION BY doc_id, win) > 1 AS again FROM w),
    p AS (SELECT doc_id, count(DISTINCT j) AS n FROM (
            SELECT doc_id, unnest(range(i, i + 8)) AS j FROM r WHERE again) GROUP BY doc_id),
    l AS (
        SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
        WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
    m AS (
        SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, len(list_distinct(words)) AS n_kinds,
               len(regexp_extract_all(text, '{_LETTER}')) AS n_letters,
               len(regexp_extract_all(text, '{_BULLET}')) AS n_bullets,
               len(regexp_extract_all(text, '{_CUT_OFF}')) AS n_cut_off,
               CAST(len(array_to_string(words, '')) AS BIGINT) AS word_chars,
               CAST(len(regexp_extract_all(text, '{SYMBOLS}')) AS BIGINT) AS n_symbols,
               coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words
        FROM d LEFT JOIN p USING (doc_id) LEFT JOIN l USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 2 * n_symbols > n_words
                OR word_chars > 25 * n_words OR word_chars < 2 * n_words OR 2 * n_dup_lines > n_lines
                OR 20 * n_kinds < n_words OR 3 * n_letters < word_chars
                OR (n_lines > 2 AND (10 * n_bullets > 9 * n_lines OR 2 * n_cut_off > n_lines))) AS kept
    FROM m
    """,
)
def op7_quality_rules(spark, sf_dir):
    base = F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")
    return judge(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (F.col("kept") & ~base).alias("kept"),
    )
