"""Personal data by boosted trees over candidate spans, in DataFrame functions only.

Generators of high recall propose spans that may overlap and may be of several kinds: whatever has the digits of a
phone number, a card or an address, and mail addresses with an at sign or spelled out. Format features of a span and features of its
context go through boosted trees, written as CASE expressions, and per-kind thresholds select the redactions.

The trees learn from the corpus itself: a proposal that overlaps a strictly valid span (the base) of its kind counts
as personal data, others don't. What makes a span strictly valid but is only a way of writing (the plus of a phone
number, how a mail address spells at and dot, how many digits a card has) is no feature, so number groups written like
phone numbers, spelled-out addresses and cards of 13 to 15 digits are found without it. Of the latter two, those that
have what makes a base span (a dot, the check digit) have no label and are left out of the fit. All others are counted
by their features in Spark, and all counts go into the fit: a kind with up to ``FIT_ROWS`` different feature vectors
is fitted on the driver, one with more by sums over nodes, features and values that Spark makes, to the same trees.

Spans are code points, end exclusive. Base spans always stay; added ones overlap neither these nor each other.

Defined results: null text is empty and has no spans; an empty table gives no rows; without proposals no trees are
grown and nothing is added.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import load, query, text_of
from millrace.session import settle

# Fixed patterns of the base. Possessive quantifiers and the look-behinds only spare the search hopeless attempts:
# where an attempt fails at the start of a run, it fails at all later places of the run, too.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# High-recall generators: a run of digits with separators, a few short digit groups (which leaves out a country
# code), and a mail address, also spelled out or without a dot.
NUMBER = r"\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+"
LOCAL = r"(?<![0-9.-])\(?[0-9]{2,4}\)?(?:[\x20.-][0-9]{2,4}){1,3}(?![0-9])"
AT, DOT = r"\x20?(?:\(at\)|\[at\])\x20?", r"\x20?(?:\(dot\)|\[dot\])\x20?"
MAIL = rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|{AT})[A-Za-z0-9-]++(?:(?:\.|{DOT})[A-Za-z0-9-]++)*+"
FIT_ROWS = 5000
ROUNDS = 30
DEPTH = 3
RATE = 0.3
PRECISION = 0.8
CONTEXT = 24

FEATURES = (
    "digits", "separators", "parens", "dots", "spaces", "hyphens", "groups", "first", "last", "luhn", "octets",
    "left", "right", "cue",
)


def found_spans(text: Column, pattern: str, guard: Column) -> Column:
    """``array<struct<s, e, v>>``: all matches with their places; texts outside ``guard`` are not searched."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,v:string>>").alias("found"))
    placed = F.aggregate(
        F.arrays_zip(between.alias("b"), values.alias("v")), start,
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["b"]) + F.coalesce(F.length(x["v"]), F.lit(0))).alias("at"),
            F.when(x["v"].isNull(), acc["found"]).otherwise(F.concat(acc["found"], F.array(F.struct(
                (acc["at"] + F.length(x["b"])).alias("s"),
                (acc["at"] + F.length(x["b"]) + F.length(x["v"])).alias("e"), x["v"].alias("v"),
            )))).alias("found"),
        ),
        lambda acc: acc["found"],
    )
    return F.when(guard, placed).otherwise(F.array().cast("array<struct<s:int,e:int,v:string>>"))


def digits_of(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the check-digit rule."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")
    ).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, F.lit(9)).otherwise(F.lit(0))))
    total = F.aggregate(F.filter(places, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def octets(v: Column) -> Column:
    """Whether all dotted parts are at most 255."""
    def small(p):
        bare = F.regexp_replace(p, "^0+(?=[0-9])", "")
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(999)) <= 255)

    return F.forall(F.split(v, r"\."), small)


def base_spans(text: Column) -> dict[str, Column]:
    """The spans that are always personal data, by kind."""
    has_digit = F.regexp_like(text, F.lit("[0-9]"))
    number = lambda x: F.length(digits_of(x["v"]))
    return {
        "email": found_spans(text, BASE["email"], F.contains(text, F.lit("@"))),
        "ip": F.filter(
            found_spans(text, BASE["ip"], F.regexp_like(text, F.lit(r"[0-9]\.[0-9]"))), lambda x: octets(x["v"])
        ),
        "card": F.filter(
            found_spans(text, BASE["card"], has_digit),
            lambda x: F.when(number(x).between(16, 19), luhn(digits_of(x["v"]))).otherwise(F.lit(False)),
        ),
        "phone": F.filter(
            found_spans(text, BASE["phone"], F.contains(text, F.lit("+"))), lambda x: number(x).between(8, 15)
        ),
    }


def _capped(c: Column, most: int) -> Column:
    return F.least(c.cast("int"), F.lit(most))


def _side(c: Column) -> Column:
    """A coarse class of a neighbouring character."""
    return (
        F.when(c.isNull() | (c == ""), F.lit(0)).when(c == "\n", F.lit(1)).when(c == " ", F.lit(2))
        .when(F.regexp_like(c, F.lit("[0-9]")), F.lit(3)).when(F.regexp_like(c, F.lit(r"\p{L}")), F.lit(4))
        .when(F.regexp_like(c, F.lit("[\"'=:]")), F.lit(5)).otherwise(F.lit(6))
    )


def proposals(text: Column) -> Column:
    """``array<struct<kind, s, e, features…>>``: all that may be personal data, overlapping and of several kinds."""
    numbers = found_spans(text, NUMBER, F.regexp_like(text, F.lit("[0-9]")))
    local = found_spans(text, LOCAL, F.regexp_like(text, F.lit("[0-9][\\x20.)-]+[0-9]")))
    mails = found_spans(text, MAIL, F.regexp_like(text, F.lit(r"@|\(at\)|\[at\]")))

    def of_kind(spans, kind, keep):
        return F.transform(F.filter(spans, keep), lambda x: F.struct(F.lit(kind).alias("kind"), *_features(text, x, kind)))

    size = lambda x: F.length(digits_of(x["v"]))
    return F.concat(
        of_kind(mails, "email", lambda x: F.lit(True)),
        of_kind(numbers, "ip", lambda x: F.regexp_like(x["v"], F.lit(r"^[0-9]+(\.[0-9]+){3}$"))),
        of_kind(numbers, "card", lambda x: size(x).between(13, 19)),
        F.array_distinct(F.concat(*[of_kind(x, "phone", lambda x: size(x).between(7, 15)) for x in (local, numbers)])),
    )


def _features(text: Column, x: Column, kind: str) -> list[Column]:
    v, s, e = x["v"], x["s"], x["e"]
    digits = digits_of(v)
    valid, labelled = F.when(digits != "", luhn(digits)).otherwise(F.lit(False)), F.lit(True)
    if kind == "card":
        labelled = F.length(digits).between(16, 19) | ~valid
    elif kind == "email":
        # An address looks the same however it is spelled.
        labelled = F.contains(v, F.lit("@"))
        v = F.regexp_replace(F.regexp_replace(v, AT, "@"), DOT, ".")
        labelled = labelled | ~F.contains(F.substring_index(v, "@", -1), F.lit("."))
    groups = F.filter(F.split(v, "[^0-9]+"), lambda g: g != "")
    before = F.substring(text, F.greatest(s - CONTEXT, F.lit(0)) + 1, F.least(s, F.lit(CONTEXT)))
    # The plus and the country code of a phone number are a way of writing, not a feature.
    near = F.regexp_replace(before, r"\+?[0-9]{1,3}[\x20-]?$", "")
    cue = (
        F.when(F.regexp_like(near, F.lit(r"(?i)\b(?:tel|phone|call|fax|mobile)\b")), F.lit(1))
        .when(F.regexp_like(near, F.lit(r"(?i)\b(?:card|visa|pay|credit)\b")), F.lit(2))
        .when(F.regexp_like(near, F.lit(r"(?i)\b(?:ip|host|server|addr)\b")), F.lit(3))
        .when(F.regexp_like(near, F.lit(r"(?i)\b(?:id|no|token|key|isbn|ref)\b")), F.lit(4)).otherwise(F.lit(0))
    )
    count = lambda c: F.regexp_count(v, F.lit(c))
    return [
        s.alias("s"), e.alias("e"), labelled.alias("labelled"),
        (F.lit(0) if kind == "card" else _capped(F.length(digits), 20)).alias("digits"),
        _capped(F.length(v) - F.length(digits), 9).alias("separators"), _capped(count(r"[()]"), 2).alias("parens"),
        _capped(count(r"\."), 5).alias("dots"), _capped(count(" "), 6).alias("spaces"), _capped(count("-"), 6).alias("hyphens"),
        _capped(F.size(groups), 7).alias("groups"), _capped(F.coalesce(F.length(F.get(groups, F.lit(0))), F.lit(0)), 9).alias("first"),
        _capped(F.coalesce(F.length(F.get(groups, F.size(groups) - 1)), F.lit(0)), 9).alias("last"),
        valid.cast("int").alias("luhn"), octets(v).cast("int").alias("octets"),
        _side(F.substring(near, -1, 1)).alias("left"), _side(F.substring(text, e + 1, F.lit(1))).alias("right"), cue.alias("cue"),
    ]


def _overlaps(x: Column, y: Column) -> Column:
    return (x["s"] < y["e"]) & (y["s"] < x["e"])


# --- boosted trees over counted feature vectors ---------------------------------------------------------------


# Probabilities are whole multiples of 1 / SCALE, so sums of gradients are exact in any order.
SCALE = 1 << 16
_HALVED = 14  # binary digits left out of p * (SCALE - p), so that its sums stay exact, too
_HESS_SCALE = SCALE * SCALE >> _HALVED


def _best_split(tables):
    """(gain, feature, threshold, low sums) of the split ``feature <= threshold`` with the most gain, or None.

    ``tables`` has per feature its values in ascending order with the gradients and second derivatives of each.
    """
    best = None
    for f, values, grads, hesses in tables:
        if len(values) < 2:
            continue
        gs, hs = np.cumsum(grads), np.cumsum(hesses)
        g, h = gs[-1] / SCALE, hs[-1] / _HESS_SCALE
        gl, hl = gs[:-1] / SCALE, hs[:-1] / _HESS_SCALE
        gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
        k = int(np.argmax(gain))
        if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = (float(gain[k]), f, int(values[k]), (int(gs[k]), int(hs[k])))
    return best


def _leaf(grad: int, hess: int) -> float:
    return float(-RATE * (grad / SCALE) / (hess / _HESS_SCALE + 1))


def _grow(x, grad, hess, rows, depth):
    def tables():
        for f in range(x.shape[1]):
            values, place = np.unique(x[rows, f], return_inverse=True)
            yield f, values, np.bincount(place, grad[rows]), np.bincount(place, hess[rows])

    split = _best_split(tables()) if depth else None
    if split is None:
        return _leaf(int(grad[rows].sum()), int(hess[rows].sum()))
    _, f, t, _ = split
    low = x[rows, f] <= t
    return (f, t, _grow(x, grad, hess, rows[low], depth - 1), _grow(x, grad, hess, rows[~low], depth - 1))


def _value(tree, x):
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, t, low, high = tree
    return np.where(x[:, f] <= t, _value(low, x), _value(high, x))


def _prior(pos: float, n: float) -> float:
    return math.log((pos + 1) / (n - pos + 1))


def _probability(score: np.ndarray) -> np.ndarray:
    """In multiples of 1 / SCALE."""
    return np.clip(np.floor(SCALE / (1 + np.exp(-score)) + 0.5), 1, SCALE - 1).astype(np.int64)


def _probability_column(score: Column) -> Column:
    p = F.floor(SCALE / (1 + F.exp(-score)) + 0.5)
    return F.least(F.greatest(p, F.lit(1)), F.lit(SCALE - 1)).cast("long")


def fit_trees(x: np.ndarray, pos: np.ndarray, n: np.ndarray, rounds: int = ROUNDS):
    """Gradient boosting of the logistic loss over feature vectors that occur ``n`` times, ``pos`` times positive."""
    pos, n = pos.astype(np.int64), n.astype(np.int64)
    prior = _prior(int(pos.sum()), int(n.sum()))
    score, trees = np.full(len(x), prior), []
    for _ in range(rounds):
        p = _probability(score)
        tree = _grow(x, n * p - pos * SCALE, n * (p * (SCALE - p) >> _HALVED), np.arange(len(x)), DEPTH)
        trees.append(tree)
        score = score + _value(tree, x)
    return prior, trees, _probability(score) / SCALE


def _grow_spread(scored: DataFrame):
    """A tree from sums by node, feature and value; only these, a few thousand at most, reach the driver."""
    p = _probability_column(F.col("score"))
    grad, hess = F.col("n") * p - F.col("pos") * SCALE, F.col("n") * F.shiftright(p * (SCALE - p), _HALVED)
    splits, sums = {}, {}

    def node(i):
        if i not in splits:
            return F.lit(i)
        f, t = splits[i]
        return F.when(F.col(FEATURES[f]) <= t, node(2 * i)).otherwise(node(2 * i + 1))

    def tree(i):
        return (*splits[i], tree(2 * i), tree(2 * i + 1)) if i in splits else _leaf(*sums[i])

    values = F.array(*[F.struct(F.lit(f).alias("f"), F.col(c).alias("v")) for f, c in enumerate(FEATURES)])
    for depth in range(DEPTH):
        found = scored.select(node(1).alias("node"), grad.alias("g"), hess.alias("h"), F.explode(values).alias("c"))
        found = found.filter(F.col("node") >= 1 << depth).groupBy("node", "c.f", "c.v").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        tables: dict = {}
        for r in sorted(tuple(r) for r in found.collect()):
            tables.setdefault(r[0], {}).setdefault(r[1], []).append(r[2:])
        for i, features in tables.items():
            whole = [sum(r[k] for r in features[0]) for k in (1, 2)]
            sums[i] = tuple(whole)
            split = _best_split((f, *(np.array(c, np.int64) for c in zip(*rows))) for f, rows in features.items())
            if split is not None:
                _, f, t, low = split
                splits[i] = (f, t)
                sums[2 * i], sums[2 * i + 1] = low, (whole[0] - low[0], whole[1] - low[1])
    return tree(1)


def fit_spread(counted: DataFrame, rounds: int = ROUNDS) -> tuple:
    """``fit_trees`` and ``threshold`` over any number of feature vectors, which stay on executors: the same model.

    Equal probabilities are counted together, so at most ``SCALE`` rows decide on the threshold.
    """
    pos, n = counted.agg(F.sum("pos"), F.sum("n")).first()
    prior, trees = _prior(pos, n), []
    scored = counted.withColumn("score", F.lit(prior))
    for _ in range(rounds):
        trees.append(_grow_spread(scored))
        scored = settle(scored.withColumn("score", F.col("score") + _tree_column(trees[-1], scored)), "scored")
    ranked = scored.groupBy(_probability_column(F.col("score")).alias("p")).agg(F.sum("pos"), F.sum("n")).orderBy("p").collect()
    p, pos, n = (np.array(c, float) for c in zip(*ranked))
    return prior, trees, threshold(p / SCALE, pos, n)


def threshold(p: np.ndarray, pos: np.ndarray, n: np.ndarray, precision: float = PRECISION) -> float:
    """The smallest score from which on at least ``precision`` of the proposals are positive; 2 if there is none."""
    order = np.argsort(-p, kind="stable")
    share = np.cumsum(pos[order]) / np.cumsum(n[order])
    ends = np.r_[p[order][1:] != p[order][:-1], True]
    good = np.flatnonzero(ends & (share >= precision))
    return float(p[order][good[-1]]) if len(good) else 2.0


def _tree_column(tree, c: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    f, t, low, high = tree
    return F.when(c[FEATURES[f]] <= t, _tree_column(low, c)).otherwise(_tree_column(high, c))


def fit(spans: DataFrame, fit_rows: int = FIT_ROWS) -> dict:
    """Kind → (prior, trees, threshold), from ``proposed`` and the base spans of all documents.

    Every labelled proposal counts. Only where the work is done depends on ``fit_rows``: a kind with up to as many
    different feature vectors is fitted on the driver, one with more by sums that Spark makes.
    """
    rows = spans.select(F.explode("proposed").alias("c"), "base").filter("c.labelled").select(
        "c.kind", *[F.col(f"c.{f}").alias(f) for f in FEATURES],
        F.exists("base", lambda b: (b["kind"] == F.col("c.kind")) & (b["s"] < F.col("c.e")) & (F.col("c.s") < b["e"])).alias("y"),
    )
    counted = settle(rows.groupBy("kind", *FEATURES).agg(F.count_if("y").alias("pos"), F.count("*").alias("n")), "counted")
    sizes = {r["kind"]: r["count"] for r in counted.groupBy("kind").count().collect()}
    models = {}
    for kind in KINDS:
        own = counted.filter(F.col("kind") == kind)
        if sizes.get(kind, 0) > fit_rows:
            models[kind] = fit_spread(own.select(*FEATURES, "pos", "n"))
        elif kind in sizes:
            vectors = own.orderBy(*FEATURES).collect()
            x = np.array([[r[f] for f in FEATURES] for r in vectors], np.int64)
            pos, n = (np.array([r[c] for r in vectors], float) for c in ("pos", "n"))
            prior, trees, p = fit_trees(x, pos, n)
            models[kind] = (prior, trees, threshold(p, pos, n))
    return models


def _placed_kind(kind: str):
    return lambda x: F.struct(
        F.lit(KINDS.index(kind)).alias("rank"), x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind")
    )


def _chosen(kind: str, prior: float, trees: list, least: float):
    def keep(c):
        score = sum((_tree_column(t, c) for t in trees), F.lit(prior))
        return (c["kind"] == kind) & (_probability_column(score) >= round(least * SCALE))

    return keep


def _without(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others."""
    return F.filter(spans, lambda c: ~F.exists(others, lambda b: _overlaps(c, b)))


def span_table(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``(doc_id, base, spans)``: arrays of ``(kind, s, e)`` by kind and start; ``spans`` also has the added ones."""
    text = text_of(docs)
    base = base_spans(text)
    kinded = [F.transform(base[k], _placed_kind(k)) for k in KINDS]
    spans = settle(
        docs.select(docs["doc_id"], F.concat(*kinded).alias("base"), proposals(text).alias("proposed")), "proposals"
    )
    models = fit(spans, fit_rows)
    added = F.array().cast("array<struct<rank:int,s:int,e:int,kind:string>>")
    for kind in KINDS:
        if kind in models and models[kind][2] <= 1:
            fresh = F.filter(_without(F.col("proposed"), F.col("base")), _chosen(kind, *models[kind]))
            added = F.concat(added, F.transform(_without(fresh, added), _placed_kind(kind)))
    return spans.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def redact(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``docs`` with each span of a document replaced by its kind in angle brackets; needs one row per ``doc_id``."""
    found = span_table(docs, fit_rows).select(F.col("doc_id").alias("_id"), "spans")
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found["_id"]), "left")
    by_place = F.array_sort(F.transform("spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    whole = F.aggregate(
        by_place, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, x: F.struct(
            F.greatest(x["e"], a["at"]).alias("at"),
            F.when(x["s"] < a["at"], a["out"]).otherwise(F.concat(
                a["out"], F.substring(text_of(docs), a["at"] + 1, x["s"] - a["at"]), F.lit("<"), x["kind"], F.lit(">")
            )).alias("out"),
        ),
        lambda a: F.concat(a["out"], F.substring(text_of(docs), a["at"] + 1, F.length(text_of(docs)))),
    )
    text = F.when(F.size("spans") > 0, whole).otherwise(docs["text"])
    return joined.select(*[text.alias(c) if c == "text" else docs[f"`{c}`"] for c in docs.columns])


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


@query("op1_pii_boosting")
def op1_pii_boosting(spark, sf_dir):
    found = span_table(load(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
