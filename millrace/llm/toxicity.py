"""Toxicity by nearest labelled examples under exact TF-IDF cosine, found with a block-max inverted index.

Fitting reads a bounded sample of labelled rows: at most ``EXAMPLES`` of either class, those whose ids hash lowest.
Their words and the words' first 4, 5 and 6 letters are counted in Spark; the ``TERMS`` ones whose document
frequency differs most between the classes (by the log-likelihood ratio, at least ``MIN_G``) are the vocabulary,
weighted by (1 + ln tf) * idf. Examples with equal
vectors are one entry with their labels counted.

The index keeps, per term, its entries by block, and the greatest weight per block. A text's blocks are scored in
order of the sum of these bounds until no bound can reach its k-th nearest example, so the cosine is exact. The
nearest entries that hold ``K`` examples (all of an entry's) vote, weighted by similarity and by how much of their
class the sample holds; a monotone step function, fitted on the examples with each left out of its own vote, turns
votes into probabilities. The nearest examples are returned as evidence.

Defined results: a text without a word of the vocabulary (null and empty ones too) has no neighbours, and the
share of toxic ones among such examples as its score; ties in similarity go to the entry with the smaller id; without
labelled rows of both classes the score is the share of label 1 (0 without labels); an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import held_out, load, query, text_of
from millrace.session import settle

EXAMPLES = 4096
TERMS = 1024
MIN_G = 25.0
K = 15
BLOCK = 64
FIRST_BLOCKS = 8
THRESHOLD = 0.3
CACHE = 50_000
WORD_CACHE = 200_000
STEMS = (4, 5, 6)

_WORDS = re.compile(r"[^\W_]+")


@dataclass
class Index:
    """Entries are distinct example vectors; ``starts[t, b]`` bounds term t's postings of block b."""

    vocab: dict[str, int]
    idf: np.ndarray
    starts: np.ndarray
    entry: np.ndarray
    weight: np.ndarray
    block_max: np.ndarray
    votes: np.ndarray  # per entry: weight of all its examples, weight of the toxic ones, number, number toxic
    ids: list[list[int]]
    class_weight: tuple[float, float]
    none_score: float = 0.0
    steps: tuple = field(default=((), ()))
    words: dict = field(default_factory=dict)
    heads: frozenset | None = None
    dense: np.ndarray | None = None

    def terms_of(self, word: str) -> tuple[int, ...]:
        forms = (word, *(word[:k] + "*" for k in STEMS if len(word) > k))
        found = tuple(t for t in map(self.vocab.get, forms) if t is not None)
        if len(self.words) >= WORD_CACHE:
            self.words.clear()
        self.words[word] = found
        return found

    def vector(self, text: str | None) -> tuple:
        """``((term, tf), …)`` of a text, by term."""
        counts: dict[int, int] = {}
        known, first = self.words, STEMS[0]
        if self.heads is None:
            self.heads = frozenset(w.rstrip("*")[:first] for w in self.vocab)
        heads = self.heads
        for w in [w for w in _WORDS.findall((text or "").lower()) if w[:first] in heads]:
            found = known.get(w)
            for t in self.terms_of(w) if found is None else found:
                counts[t] = counts.get(t, 0) + 1
        return tuple(sorted(counts.items()))

    def unit(self, vector: tuple) -> tuple[np.ndarray, np.ndarray]:
        terms = np.array([t for t, _ in vector], np.int64)
        w = np.array([1 + math.log(n) for _, n in vector]) * self.idf[terms]
        return terms, w / math.sqrt(float(w @ w))

    def rows(self) -> np.ndarray:
        """Each term's posting list as an array over blocks and places in them."""
        if self.dense is None:
            blocks = self.block_max.shape[1]
            self.dense = np.zeros((len(self.block_max), blocks * BLOCK))
            self.dense[np.repeat(np.arange(len(self.starts)), self.starts[:, -1] - self.starts[:, 0]), self.entry] = self.weight
            self.dense = self.dense.reshape(-1, blocks, BLOCK)
        return self.dense

    def nearest(self, vector: tuple, k: int, without: int | None = None) -> list[tuple[float, int]]:
        """``(cosine, entry)`` of the nearest entries that hold ``k`` examples, nearest first.

        ``without`` is an entry one of whose examples does not count.
        """
        if not vector or not len(self.votes):
            return []
        terms, w = self.unit(vector)
        bounds = w @ self.block_max[terms]
        order = np.argsort(-bounds, kind="stable")
        order = order[:int((bounds > 0).sum())]
        # The blocks with the greatest bounds first; then those that can still hold one of the k nearest.
        cosine, entry = self._scored(terms, w, order[:FIRST_BLOCKS], k)
        least = cosine.min() if len(cosine) > k else 0.0
        rest = order[FIRST_BLOCKS:]
        rest = rest[bounds[rest] >= least - 1e-9]
        if len(rest):
            more, others = self._scored(terms, w, rest, k)
            cosine, entry = np.r_[cosine, more], np.r_[entry, others]
        best = np.lexsort((entry, -cosine))
        held = np.cumsum(self.votes[entry[best], 2] - (entry[best] == without))
        best = best[:int(np.searchsorted(held, k)) + 1]
        return [
            (c, e) for c, e in zip(cosine[best].tolist(), entry[best].tolist()) if e != without or self.votes[e, 2] > 1
        ]

    def _scored(self, terms: np.ndarray, w: np.ndarray, blocks: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the entries of these blocks that share a term with the text, the ``k + 1`` nearest and their equals."""
        scores = np.round(np.tensordot(w, self.rows()[terms[:, None], blocks[None, :]], 1).ravel(), 9)
        least = np.partition(scores, -k - 1)[-k - 1] if len(scores) > k else 0.0
        hit = np.flatnonzero((scores >= least) & (scores > 0))
        return scores[hit], blocks[hit // BLOCK] * BLOCK + hit % BLOCK

    def raw(self, near: list[tuple[float, int]], without: tuple[int, int] | None = None) -> float | None:
        """The share of the weighted votes that are toxic; None without neighbours."""
        total = toxic = 0.0
        for cosine, e in near:
            every, bad = self.votes[e, 0], self.votes[e, 1]
            if without is not None and e == without[0]:
                own = self.class_weight[without[1]]
                every, bad = every - own, bad - own * without[1]
            total += cosine * every
            toxic += cosine * bad
        return toxic / total if total > 0 else None

    def calibrated(self, raw: float | None) -> float:
        if raw is None:
            return self.none_score
        if not len(self.steps[0]):
            return raw
        step = self.steps[1][max(0, int(np.searchsorted(self.steps[0], raw, "right")) - 1)]
        # The raw vote keeps an order within a step.
        return float((999 * step + raw) / 1000)


def build_index(vocab: list[str], idf: list[float], examples: list[tuple[int, int, tuple]], class_counts: tuple[int, int]) -> Index:
    """``examples`` are ``(doc_id, label, vector)``; ``class_counts`` the labelled rows per class in all."""
    sampled = [sum(1 for e in examples if e[1] == c) for c in (0, 1)]
    weight = tuple(class_counts[c] / sampled[c] if sampled[c] else 0.0 for c in (0, 1))
    groups: dict[tuple, list[tuple[int, int]]] = {}
    for doc_id, label, vector in sorted(examples, key=lambda e: e[0]):
        if vector:
            groups.setdefault(vector, []).append((doc_id, label))
    # Like vectors come to lie in one block: by rarest term first.
    idf_array = np.array(idf, float)
    order = sorted(groups, key=lambda v: sorted(((-idf[t], t) for t, _ in v)))
    votes = np.zeros((len(order), 4))
    for e, v in enumerate(order):
        for _, label in groups[v]:
            votes[e] += (weight[label], weight[label] * label, 1, label)
    index = Index(
        {w: t for t, w in enumerate(vocab)}, idf_array, np.zeros((len(vocab), 1), np.int64), np.zeros(0, np.int64),
        np.zeros(0), np.zeros((len(vocab), 0)), votes, [[i for i, _ in groups[v]] for v in order], weight,
    )
    rows = []
    for e, v in enumerate(order):
        terms, w = index.unit(v)
        rows.append(np.stack([terms, np.full(len(terms), e), w]))
    if rows:
        terms, entry, w = np.concatenate(rows, 1)
        terms, entry = terms.astype(np.int64), entry.astype(np.int64)
        by = np.lexsort((entry, terms))
        terms, index.entry, index.weight = terms[by], entry[by], w[by]
        blocks = -(-len(order) // BLOCK)
        place = terms * blocks + index.entry // BLOCK
        cell = np.searchsorted(place, np.arange(len(vocab) * blocks + 1))
        index.starts = np.stack([cell[t * blocks:t * blocks + blocks + 1] for t in range(len(vocab))])
        index.block_max = np.zeros(len(vocab) * blocks)
        np.maximum.at(index.block_max, place, index.weight)
        index.block_max = index.block_max.reshape(len(vocab), blocks)
    _calibrate(index, examples, {v: e for e, v in enumerate(order)})
    return index


def _calibrate(index: Index, examples, entry_of) -> None:
    """Steps of probability over raw votes (pool adjacent violators), each example left out of its own vote."""
    cache: dict[tuple, float | None] = {}
    seen, none = [], [0.0, 0.0]
    for _, label, vector in examples:
        w = index.class_weight[label]
        if (vector, label) not in cache:
            own = entry_of.get(vector)
            cache[vector, label] = index.raw(index.nearest(vector, K, own), None if own is None else (own, label))
        raw = cache[vector, label]
        if raw is None:
            none[0] += w
            none[1] += w * label
        else:
            seen.append((raw, w, w * label))
    # A labelled row more of each class: no step is certain.
    index.none_score = (none[1] + 0.1) / (none[0] + 1)
    pools: list[list[float]] = []
    for raw, w, y in sorted(seen):
        if pools and pools[-1][3] == raw:
            pools[-1][1] += w
            pools[-1][2] += y
        else:
            pools.append([raw, w, y, raw])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            _, w2, y2, top = pools.pop()
            pools[-1] = [pools[-1][0], pools[-1][1] + w2, pools[-1][2] + y2, top]
    index.steps = (np.array([p[0] for p in pools]), np.array([p[2] / p[1] for p in pools]))


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, terms: int = TERMS) -> Index:
    """The index over a bounded sample of the labelled rows of ``labels (doc_id, toxic)``."""
    rows = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("label")
    ).groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    low = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = rows.withColumn("rank", F.row_number().over(low)).filter(F.col("rank") <= examples).drop("rank")
    sample = settle(
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
        .join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("label").alias("label")),
        "examples",
    )
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    forms = F.flatten(F.transform(found, lambda w: F.filter(
        F.array(w, *[F.when(F.length(w) > k, F.concat(F.substring(w, 1, k), F.lit("*"))) for k in STEMS]),
        lambda x: x.isNotNull(),
    )))
    words = sample.select("label", F.explode(F.array_distinct(forms)).alias("word"))
    size = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    df = words.groupBy("word").agg(F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") == 0).alias("b"))
    a, b = F.col("a"), F.col("b")

    def part(seen, expected):
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    share = (a + b) / (n0 + n1)
    g = part(a, share * n1) + part(b, share * n0) + part(n1 - a, (1 - share) * n1) + part(n0 - b, (1 - share) * n0)
    top = df.withColumn("g", g).filter(F.col("g") >= MIN_G)
    top = top.orderBy(F.desc("g"), "word").limit(terms).collect() if n0 and n1 else []
    # Of forms that occur in the same documents, as counts and first letters tell, the shortest speaks for all.
    same: dict[tuple, object] = {}
    for r in sorted(top, key=lambda r: (len(r["word"]), r["word"])):
        same.setdefault((r["word"][:STEMS[0]], r["a"], r["b"]), r)
    top = sorted(same.values(), key=lambda r: (-r["g"], r["word"]))
    vocab = [r["word"] for r in top]
    idf = [math.log((1 + n0 + n1) / (1 + r["a"] + r["b"])) + 1 for r in top]
    known = Index({w: t for t, w in enumerate(vocab)}, np.array(idf), None, None, None, None, np.zeros((0, 4)), [], (1.0, 1.0))

    def vectors(batches):
        for batch in batches:
            found = [known.vector(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2).cast(pa.int32()), pa.array([[x for p in v for x in p] for v in found], pa.list_(pa.int32()))],
                ["doc_id", "label", "vector"],
            )

    sparse = sample.select("doc_id", "text", "label").mapInArrow(vectors, "doc_id long, label int, vector array<int>").collect()
    return build_index(
        vocab, idf, [(r["doc_id"], r["label"], tuple(zip(r["vector"][::2], r["vector"][1::2]))) for r in sparse],
        (counts.get(0, 0), counts.get(1, 0)),
    )


class Scorer:
    """Scores of texts, remembering those of vectors seen before."""

    def __init__(self, index: Index):
        self.index, self.seen = index, {}

    def __call__(self, text: str | None) -> tuple[float, list[tuple[float, int]]]:
        vector = self.index.vector(text)
        if vector not in self.seen:
            if len(self.seen) >= CACHE:
                self.seen.clear()
            near = self.index.nearest(vector, K)
            self.seen[vector] = (self.index.calibrated(self.index.raw(near)), near)
        return self.seen[vector]


def score_texts(docs: DataFrame, index: Index) -> DataFrame:
    """``(doc_id, score, evidence)``; evidence are the nearest examples, ``array<struct<doc_id, cosine>>``."""
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by EXAMPLES and TERMS
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())]))

    def work(batches):
        score = Scorer(shared.value)
        for batch in batches:
            found = [score(t) for t in batch.column(1).to_pylist()]
            near = [[{"doc_id": i, "cosine": c} for c, e in n for i in score.index.ids[e]][:K] for _, n in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s for s, _ in found], pa.float64()), pa.array(near, kind)],
                ["doc_id", "score", "evidence"],
            )

    return docs.select(docs["doc_id"], docs["text"].cast("string").alias("text")).mapInArrow(
        work,
        T.StructType([
            docs.schema["doc_id"], T.StructField("score", T.DoubleType()),
            T.StructField("evidence", T.ArrayType(T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("cosine", T.DoubleType())]))),
        ]),
    )


def drop_toxic(docs: DataFrame, index: Index, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, as they are; rows pass through without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    at = docs.columns.index("text")

    def work(batches):
        score = Scorer(shared.value)
        for batch in batches:
            yield batch.filter(pa.array([score(t)[0] < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


@query("op4_toxicity_nearest")
def op4_toxicity_nearest(spark, sf_dir):
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    index = fit(docs, labels.filter(~held_out(F.col("doc_id"), 4, 2)))
    return score_texts(docs, index).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
