"""Language identification by a byte convolutional network, trained in numpy.

Texts are cut into fixed windows of ``WINDOW`` bytes (the last one padded with spaces). Filters of several widths
slide over the bytes of a window, the greatest response of each filter goes through a softmax layer, and a text's
language is the one with the greatest mean probability over all its windows. A filter over bytes is a table of a
value per place and byte, so a convolution is a few look-ups per byte.

Training reads at most ``DOCS`` labelled texts per language, those whose ids hash lowest, and ``PER_DOC`` windows
of each, spread evenly over the text. Letters A-Z count as a-z, and ASCII digits and signs as spaces.

Defined results: a null text or one without a letter is ``und`` with score 0; without labelled texts all are
``und``; languages with equal probability go by name; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as Over
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.bytewords import byte_chunks
from millrace.llm.common import held_out, load, query

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
DOCS = 400
PER_DOC = 6
EPOCHS = 6
BATCH = 64
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[:128] = 32
_CLASS[97:123] = np.arange(97, 123)
_CLASS[65:91] = np.arange(97, 123)


@dataclass
class Network:
    """``tables[w]`` is ``(width, 256, FILTERS)``; ``dense`` maps all filters' greatest responses to languages."""

    languages: list[str]
    tables: list[np.ndarray]
    bias: list[np.ndarray]
    dense: np.ndarray
    offset: np.ndarray

    def pooled(self, windows: np.ndarray, places: bool = False):
        """Each filter's greatest response over each window, and where it was."""
        tops, at = [], []
        for table, bias in zip(self.tables, self.bias):
            n = windows.shape[1] - len(table) + 1
            out = table[0][windows[:, :n]]
            for j in range(1, len(table)):
                out += table[j][windows[:, j:j + n]]
            if places:
                p = out.argmax(1)
                at.append(p)
                tops.append(np.take_along_axis(out, p[:, None, :], 1)[:, 0] + bias)
            else:
                tops.append(out.max(1) + bias)
        return np.concatenate(tops, 1), at

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        top, _ = self.pooled(windows)
        return softmax(np.maximum(top, 0) @ self.dense + self.offset)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def windows_of(data: np.ndarray, offsets: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts, and each text's first window (one more than there are texts)."""
    lengths = np.diff(offsets)
    count = np.maximum(1, -(-lengths // size))
    first = np.r_[0, np.cumsum(count)]
    out = np.full(first[-1] * size, 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(first[:-1] * size - offsets[:-1], lengths)] = _CLASS[data]
    return out.reshape(-1, size), first


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 1) -> Network:
    """Adam on the cross entropy; only the place of a filter's greatest response gets its gradient."""
    rng = np.random.default_rng(seed)
    f, k = FILTERS, len(languages)
    net = Network(
        languages,
        [rng.normal(0, 0.3, (w, 256, f)).astype(np.float32) for w in WIDTHS],
        [np.zeros(f, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.2, (f * len(WIDTHS), k)).astype(np.float32), np.zeros(k, np.float32),
    )
    params = [*net.tables, *net.bias, net.dense, net.offset]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    weight = (len(labels) / k / np.maximum(1, np.bincount(labels, minlength=k))).astype(np.float32)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for i in range(0, len(order), BATCH):
            x, y = windows[order[i:i + BATCH]], labels[order[i:i + BATCH]]
            top, at = net.pooled(x, places=True)
            hidden = np.maximum(top, 0)
            delta = softmax(hidden @ net.dense + net.offset)
            delta[np.arange(len(y)), y] -= 1
            delta *= (weight[y] / len(y))[:, None]
            back = (delta @ net.dense.T) * (top > 0)
            grads = []
            for n, (table, p) in enumerate(zip(net.tables, at)):
                own, g = back[:, n * f:(n + 1) * f], np.zeros_like(table)
                rows = np.arange(len(y))[:, None]
                for j in range(len(table)):
                    np.add.at(g[j], (x[rows, p + j], np.arange(f)[None, :]), own)
                grads.append(g)
            grads += [back[:, n * f:(n + 1) * f].sum(0) for n in range(len(WIDTHS))]
            grads += [hidden.T @ delta, delta.sum(0)]
            step += 1
            for param, g, m, v in zip(params, grads, mean, square):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                param -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def fit(docs: DataFrame, per_language: int = DOCS, per_doc: int = PER_DOC) -> Network | None:
    """A network for the languages in ``docs (doc_id, text, lang)``, from a bounded sample; None without labels."""
    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang")
    low = Over.partitionBy("lang").orderBy(F.xxhash64(F.col("doc_id")), "doc_id")
    chosen = known.withColumn("rank", F.row_number().over(low)).filter(F.col("rank") <= per_language).drop("rank")
    chosen = chosen.groupBy(F.col("doc_id").alias("_id")).agg(F.min("lang").alias("label"))
    sample = docs.join(F.broadcast(chosen), docs["doc_id"].eqNullSafe(chosen["_id"])).select(
        "label", docs["text"].cast("string").alias("text")
    )

    def cut(batches):
        for batch in batches:
            labels = batch.column(0).to_pylist()
            for i, _, data, offsets in byte_chunks(batch.column(1)):
                windows, first = windows_of(data, offsets)
                out = []
                for d in range(len(first) - 1):
                    n = first[d + 1] - first[d]
                    own = windows[first[d] + np.unique(np.linspace(0, n - 1, min(n, per_doc)).astype(int))]
                    out.append((labels[i + d], own.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*out), (pa.string(), pa.binary()))], ["label", "windows"]
                )

    rows = sorted((r["label"], bytes(r["windows"])) for r in sample.mapInArrow(cut, "label string, windows binary").collect())
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    place = {x: i for i, x in enumerate(languages)}
    windows = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, WINDOW)
    labels = np.repeat([place[x] for x, _ in rows], [len(w) // WINDOW for _, w in rows])
    return train(windows, labels, languages)


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """``(doc_id, lang_pred, score)``, one row per row of ``docs``; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a fixed number of filters

    def work(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column(1)
            best, score = [], []
            for i, j, data, offsets in byte_chunks(texts):
                if model is None:
                    best += [UNKNOWN] * (j - i)
                    score += [0.0] * (j - i)
                    continue
                windows, first = windows_of(data, offsets)
                p = np.concatenate([model.probabilities(windows[a:a + BATCH]) for a in range(0, len(windows), BATCH)])
                mean = np.add.reduceat(p.astype(float), first[:-1]) / np.diff(first)[:, None]
                top = mean.argmax(1)
                for text, t, m in zip(texts[i:j].to_pylist(), top.tolist(), mean):
                    lettered = text is not None and _LETTER.search(text) is not None
                    best.append(model.languages[t] if lettered else UNKNOWN)
                    score.append(float(min(1.0, m[t])) if lettered else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    return docs.select(docs["doc_id"], docs["text"].cast("string").alias("text")).mapInArrow(
        work, T.StructType([docs.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    )


@query("op2_language_bytes")
def op2_language_bytes(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    net = fit(docs.filter(~held_out(F.col("doc_id"), 5, 0)))
    return predict(docs, net).select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "lang_pred", "score")
