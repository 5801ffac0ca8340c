"""Packing token sequences of controlled mixture by deficit round-robin over source queues.

Every source is a queue of its documents' tokens. Windows of ``WINDOW`` sequences are filled from all queues: each
window owes a source its share of the window plus the fraction of a token that earlier windows still owe it. These
deficits carry over without anybody keeping them: after ``w`` windows the first ``s`` sources have got
``floor(w * WINDOW * SEQUENCE * C_s / T)`` tokens in all, with ``C_s`` their tokens and ``T`` all tokens, so where a
token goes follows from its place in its queue. Queues are laid end to end from per-task sums, so no queue is
sorted or held by one task, and deficits carry across tasks as well.

With ``targets`` the shares are the given ones; when a queue runs dry, the rest go on with theirs (a phase per
queue). Without, each source's share is that of its tokens, so all queues end together. Windows and sequences are
gapless; only the last sequence of all can be short, and it is padded up to a power of two.

Tokens are byte-pair ids of the public tokenizer file named by ``tokenizer``; each document ends with id 0.

Defined results: null text is empty and packs its end id alone; a null source is a queue of its own; rows that
repeat a ``doc_id`` are packed once each; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import load, query
from millrace.session import settle

SEQUENCE = 1024
WINDOW = 64
END_ID = 0
TOKENIZER = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
BATCH_CHARS = 1 << 20

_LOADED: dict[str, tuple] = {}


def _encoders(name: str):
    """Encoders of one vocabulary: a fast one, and the reference one, which alone knows the special token's text."""
    if name not in _LOADED:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _LOADED[name] = (fast, Tokenizer.from_file(public_tokenizers.path(f"{name}.json")))
    return _LOADED[name]


def encode(text: str | None, tokenizer: str = TOKENIZER) -> np.ndarray:
    """Ids of a text and the end id, as unsigned 16-bit numbers."""
    fast, reference = _encoders(tokenizer)
    text = text or ""
    if SPECIAL in text:
        ids = reference.encode(text, add_special_tokens=False).ids
    else:
        ids = fast.encode_ordinary(text)
    ids.append(END_ID)
    return np.array(ids, np.uint16)


def _token_rows(tokenizer: str):
    """Per document: its ids and its place among its source's tokens in this task."""
    schema = pa.schema([
        ("part", pa.int32()), ("doc_id", pa.int64()), ("source", pa.string()), ("n", pa.int64()), ("at", pa.int64()), ("ids", pa.binary()),
    ])

    def work(batches):
        part = TaskContext.get().partitionId()
        queued: dict[str | None, int] = {}
        for batch in batches:
            rows, chars = [], 0
            for doc_id, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = encode(text, tokenizer)
                at = queued.get(source, 0)
                queued[source] = at + len(ids)
                rows.append((part, doc_id, source, len(ids), at, ids.tobytes()))
                chars += len(text or "")
                if chars >= BATCH_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                    rows, chars = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return work


def schedule(
    totals: dict[str | None, int], targets: dict[str | None, float] | None = None, window: int = WINDOW * SEQUENCE
) -> list[tuple]:
    """``(source, phase, start, take, lead, whole, before, size, base)``: what each queue gives in each phase.

    In a phase of ``size`` tokens from position ``base`` on, a source gives ``take`` tokens from its place ``start``.
    Sources that are due less than two tokens a window share a queue of ``whole`` tokens with others, ``lead`` of
    which come first; otherwise ``whole`` is ``take``. The queues before it, in order, give ``before``.
    """
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    left = {s: totals[s] for s in order if totals[s]}
    rows, base, phase = [], 0, 0
    while left:
        share = {s: (totals[s] if targets is None else targets.get(s, 0)) for s in left}
        if not any(share.values()):
            share = {s: left[s] for s in left}  # queues without a target come last, together
        rounds = min(left[s] / share[s] for s in left if share[s] > 0)
        take = {s: left[s] if share[s] > 0 and left[s] / share[s] <= rounds else min(left[s], int(rounds * share[s])) for s in left}
        size, before = sum(take.values()), 0
        for queue in _queues([s for s in order if take.get(s)], take, size, window):
            whole, lead = sum(take[s] for s in queue), 0
            for s in queue:
                rows.append((s, phase, totals[s] - left[s], take[s], lead, whole, before, size, base))
                lead += take[s]
            before += whole
        base += size
        phase += 1
        left = {s: left[s] - take[s] for s in left if left[s] > take[s]}
    return rows


def _queues(order: list, take: dict, size: int, window: int) -> list[list]:
    """The sources by queue, so that each queue is due two tokens a window at least, or is the only one.

    Below that, rounding could take back a token that an earlier window has given.
    """
    queues, small = [], []
    for s in order:
        if take[s] * window >= 2 * size:
            queues.append([s])
            continue
        small.append(s)
        if sum(take[x] for x in small) * window >= 2 * size:
            queues.append(small)
            small = []
    if small and queues:
        max(queues, key=lambda q: sum(take[x] for x in q)).extend(small)
    elif small:
        queues.append(small)
    return queues


def _spread(tokens: int, before: int, size: int) -> int:
    """How many of the first ``tokens`` of a phase come from the queues that give ``before`` of its ``size``."""
    return min(tokens, size) * before // size


def pieces(at: int, n: int, phases: list[tuple], window: int = WINDOW * SEQUENCE):
    """``(start, length, position)`` for a document at place ``at`` of its source; pieces end with their sequence."""
    done = 0
    for start, take, lead, whole, before, size, base in phases:
        while done < n and start <= at + done < start + take:
            c = lead + at + done - start
            w = c * size // (whole * window)

            def got(w):
                return _spread(w * window, before + whole, size) - _spread(w * window, before, size)

            while got(w) > c:
                w -= 1
            while got(w + 1) <= c:
                w += 1
            ahead = _spread((w + 1) * window, before, size) - _spread(w * window, before, size)
            position = base + w * window + ahead + (c - got(w))
            length = min(n - done, got(w + 1) - c, start + take - at - done, SEQUENCE - position % SEQUENCE)
            yield done, length, position
            done += length


def _piece_rows(with_ids: bool):
    fields = [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ] + [("ids", pa.binary())] * with_ids
    schema = pa.schema(fields)

    def work(batches):
        for batch in batches:
            rows, size = [], 0
            for doc_id, at, ids, *flat in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(ids, np.uint16).astype("<u4")
                for start, length, position in pieces(at, len(ids), list(zip(*flat))):
                    own = ids[start:start + length].tobytes()
                    row = (doc_id, start, length, zlib.crc32(own), len(ids), position // SEQUENCE, position % SEQUENCE)
                    rows.append((*row, own) if with_ids else row)
                size += len(ids)
                if size >= BATCH_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return work


_PHASES = ("p_start", "p_take", "p_lead", "p_whole", "p_before", "p_size", "p_base")


def pack(
    docs: DataFrame, targets: dict[str | None, float] | None = None, tokenizer: str = TOKENIZER, with_ids: bool = True
) -> DataFrame:
    """Pieces of documents in sequences: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]``."""
    spark = docs.sparkSession
    tokens = settle(
        docs.select(docs["doc_id"].cast("long"), docs["source"].cast("string"), docs["text"].cast("string")).mapInArrow(
            _token_rows(tokenizer), "part int, doc_id long, source string, n long, at long, ids binary"
        ),
        "tokens",
    )
    parts = settle(tokens.groupBy("source", "part").agg(F.sum("n").alias("n")), "parts")
    totals = {r["source"]: r["n"] for r in parts.groupBy("source").agg(F.sum("n").alias("n")).collect()}  # a row a source
    rows: dict[str | None, list] = {}
    for source, _, *what in schedule(totals, targets):
        rows.setdefault(source, []).append(what)
    kind = T.StructType(
        [T.StructField("of", T.StringType())] + [T.StructField(c, T.ArrayType(T.LongType())) for c in _PHASES]
    )
    phases = spark.createDataFrame([(s, *map(list, zip(*what))) for s, what in rows.items()], kind)
    before = F.coalesce(
        F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    bases = settle(
        parts.withColumn("base", before).join(phases, F.col("source").eqNullSafe(F.col("of")))
        .select("of", F.col("part").alias("_part"), "base", *_PHASES),
        "bases",
    )
    placed = tokens.join(bases, (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("of")))
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return placed.select("doc_id", (F.col("at") + F.col("base")).alias("at"), "ids", *_PHASES).mapInArrow(
        _piece_rows(with_ids), out + ", ids binary" * with_ids
    )


def assemble(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, length)``: each sequence's 32-bit ids as one value, padded with the end id."""
    joined = packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("pieces"), F.sum("length").cast("int").alias("length")
    )
    ids = F.aggregate("pieces", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    room = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("length").cast("double")))).cast("int")
    return joined.select("sequence_id", F.rpad(ids, 4 * room, F.lit(b"\0")).alias("ids"), "length")


@query("op9_packing")
def op9_packing(spark, sf_dir):
    return pack(load(spark, sf_dir, "documents"), with_ids=False)
