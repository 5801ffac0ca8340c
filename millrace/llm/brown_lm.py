"""Scoring texts with Brown's class-based bigram model.

P(text) = product over tokens of P(class | class before) * P(word | class). Every training word gets its class by
exchange. The ``FREQUENT`` most frequent ones start: each moves to the class that raises the likelihood of the corpus'
class bigrams most, until few move; meanwhile a word that is not among them counts by its last byte. Then every other
training word, however rare, gets the class that raises the likelihood most, from its counts with the classes beside it
in all training texts and the class bigrams that the start left. Class bigrams are counted again with the classes of
all words. Only words that no training text has keep a class by their last byte, so each class's words and a share
for unseen ones have probability 1 together.

How the counts are made: texts are coded in chunks of about ``CHUNK_TOKENS`` tokens, each with a dictionary of its
distinct words, so a word leaves a chunk once. The order of word hashes is cut into fragments; a fragment adds up
its words over all chunks, classifies them and sends each chunk the totals and classes of its words. A chunk's row
with these becomes a class for each token and what the texts score besides transitions; nobody holds the whole
vocabulary. What reaches the driver has fixed bounds: the frequent words, bigram counts between these, the last bytes
of the others and the end, and sums by class.

Words are told apart by 64-bit hashes. Probabilities are smoothed by adding ``CLASS_ADD`` to class bigrams and
``WORD_ADD`` to words.

Defined results: null text is empty, one end token; rows that repeat a ``doc_id`` are scored (and counted) once
each; without training texts every probability comes from smoothing alone; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytewords import byte_chunks, hashed_words
from millrace.llm.common import held_out, load, query
from millrace.session import settle

CHUNK_TOKENS = 1_000_000
FRAGMENT_WORDS = 1_000_000
BLOCK_WORDS = 4_096
FREQUENT = 1024
CLASSES = 48
TAILS = 32
ROUNDS = 4
CLASS_ADD = 0.1
WORD_ADD = 0.5

_CHUNK = pa.schema([
    ("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("train", pa.binary()), ("lengths", pa.binary()),
    ("low", pa.binary()), ("high", pa.binary()), ("words", pa.binary()), ("tails", pa.binary()), ("counts", pa.binary()),
])


def pack(values: np.ndarray) -> bytes:
    """The values' bytes, compressed, behind their number; shuffles and files hold them so."""
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(held: bytes, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(held[8:], int.from_bytes(held[:8], "little"), codec="zstd", asbytes=True), kind)


def _chunk_rows(batches):
    """Texts coded by chunk: per text its length, per token its word's place in the chunk's sorted dictionary."""
    chunk = TaskContext.get().partitionId() << 24
    held: list = []

    def row():
        nonlocal chunk, held
        ids = [x for h in held for x in h[0]]
        train, lengths, hashes, last = (np.concatenate([h[k] for h in held]) for k in (1, 2, 3, 4))
        words, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        counts = np.bincount(place[np.repeat(train, lengths)], minlength=len(words)).astype(np.uint32)
        out = (
            chunk, ids, train.tobytes(), lengths.astype(np.uint32).tobytes(), pack((place & 0xFFFF).astype(np.uint16)),
            pack((place >> 16).astype(np.uint16)), words.tobytes(), pack((last[first] & (TAILS - 1)).astype(np.uint8)), pack(counts),
        )
        chunk, held = chunk + 1, []
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(out, _CHUNK.types)], schema=_CHUNK)

    tokens = 0
    for batch in batches:
        ids = batch.column(0).to_pylist()
        train = batch.column(1).fill_null(True).to_numpy(zero_copy_only=False).astype(bool)
        for i, j, data, offsets in byte_chunks(batch.column(2)):
            hashes, places, last = hashed_words(data, offsets)
            held.append((ids[i:j], train[i:j], np.diff(places), hashes, last))
            tokens += len(hashes) + j - i
            if tokens >= CHUNK_TOKENS:
                yield row()
                tokens = 0
    if held:
        yield row()


_CHUNK_DDL = (
    "chunk long, ids array<long>, train binary, lengths binary, low binary, high binary, words binary, tails binary, counts binary"
)


def _places(low: bytes, high: bytes) -> np.ndarray:
    return unpack(low, np.uint16).astype(np.int64) | unpack(high, np.uint16).astype(np.int64) << 16


def _cuts(words: np.ndarray, fragments: int) -> list[tuple[int, int, int]]:
    """``(fragment, first, last + 1)`` of a dictionary, cut by the order of hashes."""
    width = np.uint64(min((1 << 64) // fragments + 1, (1 << 64) - 1))
    at = np.searchsorted(np.minimum(words // width, np.uint64(fragments - 1)), np.arange(fragments + 1, dtype=np.uint64)).tolist()
    return [(f, a, b) for f, (a, b) in enumerate(zip(at[:-1], at[1:])) if b > a]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _count_rows(fragments: int):
    """A chunk's dictionary and training counts by fragment."""
    schema = pa.schema([("fragment", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())])

    def work(batches):
        for batch in batches:
            for words, counts in zip(*(c.to_pylist() for c in batch.columns)):
                words, counts = np.frombuffer(words, np.uint64), unpack(counts, np.uint32)
                rows = [(f, words[a:b].tobytes(), pack(counts[a:b])) for f, a, b in _cuts(words, fragments)]
                if rows:
                    yield _batch(rows, schema)

    return work


def _top_words(frequent: int):
    """One fragment's most frequent words."""

    def work(table: pa.Table) -> pa.Table:
        words, place = np.unique(np.frombuffer(b"".join(table.column("words").to_pylist()), np.uint64), return_inverse=True)
        counts = np.concatenate([unpack(x, np.uint32) for x in table.column("counts").to_pylist()])
        total = np.bincount(place, counts, len(words)).astype(np.int64)
        top = np.lexsort((words, -total))[:frequent]
        top = top[total[top] > 0]
        # Big-endian, so that bytes sort as the numbers do.
        return pa.table({"words": pa.array([words[top].tobytes()], pa.binary()), "totals": pa.array([total[top].astype(">i8").tobytes()], pa.binary())})

    return work


def _symbols(words: np.ndarray, tails: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Per dictionary word: its place among the frequent words, or (after these) its tail class."""
    k = len(frequent)
    out = tails.astype(np.int64) + k
    if k and len(words):
        at = np.minimum(np.searchsorted(frequent, words), k - 1)
        hit = frequent[at] == words
        out[hit] = at[hit]
    return out


def _sequence(values: np.ndarray, lengths: np.ndarray, end) -> np.ndarray:
    """Values of all tokens, with ``end`` after each text."""
    return np.insert(values, np.cumsum(lengths), end)


def _bigram_rows(frequent: np.ndarray):
    """A task's bigram counts between symbols over its training texts, a row per first symbol."""
    k = len(frequent)
    size = k + TAILS + 1
    end = size - 1

    def work(batches):
        found = np.zeros(size * size, np.int64)
        for batch in batches:
            for train, lengths, low, high, words, tails in zip(*(c.to_pylist() for c in batch.columns)):
                lengths, train = np.frombuffer(lengths, np.uint32).astype(np.int64), np.frombuffer(train, bool)
                place = _places(low, high)[np.repeat(train, lengths)]
                symbols = _symbols(np.frombuffer(words, np.uint64), unpack(tails, np.uint8), frequent)
                seq = _sequence(symbols[place], lengths[train], end)
                if len(seq):
                    found += np.bincount(np.r_[end, seq[:-1]] * size + seq, minlength=size * size)
        yield from _used_rows(found.reshape(size, size))

    return work


def _used_rows(found: np.ndarray):
    used = np.flatnonzero(found.any(1)).tolist()
    if used:
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([found[r].tobytes() for r in used], pa.binary())], ["first", "counts"]
        )


def _sum_rows(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())
    return pa.table({"first": pa.array([table.column("first")[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def _xlogx(n):
    return np.where(n > 0, n * np.log(np.maximum(n, 1)), 0.0)


def exchange(bigrams: np.ndarray, k: int, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each symbol: the first ``k`` are exchanged between ``classes`` classes, the others keep one each.

    The likelihood of class bigrams is sum n(c, d) log n(c, d) - sum n(c) log n(c) - sum n(d) log n(d); moving a word
    changes one row and one column, so each word's best class is found from its counts with all classes.
    """
    size = len(bigrams)
    classes = max(1, min(classes, k))
    of = np.r_[np.arange(k) % classes, np.arange(size - k) + classes] if k else np.arange(size) + classes
    total = classes + size - k
    n = np.zeros((total, total))
    np.add.at(n, (of[:, None], of[None, :]), bigrams)
    right, left = np.zeros((size, total)), np.zeros((size, total))  # of a word: counts with the class after and before
    for s in range(size):
        right[:, of[s]] += bigrams[:, s]
        left[:, of[s]] += bigrams[s, :]
    # The most frequent words first; they shape the classes.
    order = np.argsort(-bigrams[:k].sum(1), kind="stable")
    for _ in range(rounds):
        moved = 0
        for w in order.tolist():
            c, own = of[w], bigrams[w, w]
            r, q = right[w].copy(), left[w].copy()
            r[c] -= own
            q[c] -= own
            n[c, :] -= r
            n[:, c] -= q
            n[c, c] -= own
            rows, cols = n.sum(1), n.sum(0)
            inner = n[:classes]
            # Adding w to class d: row d gains r, column d gains q, and the cell (d, d) gains all three.
            gain = (_xlogx(inner + r) - _xlogx(inner)).sum(1) + (_xlogx(n[:, :classes].T + q) - _xlogx(n[:, :classes].T)).sum(1)
            d = np.arange(classes)
            cell = n[d, d]
            gain -= _xlogx(cell + r[d]) + _xlogx(cell + q[d]) - 2 * _xlogx(cell)
            gain += _xlogx(cell + r[d] + q[d] + own) - _xlogx(cell)
            gain -= _xlogx(rows[:classes] + r.sum() + own) - _xlogx(rows[:classes])
            gain -= _xlogx(cols[:classes] + q.sum() + own) - _xlogx(cols[:classes])
            best = int(np.argmax(gain))
            if gain[c] >= gain[best] - 1e-9:
                best = c
            n[best, :] += r
            n[:, best] += q
            n[best, best] += own
            if best != c:
                moved += 1
                of[w] = best
                right[:, c] -= bigrams[:, w]
                right[:, best] += bigrams[:, w]
                left[:, c] -= bigrams[w, :]
                left[:, best] += bigrams[w, :]
        if moved <= k // 200:
            break
    return of


def _grown(n, more):
    """How much n log n gains when n does; the difference of two large numbers would lose digits."""
    return more * np.log(np.maximum(n + more, 1)) + n * np.log1p(more / np.maximum(n, 1))


def best_classes(n: np.ndarray, classes: int, of: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The class, of the first ``classes``, that each word moves to with the greatest likelihood of the class bigrams.

    ``n`` are the class bigrams with the words in the classes ``of`` them, none of which is one of the first ``classes``.
    A row of ``counts`` is a word's: by the class before it, by the class after it, and (last) how often it follows
    itself. Words do not see each other's move, so their order and their fragments do not matter. Of equal classes the
    first is taken.
    """
    total = len(n)
    before, after, own = counts[:, :total], counts[:, total:2 * total], counts[:, -1]
    word, beside = np.nonzero(counts[:, :2 * total])
    # Few counts differ, so gains are worked out once for each count and cell, for all classes.
    keys, place = np.unique(counts[word, beside] * (2 * total) + beside, return_inverse=True)
    added, at = (keys // (2 * total))[:, None], keys % (2 * total)
    cells = np.r_[n[:, :classes], n[:classes].T][at]
    gain = np.zeros((len(counts), classes))
    some, start = np.unique(word, return_index=True)
    if len(some):
        gain[some] = np.add.reduceat(_grown(cells, added)[place], start, axis=0)
    # The cell of a class with itself gains from both sides at once.
    both = (before[:, :classes] > 0) & (after[:, :classes] > 0) | (own > 0)[:, None]
    w, d = np.nonzero(both)
    cell, r, q = n[d, d], after[w, d], before[w, d]
    gain[w, d] += _grown(cell + r, q + own[w]) - _grown(cell, q)
    # What leaves the old class may leave a cell that the move adds to.
    for into, out, cells in ((before, after, n), (after, before, n.T)):
        w, d = np.nonzero((into[np.arange(len(of)), of] > 0)[:, None] & (out[:, :classes] > 0))
        cell, more = cells[of[w], d], into[w, of[w]]
        gain[w, d] += _grown(cell - out[w, d], more) - _grown(cell, more)
    sizes, place = np.unique(after.sum(1) + own, return_inverse=True)
    for side in (n.sum(1)[:classes], n.sum(0)[:classes]):
        gain -= _grown(side, sizes[:, None])[place]
    return np.argmax(gain >= gain.max(1, keepdims=True) - 1e-6, 1)


@dataclass
class Start:
    """What the frequent words' exchange leaves; its size is fixed by the parameters."""

    frequent: np.ndarray  # the frequent words by hash
    of: np.ndarray  # class of each symbol
    bigrams: np.ndarray  # between classes
    tokens: int  # training tokens, ends included
    ends: int

    @property
    def classes(self) -> int:
        """How many classes words can join; those of last bytes and of the end come after them."""
        return int(self.of[-1]) - TAILS


def start(chunks: DataFrame, fragments: int) -> Start:
    top = chunks.select("words", "counts").mapInArrow(_count_rows(fragments), "fragment int, words binary, counts binary")
    top = top.groupBy("fragment").applyInArrow(_top_words(FREQUENT), "words binary, totals binary").filter(F.length("words") > 0)
    cut = lambda c: F.substring(c, (F.col("i") * 8 + 1).cast("int"), F.lit(8))
    top = (
        top.select(F.explode(F.expr("sequence(0, cast(length(words) div 8 as int) - 1)")).alias("i"), "words", "totals")
        .select(cut("words").alias("word"), cut("totals").alias("key")).orderBy(F.desc("key"), "word").limit(FREQUENT).collect()
    )
    frequent = np.sort(np.array([np.frombuffer(bytes(r["word"]), np.uint64)[0] for r in top], np.uint64))
    k = len(frequent)
    bigrams = _bigram_table(
        chunks.select("train", "lengths", "low", "high", "words", "tails").mapInArrow(_bigram_rows(frequent), "first int, counts binary"),
        k + TAILS + 1,
    )
    of = exchange(bigrams, k)
    c = int(of[-1]) + 1
    n = np.zeros((c, c), np.int64)
    np.add.at(n, (of[:, None], of[None, :]), bigrams)
    return Start(frequent, of, n, int(bigrams.sum()), int(bigrams[:, -1].sum()))


def _bigram_table(rows: DataFrame, size: int) -> np.ndarray:
    out = np.zeros((size, size), np.int64)
    for r in rows.groupBy("first").applyInArrow(_sum_rows, "first int, counts binary").collect():
        out[r["first"]] = np.frombuffer(bytes(r["counts"]), np.int64)
    return out


_BESIDE = pa.schema([
    ("fragment", pa.int32()), ("chunk", pa.int64()), ("words", pa.binary()), ("tails", pa.binary()), ("counts", pa.binary()),
    ("kinds", pa.binary()), ("beside", pa.binary()), ("times", pa.binary()),
])
_BESIDE_DDL = (
    "fragment int, chunk long, words binary, tails binary, counts binary, kinds binary, beside binary, times binary"
)


def _beside_rows(begun: Start, fragments: int):
    """A chunk's dictionary by fragment; of words that the start left, how often each class stands before and after.

    ``kinds`` says of each word how many different places follow in ``beside``: classes before, classes after (both as
    the start has them), and last the word after itself.
    """
    total = len(begun.bigrams)
    wide = 2 * total + 1
    end = total - 1

    def work(batches):
        for batch in batches:
            for chunk, train, lengths, low, high, words, tails, counts in zip(*(c.to_pylist() for c in batch.columns)):
                lengths, train = np.frombuffer(lengths, np.uint32).astype(np.int64), np.frombuffer(train, bool)
                words, tails, counts = np.frombuffer(words, np.uint64), unpack(tails, np.uint8), unpack(counts, np.uint32)
                symbols = _symbols(words, tails, begun.frequent)
                seq = _sequence(_places(low, high)[np.repeat(train, lengths)], lengths[train], len(words))
                classes = np.r_[begun.of[symbols], end][seq]
                left = np.r_[symbols >= len(begun.frequent), False][seq]
                before, after = np.r_[end, classes[:-1]], np.r_[classes[1:], end] + total
                itself = seq[1:] == seq[:-1]
                after[:-1][itself] = 2 * total
                # Of a word and itself one pair counts once, with the first of the two.
                first = left.copy()
                first[1:] &= ~itself
                keys, times = np.unique(
                    np.concatenate([seq[first] * wide + before[first], seq[left] * wide + after[left]]), return_counts=True
                )
                beside, times = (keys % wide).astype(np.uint8), times.astype(np.uint32)
                kinds = np.bincount(keys // wide, minlength=len(words)).astype(np.uint8)
                at = np.r_[0, np.cumsum(kinds, dtype=np.int64)]
                rows = [
                    (f, chunk, words[a:b].tobytes(), pack(tails[a:b]), pack(counts[a:b]), pack(kinds[a:b]), pack(beside[at[a]:at[b]]), pack(times[at[a]:at[b]]))
                    for f, a, b in _cuts(words, fragments)
                ]
                if rows:
                    yield _batch(rows, _BESIDE)

    return work


def _classify(begun: Start):
    """One fragment: each chunk's words with their totals and classes, and (chunk null) tokens and words by class."""
    total, classes = len(begun.bigrams), begun.classes
    wide = 2 * total + 1
    n = begun.bigrams.astype(float)
    kind = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))

    def work(table: pa.Table) -> pa.Table:
        fragment = table.column("fragment")[0].as_py()
        column = lambda c, t: np.concatenate([unpack(x, t) for x in table.column(c).to_pylist()])
        parts = [np.frombuffer(x, np.uint64) for x in table.column("words").to_pylist()]
        words, first, place = np.unique(np.concatenate(parts), return_index=True, return_inverse=True)
        place = place.astype(np.int32)
        sums = np.bincount(place, column("counts", np.uint32), len(words)).astype(np.int64)
        symbols = _symbols(words, column("tails", np.uint8)[first], begun.frequent)
        of = begun.of[symbols]
        left = np.flatnonzero((symbols >= len(begun.frequent)) & (sums > 0))
        if len(left):
            word = np.repeat(place, column("kinds", np.uint8))
            order = np.argsort(word, kind="stable")
            word, beside, times = word[order], column("beside", np.uint8)[order], column("times", np.uint32)[order]
            for i in range(0, len(left), BLOCK_WORDS):
                block = left[i:i + BLOCK_WORDS]
                a, b = np.searchsorted(word, [block[0], block[-1] + 1])
                row = np.searchsorted(block, word[a:b])
                counts = np.bincount(row * wide + beside[a:b], times[a:b], len(block) * wide).astype(np.int64)
                of[block] = best_classes(n, classes, of[block], counts.reshape(len(block), wide))
        ends = np.cumsum([len(p) for p in parts])
        rows = []
        for chunk, part, e in zip(table.column("chunk").to_pylist(), parts, ends):
            at = place[e - len(part):e]
            rows.append((chunk, fragment, pack(sums[at]), pack(of[at].astype(np.uint8)), None, None))
        held = np.bincount(of, sums, total).astype(np.int64), np.bincount(of[sums > 0], minlength=total)
        rows.append((None, fragment, None, None, *(h.tolist() for h in held)))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kind)], ["chunk", "fragment", "totals", "classes", "tokens", "kinds"])

    return work


_CODED = pa.schema([
    ("ids", pa.list_(pa.int64())), ("train", pa.binary()), ("lengths", pa.binary()), ("classes", pa.binary()),
    ("known", pa.binary()), ("base", pa.binary()), ("emit", pa.binary()),
])
_CODED_DDL = "ids array<long>, train binary, lengths binary, classes binary, known binary, base binary, emit binary"


def _coded_rows(begun: Start, tokens: np.ndarray, kinds: np.ndarray):
    """A chunk's tokens as classes, and by text what its score has besides transitions."""
    room = np.log10(tokens + WORD_ADD * (kinds + 1))
    floor = math.log10(begun.tokens + int(kinds.sum()) + (begun.ends > 0) + 1)
    end = len(begun.bigrams) - 1

    def work(batches):
        for batch in batches:
            for ids, train, lengths, low, high, parts in zip(*(c.to_pylist() for c in batch.columns)):
                sizes = np.frombuffer(lengths, np.uint32).astype(np.int64)
                place = _places(low, high)
                parts = sorted(parts or [], key=lambda p: p["fragment"])
                total = np.concatenate([np.zeros(0, np.int64), *(unpack(p["totals"], np.int64) for p in parts)])
                classes = np.concatenate([np.zeros(0, np.uint8), *(unpack(p["classes"], np.uint8) for p in parts)])
                starts = np.cumsum(sizes + 1) - sizes - 1
                by_text = lambda values, last: np.add.reduceat(_sequence(values[place], sizes, last), starts)  # noqa: E731, B023
                base = by_text(np.log10(total + 1.0) - floor, math.log10(begun.ends + 1.0) - floor)
                emit = by_text(np.log10(total + WORD_ADD) - room[classes], 0.0)
                known = by_text((total > 0).astype(np.int64), int(begun.ends > 0))
                seq = _sequence(classes[place], sizes, end)
                yield _batch([(ids, train, lengths, pack(seq), known.tobytes(), base.tobytes(), emit.tobytes())], _CODED)

    return work


def _class_bigram_rows(size: int):
    """A task's class bigrams over its training texts, a row per first class."""

    def work(batches):
        found = np.zeros(size * size, np.int64)
        for batch in batches:
            for train, lengths, classes in zip(*(c.to_pylist() for c in batch.columns)):
                sizes = np.frombuffer(lengths, np.uint32).astype(np.int64) + 1
                seq = unpack(classes, np.uint8)[np.repeat(np.frombuffer(train, bool), sizes)].astype(np.int64)
                if len(seq):
                    found += np.bincount(np.r_[size - 1, seq[:-1]] * size + seq, minlength=size * size)
        yield from _used_rows(found.reshape(size, size))

    return work


def _score_rows(transition: np.ndarray, tokens: int):
    """``transition``: log10 P(class | class before)."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
        ("base_score", pa.float64()), ("score", pa.float64()),
    ])
    end = len(transition) - 1

    def work(batches):
        for batch in batches:
            for ids, lengths, classes, known, base, emit in zip(*(c.to_pylist() for c in batch.columns)):
                sizes = np.frombuffer(lengths, np.uint32).astype(np.int64) + 1
                seq = unpack(classes, np.uint8)
                moves = np.add.reduceat(transition[np.r_[end, seq[:-1]], seq], np.cumsum(sizes) - sizes)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(sizes), pa.array(np.frombuffer(known, np.int64)),
                    pa.array(np.full(len(ids), tokens)), pa.array(np.frombuffer(base, np.float64)),
                    pa.array(np.frombuffer(emit, np.float64) + moves),
                ], schema=schema)

    return work


def score_texts(docs: DataFrame, train: str = "train") -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)``; ``train`` names the column of rows to learn from."""
    chunks = settle(
        docs.select(docs["doc_id"].cast("long"), docs[train], docs["text"].cast("string")).mapInArrow(_chunk_rows, _CHUNK_DDL), "chunks"
    )
    entries = chunks.agg(F.sum(F.length("words") / 8)).first()[0] or 0
    fragments = max(1, math.ceil(entries / FRAGMENT_WORDS))
    begun = start(chunks, fragments)
    found = settle(
        chunks.select("chunk", "train", "lengths", "low", "high", "words", "tails", "counts")
        .mapInArrow(_beside_rows(begun, fragments), _BESIDE_DDL).groupBy("fragment").applyInArrow(
            _classify(begun), "chunk long, fragment int, totals binary, classes binary, tokens array<long>, kinds array<long>"
        ),
        "classes",
    )
    size = len(begun.bigrams)
    tokens, kinds = np.zeros(size), np.zeros(size)
    by_class = found.filter("chunk IS NULL").select(F.posexplode(F.arrays_zip("tokens", "kinds")).alias("class", "n"))
    for r in by_class.groupBy("class").agg(F.sum("n.tokens").alias("tokens"), F.sum("n.kinds").alias("kinds")).collect():
        tokens[r["class"]], kinds[r["class"]] = r["tokens"], r["kinds"]
    of_chunk = found.filter("chunk IS NOT NULL").groupBy("chunk").agg(F.collect_list(F.struct("fragment", "totals", "classes")).alias("parts"))
    joined = chunks.select("chunk", "ids", "train", "lengths", "low", "high").join(of_chunk.hint("merge"), "chunk", "left").drop("chunk")
    coded = settle(joined.mapInArrow(_coded_rows(begun, tokens, kinds), _CODED_DDL), "coded")
    n = _bigram_table(coded.select("train", "lengths", "classes").mapInArrow(_class_bigram_rows(size), "first int, counts binary"), size)
    transition = np.log10((n + CLASS_ADD) / (n.sum(1, keepdims=True) + CLASS_ADD * size))
    return coded.select("ids", "lengths", "classes", "known", "base", "emit").mapInArrow(
        _score_rows(transition, begun.tokens),
        "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


@query("op8_brown_lm")
def op8_brown_lm(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 7, 2)
    return score_texts(docs.withColumn("train", ~out)).select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
