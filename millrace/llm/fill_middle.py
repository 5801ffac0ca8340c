"""Fill-in-the-middle transformation of whole texts, as one chain of pyarrow.compute calls per batch.

A text's units are its words, each with the white space before it, and white space left at its end. All texts of a
batch are split into list arrays, flattened beside the index of their text, and numbered within it; each unit's role
(prefix, middle, suffix) follows from its number and the text's two cuts; units are filtered by role, put back into
lists, and the pieces joined. Cuts and form come from a hash of the id, so reruns agree and rows need no order.

Texts stay in their partition; a batch is worked on in runs of whole texts of a few MB. ``restore`` takes the output
apart with DataFrame functions.

Defined results: a null text counts as empty, is ``plain`` and has 0 units; a text that holds one of the marks
itself stays plain, so marks in an output are never part of the text; a null id hashes like an empty one; equal rows
give equal results; other columns of the input are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.bytewords import byte_chunks
from millrace.llm.common import SPACE, WORD, load, query

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
KEPT_PLAIN = 50
SPM_OF_100 = 80

_DRAWS = ("h1", "h2", "h3", "h4")


def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All units of the texts one after another, and the index of each unit's text."""
    gaps = pc.split_pattern_regex(texts, WORD)
    words = pc.list_flatten(pc.split_pattern_regex(texts, f"[{SPACE}]+"))
    words = words.filter(pc.greater(pc.binary_length(words), 0))
    parents = pc.list_parent_indices(gaps).to_numpy()
    # A text with k words has k + 1 gaps: each but the last stands before a word.
    ends = np.ones(len(parents), bool)
    ends[:-1] = parents[1:] != parents[:-1]
    behind = pc.replace_with_mask(pa.repeat(_text(""), len(parents)), pa.array(~ends), words)
    joined = pc.binary_join_element_wise(pc.list_flatten(gaps), behind, _text(""))
    kept = pc.greater(pc.binary_length(joined), 0)
    return joined.filter(kept), parents[kept.to_numpy(zero_copy_only=False)].astype(np.int64)


def _joined(pieces: pa.Array, parents: np.ndarray, chosen: np.ndarray, rows: int) -> pa.Array:
    """The chosen units of each text as one text."""
    offsets = np.zeros(rows + 1, np.int64)
    np.cumsum(np.bincount(parents[chosen], minlength=rows), out=offsets[1:])
    lists = pa.LargeListArray.from_arrays(pa.array(offsets), pieces.filter(pa.array(chosen)))
    return pc.binary_join(lists, _text(""))


def rearranged(texts: pa.Array, draws: list[np.ndarray], plain_of_100: int, spm_of_100: int) -> list[pa.Array]:
    """Number of units, form, output, and characters of prefix and middle (null where plain) of each text."""
    rows = len(texts)
    pieces, parents = units(texts)
    n = np.bincount(parents, minlength=rows)
    starts = np.cumsum(n) - n
    ordinals = np.arange(len(parents)) - starts[parents]
    one, other = draws[0] % (n + 1), draws[1] % (n + 1)
    first, last = np.minimum(one, other), np.maximum(one, other)
    before, inside = ordinals < first[parents], ordinals < last[parents]
    prefix = _joined(pieces, parents, before, rows)
    middle = _joined(pieces, parents, inside & ~before, rows)
    suffix = _joined(pieces, parents, ~inside, rows)

    marked = pc.equal(pc.binary_length(texts), 0)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = pc.or_(marked, pc.match_substring(texts, mark))
    plain = pc.or_(marked, pa.array(draws[2] % 100 >= plain_of_100))
    spm = pa.array(draws[3] % 100 < spm_of_100)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    p, s, m = _text(PREFIX), _text(SUFFIX), _text(MIDDLE)
    as_spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, _text(""))
    as_psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, _text(""))
    output = pc.if_else(plain, texts, pc.if_else(spm, as_spm, as_psm))
    none = pa.scalar(None, pa.int64())
    sizes = [pc.if_else(plain, none, pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
    return [pa.array(n, pa.int64()), form.cast(pa.string()), output.cast(pa.string()), *sizes]


def fill_middle(
    docs: DataFrame, seed: int = SEED, plain_of_100: int = KEPT_PLAIN, spm_of_100: int = SPM_OF_100
) -> DataFrame:
    """``(doc_id, n, form, output, prefix_chars, middle_chars)``, one row per row of ``docs``.

    ``plain_of_100`` of 100 texts are rearranged, ``spm_of_100`` of 100 of those suffix first.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(docs["doc_id"].cast("string"), F.lit(""))), 256)
    drawn = docs.select(
        docs["doc_id"].alias("doc_id"), docs["text"].cast("string").alias("text"),
        *[F.conv(F.substr(key, F.lit(8 * i + 1), F.lit(8)), 16, 10).cast("bigint").alias(h) for i, h in enumerate(_DRAWS)],
    )
    names = ["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"]

    def work(batches):
        for batch in batches:
            texts = batch.column(1).fill_null("").cast(pa.large_string())
            draws = [batch.column(2 + k).to_numpy() for k in range(len(_DRAWS))]
            for i, j, _, _ in byte_chunks(batch.column(1)):
                done = rearranged(texts[i:j], [d[i:j] for d in draws], plain_of_100, spm_of_100)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], *done], names)

    fields = [T.StructField(c, t) for c, t in zip(names[1:], (T.LongType(), T.StringType(), T.StringType(), T.LongType(), T.LongType()))]
    return drawn.mapInArrow(work, T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *fields]))


def restore(rows: DataFrame) -> DataFrame:
    """Add ``restored``: the text of ``output``, from itself and ``form`` alone."""
    head, middle = F.split_part("output", F.lit(MIDDLE), F.lit(1)), F.split_part("output", F.lit(MIDDLE), F.lit(2))

    def between(mark):
        cut = F.split_part(head, F.lit(mark), F.lit(1))
        return F.substr(cut, F.lit(len(mark) + 1)), F.split_part(head, F.lit(mark), F.lit(2))

    prefix, suffix = between(SUFFIX)
    last, first = between(PREFIX)
    return rows.withColumn(
        "restored",
        F.when(F.col("form") == "psm", F.concat(prefix, middle, suffix))
        .when(F.col("form") == "spm", F.concat(first, middle, last)).otherwise(F.col("output")),
    )


@query(
    "op11_fill_middle",
    r"""
    WITH cut AS (
        SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || doc_id) AS h,
               regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
        FROM documents
    ), drawn AS (
        SELECT doc_id, body, u, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
               ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
        FROM cut
    ), formed AS (
        SELECT doc_id, body, n,
               array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
               array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
               array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS s,
               CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
                         OR h3 % 100 >= 50 THEN 'plain'
                    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
        FROM drawn
    )
    SELECT doc_id, CAST(n AS BIGINT) AS n, form,
           CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(body) AS restored_sha256
    FROM formed
    """,
)
def op11_fill_middle(spark, sf_dir):
    rows = restore(fill_middle(load(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"), F.sha2(F.col("restored"), 256).alias("restored_sha256"),
    )
