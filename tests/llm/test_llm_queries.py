"""The registered queries over the smallest tables: against their SQL, or against brute force where SQL cannot say it."""

import hashlib
import html
import math
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline
from millrace.llm.queries import ORACLE, QUERIES
from oracle import differences
from test_llm_cases import WORD, brute_base, brute_components
from test_llm_further_cases import brute_secrets

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()


def result(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, SF_DIR).collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    assert differences(spark, SF_DIR, QUERIES[name], ORACLE[name]) == []


def test_op1(spark, docs):
    got = {r["doc_id"]: r for r in result(spark, "op1_pii_boosting")}
    for d in docs:
        want = brute_base(d["text"])
        assert hashlib.sha256(",".join(want).encode()).hexdigest() == got[d["doc_id"]]["base_sha256"]
        assert set(want) <= set(got[d["doc_id"]]["spans"].split(","))


def test_op2_and_op4_held_out_accuracy(spark, docs):
    lang = {r["doc_id"]: r for r in result(spark, "op2_language_bytes")}
    own = [d for d in docs if lang[d["doc_id"]]["held_out"]]
    assert sum(lang[d["doc_id"]]["lang_pred"] == d["lang"] for d in own) >= 0.9 * len(own)
    toxic = {r["doc_id"]: r for r in result(spark, "op4_toxicity_nearest")}
    assert len(toxic) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in toxic.values())


def test_op3(spark, docs):
    want = brute_components(docs)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result(spark, "op3_ngram_jaccard")} == want


def test_op8(spark, docs):
    tokens = {d["doc_id"]: [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), d["text"] or "")), None] for d in docs}
    counts = Counter()
    for i, w in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    got = result(spark, "op8_brown_lm")
    for r in got:
        w = tokens[r["doc_id"]]
        assert math.isclose(r["base_score"], sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_op10(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in result(spark, "op10_page_text"):
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [
            " ".join(html.unescape(re.sub("<[^>]+>", lambda m: " " if m[0] == "<br>" else "", b)).split())
            for b in re.split("</?(?:h1|p)>", article)
        ]
        assert r["text"] == "\n\n".join(b for b in blocks if b)


def test_op12(spark, docs):
    texts = {d["doc_id"]: d["text"] for d in docs}
    got = result(spark, "op12_secret_scan")
    assert len(got) == len(texts)
    for r in got:
        want = brute_secrets(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex")]
        assert [s for s in r["spans"].split(",") if s.split(":")[0] in ("assign", "access", "hex")] == want


def check_pieces(rows):
    sequences, of = defaultdict(list), defaultdict(int)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        of[r["doc_id"]] += r["length"]
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(sum(n for _, n in own) == 1024 for own in sequences.values()) >= len(sequences) - 1
    return of


def test_op9(spark, docs):
    rows = result(spark, "op9_packing")
    of = check_pieces(rows)
    assert of == {r["doc_id"]: r["doc_tokens"] for r in rows} and len(of) == len(docs)


def test_pipeline(spark, docs):
    from millrace.session import settle

    frame, kept = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        names = frame.columns
        frame = settle(stage(spark, frame, SF_DIR), name)
        if name != "packing":
            assert frame.columns == names
            kept[name] = frame.collect()
    texts = [d["text"] for d in kept["exact_dedup"]]
    assert len(texts) == len(set(texts)) == len({d["text"] for d in kept["toxicity"]})
    components = brute_components(kept["exact_dedup"])
    assert Counter(components[d["doc_id"]][1] for d in kept["ngram_jaccard"]).most_common(1)[0][1] == 1
    assert len(kept["ngram_jaccard"]) == len({c for _, c in components.values()})
    check_pieces([r.asDict() for r in frame.collect()])
