"""Edge cases of the fill-in-the-middle transformation, the secret scan, the ranked search and the language model's classes."""

import base64
import hashlib
import json
import math
import random
import re
import sys
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from millrace.llm import brown_lm, fill_middle, ranked_search, secret_scan
from millrace.llm.bytewords import byte_chunks, hashed_words
from millrace.session import batches_within
from test_llm_cases import clashing, none, odd, rows, table  # noqa: F401

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


# --- fill in the middle -----------------------------------------------------------------------------------------


def brute_fill(doc_id, text, plain_of_100=50):
    text, h = text or "", hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    u = UNIT.findall(text)
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= plain_of_100:
        return len(u), "plain", text, None, None
    if h4 % 100 < 80:
        return len(u), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(u), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def test_units_of_random_texts():
    draw = random.Random(5)
    texts = ["".join(draw.choices(" \t\n\x0b\x00\x85aéß\U0001F600<>PSM", k=draw.randrange(14))) for _ in range(3000)] + ["", " "]
    found, parents = fill_middle.units(pa.array(texts, pa.large_string()))
    of = [[] for _ in texts]
    for unit, i in zip(found.to_pylist(), parents.tolist()):
        of[i].append(unit)
    assert of == [UNIT.findall(t) for t in texts]


@pytest.mark.parametrize("make", [lambda d: d, clashing])
@pytest.mark.parametrize("plain_of_100", [0, 50, 100])
def test_fill_middle(odd, make, plain_of_100):  # noqa: F811
    got = rows(fill_middle.restore(fill_middle.fill_middle(make(odd), plain_of_100=plain_of_100)))
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    names = ("n", "form", "output", "prefix_chars", "middle_chars")
    want = [(i, *brute_fill(i, t, plain_of_100), t or "") for i, t in texts]
    assert sorted(map(repr, ((r["doc_id"], *(r[c] for c in names), r["restored"]) for r in got))) == sorted(map(repr, want))


def test_texts_that_hold_a_mark_stay_plain(spark, none):  # noqa: F811
    docs = table(spark, [(i, f"a b {mark} c < S> <p> d", "en", "a", 1) for i in range(40) for mark in ("<P>", "<S>", "<M>", "<<", "S>")])
    got = rows(fill_middle.restore(fill_middle.fill_middle(docs)))
    assert all(r["form"] == "plain" for r in got if re.search("<[PSM]>", r["restored"]))
    assert {r["form"] for r in got} == {"plain", "psm", "spm"} and all(r["restored"].startswith("a b ") for r in got)
    assert fill_middle.fill_middle(none).count() == 0


# --- secrets ----------------------------------------------------------------------------------------------------


def brute_secrets(text):
    """The three patterned kinds, as matched one after another."""
    kw = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    kinds = (
        (rf"(?:{kw})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[1]) >= 12),
        ("AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18), ("[0-9a-f]+", lambda m: len(m[0]) >= 16),
    )
    found = sorted((m.start(), k, m.end()) for k, (p, fits) in enumerate(kinds) for m in re.finditer(p, text or "") if fits(m))
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in found]


def found_in(text):
    return [(kind, text[start:end]) for kind, start, end, _ in secret_scan.spans_of(pa.array([text], pa.large_string()))[0]]


def der(tag, body):
    size = len(body)
    head = bytes([size]) if size < 128 else (lambda b: bytes([0x80 | len(b)]) + b)(size.to_bytes((size.bit_length() + 7) // 8))
    return bytes([tag]) + head + body


def der_int(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1))


def ssh_string(body):
    return len(body).to_bytes(4) + body


P, Q = random.Random(1).getrandbits(512) | 1, random.Random(2).getrandbits(500) | 1
RSA = der(0x30, b"".join(map(der_int, (0, P * Q, 65537, 12345, P, Q, 1, 2, 3))))
EC = der(0x30, der_int(1) + der(4, bytes(range(32))) + der(0xA0, der(6, b"\x2a\x86\x48")))
WRAPPED = der(0x30, der_int(0) + der(0x30, der(6, b"\x2b\x65\x70")) + der(4, der(4, bytes(range(32)))))
LOCKED = der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d01050d"))) + der(4, bytes(48)))
OPENSSH = b"openssh-key-v1\0" + ssh_string(b"none") + ssh_string(b"none") + ssh_string(b"") + (1).to_bytes(4) + ssh_string(
    ssh_string(b"ssh-ed25519") + ssh_string(bytes(32))) + ssh_string(bytes(136))
KEYS = {"rsa": RSA, "elliptic curve": EC, "wrapped": WRAPPED, "encrypted wrapped": LOCKED, "openssh": OPENSSH}


def b64(data, url=False):
    return (base64.urlsafe_b64encode if url else base64.b64encode)(data).decode()


def lines(text, width=64, end="\n"):
    return end.join(text[i:i + width] for i in range(0, len(text), width))


def jwt(head, size, payload=b'{"sub": 1}'):
    return ".".join(b64(x, True).rstrip("=") for x in (json.dumps(head).encode(), payload, bytes(range(97, 97 + 26)) * 12)[:2]) + "." + b64(
        bytes(i % 251 for i in range(size)), True).rstrip("=")


@pytest.mark.parametrize("kind", KEYS)
def test_keys_are_found_in_every_wrapping(kind):
    data = KEYS[kind]
    plain = b64(data)
    forms = [plain, b64(data, True).rstrip("="), lines(plain), lines(plain, 70, "\\n"), lines(plain, 64, "\r\n  "), data.hex(), data.hex().upper()]
    if kind != "openssh":
        forms.append(":".join(f"{x:02x}" for x in data))
    else:
        forms = forms[:5]  # its lengths are looked for in base64, as it is always written
    for form in forms:
        text = f"żó see <{form}> and MORE words\nMostly1234567890abcdef here"
        assert [x for k, x in found_in(text) if k == "key"] == [form], form[:30]
    armoured = f"-----BEGIN PRIVATE KEY-----\n{lines(plain)}\n-----END PRIVATE KEY-----\nMuch later words that follow it all"
    assert [x for k, x in found_in(armoured) if k == "key"] == [lines(plain)]


@pytest.mark.parametrize("kind", KEYS)
def test_damaged_keys_and_public_ones_are_not_reported(kind):
    data = bytearray(KEYS[kind])
    cut = bytes(data[:-3])
    data[1 if kind != "openssh" else 18] ^= 0x41
    public = der(0x30, der(0x30, der(6, b"\x2a\x86\x48") + der(5, b"")) + der(3, b"\0" + der(0x30, der_int(P * Q) + der_int(65537))))
    for form in (bytes(data), cut, public, der(0x30, der_int(7) * 9), der(0x30, b"".join(map(der_int, (0, P * Q + 2, 3, 4, P, Q, 1, 2, 3))))):
        for text in (f"key {b64(form)} end", f"key {form.hex()} end"):
            assert [k for k, _ in found_in(text) if k not in secret_scan.BASE] == []


def test_hostile_texts_take_linear_time():
    parts = ("b3BlbnNzaC1rZXktdjEA\n", b64(OPENSSH[:40]) + "\n", b64(RSA[:90]) + "\n", "ey" * 20 + ".", "token=", "3082" * 8 + "\n", "M" * 16 + "\n", "basic " * 3)
    began = time.perf_counter()
    for part in parts:
        found_in(part * (1_000_000 // len(part)))
    assert time.perf_counter() - began < 30


def test_password_armour():
    body = lines(b64(bytes(range(200)) + bytes(56)))
    text = f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: DES-EDE3-CBC,0123456789ABCDEF\n\n{body}\n-----END RSA PRIVATE KEY-----"
    assert [x.strip() for k, x in found_in(text) if k == "key"] == [body]


def test_signed_tokens_need_header_payload_and_signature():
    good = [jwt({"alg": "HS256"}, 32), jwt({"typ": "JWT", "alg": "RS256"}, 256), jwt({"alg": "ES384", "x": [1]}, 96)]
    bad = [jwt({"alg": "HS256"}, 31), jwt({"alg": "none"}, 32), jwt({"typ": "x"}, 32), jwt({"alg": ["HS256"]}, 32), jwt({"alg": "HS256"}, 32, b"[1]"), "eyes.on.you"]
    text = " ; ".join(good + bad)
    assert [x for k, x in found_in(text) if k == "token"] == good


def test_basic_credentials_and_checksums():
    part = "abcDEF0123456789abcDEF01234567"
    n, sign = zlib.crc32(part.encode()), ""
    while n:
        n, k = divmod(n, 62)
        sign = secret_scan._BASE62[k] + sign
    sign = sign.rjust(6, "0")
    text = f"Authorization: Basic {b64(b'ann:open sesame')} and basic information ghp_{part}{sign} ghp_{part}{sign[::-1]}"
    got = [(k, x) for k, x in found_in(text) if k in ("basic", "checked")]
    assert got == [("basic", b64(b"ann:open sesame")), ("checked", f"ghp_{part}{sign}")]


def test_patterned_spans_of_random_texts():
    draw = random.Random(9)
    pieces = ["token", "ToKen", "api_key", "APIKEY", "\u212aey", "\u017fecret", "secret", "password", "=", ":", " ", '"', "'", "abcdef012345", "0" * 16, "AKIA", "ABCDEFGH",
              "12345678", "x", "ż", "\n", "é😀", "a/b+c=d-e.f_g", "deadbeefdeadbeef"]
    texts = ["".join(draw.choices(pieces, k=draw.randrange(30))) for _ in range(4000)]
    for text, spans in zip(texts, secret_scan.spans_of(pa.array(texts, pa.large_string()))):
        assert [f"{k}:{a}:{b}" for k, a, b, _ in spans if k in secret_scan.BASE] == brute_secrets(text), text


@pytest.mark.parametrize("make", [lambda d: d, clashing])
def test_find_secrets(spark, odd, none, make):  # noqa: F811
    extra = table(spark, [(20, f"x token: {'z' * 12} {b64(EC)}", "en", "a", 1), (20, f"x token: {'z' * 12} {b64(EC)}", "en", "a", 1), (21, "w " * 500_000 + "AKIA" + "Q7" * 8, "en", "a", 1)])
    got = rows(secret_scan.find_secrets(make(odd.unionByName(extra))))
    assert len(got) == odd.count() + 3
    of = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["found"]] for r in got}
    assert of[21] == [("access", 1_000_000, 1_000_020)] and of[20] == [("assign", 2, 21), ("key", 22, 22 + len(b64(EC)))]
    assert all(of[i] == [] for i in of if i not in (20, 21))
    assert secret_scan.find_secrets(none).count() == 0


# --- ranked search ----------------------------------------------------------------------------------------------


def brute_search(docs, items, top=10):
    """``(item_id, rank, doc_id, score)`` by scoring every document for every item."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def terms(text):
        return term.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    documents, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i].update(terms(t))
    out = []
    for item, own in wanted.items():
        scores = []
        for i, c in counted:
            m = 10 + 90 * c.total() * documents // total
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if c[t]
            )
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[:2], x[2] or 0))[:top])]
    return sorted(out, key=repr)


def searched(docs, items, **kw):
    index = ranked_search.build(docs, kw.pop("shard_bytes", ranked_search.SHARD_BYTES))
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in ranked_search.search(index, items, **kw).collect()), key=repr)


ITEMS = "item_id long, text string"


@pytest.mark.parametrize("shard_bytes", [1, 3000, 1 << 24])
def test_ranked_search_equals_brute_force(spark, shard_bytes):
    draw = random.Random(3)
    words = [f"W{i}" for i in range(40)] + ["ü", "日本", "x_y", "a-b", "\x00", "é1"]
    docs = [(i, " ".join(draw.choices(words, [1 / (k + 1) for k in range(len(words))], k=draw.randrange(60)))) for i in range(400)]
    docs += [(i + 500, docs[7][1]) for i in range(60)] + [(3, docs[9][1]), (3, docs[9][1]), (None, docs[7][1]), (None, "w39")]
    draw.shuffle(docs)
    items = [(i, " ".join(draw.choices(words, k=draw.randrange(30)))) for i in range(60)] + [(5, "w0 w39"), (70, docs[0][1])]
    got = searched(table(spark, docs, "doc_id long, text string").repartition(3), table(spark, items, ITEMS), shard_bytes=shard_bytes)
    assert got == brute_search(docs, items)


def test_ranked_search_in_blocks_gives_the_same(spark):
    draw = random.Random(4)
    docs = [(i, " ".join(f"t{draw.randrange(30)}" for _ in range(draw.randrange(1, 20)))) for i in range(200)]
    items = [(i, f"t{i} t{i + 1} t{i + 7}") for i in range(25)]
    frame, asked = table(spark, docs, "doc_id long, text string"), table(spark, items, ITEMS)
    assert searched(frame, asked, block_terms=20, top=3) == brute_search(docs, items, 3)


@pytest.mark.parametrize("make", [lambda d: d, clashing])
def test_ranked_search_of_odd_texts(spark, odd, none, make):  # noqa: F811
    items = [(1, "word1 thing2 ONE"), (2, None), (3, ""), (None, "mail w59999"), (4, "-- ?"), (5, "日本語"), (6, "unheard of")]
    asked = table(spark, items, ITEMS)
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert searched(make(odd), asked.withColumn("rank", asked["item_id"]).withColumn("term", asked["text"])) == brute_search(docs, items)
    assert searched(none, asked) == [] and searched(odd, table(spark, [], ITEMS)) == []
    assert searched(table(spark, [(1, " - "), (2, None)], "doc_id long, text string"), asked) == []


def test_treaps_survive_writing():
    draw = np.random.default_rng(1)
    for rows, columns, n in ((1, 1, 1), (1, 900, 300), (900, 1, 300), (1000, 37, 5000), (3, 3, 9)):
        cells = np.unique(draw.integers(0, rows * columns, n))
        r, c = np.divmod(cells, columns)
        impact = draw.integers(1, 1_000_000, len(cells))
        treap = ranked_search.Treap.of(r, c, impact)
        leaf = treap.masks == 0
        assert sorted(zip(treap.rows, treap.columns, treap.maxima[leaf])) == sorted(zip(r, c, impact))
        assert (treap.maxima[treap.parents()] >= treap.maxima[1:]).all() and treap.maxima[0] == impact.max()
    ids, texts = pa.array([5, None, 2]), pa.array(["a b", "b b c", "c d"], pa.large_string())
    row = ranked_search.shard_of(ids, texts, 3, 7)
    back = ranked_search.treap_of({**row, "doc_ids": None})
    assert row["doc_ids"].to_pylist() == [2, 5, None] and (np.diff(np.frombuffer(row["frequencies"], np.int32)) <= 0).all()
    lengths, found = np.array([2, 2, 3])[back.columns], back.maxima[back.masks == 0]
    once, twice = (ranked_search.impacts(np.full(6, k), lengths, 3, 7) for k in (1, 2))
    assert len(found) == 6 and (found == once).sum() == 5 and (found == twice).sum() == 1


def test_shards_stand_in_row_groups_of_their_own(spark):
    """A task that reads one of a file's shards does not hold all of them."""
    draw = np.random.default_rng(2)
    docs = [(i, " ".join(map(str, draw.integers(0, 1 << 40, 80_000)))) for i in range(24)]
    index = ranked_search.build(table(spark, docs, "doc_id long, text string").coalesce(1))
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.shards.inputFiles()]
    groups = [(m.row_group(k).num_rows, m.row_group(k).total_byte_size) for m in files for k in range(m.num_row_groups)]
    assert len(groups) > 2 and max(size / n for n, size in groups) > ranked_search.BATCH_BYTES and max(n for n, _ in groups) == 1
    batches = index.shards.mapInArrow(lambda batches: (pa.RecordBatch.from_pylist([{"n": b.num_rows}]) for b in batches), "n bigint")
    with batches_within(spark, ranked_search.BATCH_BYTES):
        assert [r["n"] for r in batches.collect()] == [1] * len(groups)


def test_a_read_shard_takes_few_bytes_a_node():
    cells = np.unique(np.random.default_rng(3).integers(0, 30_000 * 1_000, 300_000))
    treap = ranked_search.Treap.of(*np.divmod(cells, 1_000), np.ones(len(cells), np.int64))
    gaps = np.zeros(len(treap.masks), np.int32)
    gaps[0] = 1
    row = {"side": treap.side, "masks": treap.masks.tobytes(), "maxima": gaps.tobytes()}
    row |= {"leaf_rows": treap.rows.astype(np.int32).tobytes(), "leaf_columns": treap.columns.astype(np.int32).tobytes()}
    tracemalloc.start()
    try:
        back = ranked_search.treap_of(row)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (back.maxima == 1).all() and (back.first == treap.first).all() and most < 16 * len(treap.masks)


# --- language model ---------------------------------------------------------------------------------------------


def test_rare_words_get_classes_from_their_neighbours(spark):
    """Two kinds of text that share no word: a rare word of one kind fits texts of that kind only."""
    draw = random.Random(2)
    texts = []
    for kind in "ab":
        often = [f"{kind}{i}" for i in range(540)] * 12
        draw.shuffle(often)
        for i in range(30):
            for _ in range(4):
                often.insert(draw.randrange(len(often)), f"rare{kind}{i}z")
        texts += [" ".join(often[i:i + 12]) for i in range(0, len(often), 12)]
    asked = [f"{a}{i} rare{b}{i}z {a}{i + 9}" for i in range(30) for a in "ab" for b in "ab"]
    docs = table(spark, [(i, t, i < len(texts)) for i, t in enumerate(texts + asked)], "doc_id long, text string, train boolean")
    score = {r["doc_id"]: r["score"] for r in rows(brown_lm.score_texts(docs))}
    got = np.array([score[len(texts) + i] for i in range(len(asked))]).reshape(30, 2, 2)
    assert (got[:, 0, 0] > got[:, 0, 1] + 1).mean() > 0.9 and (got[:, 1, 1] > got[:, 1, 0] + 1).mean() > 0.9


def likelihood(n):
    x = lambda v: np.where(v > 0, v * np.log(np.maximum(v, 1)), 0).sum()
    return x(n) - x(n.sum(0)) - x(n.sum(1))


def class_table(tokens, of, size):
    n = np.zeros((size, size), np.int64)
    np.add.at(n, ([of[a] for a in tokens[:-1]], [of[b] for b in tokens[1:]]), 1)
    return n


def brute_class(tokens, of, size, classes, word):
    """Moves the word to each class in turn and looks at the likelihood of the whole text."""
    got = [likelihood(class_table(tokens, {**of, word: d}, size)) for d in range(classes)]
    return int(np.argmax(got >= np.max(got) - 1e-6))


def test_best_class_by_brute_force():
    draw = np.random.default_rng(3)
    tokens = draw.zipf(1.3, 1500)
    tokens = [0, *np.where(tokens > 60, 0, tokens).tolist(), 40, 40, 40, 0]
    of = {w: 8 if w == 0 else w % 5 if w < 9 else 5 + w % 3 for w in range(61)}
    words = sorted(w for w in set(tokens) if w > 8)
    counts = np.zeros((len(words), 19), np.int64)
    for i, w in enumerate(words):
        for a, b in zip(tokens, tokens[1:]):
            if b == w:
                counts[i, 18 if a == w else of[a]] += 1
            if a == w and b != w:
                counts[i, 9 + of[b]] += 1
    got = brown_lm.best_classes(class_table(tokens, of, 9).astype(float), 5, np.array([of[w] for w in words]), counts)
    assert got.tolist() == [brute_class(tokens, of, 9, 5, w) for w in words] and len(set(got.tolist())) > 2 and counts[:, 18].any()


def test_class_scores_by_brute_force(spark, monkeypatch):
    """Classes and scores of a small corpus worked out text by text; several chunks and fragments."""
    monkeypatch.setattr(brown_lm, "FREQUENT", 25)
    monkeypatch.setattr(brown_lm, "FRAGMENT_WORDS", 60)
    monkeypatch.setattr(brown_lm, "BLOCK_WORDS", 7)
    draw = random.Random(11)
    vocabulary = [f"w{i}" if i % 3 else f"W{i}é" for i in range(150)]
    weight = [1 / (i + 1) for i in range(150)]
    texts = [" ".join(draw.choices(vocabulary, weight, k=draw.randrange(40))) for _ in range(90)] + [None, "", "new words w3", "w90 w90 w90"]
    train = [i % 5 != 2 for i in range(len(texts))]
    docs = table(spark, [(i, t, k) for i, (t, k) in enumerate(zip(texts, train))], "doc_id long, text string, train boolean")
    got = {r["doc_id"]: r for r in rows(brown_lm.score_texts(docs.repartition(3)))}

    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    known = sorted({w for ws in words for w in ws})
    ((_, _, data, offsets),) = byte_chunks(pa.array(known, pa.large_string()))
    hashes, _, last = hashed_words(data, offsets)
    hashes, tail = dict(zip(known, hashes.tolist())), {w: int(x) % 32 for w, x in zip(known, last)}
    counts = Counter(w for ws, k in zip(words, train) if k for w in ws)
    frequent = sorted(counts, key=lambda w: (-counts[w], hashes[w].to_bytes(8, "little")))[:25]
    place = {w: i for i, w in enumerate(sorted(frequent, key=hashes.get))}
    trained = [None, *(w for ws, k in zip(words, train) if k for w in [*ws, None])]

    symbols = {None: 57} | {w: place.get(w, 25 + tail[w]) for w in known}
    of = brown_lm.exchange(class_table(trained, symbols, 58), 25)
    begun = {w: of[s] for w, s in symbols.items()}
    size, classes = of[57] + 1, of[57] - 32
    moved = {w: brute_class(trained, begun, size, classes, w) for w in counts if w not in place}
    final = {**begun, **moved}
    n = class_table(trained, final, size)
    transition = np.log10((n + brown_lm.CLASS_ADD) / (n.sum(1, keepdims=True) + brown_lm.CLASS_ADD * size))
    room = np.zeros(size)
    for w, c in counts.items():
        room[final[w]] += c + brown_lm.WORD_ADD
    room = np.log10(room + brown_lm.WORD_ADD)
    for i, ws in enumerate(words):
        of_text = [final[w] for w in [None, *ws, None]]
        want = sum(transition[a, b] for a, b in zip(of_text, of_text[1:]))
        want += sum(math.log10(counts[w] + brown_lm.WORD_ADD) - room[final[w]] for w in ws)
        assert math.isclose(got[i]["score"], want, rel_tol=1e-9)
        assert got[i]["n_known"] == sum(counts[w] > 0 for w in ws) + 1 and got[i]["train_tokens"] == len(trained) - 1
    assert {final[w] for w in counts} <= set(range(classes)) and len(counts) > 100
