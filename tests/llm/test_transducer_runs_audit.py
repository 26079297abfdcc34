"""Operators 11 to 13 against the library and brute force."""

import base64
import hashlib
import random
import re
import zlib
from itertools import permutations

import public_tokenizers as tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from churnpanel.llm import queries as llm
from churnpanel.llm.bpe_transducer import (
    Decoder, Encoder, Transducer, Utf8Machine, merge_steps, read_ranks, with_decoded_text, with_token_ids,
)
from churnpanel.llm.filter_audit import RULES, audit, document_counts, path_counts
from churnpanel.llm.periodic_runs import LastEnds, SuffixTree, collapse, sequence_runs, text_runs, with_runs

PATH = tokenizers.path("byte_bpe_50k.tiktoken")
WORD = r"[^\x20\x09-\x0D]+"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(PATH)


@pytest.fixture(scope="module")
def library():
    found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=found, special_tokens={})


AWKWARD = ["", " ", "\n\n  x", "don't THEY'RE", "a\x1c\x1db \x85c d᠎", "<|endoftext|>", "0" * 50, "\x00\x7f", "é" * 40 + "漢字🙂🙂"]


def texts(count=1500, seed=4):
    r = random.Random(seed)
    pools = ["abcdefgh ", "aab", "  \n\t\x0b\r\x1c\x85 ​﻿", "éßüñ漢字日本語🙂🙃", "'sTre'll 0123²½",
             "".join(map(chr, range(0x20, 0x250))), "etaoin shrdlu"]
    return AWKWARD + ["".join(r.choice(r.choice(pools)) for _ in range(r.randint(0, 70))) for _ in range(count)]


# --- 11: transducer

def test_encoder_equals_library(ranks, library):
    encoder, decoder = Encoder(ranks, tokenizers.PATTERN), Decoder(ranks)
    for t in texts():
        ids = encoder.encode(t)
        assert ids == library.encode_ordinary(t)
        assert decoder.decode(ids) == t


def test_small_tables_give_the_same(ranks, library):
    """Full tables of states, pairs and pieces only cost time."""
    encoder = Encoder(ranks, tokenizers.PATTERN, memory=50, pieces=20)
    for t in texts(300, 9):
        assert encoder.encode(t) == library.encode_ordinary(t)
    assert len(encoder.machine.states) <= 50 and len(encoder.known) <= 20 and encoder.machine.missed


def test_lookahead_is_bounded(ranks):
    """Tokens leave while a long piece is read: what is pending never exceeds a few of them."""
    machine, r = Transducer(ranks), random.Random(2)
    state, most = machine.begin, 0
    for _ in range(20000):
        state, _ = machine._move(state, r.choice(b"theandrisong"))
        most = max(most, *(len(p) for p, _ in state[1:]))
    assert most <= max(map(len, ranks))


def test_adjacency_equals_merging(ranks):
    machine, r = Transducer(ranks), random.Random(3)
    some = r.sample(sorted(ranks.values()), 300)
    for a in some[:120]:
        for b in some:
            parts, _ = merge_steps(machine.token[a] + machine.token[b], ranks)
            assert machine.adjacent(a, b) == ([ranks[p] for p in parts] == [a, b])


def test_unordered_ranks():
    """Ranks in which a merge becomes possible after a higher one."""
    r = random.Random(8)
    for _ in range(60):
        ranks = {bytes([b]): 1000 + b for b in range(256)}
        made = [b"a", b"b", b"c"]
        for _ in range(12):
            made.append(r.choice(made) + r.choice(made))
        made = [t for t in dict.fromkeys(made[3:]) if len(t) < 12]
        ranks |= dict(zip(made, r.sample(range(900), len(made))))
        machine = Transducer(ranks)
        for _ in range(60):
            piece = bytes(r.choice(b"abc") for _ in range(r.randint(1, 30)))
            if piece not in ranks:
                assert machine.encode(piece) == [ranks[p] for p in merge_steps(piece, ranks)[0]]


def test_utf8_machine():
    r = random.Random(5)
    for _ in range(3000):
        data = bytes(r.choice([r.randrange(256), 0x80, 0xE2, 0x82, 0xF0, 0x9F, 65]) for _ in range(r.randint(0, 12)))
        machine = Utf8Machine()
        got = "".join(machine.feed(data[i: i + 1]) for i in range(len(data))) + machine.close()
        assert got == data.decode(errors="replace")


def test_long_text(ranks, library):
    text = "word and words " * 160_000 + "x" * 100_000  # over 2 MB, cut into blocks
    ids = Encoder(ranks, tokenizers.PATTERN).encode(text)
    assert len(text) > 2_000_000 and ids == library.encode_ordinary(text) and Decoder(ranks).decode(ids) == text


def test_encoding_rows(spark, library):
    rows = [(i, t, "kept", None) for i, t in enumerate(texts(40))] + [(None, "null key", "k", None), (3, None, None, 1), (3, None, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, token_ids string, decoded int")
    got = with_decoded_text(with_token_ids(df, PATH, tokenizers.PATTERN), PATH)
    assert got.columns == ["doc_id", "text", "token_ids", "decoded"]
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.token_ids == library.encode_ordinary(r.text or "") and r.decoded == (r.text or "")
    assert with_token_ids(df.limit(0), PATH, tokenizers.PATTERN).count() == 0
    unknown = spark.createDataFrame([(1, None), (2, [])], "doc_id long, token_ids array<int>")
    assert [r.decoded for r in with_decoded_text(unknown, PATH).collect()] == ["", ""]


def test_op11(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {}
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), sha(" ".join(map(str, ids))), sha(r.text or ""))
    got = {r[0]: tuple(r[1:]) for r in llm.op11_bpe_transducer(spark, sf_dir).collect()}
    assert got == want


# --- 12: periodic runs

def brute_runs(w, least=12):
    out, n = [], len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, 2 * q) and not any(
                    all(w[k] == w[k + p] for k in range(i, i + size - p)) for p in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    r, found = random.Random(3), 0
    for _ in range(1500):
        w = [r.randrange(r.choice([1, 2, 3, 5, 40])) for _ in range(r.randint(0, 90))]
        if r.random() < 0.6 and len(w) > 14:
            a = r.randrange(len(w))
            p = 1 + (len(w) - a) // r.randint(2, 9)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        want = brute_runs(w)
        found += len(want)
        assert text_runs(w) == want
        assert sorted(sequence_runs(w)) == sorted(want)  # without the cut by hashes
        gone = {i for s, n, p in want for i in range(s + p, s + n)}
        assert collapse(w, want) == [x for i, x in enumerate(w) if i not in gone]
    assert found > 500
    assert sequence_runs([0, 1, 0, 1, 0], 4) == [(0, 5, 2)]


def test_access_gives_last_ends():
    r = random.Random(6)
    w = [r.randrange(2) for _ in range(120)]
    tree = SuffixTree(w)
    ends, last = LastEnds(tree.parent), {}
    for i in range(len(w)):
        segments = list(ends.access(tree.prefix[i], i))
        at, path = tree.prefix[i], []
        while at:
            path.append(at)
            at = tree.parent[at]
        # segments are the path's maximal stretches of one last end, deepest state first
        want = [s for k, s in enumerate(path) if not k or last.get(s, -1) != last.get(path[k - 1], -1)]
        assert {s for s, _ in segments} >= set(want)
        assert all(e == last.get(s, -1) for s, e in segments)
        last.update(dict.fromkeys(path, i))


def op12_row(key, text, planted=True):
    w = re.findall(WORD, text or "")
    n = len(w)
    h = zlib.crc32(str(key).encode())
    if planted and key is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = text_runs(w) if n > 400 else brute_runs(w)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_op12(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r[0]: tuple(r[1:]) for r in llm.op12_periodic_runs(spark, sf_dir).collect()}
    assert got == {r.doc_id: op12_row(r.doc_id, r.text) for r in docs}
    assert sum(v[0] > 0 for v in got.values()) > 10


def test_runs_of_rows(spark):
    song = "la di da " * 30 + "x\x0by z " + "boom " * 20
    long = " ".join(f"w{i % 5000}" for i in range(400_000))  # over 2 MB in one run
    rows = [(1, song, 7), (1, song, 7), (None, song, None), (2, None, 1), (3, "", 1), (4, "\t \n", 1), (5, "a " * 11, 1), (6, long, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = with_runs(df).collect()
    assert with_runs(df).columns == ["doc_id", "text", "runs", "collapsed"] and len(got) == len(rows)
    for r in got:
        if r.doc_id == 6:
            assert [tuple(x) for x in r.runs] == [(0, 400_000, 5000)] and r.collapsed == " ".join(f"w{i}" for i in range(5000))
        else:
            w = re.findall(WORD, r.text or "")
            want = brute_runs(w)
            assert [tuple(x) for x in r.runs] == want
            assert r.collapsed == " ".join(collapse(w, want))
    assert {r.doc_id: len(r.runs) for r in got}[1] == 2
    assert with_runs(df.limit(0)).count() == 0


def test_planted_periods(spark):
    rows = [(i, t) for i in range(60) for t in ("one two three four five six seven " * 4, "", None)] + [(None, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    changed = {(r.doc_id, r.text) for r in llm.with_planted_periods(df).collect()}
    assert len(llm.with_planted_periods(df).columns) == 2 and (None, "a b") in changed
    hit = [i for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0]
    assert hit and all((i, None) in changed for i in range(60))
    for i in hit:
        assert (i, "") in changed and (i, rows[0][1]) not in changed


# --- 13: filter audit

def test_path_counts():
    forward, backward = path_counts(4)
    assert forward[-1] == backward[0] == 24 and forward[0b0101] == 2 and backward[0b0101] == 2
    for depth in range(5):  # every order passes each level once
        assert sum(forward[s] * backward[s] for s in range(16) if s.bit_count() == depth) == 24


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for key, text, lang in rows:
        text = text or ""
        w = re.findall(WORD, text)
        fails = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                 bool(re.search("[#$%&*|]", text)),
                 key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in rows))
        docs.append((lang or "", dict(zip("ABCDE", fails)), key in good, key in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            alive = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in alive if d[1][f]]
                kept = [d for d in alive if not d[1][f]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(kept), len(gone), sum(d[1][f] for d in mine) - len(gone),
                                                   sum(d[1][f] and sum(d[1].values()) == 1 for d in mine),
                                                   sum(d[2] for d in gone), sum(d[3] for d in gone)]
                alive = kept
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_equals_every_order(spark):
    r = random.Random(1)
    long = " ".join(f"w{i}" for i in range(220))
    pool = [long, long + " #", long.upper(), "a " * 300, "short", "", None, "A B $", long, long + " z" * 300]
    rows = [(r.choice([None, *range(60)]), r.choice(pool), r.choice(["en", "de", "", None])) for _ in range(200)]
    rows += [(5, "huge " * 500_000, "en"), (6, "huge " * 500_000, "de")]  # over 2 MB
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 60, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    df = spark.createDataFrame([(*x, 1, "n") for x in rows], "doc_id long, text string, lang string, hash int, part string").repartition(5)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(x.part, x.filter_order, x.step): tuple(x)[3:] for x in audit(document_counts(df, known), RULES).collect()}
    assert got == brute_audit(rows, labels)
    assert audit(document_counts(df.limit(0), known), RULES).count() == 0
    no_labels = audit(document_counts(df, known.limit(0)), RULES).agg(F.sum("good_lost"), F.count("*")).first()
    assert tuple(no_labels) == (0, 120 * 5 * 3)


def test_shapley_adds_up(spark):
    counts = spark.createDataFrame([("p", f, False, False, 1 + f) for f in range(8)], "part string, failed int, good boolean, toxic boolean, n long")
    rows = audit(counts, "XYZ").collect()
    assert len(rows) == 6 * 3
    per = {r.filter_order[r.step - 1]: r.shapley for r in rows}
    assert sum(per.values()) == 6 * sum(1 + f for f in range(1, 8))  # each order removes all that fail anything


def test_lists_decode_like_the_stream(ranks):
    """Random ids: characters cut anywhere, malformed bytes, empty lists."""
    import numpy as np
    import pyarrow as pa

    r, decoder = random.Random(12), Decoder(ranks)
    odd = [i for i in ranks.values() if decoder.whole[i] is None]
    lists = [[r.choice(odd) if r.random() < 0.3 * (k % 3) else r.randrange(50_000) for _ in range(r.randint(0, 12))] for k in range(400)]
    sizes = np.array([len(x) for x in lists])
    got = decoder.decode_lists(pa.array([i for x in lists for i in x], pa.int32()), sizes).to_pylist()
    assert got == [b"".join(decoder.token[i] for i in x).decode(errors="replace") for x in lists]
    with pytest.raises(ValueError):
        decoder.decode_lists(pa.array([60_000], pa.int32()), np.array([1]))
