"""The training-data operators against brute force, on small and awkward tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from churnpanel.llm import compression_bands as bands
from churnpanel.llm import queries as llm
from churnpanel.llm import repeats
from churnpanel.llm.automaton_dedup import SuffixAutomaton, remove_repeated_windows
from churnpanel.llm.components import connected_components
from churnpanel.llm.compression_bands import chunk_ends, with_quality
from churnpanel.llm.decontaminate import contained_items, drop_contaminated
from churnpanel.llm.induced_sort import CAP, sort_suffixes, sorted_suffixes
from churnpanel.llm.line_templates import Leaf, drop_template_lines
from churnpanel.llm.mixing import leaf_budgets, mix_sources
from churnpanel.llm.near_dedup import bayes_limits, keep_one, near_duplicates
from churnpanel.llm.suffix_dedup import digest, remove_repeats
from churnpanel.llm.token_counts import MergeCounter, with_token_counts
from churnpanel.llm.token_shards import Shard, compress, expand_symbols, read_documents, write_shards
from churnpanel.llm.toxicity import Settings, ToxicityModel, score_toxicity

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, kept string, budget int"
BPE = public_tokenizers.path("word_bpe_49k.json")


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeéß") for _ in range(r.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, short, empty and null texts, one long text."""
    base, passage = prose(1, 120), prose(2, 60)
    texts = [
        base, base, base + " tail", prose(3, 50) + "\n" + passage, passage + " " + prose(4, 40), None, "", "one",
        "two words", " \t\n", "x" * 500, "x" * 700, prose(5, 4000), prose(3, 50), "a b c a b c a b c",
        "Licensed under version 1.0 of the terms", "日本語 テスト " * 30, "<|endoftext|> x <s> 'S don't", passage.upper(),
    ]
    return [(i * 7 % 100, t, ["en", None, "de"][i % 3], ["src0", "src1", None][i % 3], None, 5, "k", 1) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(rows):
    return sorted((r[0], r[1] or "") for r in rows)


# --- 1: token shards

def test_grammar_round_trip():
    r = np.random.default_rng(0)
    for ids in (r.integers(0, 5, 5000), np.zeros(1001), np.arange(10), np.zeros(0), r.integers(0, 50, 3)):
        ids = ids.astype(np.uint32)
        seq, rules, lengths = compress(ids, 100, per_round=3, least=2)
        assert np.array_equal(expand_symbols(seq, rules, 100), ids)
        for rule, n in zip(np.arange(len(rules)) + 100, lengths):
            assert len(expand_symbols(np.array([rule]), rules, 100)) == n
    assert len(compress(np.tile([1, 2, 3, 4], 200), 100, least=2)[0]) < 100


def test_shard_random_access():
    r = np.random.default_rng(1)
    ids = r.integers(0, 6, 3000).astype(np.uint32)
    shard = Shard.from_bytes(Shard.build(ids, np.array([10, 10, 3000]), 60, least=2).to_bytes())
    assert np.array_equal(shard.ids(), ids) and shard.ends.tolist() == [10, 10, 3000]
    for a, b in ((0, 1), (5, 5), (17, 900), (2999, 3000), (0, 3000)):
        assert np.array_equal(shard.range(a, b), ids[a:b])
    assert shard.document(0).tolist() == ids[:10].tolist() and not len(shard.document(1))
    with pytest.raises(ValueError):
        Shard.from_bytes(b"nothing at all")


def test_shard_positions():
    """Ranges across stored positions, in a sequence of many more symbols than one stride."""
    ids = np.random.default_rng(2).integers(0, 40000, 30000).astype(np.uint32)
    ids[5000:9000] = 7
    shard = Shard.from_bytes(Shard.build(ids, np.array([30000]), 40000).to_bytes())
    assert len(shard.marks) > 5
    for a, b in ((0, 30000), (4095, 4097), (4990, 9010), (8192, 8193), (29999, 30000), (12288, 20480)):
        assert np.array_equal(shard.range(a, b), ids[a:b])
    assert np.array_equal(shard.document(0), ids)


def test_shard_rules_pay():
    """Without rules the shard is larger; a pair seen once less than the price stays."""
    r = np.random.default_rng(3)
    ids = r.integers(0, 300, 20000).astype(np.uint32)
    plain = len(Shard.build(ids, np.array([20000]), 300, least=10 ** 6).to_bytes())
    assert len(Shard.build(ids, np.array([20000]), 300).to_bytes()) <= plain
    few = np.concatenate([np.arange(100, 300), np.tile([1, 2, 3, 4, 5], 1), np.arange(300, 400)])
    assert not len(compress(few, 1000)[1])


def test_shards_match_library(spark, docs, rows, tmp_path):
    from tokenizers import Tokenizer

    again = docs.unionByName(spark.createDataFrame([(None, "no key", None, None, 0, 0, "", 0), rows[3]], SCHEMA))
    write_shards(again, f"file://{tmp_path}/s", BPE, 1, shard_tokens=700, least=2)
    got = read_documents(spark, f"file://{tmp_path}/s").orderBy("start").collect()
    want = sorted([(r[0], r[1] or "") for r in rows] + [(rows[3][0], rows[3][1]), (-1, "no key")])
    model = Tokenizer.from_file(BPE)
    start = 0
    assert len(got) == len(want)
    for g, (key, text) in zip(got, want):
        ids = model.encode(text, add_special_tokens=False).ids + [1]
        assert (g.doc_id if g.doc_id is not None else -1, g.start, g.ids) == (key, start, ids)
        assert g.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_shards_empty(spark, empty, tmp_path):
    write_shards(empty, f"file://{tmp_path}/e", BPE, 1)
    assert read_documents(spark, f"file://{tmp_path}/e").count() == 0


# --- 2 and 7: repeated strings and windows

def test_induced_sorting():
    r = random.Random(3)
    for _ in range(400):
        t = [r.randint(2, r.choice([2, 3, 5])) for _ in range(r.randint(0, 40))] + [0]
        want = sorted(range(len(t)), key=lambda i: t[i:])
        memory = r.choice([2, 3, 1000])
        assert sort_suffixes(np.array(t), memory).tolist() == want
        got = list(sorted_suffixes(np.array(t, np.uint16), memory))
        assert [p for p, _ in got] == want[::-1]
        for (a, _), (b, h) in zip(got, got[1:]):
            same = next((k for k in range(min(len(t) - a, len(t) - b)) if t[a + k] != t[b + k]), min(len(t) - a, len(t) - b))
            assert h == min(same, CAP)


def brute_bytes(rows, length):
    seen, out = set(), {}
    for key, text in texts_of(rows):
        b, gone = text.encode(), bytearray(len(text.encode()))
        for k in range(len(b) - length + 1):
            if b[k: k + length] in seen:
                gone[k: k + length] = b"\1" * length
            seen.add(b[k: k + length])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[key] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def test_repeated_bytes(docs, rows, empty):
    got = {r[0]: tuple(r[1:]) for r in digest(remove_repeats(docs)).collect()}
    assert got == brute_bytes(rows, 100)
    assert any(v[1] for v in got.values())
    assert remove_repeats(empty).count() == 0


def test_repeated_windows(docs, rows, empty):
    count, words = Counter(), {k: re.findall(WORD, t) for k, t in texts_of(rows)}
    for w in words.values():
        count.update(tuple(w[k: k + 35]) for k in range(len(w) - 34))
    want = {}
    for key, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if count[tuple(w[k: k + 35])] > 1:
                gone[k: k + 35] = [True] * 35
        want[key] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    got = {r[0]: tuple(r[1:]) for r in remove_repeated_windows(docs).collect()}
    assert got == want and any(v[1] for v in got.values())
    assert remove_repeated_windows(empty).count() == 0


def test_automaton_statistics():
    a = SuffixAutomaton()
    a.add([1, 2, 3, 1, 2], -1)
    a.add([2, 3, 9], -2)
    a.close()
    assert a.statistics([1, 2, 3, 1, 2]) == [1, 2, 2, 1, 2]


def test_repeated_keys_take_greatest_text(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b" * 150), (1, None), (None, "c"), (2, "b" * 120)], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in digest(remove_repeats(df)).collect()}
    assert got == {1: (150, 149), 2: (120, 120)}


def test_crowded_cores(spark, monkeypatch):
    passage, r = prose(2, 60), random.Random(6)
    edge = lambda: "".join(r.choice("xyz") for _ in range(15))
    texts = [f"{edge()} {edge()} {passage} {edge()} {edge()}" for _ in range(60)] + [passage, passage]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setitem(repeats.SHARD, "bytes", 1500)
    monkeypatch.setitem(repeats.SHARD, "words", 300)
    got = {r[0]: tuple(r[1:]) for r in digest(remove_repeats(df)).collect()}
    assert got == brute_bytes(rows, 100)
    count, split = Counter(), {k: t.split() for k, t in rows}
    for w in split.values():
        count.update(tuple(w[k: k + 35]) for k in range(len(w) - 34))
    for g in remove_repeated_windows(df).collect():
        w = split[g.doc_id]
        gone = {k + d for k in range(len(w) - 34) if count[tuple(w[k: k + 35])] > 1 for d in range(35)}
        assert g.kept == " ".join(x for k, x in enumerate(w) if k not in gone) and g.n_removed == len(gone)

    def solver(ids, lo, n, bodies):  # no call gets more than two shards
        assert len(bodies[0]) <= 2 * 1500 + 115
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    base = df.select(F.col("doc_id").alias("id"), "text")
    assert repeats.RepeatedWindows(base, "bytes", 100, 32, 16, True, solver).ranges().count()


# --- 3: near duplicates

def brute_components(rows, size, percent):
    sets = {}
    for key, text in texts_of(rows):
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets[key] = {tuple(w[k: k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    root = {k: k for k in sets}
    keys = sorted(sets)
    changed = True
    while changed:
        changed = False
        for a in keys:
            for b in keys:
                shared = len(sets[a] & sets[b])
                if shared and 100 * shared >= percent * len(sets[a] | sets[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return {k: (len(sets[k]), root[k]) for k in keys}


def test_near_duplicates(spark, docs, rows, empty):
    chain = [prose(50, 200).split()]
    for i in range(8):  # a chain of edits: neighbours are linked, the ends are not
        w = list(chain[-1])
        w[i * 20 + 3: i * 20 + 6] = [f"new{i}", "x", f"y{i}"]
        chain.append(w)
    more = rows + [(200 + i, " ".join(w), "en", "s", 0, 0, "", 0) for i, w in enumerate(chain)]
    df = spark.createDataFrame(more, SCHEMA)
    for size, percent in ((3, 85), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, shingle=size, percent=percent).collect()}
        assert got == brute_components(more, size, percent)
    assert near_duplicates(empty).count() == 0
    kept = keep_one(df.unionByName(spark.createDataFrame([(None, "x", None, None, 0, 0, "", 0)], SCHEMA)), shingle=3, percent=85)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.select("doc_id").collect())[-1] == (True, None)


def test_sequential_limits():
    limits = bayes_limits(192, 32, 0.85, 1e-5)
    assert list(limits) == sorted(limits) and 10 < limits[0] < 27 and limits[-1] < 0.85 * 192


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 10), (10, 1), (4, 4), (2, 1)], "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in range(1, 12)], "id long")
    got = {r.id: r.component for r in connected_components(nodes, links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 1, 9: 1, 10: 1, 4: 4, 5: 5, 6: 6, 7: 7, 11: 11}


# --- 4: containment

def test_containment(spark, docs, rows, empty):
    passage = prose(2, 60)
    cut = " ".join(passage.split()[:57] + ["zz"] * 3)  # over 80 % of its shingles
    far = " ".join(passage.split()[:30] + prose(77, 30).split())
    items = spark.createDataFrame([(1, passage), (2, cut), (3, far), (4, None), (5, ""), (6, "two words"), (None, "x"), (1, passage)],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in contained_items(docs, items).collect()}
    want = {}
    for key, text in texts_of(rows):
        shingles = lambda t: (lambda w: {tuple(w[k: k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())(
            re.findall(WORD, t.translate({c: c + 32 for c in range(65, 91)})))
        for i in items.distinct().collect():
            s = shingles(i.text or "")
            if s and 100 * len(s & shingles(text)) >= 80 * len(s):
                want[key, i.item_id] = (len(s), len(s & shingles(text)))
    assert got == want and len(want) >= 5
    assert drop_contaminated(docs, items).count() == len(rows) - len({k for k, _ in want})
    assert contained_items(empty, items).count() == 0 and contained_items(docs, items.limit(0)).count() == 0


def test_containment_without_keys(spark):
    """Items of one id are judged by their own sizes; rows without a key by their own text."""
    short, long, other = prose(3, 20), prose(4, 90), prose(5, 30)
    items = spark.createDataFrame([(1, short), (1, long), (None, other)], "item_id long, text string")
    rows = [(1, f"{prose(6, 40)} {short}"), (2, long), (None, f"{other} {prose(7, 40)}"), (None, prose(8, 40)), (None, None), (4, other)]
    df = spark.createDataFrame([(k, t, "a", "b") for k, t in rows], "doc_id long, text string, _hit string, document string")
    got = sorted(((r.doc_id, r.item_id, r.n_item) for r in contained_items(df, items).collect()), key=str)
    assert got == sorted([(1, 1, 16), (2, 1, 86), (None, None, 26), (4, None, 26)], key=str)
    left = drop_contaminated(df, items)
    assert left.columns == df.columns
    assert sorted(map(tuple, left.collect()), key=str) == sorted([(None, prose(8, 40), "a", "b"), (None, None, "a", "b")], key=str)


# --- 5: line templates

def test_line_templates(spark, empty):
    lines = [f"Posted by user{i} on day {i} of the year at noon" for i in range(8)]
    texts = [f"{prose(i, 12)}\n{lines[i]}\n\n{prose(i + 50, 9)}" for i in range(8)] + [None, "", "\n\n", "one line only"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in drop_template_lines(df).collect()}
    for i in range(8):
        assert (got[i].n_lines, got[i].n_dropped) == (3, 1)
        assert got[i].text == f"{prose(i, 12)}\n\n{prose(i + 50, 9)}"
    assert [got[i].text for i in range(8, 12)] == ["", "", "\n\n", "one line only"]
    assert all(r.n_dropped == 0 for r in drop_template_lines(df.limit(3)).collect())
    assert drop_template_lines(empty).count() == 0


def test_template_documents_count_once(spark):
    verse = lambda i: f"When the night {'abcdefgh'[i]} falls on all the quiet hills"
    other = [f"When the night {prose(i, 7)}" for i in range(6)]
    alone = ["\n".join(verse(i) for i in range(6)), *other]
    shared = ["\n".join(verse(i) for i in (0, 1, 2)), "\n".join(verse(i) for i in (3, 4, 5)), *other]
    for texts in (alone, shared):  # six lines of a template, in one and in two documents
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        assert [(r.n_dropped, r.text) for r in drop_template_lines(df).orderBy("doc_id").collect()] == [(0, t) for t in texts]
    six = [f"{verse(i)}\n{prose(i, 9)}\n{verse(7 - i)}" for i in range(6)]
    df = spark.createDataFrame(list(enumerate(six)), "doc_id long, text string")
    assert [(r.n_dropped, r.text) for r in drop_template_lines(df).orderBy("doc_id").collect()] == [(2, prose(i, 9)) for i in range(6)]


def test_short_template_lines(spark):
    names = ["Alice", "Bob", "Chloé", "Dora", "Emil", "Fay"]
    texts = [f"Posted by user {n}\n{prose(i, 9)}\nWritten by staff writer {n}" for i, n in enumerate(names)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [(r.n_dropped, r.text) for r in drop_template_lines(df).orderBy("doc_id").collect()] == [(2, prose(i, 9)) for i in range(6)]
    assert all(r.n_dropped == 0 for r in drop_template_lines(df.where("doc_id < 5")).collect())
    leaf = Leaf(3, 60)  # from six tokens on, one more place than the lead must agree
    assert [leaf.place(x.split()) for x in ("a b c d e f", "a b c x y z", "a b c d y x", "a b c v y w")] == [0, 1, 0, 1]


# --- 6: mixing

def test_budgets_redistribute_to_siblings_first(spark):
    df = spark.createDataFrame([(1, "a", "x", 10), (2, "a", "y", 100), (3, "b", "x", 100), (4, "b", "y", 100)],
                               "doc_id long, d string, s string, n long")
    got = {(r.d, r.s): r.budget for r in leaf_budgets(df, ["d", "s"], "n", 120).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 50, ("b", "x"): 30, ("b", "y"): 30}
    got = {(r.d, r.s): r.budget for r in leaf_budgets(df, ["d", "s"], "n", 300).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 100, ("b", "x"): 95, ("b", "y"): 95}
    got = {(r.d, r.s): r.budget for r in leaf_budgets(df, ["d", "s"], "n", 10 ** 9).collect()}
    assert sum(got.values()) == 310


def test_mixing_prefixes(spark):
    rows = [(i, "ab"[i % 2], None if i % 3 else "q", i % 9) for i in range(400)]
    df = spark.createDataFrame(rows + [(7, "a", None, 7), (None, None, None, None)], "doc_id long, d string, s string, n long")
    got = mix_sources(df, ["d", "s"], "n", F.floor(F.col("all_tokens") * 1.5), {("a",): 5}, epochs=3, seed=4)
    budgets = {(r.d, r.s): (r.budget, r.tokens) for r in leaf_budgets(df.fillna(0, ["n"]), ["d", "s"], "n", F.floor(F.col("all_tokens") * 1.5), {("a",): 5}, 3).collect()}
    for r in got.groupBy("d", "s").agg(F.sum("n").alias("n"), F.max("epoch").alias("e")).collect():
        budget, tokens = budgets[r.d, r.s]
        assert r.n <= budget and budget - r.n < 16 + (tokens == 0)
    again = mix_sources(df.repartition(7), ["d", "s"], "n", F.floor(F.col("all_tokens") * 1.5), {("a",): 5}, epochs=3, seed=4)
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))
    assert mix_sources(df.limit(0), ["d", "s"], "n", 10).count() == 0


def test_mixing_with_clashing_names(spark):
    rows = [(i, "ab"[i % 2], i % 9 + 1, i, "t", -1) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, d string, n long, _full long, `_stop` string, epoch int")
    got = mix_sources(df, ["d"], "n", 150, epochs=2, seed=4)
    assert got.columns == ["doc_id", "d", "n", "_full", "_stop", "epoch"]
    plain = mix_sources(df.select("doc_id", "d", "n"), ["d"], "n", 150, epochs=2, seed=4)
    assert sorted((r.doc_id, r.epoch) for r in got.collect()) == sorted((r.doc_id, r.epoch) for r in plain.collect())
    assert all(r._full == r.doc_id and r._stop == "t" and r.epoch == 1 for r in got.collect())
    named = mix_sources(df.withColumnsRenamed({"d": "capacity", "n": "budget"}), ["capacity"], "budget", 150, epochs=2, seed=4)
    assert sorted((r.doc_id, r.epoch) for r in named.collect()) == sorted((r.doc_id, r.epoch) for r in plain.collect())


# --- 8: quality

def test_quality(docs, rows, empty):
    got = {r.doc_id: r for r in with_quality(docs).collect()}
    for key, text in texts_of(rows):
        w = re.findall(WORD, text)
        tri = Counter(zip(w, w[1:], w[2:]))
        cover = {k + d for k in range(len(w) - 2) if tri[tuple(w[k: k + 3])] > 1 for d in range(3)}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if re.search(WORD, line):
                dup += line in seen
                seen.add(line)
        g = got[key]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover))
        assert g.base_failed == (len(w) < 50 or 100 * len(cover) > 50 * len(w))
        assert not (g.kept and g.base_failed)
    assert with_quality(empty).count() == 0


def test_quality_bands(spark):
    r = random.Random(9)
    noise = " ".join("".join(chr(r.randint(33, 126)) for _ in range(30)) for _ in range(300))
    same = "\n".join(f"the same line again and again number {i % 7}" for i in range(400))
    words = [prose(i, 1) for i in range(400)]
    text = " ".join(r.choice(words) for _ in range(900))
    df = spark.createDataFrame([(1, noise), (2, same), (3, text)], "doc_id long, text string")
    assert {x.doc_id: x.kept for x in with_quality(df).collect()} == {1: False, 2: False, 3: True}


def test_every_part_is_judged(spark):
    r = random.Random(10)
    noise = lambda n: " ".join("".join(chr(r.randint(33, 126)) for _ in range(60)) for _ in range(n // 61 + 1))[:n]
    same = "".join(f"the same line again and again number {i % 7}\n" for i in range(80))
    words = [prose(i, 1) for i in range(400)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))[:n]
    bad = [same[:2000] + noise(2000), text(4000) + noise(4000), text(1100) + noise(1100), text(1100) + same[:1100]]
    good = [text(n) for n in (600, 767, 1000, 1279, 1644, 4000, 8000)]
    df = spark.createDataFrame(list(enumerate(bad + good)), "doc_id long, text string")
    got = with_quality(df, max_repeat=100).orderBy("doc_id").collect()
    assert [x.kept for x in got] == [False] * len(bad) + [True] * len(good)
    assert all(x.n_chunks > 0 for x in got)
    for n in range(3000):
        size = np.diff([0, *chunk_ends(n)])
        assert size.sum() == n and (n < 512 or (256 <= size.min() and size.max() < 768))


def test_learnt_limits_brute_force(spark):
    """Ratios, limits and verdicts, computed again in plain Python."""
    import math

    import zstandard

    r = random.Random(12)
    words = [prose(i, 1) for i in range(500)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(150, 420))) for _ in range(330)]
    texts += [" ".join(f"{r.randint(0, 9)}{r.randint(0, 9)}{i % 7}" for i in range(420)) for _ in range(8)]  # far below the others
    texts += [texts[0]] * 400 + ["", "short"]  # copies must not move the limits
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("_q_bytes", F.lit("clash"))
    got = {x.doc_id: x for x in with_quality(df.repartition(5)).collect()}

    pack = zstandard.ZstdCompressor(level=3)
    cls = lambda n: min(math.floor(2 * (math.log(max(n, 1)) / math.log(2))), 63)
    seen: dict = {}
    measured = []
    for i, text in enumerate(texts):
        data = text.encode()
        ends = [0, *chunk_ends(len(data))]
        chunks = [(b - a, len(pack.compress(data[a:b])) / (b - a)) for a, b in zip(ends, ends[1:])]
        ratio = len(pack.compress(data)) / len(data) if data else 1.0
        measured.append((len(data), ratio, chunks))
        if not got[i].base_failed and text not in texts[:i]:
            seen.setdefault(("document", cls(len(data))), []).append(ratio)
            for n, x in chunks:
                seen.setdefault(("chunk", cls(n)), []).append(x)
    limits = {}
    for key, values in seen.items():
        steps = sorted(min(math.floor(v * 1000), 4000) for v in values)
        if len(steps) >= 100:
            a, b, c = (steps[-(-len(steps) * q // 4) - 1] / 1000 for q in (1, 2, 3))
            limits[key] = (b - 2.5 * max(c - a, 0.015), b + 2.5 * max(c - a, 0.015))
    assert ("document", cls(1500)) in limits and ("chunk", cls(512)) in limits

    def bounds(kind, n, fixed):
        return limits.get((kind, cls(n))) or [(lo, hi) for least, lo, hi in fixed if n >= least][-1]

    rejected = 0
    for i, (n, ratio, chunks) in enumerate(measured):
        lo, hi = bounds("document", n, bands.DOCUMENT_BANDS)
        low = sum(x < bounds("chunk", m, bands.CHUNK_BANDS)[0] for m, x in chunks)
        high = sum(x > bounds("chunk", m, bands.CHUNK_BANDS)[1] for m, x in chunks)
        assert got[i].doc_ratio == ratio and (got[i].n_chunks, got[i].n_chunks_low, got[i].n_chunks_high) == (len(chunks), low, high)
        fits = lo <= ratio <= hi and low + high <= 0.25 * len(chunks)
        assert got[i].kept == (fits and not got[i].base_failed)
        rejected += not fits and not got[i].base_failed
    assert rejected >= 8


# --- 9: token counts

def test_token_counts(docs, rows, empty):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: r.n_tokens for r in with_token_counts(docs, path).collect()}
    assert got == {k: len(model.encode(t)) for k, t in texts_of(rows)}
    counter = MergeCounter.from_sentencepiece(path)
    for t in ("  a  b ", "\n\n", "▁▁x", "x▁y", "\t a\r\n", "1234567 89", "🙂🙂 é́", "a" * 300, "\x00a", " <0x41> <unk>"):
        assert counter.count(t) == len(model.encode(t)), t
    assert with_token_counts(empty, path).count() == 0


# --- 10: toxicity

def test_toxicity(spark, empty):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        w = prose(i, 60).split()
        bad = i % 4 == 0
        for _ in range(4 if bad else 0):
            w.insert(r.randrange(len(w)), r.choice(["zzfoul", "zzvile", "qqrude"]) + r.choice(["", "er", "ly"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows + [(1000, None), (None, ""), (3, rows[3][1])], "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(5, None), (None, 1)], "doc_id long, toxic int")
    got = score_toxicity(docs, lab).collect()
    assert len(got) == 603 and all(0 <= g.score <= 1 for g in got)
    held = [g for g in got if g.held_out and g.doc_id is not None and g.doc_id < 600]
    assert all(zlib.crc32(str(g.doc_id).encode()) % 3 == 1 for g in held)
    right = sum(g.predicted == (g.doc_id % 4 == 0) for g in held) / len(held)
    assert right > 0.97
    assert all(g.predicted == 0 for g in got if not g.text)
    flat = score_toxicity(docs, lab.limit(0)).select("score").distinct().collect()
    assert len(flat) == 1 and flat[0][0] < 0.01
    assert score_toxicity(spark.createDataFrame([], "doc_id long, text string, score string"), lab, Settings(sample=10)).count() == 0


def test_lexicon_counts_all_labels(spark):
    rows = [(i, prose(i, 40) + (" zzfoul" if i % 4 == 0 else "") + (" qqvile" if i % 24 == 0 else "")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)], "doc_id long, toxic int")
    few, every = (ToxicityModel.fit(docs, lab, Settings(sample=n)) for n in (60, 40_000))
    assert len(every.voters.hashes) and few.voters.hashes.tolist() == every.voters.hashes.tolist()
    assert few.weights.tolist() != every.weights.tolist()


# --- queries

def test_registered():
    names = list(llm.registry())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(llm.oracle_sql()) <= set(names)


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
    got = corpus_pipeline.run(spark, sf_dir)
    rows = got.orderBy("doc_id").collect()
    assert 0 < len(rows) < ids and len({r.doc_id for r in rows}) == len(rows)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]
