"""Operators against brute force, round trips and held-out labels."""

import glob
import hashlib
import math
import os
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

import __spark_entry__ as E
import corpus_pipeline
from tenderlens.llm import (attention, attention_lm, exact_dedup, mixing, packing, quality, simhash, token_frames,
                            url_rules, viterbi, winnowing)
from tenderlens.llm.encode import WordEncoder, tokenizer_path

SF = "/root/testdata/sf0.001"
BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def texts():
    return pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id").text.to_dict()


def library(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


# winnowing

def brute_winnow(text, k, w):
    h = winnowing.gram_hashes(text, k).tolist()
    w = min(w, len(h))
    out = set()
    for i in range(len(h) - w + 1):
        best = min(x >> 24 for x in h[i: i + w])
        out.add(max(j for j in range(i, i + w) if h[j] >> 24 == best))
    return sorted(out)


@given(st.text("abc ", max_size=300), st.integers(1, 6), st.integers(1, 12))
@settings(max_examples=150, deadline=None)
def test_winnow_minima(text, k, w):
    hashes, positions = winnowing.winnow(text, k, w)
    assert positions.tolist() == (brute_winnow(text, k, w) if text else [])
    grams = winnowing.gram_hashes(text, k)
    seen = {}
    for i, x in enumerate(grams.tolist()):  # equal grams, equal hashes; others differ
        assert seen.setdefault(text[i: i + k], x) == x
    assert len(set(seen.values())) == len(seen)


def test_winnow_guarantee_and_segments(monkeypatch):
    a, b = "x" * 500 + "a passage that both texts share, long enough" * 4, "a passage that both texts share, long enough" * 4
    assert set(winnowing.winnow(a)[0].tolist()) & set(winnowing.winnow(b)[0].tolist())
    whole = winnowing.winnow(a * 5, 8, 20)[1]
    monkeypatch.setattr(winnowing, "_SEGMENT", 64)
    assert (winnowing.winnow(a * 5, 8, 20)[1] == whole).all()


def test_likeness_of_short_edited_texts(texts):
    assert winnowing.GRAM + winnowing.WINDOW - 1 <= 23  # shared passages of this length are always found
    long = max(texts.values(), key=len)
    for n in (60, 90, 120, 200):
        near = []
        for at in range(0, 4_000, 400):
            text, other = long[at: at + n], long[8_000 + at: 8_000 + at + n // 3]
            edited = text[: n - len(other)] + other
            near.append(winnowing.likeness(winnowing.winnow(text)[0], winnowing.winnow(edited)[0]))
        assert 0 < min(near) and max(near) < 1 and 0.3 < np.mean(near) < 0.7, (n, near)


def test_op1(spark, texts):
    rows = {r["doc_id"]: r for r in E.queries()["op1_winnowing"](spark, SF).collect()}
    order = sorted(texts, reverse=True)
    for i, key in enumerate(order):
        nxt, text = texts[order[(i + 1) % len(order)]], texts[key]
        third = len(text) // 3
        edited = text[: len(text) - third] + nxt[:third]
        r = rows[key]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        mine, other, next_one = (winnowing.winnow(t) for t in (text, edited, nxt))
        assert r["fingerprint"] == winnowing.as_string(*mine) and r["edited_fingerprint"] == winnowing.as_string(*other)
        assert r["near_edited"] == winnowing.likeness(mine[0], other[0])
        assert r["near_next"] == winnowing.likeness(mine[0], next_one[0])


# mixing

@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), min_size=1, max_size=6), st.integers(0, 200))
@settings(max_examples=150, deadline=None)
def test_knapsack(counts, budget):
    lengths, n = list(counts), list(counts.values())
    sums = {0}
    for x, c in counts.items():
        sums = {s + x * i for s in sums for i in range(c + 1)}
    taken = mixing.knapsack(lengths, n, budget)
    assert all(0 <= t <= c for t, c in zip(taken, n))
    assert sum(t * x for t, x in zip(taken, lengths)) == max(s for s in sums if s <= budget)


def test_fit_takes_documents_again_only_when_needed():
    assert mixing.fit_lengths(np.array([3, 5]), np.array([1, 1]), 5, 3).tolist() == [0, 1]
    assert mixing.fit_lengths(np.array([3, 5]), np.array([1, 1]), 6, 3).tolist() == [2, 0]
    assert mixing.fit_lengths(np.array([2]), np.array([4]), 5, 1, window=1).tolist() == [2]


def test_targets_reshare():
    sizes = {"a": 100, "b": 10, None: 50}
    t = mixing.targets(sizes, mixing.cycle_weights(list(sizes)))
    assert t["b"] == 30 and math.isclose(sum(t.values()), 160) and math.isclose(t[None], 130 * 3 / 4)
    assert mixing.targets({"a": 0}, {"a": 1.0}) == {"a": 0.0}


def test_op2(spark, texts):
    rows = E.queries()["op2_mixing"](spark, SF).toPandas()
    assert (rows.set_index("doc_id")["size"].sort_index() == [len(t.encode().split()) for _, t in sorted(texts.items())]).all()
    by = rows.groupby("source").agg(total=("size", "sum"), said=("source_size", "first"), target=("target", "first"),
                                    taken=("taken", "sum"))
    assert (by.total == by.said).all() and (rows.taken <= 3 * rows["size"]).all()
    assert math.isclose(by.target.sum(), by.total.sum()) and (by.target <= 3 * by.total).all()
    assert ((by.target - by.taken).abs() <= 0.01 * by.target + 1).all()  # ten documents a source
    again = E.queries()["op2_mixing"](spark, SF).toPandas()
    assert rows.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))


# attention language model

def test_model_is_a_causal_distribution():
    shape = attention.Shape(groups=4, members=4, width=8, hidden=8, context=8, overlap=3)
    draw = np.random.default_rng(1)
    w, prior = attention.new_weights(shape), attention.Prior.of(draw.random((17, 16)) + 0.1, shape)
    x = draw.integers(0, 16, (1, 8))
    assert np.allclose(attention.forward(w, x), attention.states(w, x), atol=1e-5)
    changed = x.copy()
    changed[0, -1] = (changed[0, -1] + 1) % 16
    assert np.allclose(attention.states(w, x)[0, :-1], attention.states(w, changed)[0, :-1], atol=1e-6)
    state = attention.states(w, x)[0, 3:4]
    p = [math.exp(attention.log_probabilities(w, prior, state, x[0, 3:4], np.array([u]))[0]) for u in range(16)]
    assert math.isclose(sum(p), 1, rel_tol=1e-5)


def test_gradient():
    shape = attention.Shape(groups=2, members=3, width=4, hidden=5, context=5, overlap=1)
    draw = np.random.default_rng(2)
    w = {k: v.astype(float) for k, v in attention.new_weights(shape).items()}
    prior = attention.Prior.of(draw.random((7, 6)) + 0.1, shape)
    x, y = draw.integers(0, 7, (3, 5)), draw.integers(0, 6, (3, 5))
    live = draw.random((3, 5)) > 0.2
    _, g = attention.loss_and_slopes(w, prior, x, y, live)
    for name in attention.NAMES:
        at = tuple(draw.integers(0, n) for n in w[name].shape)
        old = w[name][at]
        w[name][at] = old + 1e-4
        up = attention.loss_and_slopes(w, prior, x, y, live)[0]
        w[name][at] = old - 1e-4
        down = attention.loss_and_slopes(w, prior, x, y, live)[0]
        w[name][at] = old
        assert math.isclose((up - down) / 2e-4, g[name][at], rel_tol=2e-2, abs_tol=2e-5), name


def test_windows_score_each_unit_once():
    shape = attention.Shape(groups=4, members=4, width=8, hidden=8, context=8, overlap=3)
    draw = np.random.default_rng(3)
    w, prior = attention.new_weights(shape), attention.Prior.of(draw.random((17, 16)) + 0.1, shape)
    for n in (1, 7, 8, 9, 13, 14, 40):
        s = draw.integers(0, 16, n)
        full, want = np.concatenate(([16], s)), 0.0
        for a in range(0, max(1, n - shape.overlap), 5):
            long = min(8, n - a)
            found = attention.forward(w, full[None, a: a + long])[0]
            skip = 0 if a == 0 else shape.overlap
            want += attention.log_probabilities(w, prior, found[skip:], full[a + skip: a + long],
                                                full[a + 1 + skip: a + long + 1]).sum()
        assert math.isclose(attention.score(w, prior, shape, [s])[0], want, rel_tol=1e-4)


def test_op3(spark, texts):
    rows = {r["doc_id"]: r for r in E.queries()["op3_attention_lm"](spark, SF).collect()}
    words = {k: t.encode().lower().split() + [b" "] for k, t in texts.items()}
    held = {k for k in texts if zlib.crc32(str(k).encode()) % 7 == 2}
    counts = Counter(w for k in words if k not in held for w in words[k])
    n, v = sum(counts.values()), len(counts)
    uniform = 0.0
    for k, w in words.items():
        r = rows[k]
        assert r["held_out"] == (k in held) and r["n_tokens"] == len(w) and r["train_tokens"] == n
        assert r["n_known"] == sum(x in counts for x in w)
        assert math.isclose(r["base_score"], sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        if k in held:
            uniform += len(library(BYTE).encode(texts[k]).ids) * math.log10(1 / 1024)
    assert sum(rows[k]["score"] for k in held) > 0.75 * uniform  # far better than chance on unseen texts


def test_rare_words_by_join(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"common rare{i} common pair{i // 2}") for i in range(20)], "doc_id bigint, text string")
    shape = attention.Shape(width=8, hidden=8, context=16, overlap=4)
    whole = {r["doc_id"]: (r["n_known"], r["base_score"]) for r in attention_lm.score_texts(df, BYTE, shape=shape).collect()}
    monkeypatch.setattr(attention_lm.frequent_words, "__defaults__", (2,))
    some = {r["doc_id"]: (r["n_known"], r["base_score"]) for r in attention_lm.score_texts(df, BYTE, shape=shape).collect()}
    assert all(whole[k][0] == some[k][0] and math.isclose(whole[k][1], some[k][1]) for k in whole)


def test_training_windows_cover_whole_texts(spark):
    texts = ["", "one", "x" * 3_000, " ".join(f"word{i}" for i in range(2_000)), "语" * 700 + " end"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "mixed bigint, text string")
    shape, size = attention.Shape(context=16, overlap=4), library(BYTE).get_vocab_size()
    windows = [np.frombuffer(r["ids"], "<u4").tolist() for r in attention_lm.training_windows(df, BYTE, shape).collect()]
    wanted = Counter()
    for t in texts * 2:
        ids = [size + 1, *library(BYTE).encode(" " + t if t else "").ids, size]
        wanted.update(zip(ids, ids[1:]))
    assert max(map(len, windows)) <= shape.context + 1
    assert Counter(p for w in windows for p in zip(w, w[1:])) == wanted  # every id is predicted once, after the one before it


def test_pairs_are_counted_across_words(spark):
    texts = ["red fox", "blue whale", "red fox blue whale", "", "redfox " * 40] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    shape = attention.Shape(width=8, hidden=8, context=16, overlap=4)
    windows = attention_lm.training_windows(df.withColumnRenamed("doc_id", "mixed"), BYTE, shape)
    counts = attention_lm.word_counts(df)
    size = library(BYTE).get_vocab_size()
    units = attention_lm.Units(attention_lm.id_counts(counts, BYTE), shape, [])
    wanted = np.zeros((shape.units + 1, shape.units))
    for t in texts:
        words = " ".join(t.split())
        x = units.of[[size + 1, *library(BYTE).encode(" " + words if words else "").ids, size]]
        np.add.at(wanted, (x[:-1], x[1:]), 1)
    found = attention_lm.follow_counts(windows, units, shape)
    assert np.abs(found - wanted).max() <= 20
    red, fox, whale = (units.of[library(BYTE).encode(f" {w}").ids[0]] for w in ("red", "fox", "whale"))
    assert found[red, fox] > 5 and (found - wanted)[red, whale] < 2  # the fox follows red, a whale never does
    rest = found - wanted
    assert np.allclose(rest / rest.sum(axis=1, keepdims=True), rest[0] / rest[0].sum())  # smoothing alike in every row


# URL rules

def test_rules_against_brute_force(spark):
    draw = np.random.default_rng(4)
    label, step = ["a", "b", "net", "x-y", "aa"], ["", "p/", "p/q/", "q", "pp/"]
    host = lambda: ".".join(draw.choice(label, draw.integers(1, 5)))
    rules = {(host(), "/" + str(draw.choice(step))): str(draw.choice(["block", "allow"])) for _ in range(60)}
    pages = [(i, f"http://{host()}/{draw.choice(step)}{draw.choice(step)}") for i in range(600)]
    table = spark.createDataFrame([(h, p, a) for (h, p), a in rules.items()], "host string, path string, action string")
    rows = url_rules.judge_urls(spark.createDataFrame(pages, "page_id bigint, url string"), table).collect()
    for r in rows:
        fit = [(len(h + p), len(h), a == "block", h + p) for (h, p), a in rules.items()
               if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
        best = max(fit, default=None)
        assert (r["rule"], r["verdict"]) == ((best[3], "block" if best[2] else "allow") if best else (None, "allow"))


# SimHash

def test_simhash_and_golay():
    text = "The quick brown FOX jumps over\tthe lazy dog again"
    w = text.lower().split()
    h = [xxhash.xxh64_intdigest(" ".join(w[i: i + 4]), 42) for i in range(len(w) - 3)]
    assert simhash.simhash(text) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert simhash.simhash("  ") == 0 and simhash.simhash("a b") == xxhash.xxh64_intdigest("a b", 42)
    draw = np.random.default_rng(5)
    words = draw.integers(0, 1 << 23, 2000)
    near, n = simhash.nearby(words)
    assert set(n.tolist()) <= {1, 6}
    for flips in (0, 1, 2):
        for x, row, m in zip(words[:300], near, n):
            y = int(x)
            for bit in draw.choice(23, flips, replace=False):
                y ^= 1 << int(bit)
            other, k = simhash.nearby(np.array([y]))
            assert set(row[:m].tolist()) & set(other[0][: k[0]].tolist())
            if flips < 2:
                assert row[0] in other[0][: k[0]]


def test_links_of_every_distance(spark):
    draw = np.random.default_rng(6)
    values = []
    for i in range(400):
        x = int(draw.integers(0, 1 << 63)) * 2 + 1
        y = x
        for bit in draw.choice(64, i % 8, replace=False):
            y ^= 1 << int(bit)
        values += [x, y]
    dense = int(draw.integers(0, 1 << 62))
    for _ in range(400):  # a dense group: many fingerprints around one
        y = dense
        for bit in draw.choice(64, 3, replace=False):
            y ^= 1 << int(bit)
        values.append(y)
    fps = spark.createDataFrame([(i, simhash._signed(v)) for i, v in enumerate(values)], "id bigint, fp bigint")
    got = {r["id"]: r["first"]["id"] for r in simhash.with_components(fps).collect()}
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    v = np.array(values, dtype=np.uint64)
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= 4):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    assert got == {i: find(i) for i in range(len(values))}


def test_long_runs_link_like_short_ones(monkeypatch):
    draw = np.random.default_rng(7)
    fps = np.unique(np.concatenate([x ^ (1 << draw.integers(0, 62, 60)) for x in draw.integers(0, 1 << 62, 3)]))
    key, role = np.zeros(len(fps), np.int64), np.full(len(fps), 2, np.int8)
    short = simhash.links(key, role, fps, 4)
    monkeypatch.setattr(simhash, "_PAIRS", 10)
    long = simhash.links(key, role, fps, 4)
    assert dict(zip(*map(np.ndarray.tolist, short))) == dict(zip(*map(np.ndarray.tolist, long)))


def test_star_components(spark):
    draw = np.random.default_rng(8)
    edges = [(i, i + 1) for i in range(0, 60)] + [(int(a), int(b)) for a, b in draw.integers(100, 200, (60, 2))]
    got = {r["node"]: r["root"] for r in simhash.star_components(
        spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    x, y = simhash.forest(*np.array(edges).T)
    assert got == dict(zip(x.tolist(), y.tolist()))


def test_op5(spark, texts):
    rows = {r["doc_id"]: r for r in E.queries()["op5_simhash"](spark, SF).collect()}
    fps = {k: simhash.simhash(t) for k, t in texts.items()}
    root = {k: k for k in fps}
    for _ in range(5):
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 4:
                    root[a] = root[b] = min(root[a], root[b])
    assert {k: (r["fingerprint"], r["component_id"]) for k, r in rows.items()} == {
        k: (f"{fps[k]:016x}", root[k]) for k in fps}


# token counts

def test_viterbi_matches_library(texts):
    vocabulary = viterbi.unigram_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    t = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=viterbi.SPACE, prepend_scheme="always", split=True)
    mine = viterbi.counter(tokenizer_path("piece_bpe_32k.model"))
    odd = ["", " ", "  two  spaces ", "日本語 テスト", "\U0001F600\U0001F601 x", "a\nb\n\nc", "\u2581lead", "ünï…", "x" * 500]
    for text in [*texts.values(), *odd]:
        assert mine.text(text)[0] == len(t.encode(text, add_special_tokens=False).ids), text[:40]


@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=3), st.integers(-4, -1)), min_size=1, max_size=12,
                unique_by=lambda x: x[0]), st.text("abcd", min_size=1, max_size=12))
@settings(max_examples=200, deadline=None)
def test_viterbi_ties(pieces, word):
    vocabulary = [("<unk>", 0.0)] + [(p, float(s)) for p, s in pieces] + [(f"<0x{b:02X}>", -9.0) for b in range(256)]
    t = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    assert viterbi.Counter(vocabulary).count(word)[0] == len(t.encode(word, add_special_tokens=False).ids)


# packing

def exact_bins(items, capacity):
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + items[i] <= capacity and bins[j] not in bins[:j]:
                place(i + 1, bins[:j] + [bins[j] + items[i]] + bins[j + 1:])
        place(i + 1, [*bins, items[i]])

    items = sorted(items, reverse=True)
    place(0, [])
    return best


@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
@settings(max_examples=150, deadline=None)
def test_packing_is_minimal_on_small_sets(items):
    counts = np.bincount(items, minlength=21)
    patterns = packing.pack_lengths(counts, 20)
    packed = Counter()
    for lengths, n in patterns:
        assert sum(lengths) <= 20 and n > 0
        packed.update({x: n * c for x, c in Counter(lengths).items()})
    assert packed == Counter(items)
    least = exact_bins(items, 20)
    assert packing.lower_bound(counts, 20) <= least <= sum(n for _, n in patterns) <= sum(n for _, n in packing.best_fit(counts, 20))
    assert sum(n for _, n in patterns) <= least + 1


def test_op7(spark, texts):
    rows = E.queries()["op7_packing"](spark, SF).toPandas()
    t = library(WORD)
    for key, part in rows.groupby("doc_id"):
        ids = np.array(t.encode(texts[key], add_special_tokens=False).ids + [1], dtype="<u4")
        part = part.sort_values("piece")
        assert part.piece.tolist() == list(range(-(-len(ids) // 4096)))
        assert part.length.sum() == len(ids) and (part.length[:-1] == 4096).all()
        for r in part.itertuples():
            assert r.start == 4096 * r.piece and r.ids_crc32 == zlib.crc32(ids[r.start: r.start + r.length].tobytes())
    spans = rows.sort_values(["sequence_id", "offset"])
    assert (spans.groupby("sequence_id").length.cumsum() - spans.length == spans.offset).all()
    assert rows.sequence_id.nunique() <= -(-rows.length.sum() // 4096) + 1


# exact dedup

def test_collisions_stay_apart(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "ab "), (3, "ab"), (4, "abc"), (5, "a\u00a0b")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(df).collect()}
    assert got == {1: (1, 3, True), 2: (1, 3, False), 3: (1, 3, False), 4: (4, 1, True), 5: (5, 1, True)}


@pytest.mark.parametrize("name", ["op4_url_rules", "op8_exact_dedup"])
def test_oracle(spark, name):
    import duckdb

    from tools.check_oracle import digest

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, res.fetchall())[0]


# token files

@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_matches_library(path, texts):
    mine, t = WordEncoder(path), library(path)
    odd = ["", " ", " lead", "trail ", "a  b", "tab\there", "it's we'll 'x'", "ÉCOLE Straße ΣΑΣ", "x1y2 3,000", "(a) [b] !!",
           "\u00a0 nb \u2028", "日本 語", "<|endoftext|> z", "a\nb\n\nc \n d", "é e\u0301", "\x01 \x7f", "word...!!! #tag %%%"]
    for text in [*texts.values(), *odd]:
        for _ in range(2):  # the second time from memory
            ids = np.frombuffer(mine.encode(text), "<u4").tolist()
            assert ids == t.encode(text, add_special_tokens=False).ids, text[:60]


def test_op9_files(spark, texts, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    manifest = token_frames.write_token_files(docs, BYTE, 0, folder=str(tmp_path / "tokens"))
    rows = {r["doc_id"]: r for r in token_frames.read_token_files(manifest).collect()}
    t, at = library(BYTE), 0
    for key in sorted(texts):
        ids = np.array(t.encode(texts[key], add_special_tokens=False).ids + [0], dtype="<u4")
        r = rows[key]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    files = sorted(glob.glob(str(tmp_path / "tokens" / "*")))
    assert len(files) == manifest.count() and all(f.endswith(".zst") for f in files)
    some = token_frames.read_documents(files[0], {0, 3})
    assert some[3].tolist() == t.encode(texts[3], add_special_tokens=False).ids + [0] and set(some) == {0, 3}
    assert os.path.getsize(files[0]) > 0
    import zstandard  # any reader of the public format sees one frame after another
    with open(files[0], "rb") as f:
        first = zstandard.ZstdDecompressor().decompressobj().decompress(f.read())
    assert np.frombuffer(first, "<u4").tolist() == t.encode(texts[0], add_special_tokens=False).ids + [0]
    with open(files[0], "r+b") as f:
        f.seek(12)
        f.write(b"\x00\x01\x02")
    with pytest.raises(Exception):
        token_frames.read_documents(files[0], {0})


# quality

def test_shape_of_a_whole_word():
    words = quality._Words()
    shape = lambda w: words[w] >> quality.BITS
    assert shape("a" * 64 + "b") == shape("a" * 90)  # runs are collapsed
    assert len({shape("a" * 64 + end) for end in ("b", "9", "B9", "--7x")}) == 4  # what follows the 64th character counts


def test_em_finds_the_accuracies():
    draw = np.random.default_rng(9)
    truth, counts = [], Counter()
    for _ in range(4000):
        good = draw.random() < 0.85
        low = draw.random(len(quality.HEURISTICS)) < (0.01 if good else 0.5)
        votes = tuple(int(v) for v in np.where(draw.random(len(low)) < 0.2, 0, np.where(low, -1, 1)))
        truth.append((good, votes))
        counts[quality.pattern_code(votes)] += 1
    posterior, rates, prior = quality.estimate(counts)
    right = sum((posterior[quality.pattern_code(v)] > 0.5) == g for g, v in truth)
    assert right > 0.98 * len(truth) and abs(prior - 0.85) < 0.03
    assert (rates[0] < 0.03).all() and (rates[1] > 0.4).all()
    assert quality.estimate({}) [0] == {}


def test_op10_on_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = E.queries()["op10_quality"](spark, sf).toPandas()
    assert len(rows) == 1000
    found = rows.merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    assert (found.keep == (found.quality == 1)).mean() > 0.97
    assert found.keep[found.quality == 1].mean() > 0.98


# pipeline

def test_pipeline(spark, texts):
    rows = corpus_pipeline.run(spark, SF).toPandas()
    assert rows.groupby("sequence_id").length.sum().max() <= 4096
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF)
    kept = {r["doc_id"]: r["source"] for r in docs.collect()}
    assert set(rows.doc_id) <= set(kept)
    copies = rows[rows.piece == 0].groupby("doc_id").size()
    assert copies.max() <= 3
    words = {k: len(texts[k].encode().split()) for k in kept}
    taken, sizes = Counter(), Counter()
    for k, s in kept.items():
        sizes[s] += words[k]
        taken[s] += words[k] * int(copies.get(k, 0))
    goal = mixing.targets(dict(sizes), mixing.cycle_weights(list(sizes)))
    assert all(abs(goal[s] - taken[s]) <= 0.02 * goal[s] + 2 for s in sizes)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_on_white_space_and_marks(path):
    mine, theirs = WordEncoder(path), library(path)
    fixed = ["a\nb", "a.\nB c", "x\n", "\nx y", "a\n\nb", "it's\nok 'tis", "é5! ", " a", "a\tb\nc d\x0be", "A\r\nB c", "a\x1cb c\nd", "don't\n's"]

    @given(st.text("ab .,'\n\tÉé5!-\r ", max_size=16) | st.sampled_from(fixed))
    @settings(max_examples=400, deadline=None)
    def run(text):
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids

    run()


def optimum(items, capacity):
    best = [len(items)]

    def place(i, room):
        if len(room) >= best[0]:
            return
        if i == len(items):
            best[0] = len(room)
            return
        for j in {r: j for j, r in enumerate(room) if r >= items[i]}.values():
            room[j] -= items[i]
            place(i + 1, room)
            room[j] += items[i]
        place(i + 1, [*room, capacity - items[i]])

    items = sorted(items, reverse=True)
    place(0, [])
    return best[0]


@given(st.sampled_from([20, 50, 100, 200]), st.lists(st.floats(0.02, 1), min_size=1, max_size=12), st.sampled_from([1, 2, 3]))
@settings(max_examples=400, deadline=None)
def test_packing_search_is_complete(capacity, shares, small):
    items = [max(1, int(s * capacity / small)) for s in shares]
    counts = np.bincount(items, minlength=capacity + 1)
    patterns = packing.pack_lengths(counts, capacity)
    assert all(sum(p) <= capacity for p, _ in patterns)
    held = Counter()
    for p, n in patterns:
        for x in p:
            held[x] += n
    assert held == Counter(items) and sum(n for _, n in patterns) == optimum(items, capacity)


def test_packing_search_leaves_the_good_fillings():
    counts = np.bincount([11, 13, 17, 17, 19, 20, 24, 34, 40, 41, 62], minlength=101)
    assert sum(n for _, n in packing.pack_lengths(counts, 100)) == 3
    assert all(sum(f) + min([x for x in [20, 20, 30, 50] if list(f).count(x) < [20, 20, 30, 50].count(x)], default=99) > 60
               for f in packing.fillings(np.bincount([20, 20, 30, 50], minlength=61), 60))
