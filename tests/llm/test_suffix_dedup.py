"""Deep-shallow sorting and the removal of repeated byte strings, against brute force."""

import hashlib
import random
from collections import Counter

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from tenderlens.llm import substring_dedup, suffix_sort

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string"


def covered(texts, length):
    counts = Counter(t[i: i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        marks = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if counts[t[i: i + length]] > 1:
                marks[i: i + length] = b"\1" * length
        out.append(marks)
    return out


def expected(texts, length):
    for t, marks in zip(texts, covered(texts, length)):
        kept = bytes(x for x, m in zip(t, marks) if not m)
        runs = sum(m and not (i and marks[i - 1]) for i, m in enumerate(marks))
        yield len(t), sum(marks), runs, hashlib.sha256(kept).hexdigest()


@given(st.lists(st.binary(max_size=6).map(lambda b: b"long common prefix of all of them " * 3 + b) | st.binary(max_size=90)
                | st.text("ab\0", max_size=90).map(str.encode), max_size=120))
@settings(max_examples=150, deadline=None)
def test_sort_and_common_prefixes(strings):
    order, common = suffix_sort.sort_strings(strings)
    got = [strings[i] for i in order]
    assert sorted(order.tolist()) == list(range(len(strings))) and got == sorted(strings)
    assert all(common[i] == suffix_sort.common_prefix(got[i - 1], got[i]) for i in range(1, len(got)))


def test_common_prefix():
    for a, b, n in ((b"", b"x", 0), (b"abc", b"abd", 2), (b"abc", b"abc", 3), (b"abc", b"abcd", 3), (b"x", b"y", 0)):
        assert suffix_sort.common_prefix(a, b) == n


def sample():
    rng = random.Random(7)
    word = lambda n, abc: "".join(rng.choice(abc) for _ in range(n))
    shared = word(40, "abcdefgh")
    texts = [word(rng.randint(0, 40), "ab") for _ in range(30)]
    texts += [word(rng.randint(0, 30), "abcdefgh") + shared[rng.randint(0, 9): rng.randint(20, 40)]
              + word(rng.randint(0, 30), "abcdefgh") for _ in range(50)]
    return texts + texts[:3] + ["a" * 60, "é" * 30, "", None, "日本語" * 9]


@pytest.mark.parametrize("length,gram,group_rows", [(12, 5, 20_000), (12, 5, 2), (8, 8, 3), (6, 1, 20_000)])
def test_removal_is_brute_force(spark, length, gram, group_rows):
    texts = sample()
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    rows = {r["doc_id"]: r for r in substring_dedup.remove_repeats(df, length, gram, group_rows).collect()}
    for i, (n, removed, runs, digest) in enumerate(expected([(t or "").encode() for t in texts], length)):
        r = rows[i]
        assert (r["n_bytes"], n - len(r["kept"]), len(r["spans"])) == (n, removed, runs)
        assert hashlib.sha256(r["kept"]).hexdigest() == digest


def test_cut_texts_match(spark, monkeypatch):
    """Texts longer than a chunk are cut; strings across the cuts still meet their copies."""
    texts = sample()
    long = "".join(t or "" for t in texts)
    whole = [t.encode() for t in (long, long[333:], "x" * 500)]
    marks = covered(whole, 12)
    monkeypatch.setattr(substring_dedup, "_CHUNK", 64)
    rows = []
    import numpy as np
    offsets = np.cumsum([0] + [len(t) for t in whole])
    for pieces in substring_dedup._chunks(offsets, 12):
        for row, a, b in pieces:
            data = np.frombuffer(b"".join(whole), np.uint8)[a:b]
            first, count, o, _ = substring_dedup.segments(data, np.array([len(data)]), 12, 5)
            for f, c, s in zip(first + a - offsets[row], count, o):
                body = whole[row][f: f + c + 11]
                assert len(body) == c + 11
                rows.append((row, f, c, s, body))
    starts = {(r[0], r[1] + i) for r in rows for i in range(r[2])}
    assert starts == {(i, p) for i, t in enumerate(whole) for p in range(len(t) - 11)}
    assert sum(map(sum, marks)) > 0


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "b" * 399), (3, "c" * 400), (3, "c" * 400), (4, "d" * 401), (5, "e" * 5_000_000),
            (None, None), (6, "é" * 200)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("uid", "id", "body", "h", "d", "n", "o", "w", "s", "first", "kept"):
        df = df.withColumn(c, F.lit("clash"))
    got = substring_dedup.removal_report(df)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got.collect()) == sorted([
        ("1", 0, 0, 0), ("2", 0, 0, 0), ("None", 399, 0, 0), ("3", 400, 400, 1), ("3", 400, 400, 1), ("4", 401, 401, 1),
        ("5", 5_000_000, 5_000_000, 1), ("None", 0, 0, 0), ("6", 400, 0, 0)])
    assert substring_dedup.removal_report(df.limit(0)).collect() == []


def test_query_is_brute_force(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id").text
    rows = {r["doc_id"]: r for r in E.queries()["op13_suffix_dedup"](spark, SF).collect()}
    want = dict(zip(docs.index, expected([t.encode() for t in docs.fillna("")], 400)))
    assert {k: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for k, r in rows.items()} == want
    assert sum(r["n_removed"] for r in rows.values()) > 0
