"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tenderlens.llm import (attention, attention_lm, exact_dedup, mixing, packing, quality, simhash, token_frames,
                            url_rules, viterbi, winnowing)
from tenderlens.llm.encode import tokenizer_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ("id", "rank", "bucket", "key", "row", "fp", "n", "size", "whole", "norm", "guest", "length", "mixed", "root", "chars")
WORD, BYTE, PIECE = (tokenizer_path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
LONG = " ".join(f"word{i % 977} and, then." for i in range(12_000))
ROWS = [(1, "alpha beta gamma delta epsilon", "en", "a", 1), (2, "", "en", "a", 0), (3, None, None, None, None),
        (4, " \n\t ", "en", "b", 4), (5, "alpha beta gamma delta epsilon", "en", "b", 1), (None, "lost one", "en", "b", 8),
        (None, None, "en", None, 0), (6, LONG, "en", "c", 1), (7, "x", "en", "c", 1), (7, "x", "en", "c", 1),
        (8, "naïve Ünïcode – 日本語 \U0001F600 test", "de", "c", 1), (9, "y" * 300_000, "en", "", 1),
        (10, "a  b   c \u00a0 d\u2028e", "en", "a", 1), (11, "<|endoftext|> it's 'quoted' #5", "en", "a", 1)]

RUNS = {
    "winnowing": lambda d: winnowing.fingerprint_edits(d),
    "fingerprints": lambda d: winnowing.fingerprint_documents(d),
    "mixing": lambda d: mixing.mix_sources(d),
    "attention_lm": lambda d: attention_lm.score_texts(d, BYTE, shape=attention.Shape(width=8, hidden=8, context=16, overlap=4)),
    "simhash": lambda d: simhash.simhash_components(d),
    "viterbi": lambda d: viterbi.count_tokens(d, PIECE),
    "exact_dedup": lambda d: exact_dedup.exact_dedup(d),
    "token_frames": lambda d: token_frames.read_token_files(token_frames.write_token_files(d, BYTE, 0)),
    "quality": lambda d: quality.score_documents(d),
}


def crowded(df):
    for c in CLASH:
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def docs(spark):
    return crowded(spark.createDataFrame(ROWS, SCHEMA))


@pytest.fixture(scope="module")
def nothing(spark):
    return crowded(spark.createDataFrame([], SCHEMA))


@pytest.mark.parametrize("name", RUNS)
def test_one_row_per_document(docs, nothing, name):
    rows = RUNS[name](docs).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ROWS)
    assert RUNS[name](nothing).collect() == []


def test_packing_covers_everything(docs, nothing):
    rows = packing.pack_documents(docs, WORD, 1).toPandas()
    assert rows[rows.piece == 0].shape[0] == len(ROWS)
    assert packing.pack_documents(nothing, WORD, 1).count() == 0
    spans = rows.sort_values(["sequence_id", "offset"])
    assert (spans.groupby("sequence_id").length.cumsum() - spans.length == spans.offset).all()
    assert rows.groupby("sequence_id").length.sum().max() <= 4096


def test_urls(spark):
    pages = [(1, "http://A.Net/x"), (2, None), (3, "no scheme"), (4, "http://net"), (5, "http://x.example.NET/en/1?q#f"),
             (5, "http://x.example.NET/en/1?q#f"), (None, "https://a.org/fr/"), (6, "http://"), (7, "ftp://example.com/de/#x"),
             (8, "http://network/"), (9, "http://net./"), (10, "x://a.b.example.net/en" + "z" * 100_000)]
    df = crowded(spark.createDataFrame(pages, "page_id bigint, url string"))
    rows = url_rules.judge_urls(df, url_rules.rule_table(spark)).collect()
    got = sorted((str(r["page_id"]), r["rule"], r["verdict"]) for r in rows)
    assert got == sorted([("1", "net/", "block"), ("2", None, "allow"), ("3", None, "allow"), ("4", None, "allow"),
                          ("5", "example.net/en/", "allow"), ("5", "example.net/en/", "allow"), ("None", "org/fr/", "allow"),
                          ("6", None, "allow"), ("7", "example.com/de/", "block"), ("8", None, "allow"),
                          ("9", None, "allow"), ("10", "net/", "block")])
    assert url_rules.judge_urls(df.limit(0), url_rules.rule_table(spark)).count() == 0
    no_rules = url_rules.rule_table(spark).limit(0)
    assert {r["verdict"] for r in url_rules.judge_urls(df, no_rules, default="block").collect()} == {"block"}


def test_stages_keep_columns(spark, docs, nothing):
    for table in (docs, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, "")
            assert out.columns == table.columns
            kept = out.select(*SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")).collect()
            assert {tuple(r) for r in kept} <= set(ROWS)
        assert "sequence_id" in corpus_pipeline.STAGES[-1][1](spark, table, "").columns


def test_stage_decisions(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    exact = [tuple(r)[:2] for r in stages["exact_dedup"](spark, docs, "").collect()]
    assert len(exact) == 9  # one of the empty texts, one "alpha ...", one "x"
    assert sum(t in (None, "", " \n\t ") for _, t in exact) == 1 and (4, " \n\t ") in exact
    near = [r["doc_id"] for r in stages["simhash_near_dedup"](spark, docs, "").collect()]
    assert near.count(7) == 1 and 5 not in near and 1 in near
    good = [r["doc_id"] for r in stages["quality_classifier"](spark, docs, "").collect()]
    assert 1 in good and 2 not in good and 3 not in good
