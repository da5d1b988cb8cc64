"""Text features (F11, F12, G7, G12, G13) on whole texts.

Tokens are maximal runs of letters, digits and underscore of length >= 2
after F12 normalisation; bigrams join neighbouring tokens with one space.
Everything runs as explode + aggregations; only the 10-term vocabulary (a
fixed bound) reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlens.functions.expr import normalize_text
from tenderlens.session import cut_lineage

TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def tokens(c) -> F.Column:
    return F.regexp_extract_all(normalize_text(c), F.lit(TOKEN_PATTERN), 0)


def unigrams_bigrams(t: F.Column) -> F.Column:
    bigrams = F.filter(F.transform(t, lambda x, i: F.when(i > 0, F.concat(t[i - 1], F.lit(" "), x))),
                       lambda x: x.isNotNull())
    return F.concat(t, bigrams)


def every_term(df: DataFrame, key: str, text: str, ngrams: bool = True) -> DataFrame:
    """(key, term) for every place of a term."""
    # tokens are materialised once per document; the bigram lambda indexes that column
    tok = df.select(key, tokens(text).alias("__tok"))
    t = F.col("__tok")
    return tok.select(key, F.explode(unigrams_bigrams(t) if ngrams else t).alias("term"))


def term_counts(df: DataFrame, key: str, text: str, ngrams: bool = True) -> DataFrame:
    """(key, term, tf) for every document and term."""
    return every_term(df, key, text, ngrams).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def tfidf_long(df: DataFrame, key: str, text: str, max_features: int = 10, min_df: int = 2,
               min_rows: int = 30, min_chars: int = 100) -> DataFrame:
    """(key, term, tfidf) for the ``max_features`` most frequent terms.

    Vocabulary: terms in >= ``min_df`` documents, top by corpus frequency
    (ties by term); idf = ln((1+n)/(1+df)) + 1; rows L2-normalised over the
    vocabulary. Every document gets a row per vocabulary term (zeros kept).
    The gate (>= 30 rows, > 100 characters in total) returns no rows when not met.

    A first pass adds up each term's total, in every task before the totals meet,
    beside its least and largest key, which tell whether two documents have it.
    Terms per document are counted in a second pass, for the most frequent terms
    only (``max_features`` of them, more when ``min_df`` over 2 leaves some out), so
    no row for every document and term is moved or written.
    ``min_rows``, ``min_chars`` and the number of terms are the operator's own
    rule for which columns are worth the features.
    """
    d = df.select(key, F.coalesce(F.col(text), F.lit("")).alias("__t"))
    spark = df.sparkSession
    gate = d.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("__t")).alias("chars")).first()
    n, chars = int(gate["n"]), int(gate["chars"] or 0)
    schema = f"{key} {df.schema[key].dataType.simpleString()}, term string, tfidf double"
    if n < min_rows or chars <= min_chars:
        return spark.createDataFrame([], schema)
    found = every_term(d, key, "__t")
    totals = found.groupBy("term").agg(F.count(F.lit(1)).alias("tot"), F.count(key).alias("known"), F.min(key).alias("lo"), F.max(key).alias("hi"))
    if min_df > 1:  # a null key is a document of its own
        totals = totals.where((F.col("lo") != F.col("hi")) | ((F.col("known") > 0) & (F.col("known") < F.col("tot"))))
    totals = totals.select("term", "tot")
    if min_df > 2:
        totals = cut_lineage(totals, "term_totals")
    vocab, counted, page, take = [], [], [], max_features
    while len(vocab) < max_features and len(page) in (0, take):
        rest = totals
        if page:
            tot, term, take = page[-1]["tot"], page[-1]["term"], min(4 * take, 10_000)
            rest = rest.where((F.col("tot") < tot) | ((F.col("tot") == tot) & (F.col("term") > term)))
        page = rest.orderBy(F.col("tot").desc(), "term").limit(take).collect()
        if not page:
            break
        counted.append(cut_lineage(found.where(F.col("term").isin([r["term"] for r in page])).groupBy(key, "term")
                                   .agg(F.count(F.lit(1)).alias("tf")), "terms"))
        dfs = {r["term"]: r["df"] for r in counted[-1].groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}
        vocab += [(r["term"], int(dfs[r["term"]])) for r in page if dfs[r["term"]] >= min_df][: max_features - len(vocab)]
    if not vocab:
        return spark.createDataFrame([], schema)
    import math
    idf = {t: math.log((1.0 + n) / (1.0 + dfv)) + 1.0 for t, dfv in vocab}
    terms = [t for t, _ in vocab]
    idf_map = F.create_map(*[x for t in terms for x in (F.lit(t), F.lit(idf[t]))])
    hits = reduce(DataFrame.unionByName, counted).filter(F.col("term").isin(terms))
    w = hits.select(key, "term", (F.col("tf") * idf_map[F.col("term")]).alias("w"))
    per_doc = w.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("term", "w"))).alias("__m"))
    per_doc = per_doc.select(key, "__m", F.sqrt(F.aggregate(F.map_values("__m"), F.lit(0.0),
                                                            lambda acc, x: acc + x * x)).alias("__norm"))
    docs = d.select(key).join(per_doc, key, "left")
    rows = docs.select(key, "__m", "__norm", F.explode(F.array(*[F.lit(t) for t in terms])).alias("term"))
    val = F.coalesce(rows["__m"][F.col("term")] / F.col("__norm"), F.lit(0.0))
    return rows.select(key, "term", val.alias("tfidf"))


def tfidf_wide(df: DataFrame, key: str, text: str, **kw) -> DataFrame:
    """G7 wide form: one ``TFIDF_<col>_<term>`` column per vocabulary term."""
    long = tfidf_long(df, key, text, **kw)
    terms = [r[0] for r in long.select("term").distinct().orderBy("term").limit(kw.get("max_features", 10)).collect()]
    if not terms:
        return df
    w = long.groupBy(key).pivot("term", terms).agg(F.first("tfidf"))
    return df.join(w.select(key, *[F.col(f"`{t}`").alias(f"TFIDF_{text}_{t}") for t in terms]), key, "left")


def hash_bucket(c: F.Column, dim: int) -> F.Column:
    """Stable bucket of a string: first 8 hex digits of its md5, modulo ``dim``."""
    return (F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long") % F.lit(dim)).cast("int")


def embed_text_long(df: DataFrame, key: str, text: str, dim: int = 64) -> DataFrame:
    """G12 default encoder: hashed bag of words, L2-normalised -> (key, dim, value).

    A model-based encoder can replace it (see :func:`embed_with`); this one
    needs no model files and runs fully in the JVM.
    """
    d = df.select(key, F.coalesce(F.col(text), F.lit("")).alias("__t"))
    tok = d.select(key, F.explode(tokens("__t")).alias("tok"))
    cnt = tok.groupBy(key, hash_bucket(F.col("tok"), dim).alias("dim")).agg(F.count(F.lit(1)).alias("c"))
    norm = cnt.groupBy(key).agg(F.sqrt(F.sum(F.col("c") * F.col("c"))).alias("__n"))
    return cnt.join(norm, key).select(key, "dim", (F.col("c") / F.col("__n")).alias("value"))


def long_to_dense(long: DataFrame, key: str, dim: int, all_keys: DataFrame | None = None) -> DataFrame:
    """(key, dim, value) -> (key, embedding array<double> of length ``dim``)."""
    m = long.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("dim", "value"))).alias("__m"))
    if all_keys is not None:
        m = all_keys.select(key).distinct().join(m, key, "left")
    arr = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.coalesce(F.col("__m")[i], F.lit(0.0)))
    return m.select(key, arr.alias("embedding"))


def embed_text_dense(df: DataFrame, key: str, text: str, dim: int = 64) -> DataFrame:
    """G12 in dense form: (key, embedding array<double> of length ``dim``), one row per key, without a join.

    Keys without tokens, and the null key, have zeros.
    """
    tok = df.select(key, F.explode_outer(tokens(F.coalesce(F.col(text), F.lit("")))).alias("tok"))
    cnt = tok.groupBy(key, hash_bucket(F.col("tok"), dim).alias("dim")).agg(F.count("tok").alias("c"))
    held = F.when(F.col("dim").isNotNull() & F.col(key).isNotNull(), F.struct("dim", "c"))
    m = cnt.groupBy(key).agg(F.map_from_entries(F.collect_list(held)).alias("__m"))
    norm = F.sqrt(F.aggregate(F.map_values("__m"), F.lit(0).cast("bigint"), lambda acc, c: acc + c * c))
    arr = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.coalesce(F.col("__m")[i] / F.col("__n"), F.lit(0.0)))
    return m.select(key, "__m", norm.alias("__n")).select(key, arr.alias("embedding"))


def embed_with(df: DataFrame, key: str, text: str, encoder, dim: int, batch_size: int = 32) -> DataFrame:
    """G12 plug-in: ``encoder()`` returns a function ``pandas.Series[str] -> list[list[float]]``.

    The function is created once per task (iterator pandas UDF) and sees at most
    ``batch_size`` texts at once; texts are whole and NULL becomes ''. A vector that
    does not have ``dim`` entries raises.
    """
    import pandas as pd
    from pyspark.sql.types import ArrayType, DoubleType

    def run(batches):
        model = encoder()  # built once per task
        for s in batches:
            s, made = s.fillna(""), []
            for at in range(0, len(s), batch_size):
                made += [[float(x) for x in v] for v in model(s.iloc[at: at + batch_size])]
            if len(made) != len(s) or any(len(v) != dim for v in made):
                raise ValueError(f"the encoder must give {dim} numbers for every text")
            yield pd.Series(made, index=s.index, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    enc = F.pandas_udf(run, ArrayType(DoubleType()))
    return df.select(key, enc(F.col(text)).alias("embedding"))


def reduced_text_features(df: DataFrame, key: str, text: str, k: int = 20, dim: int = 64,
                          prefix: str | None = None) -> DataFrame:
    """Hashed embedding -> centred PCA with k components -> ``PCA_<text>_<i>`` columns."""
    from tenderlens.operators.reduce import pca_reduce
    dense = cut_lineage(embed_text_dense(df, key, text, dim), "embeddings")  # the fit reads it several times
    return pca_reduce(dense, key, "embedding", k=k, prefix=prefix or f"PCA_{text}")
