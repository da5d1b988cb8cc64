"""URL rules by a sort-merge range join.

A host becomes a key of its labels in reverse order, each ended by a dot
(``net.example.blog.``). All keys that a rule's host covers - the host and its
subdomains - then lie in one interval, from the rule's key up to that key
followed by the byte FF, which no UTF-8 text holds. Intervals of prefixes are
nested or apart, so a sweep over the sorted keys keeps a stack of open ones: the
depth is a running sum of openings and closings, and the entry at each level is
the last interval opened at that depth. Both are running window functions over
range buckets of the keys; an interval that spans buckets is opened again at the
start of each, so buckets are swept apart. A second sweep finds, below each rule
host that covers a URL, the longest path prefix in the same way.

Only different keys are swept, so a host with a third of all pages is one point;
pages meet their verdict by an equi-join on (host, path).

Defined results: a null URL or one without ``://`` has an empty host and path; of
fitting rules the one with the longest host and path together wins, then the
longer host, then a block; a rule given with both actions blocks; pages keep all
their rows; an empty rule table gives every page the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bucket_of, parts

# fixed values of the registered query: (host, path, action)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(a).alias("action")) for h, p, a in rules]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def host_and_path(url: str) -> tuple[Column, Column]:
    text = F.col(url).cast("string")
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def host_key(host: Column) -> Column:
    return F.encode(F.concat(F.array_join(F.reverse(F.split(host, "\\.", -1)), "."), F.lit(".")), "utf-8")


def _cut_points(points: DataFrame, n: int) -> list:
    """n - 1 keys that split the points evenly, from the 16 n keys of smallest hash (bounded, the same on a rerun)."""
    some = points.orderBy(F.xxhash64("key"), "key").limit(16 * n).collect()
    keys = sorted(bytes(r["key"]) for r in some)
    return sorted({keys[len(keys) * i // n] for i in range(1, n)}) if keys else []


def covering_prefixes(points: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Different points (binary ``key``) with ``stack``: the prefixes that cover each, outermost first.

    ``prefixes`` holds different, binary ``key`` values. Points without any are left out.
    """
    n = parts(points.sparkSession)
    bounds = _cut_points(points, n)
    end = F.concat(F.col("key"), F.lit(bytearray(b"\xff")))
    spans = prefixes.select("key", end.alias("end"), bucket_of(F.col("key"), bounds).alias("first"),
                            bucket_of(end, bounds).alias("last"))
    nothing = F.lit(bytearray())
    opened = (spans.select(F.explode(F.sequence("first", "last")).alias("bucket"), "key", "first")
              .select("bucket", F.when(F.col("bucket") == F.col("first"), F.col("key")).otherwise(nothing).alias("at"),
                      F.lit(1).alias("kind"), "key"))
    closed = spans.select(F.col("last").alias("bucket"), F.col("end").alias("at"), F.lit(0).alias("kind"), "key")
    order = Window.partitionBy("bucket").orderBy("at", "kind", "key")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    depth = F.sum(F.when(F.col("kind") == 1, 1).when(F.col("kind") == 0, -1).otherwise(0)).over(running)
    events = opened.unionByName(closed)
    deepest = events.withColumn("depth", depth).agg(F.max("depth")).first()[0] or 0
    swept = events.unionByName(points.select(bucket_of(F.col("key"), bounds).alias("bucket"), F.col("key").alias("at"),
                                             F.lit(2).alias("kind"), "key")).withColumn("depth", depth)
    levels = [F.last(F.when((F.col("kind") == 1) & (F.col("depth") == k), F.col("key")), ignorenulls=True)
              .over(running).alias(f"level{k}") for k in range(1, deepest + 1)]
    swept = swept.select("kind", "key", "depth", *levels)
    stack = F.array(*[F.col(f"level{k}") for k in range(1, deepest + 1)]) if deepest else F.array(nothing)
    return (swept.where((F.col("kind") == 2) & (F.col("depth") > 0))
            .select("key", F.slice(stack, F.lit(1), F.col("depth").cast("int")).alias("stack")))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per page: id, host, path, rule (host and path, null if none fits), verdict."""
    host, path = host_and_path(url_col)
    rules = (rules.groupBy("host", "path")
             .agg(F.max(F.when(F.col("action") == "block", 1).otherwise(0)).alias("blocks"))
             .select("blocks", F.concat("host", "path").alias("rule"), F.length("host").alias("host_chars"),
                     host_key(F.col("host")).alias("rule_host"), F.encode("path", "utf-8").alias("rule_path")))
    split = lambda h, p: F.concat(h, F.lit(bytearray(b"\x00")), p)
    rules = rules.withColumn("prefix", split(F.col("rule_host"), F.col("rule_path")))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    pairs = urls.select("host", "path").distinct()
    hosts = pairs.select(host_key(F.col("host")).alias("key")).distinct()
    covered = covering_prefixes(hosts, rules.select(F.col("rule_host").alias("key")).distinct())
    below = (pairs.withColumn("key", host_key(F.col("host")))
             .join(covered.select("key", F.explode("stack").alias("rule_host")), "key")
             .select("host", "path", split(F.col("rule_host"), F.encode("path", "utf-8")).alias("key")))
    fitting = (covering_prefixes(below.select("key").distinct(), rules.select(F.col("prefix").alias("key")))
               .select("key", F.element_at("stack", -1).alias("prefix"))  # the longest path below this rule host
               .join(rules.select("prefix", "rule", "host_chars", "blocks"), "prefix"))
    longest = F.struct(F.length("rule"), "host_chars", "blocks", "rule")
    best = (below.join(fitting, "key").groupBy("host", "path")
            .agg(F.max_by(F.struct("rule", "blocks"), longest).alias("best")))
    verdict = F.when(F.col("best").isNull(), F.lit(default)).when(F.col("best.blocks") == 1, "block").otherwise("allow")
    return (urls.join(best, ["host", "path"], "left")
            .select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
                    verdict.alias("verdict")))


URL_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
r AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                            ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) AS t(h, q, action)),
f AS (
  SELECT p.page_id, r.h || r.q AS rule, r.action,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.h || r.q) DESC, length(r.h) DESC) AS place
  FROM p JOIN r ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.q))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM p LEFT JOIN f ON p.page_id = f.page_id AND f.place = 1
"""
