"""URL filtering by host rules and mined association rules.

Method: FP-growth mines combinations of URL tokens that go with the label "block"; rules below the support or
confidence asked for are pruned, and so is a rule that contains a shorter one at least as confident. The rules left
match pages through an inverted index: each rule is filed under its rarest token, a page's tokens are looked up
there, and the rules found are verified on the page's whole token set. Native DataFrame operations throughout.

A URL is labelled by the fixed host rules where one fits it, and else by the labels table where that has its id; URLs with neither take no part
in the fit. FP-growth is fitted on at most ``TRAIN_ROWS`` labelled URLs (smallest hashes of the id), so the rules are few at any
size of the table; every URL is judged. A mined rule may have any number of tokens.

Cases: a null URL or one without "://" has an empty host and path, no rule, and the verdict allow; labels with null
ids or values are ignored; without labels no rule is mined; a repeated row is judged again; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import checked_join, let, stash

TRAIN_ROWS = 50_000
BLOCK = "label=block"
RULE_SCHEMA = T.StructType([T.StructField("rule_id", T.LongType()), T.StructField("anchor", T.StringType()), T.StructField("tokens", T.ArrayType(T.StringType())), T.StructField("confidence", T.DoubleType()), T.StructField("support", T.DoubleType())])


def host_and_path(url: Column) -> Column:
    """struct<host, path>: host after the first "://" up to / ? # with A-Z lower-cased; path then up to ? or #."""
    found = F.instr(url, "://")
    rest = F.when(found > 0, F.substring(url, found + F.lit(3), F.length(url))).otherwise(F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def split(r: Column) -> Column:
        host = F.regexp_extract(r, r"(?s)^([^/?#]*)", 1)
        return F.struct(F.translate(host, upper, lower).alias("host"), F.regexp_extract(r, r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"))

    return let(F.coalesce(rest, F.lit("")), split)


def host_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct<rule, verdict> of the longest rule (verdict, host, path) that fits; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # the longest is tested first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens: the scheme, each domain a host lies under, the host's labels, words of the path (runs of letters), and query keys."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    named = lambda kind, words: F.transform(words, lambda x: F.concat(F.lit(kind + "="), F.lower(x)))

    def domains(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(x)), lambda i: F.array_join(F.slice(x, i, F.size(x) - i + F.lit(1)), "."))

    hosts = F.when(F.size(labels) == 0, F.array().cast("array<string>")).otherwise(let(labels, domains))
    own = F.filter(labels, lambda x: ~x.rlike("^(com|net|org|www)$"))
    words = F.filter(F.split(path, r"\P{L}+"), lambda x: x != "")
    keys = F.regexp_extract_all(url, F.lit(r"[?&]([A-Za-z_]+)="), F.lit(1))
    scheme = F.regexp_extract_all(url, F.lit(r"^([A-Za-z][A-Za-z0-9+.-]*)://"), F.lit(1))
    parts = [named(k, w) for k, w in (("scheme", scheme), ("host", hosts), ("label", own), ("path", words), ("key", keys))]
    return F.array_distinct(F.coalesce(F.concat(*parts), F.array().cast("array<string>")))


def parsed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, tokens."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.withColumn("p", host_and_path(F.col("url")))
    return rows.select("page_id", F.col("p.host").alias("host"), F.col("p.path").alias("path"), tokens(F.col("p.host"), F.col("p.path"), F.col("url")).alias("tokens"))


def labelled(pages: DataFrame, labels: DataFrame, host_rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id", bad: Column | None = None) -> DataFrame:
    """(page_id, url, bad) of the labelled rows: what a fixed rule says of the URL, else what ``labels`` say of the id."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1) if bad is None else bad
    told = labels.where(F.col(label_id).isNotNull()).select(F.col(label_id).alias("page_id"), bad.alias("told")).where("told is not null").groupBy("page_id").agg(F.max("told").alias("told"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumn("p", host_and_path(F.col("url")))
    fixed = host_rule(F.col("p.host"), F.col("p.path"), host_rules)["verdict"] == "block"
    return rows.withColumn("fixed", fixed).join(told, "page_id", "left").select("page_id", "url", F.coalesce("fixed", "told").alias("bad")).where("bad is not null")


def mine(sample: DataFrame, support: float = 0.002, confidence: float = 0.95, train_rows: int = TRAIN_ROWS, least_rows: int = 12) -> DataFrame:
    """Rules (rule_id, anchor, tokens, confidence, support) for bad URLs, from ``labelled`` rows; each is seen in ``least_rows`` rows or more."""
    sample = sample.orderBy(F.xxhash64("page_id"), "page_id", "url").limit(train_rows)
    rows = stash(parsed(sample.select(F.struct("page_id", "bad").alias("page_id"), "url")).select(F.when(F.col("page_id.bad"), F.array_append("tokens", F.lit(BLOCK))).otherwise(F.col("tokens")).alias("items")), "urls")
    count = rows.count()
    if not count:
        return sample.sparkSession.createDataFrame([], RULE_SCHEMA)
    found = stash(FPGrowth(itemsCol="items", minSupport=min(max(support, least_rows / count), 1.0)).fit(rows).freqItemsets.withColumn("items", F.array_sort("items")), "itemsets")
    bad = found.where(F.array_contains("items", BLOCK) & (F.size("items") > 1)).select(F.array_remove("items", BLOCK).alias("tokens"), F.col("freq").alias("hits"))
    rules = bad.join(found.select(F.col("items").alias("tokens"), "freq"), "tokens").select("tokens", (F.col("hits") / F.col("freq")).alias("confidence"), (F.col("hits") / count).alias("support"))
    rules = stash(rules.where(F.col("confidence") >= confidence), "rules")
    # a part of a rule has its own first token among the rule's tokens
    short = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("c"), F.get("tokens", F.lit(0)).alias("token"))
    covers = (F.size("part") < F.size("tokens")) & (F.size(F.array_intersect("part", "tokens")) == F.size("part")) & (F.col("c") >= F.col("confidence"))
    implied = rules.withColumn("token", F.explode("tokens")).join(short, "token").where(covers).select("tokens").distinct()
    pruned = rules.join(implied, "tokens", "left_anti")
    use = rows.select(F.explode("items").alias("anchor")).groupBy("anchor").count()
    anchored = pruned.withColumn("anchor", F.explode("tokens")).join(use, "anchor").groupBy("tokens", "confidence", "support").agg(F.min_by("anchor", F.struct("count", "anchor")).alias("anchor"))
    return stash(anchored.select(F.xxhash64("tokens").alias("rule_id"), "anchor", "tokens", "confidence", "support"), "url-rules")


def judge(pages: DataFrame, rules: DataFrame, host_rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, mined (tokens of the most confident mined rule that fits, or null)."""
    rows = parsed(pages, id_col, url_col).withColumn("fixed", host_rule(F.col("host"), F.col("path"), host_rules))
    rows = stash(rows.withColumn("row", F.monotonically_increasing_id()), "url-rows")  # written once, so a row's number holds
    index = rules.select("anchor", F.col("tokens").alias("needs"), "confidence", "support")
    hits = checked_join(rows.select("row", "tokens", F.explode("tokens").alias("anchor")), index, ["anchor"])
    best = hits.where(F.size(F.array_except("needs", "tokens")) == 0).groupBy("row").agg(F.max(F.struct("confidence", "support", "needs")).alias("best"))
    out = checked_join(rows, stash(best, "url-hits"), ["row"], "left")
    verdict = F.coalesce(F.col("fixed.verdict"), F.when(F.col("best").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), verdict.alias("verdict"), F.array_join("best.needs", " ").alias("mined"))
