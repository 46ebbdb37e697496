"""URL filter: fixed allow and block rules, and association rules mined from labels.

Method: a labelled URL is a transaction of its tokens and its class. Spark's
FP-growth finds the frequent token combinations; a combination that implies the
``block`` class with enough support and confidence is a rule, unless a rule with one
token less is as sure. Rules are looked up by an inverted index: each is filed
under its rarest token, a URL meets only the rules filed under its own tokens, and
of those the ones whose other tokens it has apply.

Support and confidence are relative, so the number of rules doesn't grow with the
labels. Rules are written and joined on their index token; Spark broadcasts them if
they are small and otherwise splits hot tokens.

Defined results: a null URL, or one without ``://``, has an empty host and path, no
tokens and no rule, and is allowed; repeated rows each keep a result; without labels
no rules are mined; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cvelake.session import stage

# Rules as host and path, with their verdicts.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
BLOCK_CLASS = "class=block"
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def tokens_of(url: Column) -> Column:
    """What rules are made of: host, its last two labels, its first label, folders
    of the path, file ending, query keys. Numbers are left out, since they name one page."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    folders = F.filter(F.split(path, "/"), lambda s: (s != "") & ~s.rlike("[0-9]"))
    keys = F.transform(F.split(F.regexp_replace(F.regexp_extract(url, _URL, 3), r"^\?", ""), "&"), lambda s: F.split(s, "=")[0])
    ending = F.regexp_extract(path, r"\.([A-Za-z]{1,8})$", 1)
    named = lambda kind, values: F.transform(values, lambda v: F.concat(F.lit(kind), v))
    all_tokens = F.concat(
        named("host=", F.array(host)),
        named("site=", F.array(F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."))),
        named("first=", F.slice(labels, 1, 1)),
        named("folder=", folders),
        named("ending=", F.array(ending)),
        named("key=", keys),
    )
    found = F.array_distinct(F.filter(all_tokens, lambda t: ~t.rlike("=$")))
    return F.when(host != "", found).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules of ``labelled`` (url, blocked boolean): tokens, index_token, confidence,
    support. Rows with a null label are left out."""
    spark = labelled.sparkSession
    items = F.concat(tokens_of(F.col("url")), F.when(F.col("blocked"), F.array(F.lit(BLOCK_CLASS))).otherwise(F.array().cast("array<string>")))
    baskets = stage(labelled.filter("blocked is not null").select(items.alias("items")).filter("size(items) > 0"), "url_baskets")
    schema = "tokens array<string>, index_token string, confidence double, support double"
    if baskets.isEmpty():
        return spark.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    sets = stage(model.freqItemsets, "url_itemsets")
    total = baskets.count()
    key = lambda tokens: F.array_join(F.array_sort(tokens), " ")
    bare = sets.filter(~F.array_contains("items", BLOCK_CLASS)).select(key(F.col("items")).alias("key"), F.col("freq").alias("uses"))
    blocked = sets.filter(F.array_contains("items", BLOCK_CLASS) & (F.size("items") > 1)).select(
        F.array_sort(F.array_remove("items", BLOCK_CLASS)).alias("tokens"), "freq"
    )
    sure = (
        blocked.withColumn("key", key(F.col("tokens")))
        .join(bare, "key")
        .select("key", "tokens", (F.col("freq") / F.col("uses")).alias("confidence"), (F.col("freq") / total).alias("support"))
        .filter(F.col("confidence") >= min_confidence)
    )
    # A rule with one token less that is as sure says all that this one says.
    shorter = sure.filter(F.size("tokens") > 1).select(
        F.col("key").alias("long"), F.col("confidence").alias("own"), F.explode("tokens").alias("left_out"), "tokens"
    )
    shorter = shorter.withColumn("key", key(F.array_remove(F.col("tokens"), F.col("left_out")))).drop("tokens")
    needless = shorter.join(sure.select("key", "confidence"), "key").filter(F.col("confidence") >= F.col("own")).select(F.col("long").alias("key"))
    kept = sure.join(needless.distinct(), "key", "left_anti")
    # The rarest token of a rule is the one it is filed under.
    single = bare.filter(~F.col("key").contains(" "))
    filed = kept.select("*", F.explode("tokens").alias("token")).join(single.select(F.col("key").alias("token"), "uses"), "token")
    index = filed.groupBy("key").agg(F.min_by("token", F.struct("uses", "token")).alias("index_token"))
    return stage(kept.join(index, "key").select("tokens", "index_token", "confidence", "support"), "url_rules")


def fixed_rule(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits the host or a parent of it, and the path's start."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        rule_host, slash, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rule_path)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def judge(pages: DataFrame, mined: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """``pages`` (url and any other columns) with host, path, rule, verdict,
    confidence (of the surest mined rule that applies) and mined_rule (its tokens)."""
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns])
    urls = pages.select(row.alias("row"), F.col("url").alias("url")).withColumn("uid", F.monotonically_increasing_id())
    judged = urls.select("row", "uid", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), tokens_of(F.col("url")).alias("own"))
    judged = stage(judged, "url_tokens")
    met = judged.select("uid", "own", F.explode("own").alias("index_token")).join(mined, "index_token")
    applies = met.filter(F.size(F.array_except("tokens", "own")) == 0)
    best = applies.groupBy("uid").agg(F.max(F.struct("confidence", F.array_join("tokens", " ").alias("tokens"))).alias("best"))
    verdicts = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    method = F.when(F.col("best").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return (
        judged.withColumn("rule", fixed_rule(F.col("host"), F.col("path"), rules))
        .join(best, "uid", "left")
        .select(
            "row",
            "host",
            "path",
            "rule",
            F.when(F.col("rule").isNotNull(), F.element_at(verdicts, F.col("rule"))).otherwise(method).alias("verdict"),
            F.col("best.confidence").alias("confidence"),
            F.col("best.tokens").alias("mined_rule"),
        )
    )
