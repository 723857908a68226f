"""Operator 3. URL filters: listed rules, and association rules mined by FP-growth.

Every URL becomes tokens of all its parts: scheme, every suffix of the host, every
path segment, extension, path depth, every query key and key=value, fragment.
Labelled pages are baskets of their tokens and, for bad pages (quality 0 or toxic
1), the item ``BAD``. A rule "tokens -> BAD" needs at least MIN_SUPPORT of the
baskets (and MIN_COUNT of them), MIN_CONFIDENCE, and has at most RULE_TOKENS
tokens. Tokens that are in too few bad baskets for any rule are dropped first;
Spark's FP-growth mines what is left.

FP-growth lists all subsets of what is often seen together, so a basket of many
frequent tokens is cut before: tokens are hashed to classes, and a basket becomes
one sub-basket for every set of up to RULE_TOKENS classes that it has tokens of. A
token set is counted in the sub-baskets of exactly its classes, which all baskets
that hold it have, so counts and rules are those of the whole baskets. With more
classes sub-baskets get as small as needed (BASKET_TOKENS), whatever the URLs.

Matching uses one inverted index over both kinds of rules: a listed rule stands
under its host, a mined rule under its rarest token. A page looks up its host's
suffixes and its tokens, and what it finds is checked in full: a listed rule
needs its path to begin the page's path, a mined one all its tokens. The
longest listed rule decides; without one a page is blocked if a mined rule
matches, else allowed. The lookup is a broadcast join while the index has at
most BROADCAST_RULES rows, else a shuffled one; results are the same. Only
DataFrame functions and Spark's FP-growth run, no Python.

Edge cases: a null URL or one without "://" has an empty host and path, no
tokens and no listed rule; without labels (or with fewer than MIN_COUNT labelled
pages, which no rule can reach) nothing is mined; labels that repeat a page
count once (the worse); repeated pages, null ids: judged row by row; equally
long listed rules: the greater string; other columns do not reach the result.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from .common import saved

MIN_SUPPORT, MIN_COUNT, MIN_CONFIDENCE = 0.002, 20, 0.7
#: Tokens of a rule; tokens of a basket that FP-growth sees (2**12 subsets).
RULE_TOKENS, BASKET_TOKENS = 3, 12
BROADCAST_RULES = 20_000
BAD = "bad page"
#: (host, path, verdict)
LISTED = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
          ("com", "/fr/", "allow"), ("com", "/de/", "block"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
INDEX = ("key string, tokens array<string>, confidence double, support double, "
         "path string, rule string, verdict string")


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path and tokens of every row."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).withColumn(
        "rest", F.coalesce(rest, F.lit("")))
    p = p.withColumn("raw", F.regexp_extract("rest", r"^[^/?#]*", 0))
    p = p.withColumns({"host": F.translate("raw", UPPER, LOWER), "after": F.expr("substring(rest, length(raw) + 1)")})
    p = p.withColumn("path", F.regexp_extract("after", r"^[^?#]*", 0))
    p = p.withColumns({
        "labels": F.split("host", r"\."), "segments": F.filter(F.split("path", "/"), lambda x: x != ""),
        "params": F.filter(F.split(F.regexp_extract("after", r"^[^?#]*\?([^#]*)", 1), "&"), lambda x: x != "")})
    n = F.size("labels")
    none = F.array().cast("array<string>")
    token = lambda kind, value: F.when(value != "", F.concat(F.lit(kind + "="), value))
    last = F.element_at(F.col("segments"), -1)
    tokens = F.concat(
        F.array(token("scheme", F.lower(F.expr("substring(url, 1, instr(url, '://') - 1)")))),
        F.transform(F.sequence(F.lit(1), n), lambda i: token("host", F.array_join(F.slice("labels", i, n - i + 1), "."))),
        F.transform("segments", lambda x: F.concat(F.lit("seg="), F.lower(x))),
        F.array(token("ext", F.when(F.size("segments") > 0, F.regexp_extract(last, r"\.([A-Za-z0-9]{1,5})$", 1))),
                F.concat(F.lit("deep="), F.size("segments").cast("string"))),
        F.transform("params", lambda x: token("key", F.regexp_extract(x, "^[^=]*", 0))),
        F.transform("params", lambda x: F.when(F.contains(x, F.lit("=")), F.concat(F.lit("param="), x))),
        F.array(F.when(F.instr("after", "#") > 0, F.lit("fragment=yes"))))
    return p.select("page_id", "url", "host", "path",
                    F.when(F.col("host") == "", none).otherwise(F.array_distinct(F.array_compact(tokens))).alias("tokens"))


def mine(parts: DataFrame, labels: DataFrame) -> DataFrame:
    """tokens, confidence, support and key (the rarest token) of the rules that are kept."""
    spark = parts.sparkSession
    bad = (labels.where("doc_id is not null and (quality is not null or toxic is not null)")
           .groupBy(F.col("doc_id").cast("long").alias("page_id"))
           .agg(F.max((F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False)))).alias("bad")))
    labelled = saved(parts.where("page_id is not null").select("row", "page_id", "tokens").join(bad, "page_id").select("row", "tokens", "bad"),
                     "url-labelled")
    n = labelled.count()
    least = max(MIN_COUNT, math.ceil(MIN_SUPPORT * n))
    none = spark.createDataFrame([], "tokens array<string>, confidence double, support double, key string")
    if n < least:
        return none
    each = labelled.select("row", "bad", F.explode("tokens").alias("token"))
    counts = saved(each.groupBy("token").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"))
                   .where(F.col("n_bad") >= least).select("token", "n"), "url-tokens")
    baskets = saved(each.join(broadcast_if_small(counts.select("token")), "token").groupBy("row", "bad").agg(
        F.sort_array(F.collect_list("token")).alias("tokens")), "url-baskets")
    classes = _classes(baskets)
    if classes is None:
        return none
    # classes in brackets in front of a token keep the counts of different class sets apart
    parts_of = baskets.select("bad", F.explode(_class_sets(classes)).alias("of"), "tokens").select(
        "bad", "of", F.transform(F.filter("tokens", lambda t: F.array_contains("of", _class(t, classes))), lambda t: F.concat(
            F.array_join("of", ","), F.lit("|"), t)).alias("items"))
    items = F.when(F.col("bad"), F.array_append("items", F.concat(F.array_join("of", ","), F.lit("|" + BAD)))).otherwise(F.col("items"))
    small = saved(parts_of.select(items.alias("items")), "url-small-baskets")
    total = small.count()
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / total, minConfidence=MIN_CONFIDENCE).fit(small)
    plain = lambda a: F.transform(a, lambda t: F.regexp_replace(t, r"^[0-9,]*\|", ""))
    whole = F.size(F.array_distinct(F.transform("tokens", lambda t: _class(t, classes)))) == F.size(F.split(
        F.regexp_extract(F.col("consequent")[0], r"^([0-9,]*)\|", 1), ","))
    rules = saved(model.associationRules.where(F.endswith(F.col("consequent")[0], F.lit("|" + BAD)) & (F.size("antecedent") <= RULE_TOKENS))
                  .withColumn("tokens", F.sort_array(plain(F.col("antecedent")))).where(whole)
                  .select("tokens", "confidence", (F.col("support") * total / n).alias("support")), "url-rules")
    rarest = (rules.select("*", F.explode("tokens").alias("token")).join(counts, "token")
              .groupBy("tokens").agg(F.min(F.struct("n", "token")).alias("r")))
    return rules.join(rarest, "tokens").select("tokens", "confidence", "support", F.col("r.token").alias("key"))


def _class(token: Column, classes: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(classes)).cast("int")


def _classes(baskets: DataFrame) -> int | None:
    """How many classes keep the sub-baskets small: one if all baskets are; None without baskets."""
    size = baskets.agg(F.max(F.size("tokens"))).first()[0]
    classes = 1
    while size is not None and size > BASKET_TOKENS:
        classes = 2 * RULE_TOKENS if classes == 1 else 2 * classes
        per = F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda c: F.size(F.filter("tokens", lambda t: _class(t, classes) == c)))
        most = F.slice(F.sort_array(per, asc=False), 1, RULE_TOKENS)
        size = baskets.agg(F.max(F.aggregate(most, F.lit(0), lambda s, x: s + x))).first()[0]
    return None if size is None else classes


def _class_sets(classes: int) -> Column:
    """The sets of up to RULE_TOKENS classes (each sorted) that a basket has tokens of."""
    have = F.sort_array(F.array_distinct(F.transform("tokens", lambda t: _class(t, classes))))
    sets = F.transform(have, lambda c: F.array(c))
    grown = sets
    for _ in range(min(RULE_TOKENS, classes) - 1):
        grown = F.flatten(F.transform(grown, lambda s: F.transform(
            F.filter(have, lambda c: c > F.element_at(s, -1)), lambda c: F.array_append(s, c))))
        sets = F.concat(sets, grown)
    return sets


def index(mined: DataFrame, listed: DataFrame) -> DataFrame:
    """The inverted index (INDEX) of mined and listed rules (host, path, verdict)."""
    none = lambda t: F.lit(None).cast(t)
    return mined.select("key", "tokens", "confidence", "support", none("string").alias("path"), none("string").alias("rule"),
                        none("string").alias("verdict")).unionByName(
        listed.select(F.concat(F.lit("host="), "host").alias("key"), none("array<string>").alias("tokens"),
                      none("double").alias("confidence"), none("double").alias("support"), "path",
                      F.concat("host", "path").alias("rule"), "verdict"))


def listed_rules(spark: SparkSession, rules=LISTED) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def judge(pages: DataFrame, labels: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule (null: none), verdict, mined (the best mined rule's tokens, null: none) of every row."""
    spark = pages.sparkSession
    parts = saved(with_parts(pages).withColumn("row", F.monotonically_increasing_id()), "url-parts")
    rules = saved(index(mine(parts, labels), listed if listed is not None else listed_rules(spark)), "url-index")
    small = rules.count() <= BROADCAST_RULES
    looked = parts.select("row", "path", "tokens", F.explode("tokens").alias("key"))
    r = rules.withColumnRenamed("path", "rule_path").withColumnRenamed("tokens", "rule_tokens")
    hits = looked.join(F.broadcast(r) if small else r, "key").where(
        F.when(F.col("rule").isNotNull(), F.startswith("path", "rule_path")).otherwise(
            F.size(F.array_except("rule_tokens", "tokens")) == 0))
    best = hits.groupBy("row").agg(
        F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("n"), "rule", "verdict"))).alias("l"),
        F.max(F.when(F.col("rule").isNull(), F.struct("confidence", "support", F.array_join("rule_tokens", " ").alias("t")))).alias("m"))
    return parts.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("l.rule").alias("rule"),
        F.coalesce("l.verdict", F.when(F.col("m").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.col("m.t").alias("mined"))
