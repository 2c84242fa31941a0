"""URL filter: listed rules first, mined association rules for the rest.

``parse`` splits a url into host and path; a listed rule (host, path) fits its
host and all subdomains of it if the path starts with the rule's, and the
longest fitting rule decides.

All other urls go by association rules. A url's tokens are its host labels,
its suffixes of two labels, its path segments and its query keys, digit runs
written as ``0``. ``mine`` runs Spark's FP-growth over the labelled urls, each
a set of tokens and its label, and keeps the rules "these tokens: block" of
enough support and confidence that no rule of fewer of these tokens and at
least that confidence makes idle. ``judge`` matches them by an inverted index:
each rule is listed under its rarest token (class); a url meets only the rules
listed under its tokens, and each is then checked for its other tokens. A url
that a rule fits is blocked, any other is allowed.

Mining takes every token of every labelled url that is on enough blocked urls.
The itemsets of n tokens are 2^n, so a table whose urls have more than
``FIT_TOKENS`` tokens is split first: one table for each token, of the urls
that have it and their more frequent tokens, and again while urls are too long.
No rule is lost: in a table, tokens that are on the same urls make one class
(a rule on one holds for each), and a token on all urls, or one whose urls are
all blocked, adds nothing to a rule but length. What is left grows with the
rules that differ in their urls. Matching uses all tokens. Everything runs in
the JVM: DataFrame functions and ``pyspark.ml.fpm``.

Defined cases: a null url or one without ``://`` has an empty host and path,
no listed rule and no tokens, so it is allowed; repeated rows are judged each;
labels that contradict each other for an id count as block if one says so;
null labels are no labels; without labels or with labels of one kind nothing
is mined; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

# fixed values: verdict, host, path
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

MIN_SUPPORT = 0.002  # of the labelled urls that a rule's tokens and label are on
MIN_URLS = 10  # labelled urls that a rule's tokens and label are on, at least
MIN_CONFIDENCE = 0.7  # share of a rule's urls that are labelled block
FIT_TOKENS = 10  # token classes of a url up to which FP-growth takes a table as it is; a table with longer urls is split
BLOCKED = -1  # the label's item beside the ids of token classes
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parse(url: str | Column = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)
    return F.translate(host, UPPER, LOWER), path


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (host and path written together) and its verdict; null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a url."""
    def flat(c):
        return F.regexp_replace(c, "[0-9]+", "0")

    labels = F.filter(F.split(flat(host), r"\."), lambda x: x != "")
    pairs = F.transform(F.filter(F.sequence(F.lit(1), F.size(labels)), lambda i: (i > 1)), lambda i: F.concat(
        F.lit("tail="), F.get(labels, i - 2), F.lit("."), F.get(labels, i - 1)))
    segments = F.filter(F.split(flat(path), "/"), lambda x: x != "")
    query = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"\?([^#]*)", 1)).otherwise("")
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(flat(x), "=", 1)), lambda x: x != "")

    def named(kind, xs):
        return F.transform(xs, lambda x: F.concat(F.lit(kind + "="), x))

    return F.array_distinct(F.concat(named("host", labels), pairs, named("path", segments), named("key", keys)))


def mine(labelled: DataFrame) -> DataFrame:
    """Association rules of ``labelled`` (tokens array<string>, blocked boolean):
    ``rule`` (token classes, array<array<string>>; a url fits that has a token of each), confidence, support."""
    spark = labelled.sparkSession
    labelled = written(labelled.withColumn("url_no", F.monotonically_increasing_id()), "op13-labelled")
    kinds = {r[0]: r[1] for r in labelled.groupBy("blocked").agg(F.count(F.lit(1))).collect()}
    n, bad = sum(kinds.values()), kinds.get(True, 0)
    need = max(MIN_URLS, math.ceil(MIN_SUPPORT * n - 1e-9))
    if not bad or bad == n or need > bad:
        return spark.createDataFrame([], "rule array<array<string>>, confidence double, support double")
    # table p holds the urls that have every class of its prefix; x are its other tokens
    rows = labelled.select(F.lit(0).cast("long").alias("p"), "url_no", "blocked", F.explode("tokens").alias("x"))
    prefixes = spark.range(1).select(F.col("id").alias("p"), F.array().cast("array<array<string>>").alias("prefix"), F.lit(None).cast("long").alias("urls"))
    known, rules = None, []
    while True:
        stats = (rows.groupBy("p", "x").agg(F.count(F.lit(1)).alias("many"), F.sum(F.col("blocked").cast("long")).alias("hits"),
                                            *(F.sum(F.xxhash64(F.lit(k), "url_no").cast("decimal(38,0)")).alias(f"s{k}") for k in (1, 2)))
                 .where(F.col("hits") >= need).join(prefixes, "p").where("urls is null or many < urls"))
        stats = stats.withColumn("members", F.array("x")) if known is None else stats.join(known, "x")
        classes = written(stats.groupBy("p", "many", "hits", "s1", "s2")
                          .agg(F.min("x").alias("x"), F.array_sort(F.flatten(F.collect_list("members"))).alias("members"), F.first("prefix").alias("prefix"))
                          .select("p", "x", "many", "hits", "members", F.concat("prefix", F.array("members")).alias("rule"), "prefix")
                          .withColumn("id", F.monotonically_increasing_id()), "op13-classes")
        rules.append(classes.select("rule", (F.col("hits") / F.col("many")).alias("confidence"), (F.col("hits") / F.lit(n)).alias("support"))
                     .where(F.col("confidence") >= MIN_CONFIDENCE))
        # more tokens cannot raise a confidence of 1
        baskets = written(rows.join(classes.where("hits < many").select("p", "x", "many", "id"), ["p", "x"]).groupBy("p", "url_no", "blocked")
                          .agg(F.transform(F.sort_array(F.collect_list(F.struct("many", "id"))), lambda b: b["id"]).alias("ids")).where(F.size("ids") > 1), "op13-baskets")
        most = written(baskets.groupBy("p").agg(F.max(F.size("ids")).alias("most")), "op13-most")
        short = baskets.join(most.where(F.col("most") <= FIT_TOKENS).select("p"), "p")
        rules += _grown(short, classes, need, n)
        long = baskets.join(most.where(F.col("most") > FIT_TOKENS).select("p"), "p")
        if long.isEmpty():
            break
        ahead = long.select("url_no", "blocked", "ids", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("at"))
        rows = ahead.select(F.get("ids", F.col("at") - 1).alias("p"), "url_no", "blocked",
                            F.explode(F.slice("ids", F.col("at") + 1, F.size("ids"))).alias("x"))
        prefixes = classes.select(F.col("id").alias("p"), F.col("rule").alias("prefix"), F.col("many").alias("urls"))
        known = classes.select(F.col("id").alias("x"), "members")
    found = written(reduce(DataFrame.unionByName, rules).withColumn("rule", F.array_sort("rule")), "op13-rules")
    # a rule is idle beside one of a part of its classes with as much confidence; parts are found under each left-out class
    parts = found.select("rule", "confidence", F.explode("rule").alias("out")).select(
        "rule", "confidence", F.filter("rule", lambda c: c != F.col("out")).alias("part"))
    idle = (parts.join(found.select(F.col("rule").alias("part"), F.col("confidence").alias("c")), "part").where("c >= confidence")
            .select("rule").distinct())
    return found.join(idle, "rule", "left_anti")


def _grown(baskets: DataFrame, classes: DataFrame, need: int, n: int) -> list[DataFrame]:
    """Rules of two classes or more beside their table's prefix, by FP-growth over ``baskets`` (ids, blocked)."""
    items = F.concat("ids", F.when(F.col("blocked"), F.array(F.lit(BLOCKED))).otherwise(F.array().cast("array<long>")))
    baskets = written(baskets.select(items.alias("items")), "op13-short")
    held = baskets.count()
    if held < need:
        return []
    model = FPGrowth(itemsCol="items", minSupport=(need - 0.5) / held, minConfidence=MIN_CONFIDENCE).fit(baskets)
    found = written(model.associationRules.where(F.array_contains("consequent", BLOCKED) & (F.size("antecedent") > 1))
                    .select("antecedent", "confidence", (F.col("support") * held / n).alias("support"))
                    .withColumn("rule_no", F.monotonically_increasing_id()), "op13-grown")
    return [found.withColumn("id", F.explode("antecedent")).join(classes, "id").groupBy("rule_no", "confidence", "support")
            .agg(F.concat(F.first("prefix"), F.collect_list("members")).alias("rule")).select("rule", "confidence", "support")]


def _index(rules: DataFrame, pages: DataFrame) -> DataFrame:
    """Inverted index: each rule under the tokens of its rarest class over ``pages`` (tokens array<string>)."""
    rules = written(rules.select("rule", "confidence").withColumn("rule_no", F.monotonically_increasing_id()), "op13-mined")
    seen = (pages.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("many")))
    of = (rules.select("rule_no", F.posexplode("rule").alias("at", "tokens")).select("rule_no", "at", F.explode("tokens").alias("token"))
          .join(seen, "token", "left").groupBy("rule_no", "at").agg(F.coalesce(F.sum("many"), F.lit(0)).alias("many")))
    rarest = of.groupBy("rule_no").agg(F.min(F.struct("many", "at"))["at"].alias("at"))
    return rules.join(rarest, "rule_no").select("rule", "confidence", F.explode(F.get("rule", F.col("at"))).alias("token"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, listed ``rule``, ``verdict``, and the
    mined rule that blocks (``mined``, its ``confidence``).

    ``labels`` (doc_id, quality, toxic) label the page of the same id: toxic
    or of quality 0 is block."""
    host, path = parse("url")
    url = F.coalesce("url", F.lit(""))
    split = pages.select("page_id", url.alias("url"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    rows = written(split.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"),
                                tokens(F.col("host"), F.col("path"), F.col("url")).alias("tokens"))
                   .withColumn("row_no", F.monotonically_increasing_id()), "op13-pages")
    marks = (labels.where("doc_id is not null and (toxic is not null or quality is not null)").groupBy(F.col("doc_id").alias("page_id"))
             .agg(F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)) | F.coalesce(F.col("quality") == 0, F.lit(False))).alias("blocked")))
    found = mine(rows.join(marks, "page_id").select("tokens", "blocked"))
    open_rows = rows.where("rule is null")
    met = (open_rows.select("row_no", "tokens", F.explode("tokens").alias("token")).join(_index(found, open_rows), "token")
           .where(F.forall("rule", lambda c: F.arrays_overlap(c, F.col("tokens"))))
           .withColumn("rule", F.array_sort(F.transform("rule", lambda c: F.array_max(F.array_intersect(c, F.col("tokens"))))))
           .groupBy("row_no").agg(F.max(F.struct("confidence", "rule")).alias("hit")))
    out = rows.join(met, "row_no", "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("verdict", F.when(F.col("hit").isNotNull(), "block").otherwise("allow")).alias("verdict"),
                      F.array_join("hit.rule", " ").alias("mined"), F.col("hit.confidence").alias("confidence"))
