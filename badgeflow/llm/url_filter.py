"""URL filter by association rules, with a list of given rules before them.

A URL's tokens are its host's labels, path segments and query keys. Of labelled bad pages, Spark's FP-growth mines
token combinations; how many pages in all have a combination is counted by the index below. Kept are those with enough
bad pages and confidence, without combinations that contain a shorter kept one. Enough is a number of pages, not a share,
so a rule does not depend on the size of the table; a smaller number is enough where the Chernoff bound rules chance
out. Before mining, tokens of too few bad pages go, and those that are a rule alone (no longer rule is kept that has
them); tokens that occur in exactly the same labelled pages (as 192 bits of hashes of the pages and their number say) are
mined as one, and a rule with it stands for one with each of them. So tokens that always come together do not
multiply the combinations.

Rules match through an inverted index: a rule is entered under its rarest token only, so that a URL meets few rules,
and then compared in full.

Given rules (verdict, host, path) come first: a rule fits its host and all subdomains if the URL's path starts
with its path; the longest one wins. They are joined on the host's suffixes.

Both joins are plain: Spark measures whether rules are small enough to broadcast and splits a hot host or
token otherwise.

Defined cases: a null URL, or one without '://', has no host and path, thus no tokens and no rule: it is allowed.
Identical rows (page_id and url) are judged once. Without labelled pages no rules are mined. Other columns of
the inputs are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from badgeflow.llm.common import ascii_lower, written

MIN_PAGES = 20  # labelled bad pages behind a rule, in a table of any size
FEW_PAGES = 5  # as many are enough for a rule that chance does not explain
MAX_CHANCE = 1e-4  # bound of the probability that labels dealt at random give a rule of few pages its bad ones
MIN_CONFIDENCE = 0.5

ALLOW, BLOCK = "allow", "block"
#: Given rules: verdict, host, path.
RULES: tuple[tuple[str, str, str], ...] = (
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path, tokens; identical rows once."""
    rows = pages.select("page_id", "url").distinct()
    host, path = host_and_path(F.col("url"))
    query = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^?#]*\?([^#]*)", 1)

    def marked(mark: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(mark), p))

    tokens = F.array_distinct(F.concat(
        marked("host:", F.split("host", r"\.")),
        marked("path:", F.split("path", "/")),
        marked("query:", F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))),
    ))
    return rows.withColumns({"host": host, "path": path}).withColumn(
        "tokens", F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(tokens)
    )


# --- given rules ----------------------------------------------------------------------------


def given_verdicts(urls: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES) -> DataFrame:
    """page_id, url, rule and verdict where a given rule fits."""
    if not isinstance(rules, DataFrame):
        rules = urls.sparkSession.createDataFrame(list(rules), "verdict string, rule_host string, rule_path string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fitting = (
        urls.where("host <> ''").select("page_id", "url", "path", F.explode(suffixes).alias("rule_host"))
        .join(rules, "rule_host").where(F.startswith("path", "rule_path"))
        .withColumn("rule", F.concat("rule_host", "rule_path"))
    )
    longest = F.max(F.struct(F.length("rule").alias("n"), F.length("rule_host").alias("h"), "rule", "verdict")).alias("best")
    return fitting.groupBy("page_id", "url").agg(longest).select("page_id", "url", "best.rule", "best.verdict")


# --- mined rules ----------------------------------------------------------------------------


def _chance(bad: Column, pages: Column, share: float) -> Column:
    """Chernoff bound of the probability that so many of the pages are bad if each is with this probability."""
    rate = bad / pages
    good = F.when(bad < pages, (1 - rate) * F.log((1 - rate) / (1 - share))).otherwise(0.0) if share < 1 else F.lit(0.0)
    return F.when(rate > share, F.exp(-pages * (rate * F.log(rate / share) + good))).otherwise(1.0)


def mined_rules(
    urls: DataFrame, labels: DataFrame, min_confidence: float = MIN_CONFIDENCE, min_pages: int = MIN_PAGES,
    few_pages: int = FEW_PAGES, max_chance: float = MAX_CHANCE,
) -> DataFrame:
    """tokens (sorted), confidence, support of rules that say bad, the shortest ones among them.

    labels: page_id and bad (boolean); a page with several labels is bad if one says so.
    """
    known = labels.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    pages = written(urls.join(known, "page_id").select(F.xxhash64("page_id", "url").alias("page"), "bad", "tokens"), "labelled-pages")
    n, n_bad = pages.agg(F.count("*"), F.count_if("bad")).first()
    if not n_bad:
        return urls.sparkSession.createDataFrame([], "tokens array<string>, confidence double, support double")
    least = min(few_pages, min_pages)

    def kept() -> Column:
        """Of columns bad_pages and pages."""
        chance = _chance(F.col("bad_pages"), F.col("pages"), n_bad / n)
        enough = (F.col("bad_pages") >= min_pages) | (F.col("bad_pages") >= few_pages) & (chance <= max_chance)
        return enough & (F.col("bad_pages") >= min_confidence * F.col("pages"))

    def rules(counted: DataFrame) -> DataFrame:
        return counted.select(
            F.array_sort("tokens").alias("tokens"), (F.col("bad_pages") / F.col("pages")).alias("confidence"), (F.col("bad_pages") / n).alias("support")
        )

    each = pages.select("page", "bad", F.explode("tokens").alias("token"))
    same = [F.bit_xor(F.xxhash64("page", F.lit(i))).alias(f"x{i}") for i in range(3)]
    items = each.groupBy("token").agg(F.count("*").alias("pages"), F.count_if("bad").alias("bad_pages"), *same)
    items = items.where(F.col("bad_pages") >= least)
    items = written(items.withColumn("alone", kept()), "url-items")
    classes = written(
        items.where("NOT alone").groupBy("pages", "bad_pages", "x0", "x1", "x2")
        .agg(F.min("token").alias("item"), F.collect_list("token").alias("members")).select("item", "members"),  # tokens of one page
        "url-classes",
    )
    in_classes = written(
        each.join(classes.select(F.col("item").alias("token")), "token").groupBy("page", "bad").agg(F.collect_set("token").alias("tokens")),
        "url-baskets",
    )
    baskets = in_classes.where("bad AND size(tokens) > 1").select("tokens")
    n_baskets = baskets.count()
    found = rules(items.where("alone").select(F.array("token").alias("tokens"), "pages", "bad_pages"))
    if not n_baskets:
        return found
    support = min(1.0, (least - 0.5) / n_baskets)  # the half: FP-growth rounds the number of pages up
    sets = FPGrowth(itemsCol="tokens", minSupport=support, minConfidence=0.0).fit(baskets).freqItemsets.where("size(items) > 1")
    sets = written(sets.select(F.array_sort("items").alias("tokens"), F.col("freq").alias("bad_pages")), "url-itemsets")
    counted = matches(in_classes.select("tokens"), sets.withColumn("confidence", F.lit(None).cast("double"))).groupBy(
        F.col("rule_tokens").alias("tokens")
    ).agg(F.count("*").alias("pages"))
    long_rules = sets.join(counted, "tokens")
    long_rules = without_longer(rules(long_rules.where(kept())))
    numbered = long_rules.select("confidence", "support", F.col("tokens").alias("of_rule"), F.explode("tokens").alias("item")).join(classes, "item")
    members = numbered.groupBy("of_rule", "confidence", "support").agg(F.collect_list("members").alias("choices"))

    def each_choice(rows: Column, members: Column) -> Column:
        return F.flatten(F.transform(rows, lambda r: F.transform(members, lambda m: F.concat(r, F.array(m)))))

    start = F.array(F.array().cast("array<string>"))
    expanded = members.select(F.explode(F.aggregate("choices", start, each_choice)).alias("tokens"), "confidence", "support")
    return found.unionByName(expanded.select(F.array_sort("tokens").alias("tokens"), "confidence", "support"))


def without_longer(rules: DataFrame) -> DataFrame:
    """The rules that contain no other rule."""
    rules = written(rules, "url-rules")
    own = rules.select(F.array_join("tokens", " ").alias("key"), "tokens")
    longer = matches(own, rules).where(F.size("tokens") > F.size("rule_tokens")).select("tokens").distinct()
    return rules.join(longer, "tokens", "left_anti")


def matches(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """rows (with a column tokens) with rule_tokens and confidence of each rule whose tokens they have."""
    rules = written(rules.select(F.col("tokens").alias("rule_tokens"), "confidence"), "url-index")
    each = rules.select("rule_tokens", "confidence", F.explode("rule_tokens").alias("token"))
    wanted = each.select("token").distinct()
    counts = rows.select(F.explode("tokens").alias("token")).join(wanted, "token", "left_semi").groupBy("token").count()
    entries = (
        each.join(counts, "token")
        .groupBy("rule_tokens", "confidence").agg(F.min(F.struct("count", "token"))["token"].alias("token"))
    )
    entries = written(entries, "url-entries")  # so that its size is known to the join
    return (
        rows.withColumn("token", F.explode("tokens")).join(entries, "token")
        .where(F.size(F.array_except("rule_tokens", "tokens")) == 0).drop("token")
    )


def verdicts(
    pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES, **mining: float
) -> DataFrame:
    """page_id, url, host, path, rule, verdict, confidence (of the best mined rule that matches, or null)."""
    urls = written(parsed(pages), "urls")
    mined = without_longer(mined_rules(urls, labels, **mining))
    blocked = matches(urls.select("page_id", "url", "tokens"), mined).groupBy("page_id", "url").agg(F.max("confidence").alias("confidence"))
    given = given_verdicts(urls, rules)

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        r = right.withColumnsRenamed({"page_id": "r_page", "url": "r_url"})
        same = left["page_id"].eqNullSafe(r["r_page"]) & left["url"].eqNullSafe(r["r_url"])
        return left.join(r, same, "left").drop("r_page", "r_url")

    return joined(joined(urls.drop("tokens"), given), blocked).withColumn(
        "verdict", F.coalesce("verdict", F.when(F.col("confidence").isNotNull(), BLOCK).otherwise(ALLOW))
    )
