"""URL filter by association rules over URL tokens.

A short list of policy rules judges the URLs it covers, the longest fitting rule first.
Those verdicts are the labels of the rest: FP-growth finds token combinations that are
frequent among the labelled URLs together with a verdict, and combinations whose
confidence and lift suffice become rules. A URL without policy rule is judged by the
mined rule of highest confidence whose tokens it has all of, and is allowed if there is
none. Rules are found by an inverted index on their rarest token.

Everything runs on distinct URLs; verdicts are joined back to the pages.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold.llm.graphs import stored

#: Policy rules: verdict and host with the beginning of the path.
POLICY = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
#: A combination is mined if this part of the labelled URLs has it with its verdict.
LEAST_SUPPORT = 0.01
#: But by so many of them at least: less would make a rule of every URL.
LEAST_URLS = 20
LEAST_CONFIDENCE = 0.8
#: Times the verdict's overall frequency that a rule's confidence must reach, or be 1.
LEAST_LIFT = 1.05
#: Longest policy list; it becomes one expression.
MOST_POLICY_RULES = 1000

_VERDICT = "verdict="


def host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(found, upper, upper.lower()), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def policy_rule(host: Column, path: Column, policy=POLICY) -> Column:
    """The longest rule whose host the host is or belongs to and whose path begins the
    path, or null."""
    if len(policy) > MOST_POLICY_RULES:
        raise ValueError(f"more than {MOST_POLICY_RULES} policy rules")
    found = []
    for _, rule in sorted(policy, key=lambda r: (-len(r[1]), r[1])):
        rule_host, _, rest = rule.partition("/")
        own = (host == rule_host) | host.endswith("." + rule_host)
        found.append(F.when(own & path.startswith("/" + rest), F.lit(rule)))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def policy_verdict(rule: Column, policy=POLICY) -> Column:
    """The verdict of a policy rule, or null."""
    cases = [F.when(rule == name, F.lit(verdict)) for verdict, name in policy]
    return F.coalesce(*cases) if cases else F.lit(None).cast("string")


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: scheme, host labels by level, the parts of compound ones,
    path segments and query keys; runs of digits are one."""
    digits = lambda c: F.regexp_replace(c, r"[0-9]+", "0")
    labels = F.reverse(F.filter(F.split(host(url), r"\."), lambda x: x != ""))
    named = F.transform(labels, lambda x, i: F.concat(F.lit("host"), F.least(i, F.lit(3)).cast("string"), F.lit(":"), digits(x)))
    joined = F.filter(labels, lambda x: x.rlike("[-_]"))
    parts = F.transform(F.flatten(F.transform(joined, lambda x: F.split(x, r"[-_]"))), lambda x: F.concat(F.lit("part:"), digits(x)))
    segments = F.transform(
        F.filter(F.split(path(url), "/"), lambda x: x != ""), lambda x: F.concat(F.lit("path:"), digits(F.lower(x)))
    )
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(
        F.filter(F.split(query, "&"), lambda x: x != ""),
        lambda x: F.concat(F.lit("query:"), F.lower(F.substring_index(x, "=", 1))),
    )
    scheme = F.array(F.concat(F.lit("scheme:"), F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))))
    return F.array_distinct(F.concat(scheme, named, parts, segments, keys))


def mine(
    labelled: DataFrame,
    least_support: float = LEAST_SUPPORT,
    least_confidence: float = LEAST_CONFIDENCE,
    least_lift: float = LEAST_LIFT,
    least_urls: int = LEAST_URLS,
) -> DataFrame:
    """Rules (tokens, verdict, confidence, support) of ``labelled`` (url, verdict).

    A rule stays unless one without one of its tokens says the same with no less
    confidence. Tokens that all labelled URLs have are left out, and tokens that stand in
    exactly the same URLs are mined as one: a rule has one of them, and there is a rule for
    each. Rows without url or verdict are not looked at; without labelled
    rows there are no rules.
    """
    rows = labelled.filter("url is not null and verdict is not null")
    items = rows.select(
        F.concat(tokens(F.col("url")), F.array(F.concat(F.lit(_VERDICT), "verdict"))).alias("items"),
        *[F.xxhash64("url", F.lit(k)).cast("decimal(38,0)").alias(f"mark{k}") for k in (1, 2)],
    )
    items = stored(items, "items")
    none = items.sparkSession.createDataFrame(
        [], "tokens array<string>, verdict string, confidence double, support double"
    )
    total = items.count()
    if total < least_urls:
        return none
    support = max(least_support, least_urls / total)
    counts = items.select(F.explode("items").alias("item"), "mark1", "mark2").groupBy("item").agg(
        F.count("*").alias("n"), F.sum("mark1").alias("mark1"), F.sum("mark2").alias("mark2")
    )
    often = counts.filter((F.col("n") >= support * total) & ~F.col("item").startswith(_VERDICT))
    # tokens with equal sums of two hashes of their URLs stand in the same ones
    groups = often.groupBy("n", "mark1", "mark2").agg(F.array_sort(F.collect_list("item")).alias("all"))
    groups = stored(groups.select("n", F.col("all")[0].alias("token"), "all"), "groups")
    # of frequent tokens there are no more than an URL has on average, by the support
    needless = F.when(F.col("n") == total, F.col("all")).otherwise(F.slice("all", 2, F.size("all")))
    left_out = [r[0] for r in groups.select(F.explode(needless)).collect()]
    items = items.select(F.array_except("items", F.array(*map(F.lit, left_out)).cast("array<string>")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=least_confidence).fit(items)
    said = F.col("consequent")[0]
    rules = model.associationRules.filter(said.startswith(_VERDICT) & ((F.col("lift") >= least_lift) | (F.col("confidence") >= 1))).select(
        F.array_sort("antecedent").alias("tokens"),
        F.substring(said, len(_VERDICT) + 1, 100).alias("verdict"),
        "confidence",
        "support",
    )
    rules = stored(rules, "rules")
    return stored(_with_equal_tokens(_shortest(rules), groups), "rules")


def _with_equal_tokens(rules: DataFrame, groups: DataFrame) -> DataFrame:
    """A rule for each choice of one of ``all`` the tokens that each token stands for."""
    each = rules.select("*", F.explode("tokens").alias("token")).join(groups.select("token", "all"), "token")
    each = each.groupBy("tokens", "verdict", "confidence", "support").agg(F.collect_list("all").alias("choices"))
    empty = F.array(F.array().cast("array<string>"))
    more = lambda made, some: F.flatten(F.transform(made, lambda x: F.transform(some, lambda y: F.concat(x, F.array(y)))))
    chosen = F.aggregate("choices", empty, more)
    made = each.select(F.explode(chosen).alias("tokens"), "verdict", "confidence", "support")
    return made.withColumn("tokens", F.array_sort("tokens"))


def _shortest(rules: DataFrame) -> DataFrame:
    """Rules without those that one shorter by a token makes needless."""
    without = F.filter("tokens", lambda x: x != F.col("token"))
    shorter = rules.select("tokens", "verdict", "confidence", F.explode("tokens").alias("token"))
    shorter = shorter.select(F.col("tokens").alias("longer"), "verdict", "confidence", without.alias("tokens"))
    other = rules.select("tokens", "verdict", F.col("confidence").alias("other"))
    needless = shorter.join(other, ["tokens", "verdict"]).filter("other >= confidence")
    needless = needless.select(F.col("longer").alias("tokens"), "verdict").distinct()
    return rules.join(needless, ["tokens", "verdict"], "left_anti")


def _indexed(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Rules by their rarest token among ``urls`` (tokens)."""
    often = urls.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("often"))
    each = rules.select(F.col("tokens").alias("rule_tokens"), "verdict", "confidence", "support", F.explode("tokens").alias("token"))
    place = Window.partitionBy("rule_tokens", "verdict").orderBy("often", "token")
    each = each.join(often, "token").withColumn("place", F.row_number().over(place))
    return each.filter("place = 1").drop("place", "often")


def judge(pages: DataFrame, policy=POLICY, **limits: float) -> DataFrame:
    """``(page_id, host, path, rule, verdict, mined_rule)`` for every row of ``pages``
    (page_id, url).

    ``rule`` is the policy rule that fits, else null; ``verdict`` is its verdict, else
    that of the best mined rule, else allow. ``mined_rule`` holds the tokens of the mined
    rule where one has decided. A null url, or one without ``://``, has an empty host and
    path, fits no rule and is allowed. Equal rows get equal results; extra columns are
    not looked at.
    """
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"))
    urls = pages.filter("url is not null").select("url").distinct()
    rule = policy_rule(F.col("host"), F.col("path"), policy)
    urls = urls.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    urls = urls.withColumn("rule", rule).withColumn("verdict", policy_verdict(F.col("rule"), policy))
    urls = stored(urls.withColumn("tokens", F.when(F.col("host") != "", tokens(F.col("url")))), "urls")
    rules = mine(urls.filter("host <> ''").select("url", "verdict"), **limits)
    open_urls = urls.filter("rule is null and host <> ''").select("url", "tokens")
    index = _indexed(rules, open_urls)
    fits = open_urls.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    fits = fits.filter("size(array_except(rule_tokens, tokens)) = 0")
    text = F.array_join("rule_tokens", " ")
    best = fits.groupBy("url").agg(
        F.max(F.struct("confidence", "support", F.size("rule_tokens").alias("size"), text.alias("text"), "verdict")).alias("best")
    )
    judged = urls.join(best, "url", "left").select(
        "url",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.col("best.verdict"), F.lit("allow")).alias("verdict"),
        F.col("best.text").alias("mined_rule"),
    )
    found = pages.join(judged, "url", "left")
    return found.select(
        "page_id",
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
        "mined_rule",
    )
