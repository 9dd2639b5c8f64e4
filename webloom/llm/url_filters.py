"""URL filters: a fixed rule list first, then association rules mined by FP-growth, in DataFrame functions only.

A URL's transaction is its set of tokens, taken from all of it: every suffix of the host, every word
of the path, every key of the query, marks of numbers and of fragments. Labelled URLs add a label
token. FP-growth finds frequent token sets; rules whose consequent is a label are kept above a support
and a confidence, and a rule is dropped when a shorter one with part of its tokens already says as
much. Kept rules form an inverted index from token to rule: a URL fires a rule when it holds as many
of the rule's tokens as the rule has.

FP-growth's work has a bound that doesn't depend on the data's size: its support is raised until no
labelled URL holds more than MOST_FREQUENT frequent tokens, so there are at most
2^MOST_FREQUENT / support frequent sets. Where that raises the support, the rules between the asked
support and the raised one are found by growing patterns further (`grown_rules`), only through sets
that a rule which pruning keeps can have. URLs are never cut for it, and matching sees all tokens.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webloom.llm.common import discard, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Frequent tokens that one labelled URL may hold for FP-growth over all sets; beyond it FP-growth's support rises and grown_rules finds the rest.
MOST_FREQUENT = 12
LABEL = "label="

#: Verdict, host and path of the rule list.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def rest_of(url: Column) -> Column:
    """What follows the first ://; empty for null and for a URL without it."""
    at = F.instr(url, F.lit("://"))
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(rest_of(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(rest_of(url), r"^[^/?#]*([^?#]*)", 1)


def listed_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null without one."""
    name = verdict = F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL; numbers and ids become marks."""
    labels = F.split(host, "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.lit("host:"), F.concat_ws(".", F.slice(labels, -n, n))))
    words = F.filter(F.split(path, "/"), lambda p: (p != "") & ~p.rlike("[0-9]"))
    keys = F.transform(F.split(F.regexp_extract(url, r"^[^?#]*[?]([^#]*)", 1), "&"), lambda k: F.regexp_extract(k, "^([^=]*)", 1))
    marks = F.array(F.when(path.rlike("[0-9]"), F.lit("mark:number")), F.when(url.contains("#"), F.lit("mark:fragment")))
    none = F.array().cast("array<string>")
    host_tokens = F.when(host == "", none).otherwise(suffixes)
    paths = F.transform(words, lambda p: F.concat(F.lit("path:"), F.translate(p, UPPER, LOWER)))
    queries = F.when(url.rlike("^[^#]*[?]"), F.transform(keys, lambda k: F.concat(F.lit("query:"), k))).otherwise(none)
    return F.array_distinct(F.array_compact(F.concat(host_tokens, paths, queries, marks)))


@dataclass(frozen=True)
class MinedRule:
    tokens: tuple[str, ...]
    verdict: str
    confidence: float
    support: float


def least_count(rows: DataFrame, n: int, min_support: float) -> int:
    """Least number of rows of a frequent token, so that no row of n (tokens) has more than MOST_FREQUENT of them.

    Frequent tokens number at most the mean of tokens for each row, divided by the support.
    """
    least = max(1, math.ceil(min_support * n))
    found = rows.select(F.explode("tokens").alias("token")).groupBy("token").count().where(F.col("count") >= least).orderBy("token").collect()
    if len(found) <= MOST_FREQUENT:
        return least
    names, counts = F.array(*[F.lit(r.token) for r in found]), F.array(*[F.lit(r["count"]) for r in found])
    own = F.transform(F.array_intersect("tokens", names), lambda t: F.get(counts, (F.array_position(names, t) - 1).cast("int")))
    over = rows.agg(F.max(F.get(F.sort_array(own, False), F.lit(MOST_FREQUENT)))).first()[0]
    return least if over is None else max(least, over + 1)


def grown_rules(rows: DataFrame, n: int, least: int, min_confidence: float) -> list[MinedRule]:
    """All rules with at least `least` of n rows (tokens, verdict) that pruning keeps, by pattern growth.

    A set grows by tokens that are numbered after its own, in the rows that hold it (its conditional
    pattern base; equal rows are one with a count). For a verdict, a set's other rows are those of other
    verdicts. A set counts for a verdict only if each of its tokens leaves out some of the others: if a
    token t of a set X leaves out none, none is left out by t in any set around X either, so each of them has
    no more confidence than itself without t, and pruning drops it. A set without others is a rule and grows no
    further. So neither copies of a URL nor tokens that imply one another multiply sets.
    Only tokens and rules reach the driver; sets and their rows stay tables, level by level.
    """
    counts = rows.select("verdict", F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token", "verdict").count()
    totals = counts.groupBy("token").agg(F.max("count").alias("most"), F.sum("count").alias("n")).where(F.col("most") >= least)
    names = [r.token for r in totals.orderBy("n", "token").collect()]  # frequent ones last, so that many rows have equal rests
    if not names:
        return []
    listed = F.array(*map(F.lit, names))
    ids = F.array_sort(F.transform(F.array_intersect("tokens", listed), lambda t: F.array_position(listed, t).cast("int")))
    own = rows.select("verdict", ids.alias("rest")).groupBy("verdict", "rest").agg(F.count(F.lit(1)).alias("n"))
    held = own.select("verdict", F.array().cast("array<int>").alias("set"), "rest", "n")
    alive, found, stored, size = None, [], [], 0
    while True:
        size += 1
        grown = held.select("verdict", "set", "rest", "n", F.explode("rest").alias("t"))
        grown = grown.select("verdict", F.array_append("set", F.col("t")).alias("set"), F.filter("rest", lambda x: x > F.col("t")).alias("rest"), "n")
        held = materialize(grown.groupBy("set", "rest", "verdict").agg(F.sum("n").alias("n")), "patterns")
        sums = held.groupBy("set", "verdict").agg(F.sum("n").alias("hits"))
        sums = sums.withColumn("others", F.sum("hits").over(W.partitionBy("set")) - F.col("hits")).where(F.col("hits") >= least)
        if alive is not None:
            part = sums.withColumn("part", F.explode(F.transform("set", lambda t: F.array_remove("set", t))))
            fewer = part.join(alive.select(F.col("set").alias("part"), "verdict", F.col("others").alias("before")), ["part", "verdict"]).where("others < before")
            sums = fewer.groupBy("set", "verdict", "hits", "others").agg(F.count(F.lit(1)).alias("parts")).where(F.col("parts") == size).drop("parts")
        sets = materialize(sums, "sets")
        discard(*stored)
        stored = [held, sets]
        for r in sets.where(F.col("hits") / (F.col("hits") + F.col("others")) >= min_confidence).collect():
            found.append(MinedRule(tuple(sorted(names[i - 1] for i in r.set)), r.verdict, r.hits / (r.hits + r.others), r.hits / n))
        alive = sets.where("others > 0")
        if alive.isEmpty():
            discard(*stored)
            return found
        held = held.join(alive.select("set").distinct(), "set", "left_semi")


def mine_rules(labelled: DataFrame, min_support: float = 0.01, min_confidence: float = 0.9) -> list[MinedRule]:
    """Rules from labelled URLs (tokens array<string>, verdict): FP-growth, then pruning.

    Rows with a null verdict or without tokens teach nothing; without any rows there are no rules.
    Rules with less support than FP-growth was raised to come from grown_rules.
    """
    from pyspark.ml.fpm import FPGrowth

    rows = labelled.where(F.col("verdict").isNotNull() & (F.size("tokens") > 0))
    n = rows.count()
    if not n:
        return []
    wanted, least = max(1, math.ceil(min_support * n)), least_count(rows, n, min_support)
    support = max(min_support, (least - 0.5) / n)
    items = rows.select(F.array_append("tokens", F.concat(F.lit(LABEL), F.col("verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.get("consequent", F.lit(0)).startswith(LABEL) & ~F.exists("antecedent", lambda t: t.startswith(LABEL)))
    found = [MinedRule(tuple(sorted(r.antecedent)), r.consequent[0].removeprefix(LABEL), r.confidence, r.support) for r in rules.collect()]
    if least > wanted:
        found += grown_rules(rows, n, wanted, min_confidence)
    return prune(found)


def prune(rules: list[MinedRule]) -> list[MinedRule]:
    """Drop each rule that a rule with a part of its tokens makes needless: same verdict, no less confidence.

    Kept rules are looked up by their first token, which a longer rule has too.
    """
    kept: list[MinedRule] = []
    by_token: dict[str, list[MinedRule]] = {}
    for rule in sorted(rules, key=lambda r: (len(r.tokens), -r.confidence, -r.support, r.tokens, r.verdict)):
        has = set(rule.tokens)
        shorter = (k for t in rule.tokens for k in by_token.get(t, ()))
        if not any(k.verdict == rule.verdict and k.confidence >= rule.confidence and has.issuperset(k.tokens) for k in shorter):
            kept.append(rule)
            by_token.setdefault(rule.tokens[0], []).append(rule)
    return kept


def mined_verdict(tokens: Column, rules: list[MinedRule]) -> Column:
    """Verdict of the most confident rule that fires (ties: more support, fewer tokens, then tokens), else null.

    The inverted index is a map literal from token to rule numbers; rules are numbered best first.
    """
    if not rules:
        return F.lit(None).cast("string")
    order = sorted(rules, key=lambda r: (-r.confidence, -r.support, len(r.tokens), r.tokens, r.verdict))
    index: dict[str, list[int]] = {}
    for number, rule in enumerate(order):
        for token in rule.tokens:
            index.setdefault(token, []).append(number)
    postings = F.create_map(*[x for t, n in sorted(index.items()) for x in (F.lit(t), F.array(*map(F.lit, n)))])
    sizes = F.array(*[F.lit(len(r.tokens)) for r in order])
    verdicts = F.array(*[F.lit(r.verdict) for r in order])
    hits = F.flatten(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(postings, t), F.array().cast("array<int>"))))
    fired = F.transform(F.array(hits), lambda h: F.array_min(F.filter(F.array_distinct(h), lambda n: F.size(F.filter(h, lambda m: m == n)) == F.get(sizes, n))))[0]
    return F.when(fired.isNotNull(), F.get(verdicts, fired))


def judge_urls(pages: DataFrame, labelled: DataFrame | None = None, min_support: float = 0.01, min_confidence: float = 0.9, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict and by (list, mined or default) for every page.

    labelled: (url, verdict); by default the pages' own URLs with the verdicts of the rule list, so
    that mined rules carry the list's choices over to like URLs. Null URLs and URLs without :// have
    an empty host and path and get the default. Repeated rows: judged alike. Empty table: no rows.
    """
    url = F.col("url")

    def tokenised(df: DataFrame) -> DataFrame:
        rows = df.withColumns({"_host": host_of(url), "_path": path_of(url)})
        return rows.withColumn("_tokens", url_tokens(F.coalesce(url, F.lit("")), F.col("_host"), F.col("_path")))

    if labelled is None:
        source = tokenised(pages.select("url")).withColumn("verdict", listed_rule(F.col("_host"), F.col("_path"))[1])
    else:
        source = tokenised(labelled.select("url", "verdict"))
    rules = mine_rules(source.select(F.col("_tokens").alias("tokens"), "verdict"), min_support, min_confidence)
    name, listed = listed_rule(F.col("host"), F.col("path"))
    rows = tokenised(pages.select("page_id", "url")).select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_tokens").alias("tokens"))
    judged = rows.select("page_id", "host", "path", name.alias("rule"), listed.alias("_listed"), mined_verdict(F.col("tokens"), rules).alias("_mined"))
    by = F.when(F.col("rule").isNotNull(), "list").when(F.col("_mined").isNotNull(), "mined").otherwise("default")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("_listed", "_mined", F.lit(default)).alias("verdict"), by.alias("by"))
