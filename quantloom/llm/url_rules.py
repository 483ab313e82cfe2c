"""URL verdicts: a list of rules first, association rules mined by FP-growth for the rest.

A URL becomes a set of tokens: labels of its host, segments of its path, names of its query's keys, with numbers made
alike. FP-growth over labelled URLs finds token combinations that go with a label; rules below the support or the
confidence go. Tokens that always occur together are mined as one item. The rules are matched by an inverted index on each
rule's rarest group of tokens: a URL meets only the rules of which it has a rarest token, and is then tested for the
others. Counting and matching work on distinct token sets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.sources.stage import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LABEL = "label="


@dataclass(frozen=True)
class ListRule:
    """``site`` is host and path, such as ``example.org/es/``; it fits the host and its subdomains."""

    verdict: str
    site: str

    @property
    def host(self) -> str:
        return self.site.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.site.split("/", 1)[1] if "/" in self.site else ""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``,
    ``#`` or the end. Both are empty where the URL is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def list_rule(host: Column, path: Column, rules: list[ListRule]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none does."""
    site, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.site), r.site)):  # the longest comes last and so is tested first
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        site = F.when(fits, F.lit(rule.site)).otherwise(site)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return site, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct sorted tokens of a URL; runs of digits become 0."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda kv: F.substring_index(kv, "=", 1))

    def named(kind: str, parts: Column) -> Column:
        plain = F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.regexp_replace(p, "[0-9]+", "0"))
        return F.transform(plain, lambda p: F.concat(F.lit(kind), p))

    tokens = F.concat(named("host=", F.split(host, r"\.")), named("path=", F.split(path, "/")), named("key=", keys))
    return F.array_sort(F.array_distinct(tokens))


def token_groups(sets: DataFrame, least: float) -> DataFrame:
    """Rows (item, members, freq): tokens that ``least`` rows have, those that always occur together as one item.

    ``sets`` holds distinct token sets and how many rows have each. Tokens go together when they are in the same sets, told
    by two 64-bit sums of hashes of the sets. All members are in one URL, so a group is no longer than that.
    """
    each = sets.select("n", *[F.xxhash64(F.lit(k), "tokens").alias(f"s{k}") for k in (1, 2)], F.explode("tokens").alias("token"))
    per_token = each.groupBy("token").agg(F.sum("n").alias("freq"), F.bit_xor("s1").alias("x1"), F.bit_xor("s2").alias("x2"))
    grouped = per_token.where(F.col("freq") >= least).groupBy("freq", "x1", "x2").agg(F.array_sort(F.collect_list("token")).alias("members"))
    return grouped.select(F.col("members")[0].alias("item"), "members", "freq")


def mine_rules(labelled: DataFrame, tokens: str, label: str, support: float, confidence: float) -> DataFrame:
    """Rows (tokens, label, support, confidence, groups, first): rules that reach both bounds.

    Tokens that always occur together are mined as one item, so many of them in one URL add one item, not all their
    subsets. ``groups`` holds the members of each item of a rule and ``tokens`` all of them: a rule stands for every choice of
    at least one token from each group, for all these have its support and confidence. ``first`` is the rarest group.
    ``support`` is the share of labelled rows that hold the combination together with the label.
    """
    spark = labelled.sparkSession
    schema = "tokens array<string>, label string, support double, confidence double, groups array<array<string>>, first array<string>"
    rows = labelled.where(F.col(label).isNotNull()).select(F.col(tokens).alias("tokens"), F.col(label).alias("label"))
    # one row per distinct token set and label
    sets = stage(rows.groupBy("tokens", "label").agg(F.count(F.lit(1)).alias("n")), "url-sets")
    total = sets.agg(F.sum("n")).first()[0]
    if not total:
        return spark.createDataFrame([], schema)
    distinct = stage(sets.groupBy("tokens").agg(F.sum("n").alias("n")), "url-distinct")
    groups = stage(token_groups(distinct, support * total), "url-groups")
    items = distinct.select("tokens", F.explode("tokens").alias("token")).join(groups.select("item", F.explode("members").alias("token")), "token")
    items = items.groupBy("tokens").agg(F.collect_set("item").alias("items"))
    marked = sets.join(items, "tokens", "left").select(
        F.concat(F.coalesce("items", F.array().cast("array<string>")), F.array(F.concat(F.lit(LABEL), "label"))).alias("items"), "n"
    )
    baskets = stage(marked.select("items", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy")).select("items"), "url-baskets")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.where(F.col("consequent")[0].startswith(LABEL))
    rules = rules.where(~F.exists("antecedent", lambda a: a.startswith(LABEL)))
    rules = rules.select(
        F.array_sort("antecedent").alias("rule"), F.substring(F.col("consequent")[0], len(LABEL) + 1, 1 << 20).alias("label"), "support", "confidence"
    )
    told = rules.select("rule", F.explode("rule").alias("item")).distinct().join(groups, "item")
    told = told.groupBy("rule").agg(F.array_sort(F.collect_list("members")).alias("groups"), F.min_by("members", F.struct("freq", "item")).alias("first"))
    return rules.join(told, "rule").select(F.array_sort(F.flatten("groups")).alias("tokens"), "label", "support", "confidence", "groups", "first")


def judge_urls(
    pages: DataFrame,
    rules: list[ListRule],
    page_id: str = "page_id",
    url: str = "url",
    label: Column | None = None,
    support: float = 0.002,
    confidence: float = 0.8,
    default: str = "allow",
) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, mined), one for each input row.

    ``rule`` is the fitting list rule and decides where there is one. Else the matching mined rule of the highest
    confidence does, then the one of the highest support, of most tokens, and the last in order; ``mined`` holds those of
    its tokens that the URL has. Else ``default`` does. ``label`` labels the rows to mine from; without it they are the rows on which the list
    decides, labelled with its verdict. Null or odd URLs have empty host and path and no tokens, so they get the default.
    Null ids and repeated rows are judged row by row; an empty table gives no rows; other columns are ignored.
    """
    u = F.col(url).cast("string")
    host, path = host_and_path(u)
    site, verdict = list_rule(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col(page_id).alias("page_id"), u.alias("u"), host.alias("host"), path.alias("path"), *([label.alias("given")] if label is not None else []))
    rows = rows.select("page_id", "host", "path", site.alias("rule"), verdict.alias("list_verdict"), url_tokens(F.col("u"), F.col("host"), F.col("path")).alias("tokens"), *(["given"] if label is not None else []))
    rows = stage(rows.withColumn("key", F.xxhash64("tokens")), "url-rows")
    mined = stage(mine_rules(rows, "tokens", "given" if label is not None else "list_verdict", support, confidence), "url-rules")
    mined = mined.select(F.col("tokens").alias("r_tokens"), "label", "support", "confidence", "groups", F.explode("first").alias("first"))
    # a token set is judged once, however many pages have it
    sets = rows.where("rule is null").groupBy("key").agg(F.first("tokens").alias("tokens"))
    met = sets.select("key", "tokens", F.explode("tokens").alias("first")).join(mined, "first")
    met = met.where(F.forall("groups", lambda g: F.arrays_overlap(F.col("tokens"), g)))
    met = met.withColumn("r_tokens", F.array_sort(F.array_intersect("tokens", "r_tokens")))
    rank = F.struct("confidence", "support", F.size("r_tokens").alias("n"), "r_tokens", "label")
    best = stage(met.groupBy(F.col("key").alias("b_key")).agg(F.max(rank).alias("best")), "url-verdicts")
    out = rows.join(best, F.col("key") == F.col("b_key"), "left")
    by_rule = F.col("rule").isNull()
    return out.select(
        F.col("page_id").alias(page_id), "host", "path", "rule",
        F.coalesce("list_verdict", F.col("best.label"), F.lit(default)).alias("verdict"),
        F.when(by_rule, F.array_join(F.col("best.r_tokens"), " ")).alias("mined"),
    )
