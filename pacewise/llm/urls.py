"""URL filters: written rules first, then association rules mined from labels.

FP-growth finds which combinations of URL tokens go with blocked pages. Rules with
enough support and confidence are kept, the shortest of those that say the same, and
each is entered in an inverted index under its rarest token. A page is looked up by
its tokens and then checked for the rest of each rule that comes up.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.llm.store import UPPER, stored


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: The rules that the query applies.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
MIN_SUPPORT = 0.02
MIN_CONFIDENCE = 0.95
BLOCKED = "=block"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def written_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The longest rule that fits as struct(rule, verdict), or null."""
    found = F.lit(None)
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(
            path, F.lit(rule.path)
        )
        named = F.struct(
            F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict")
        )
        found = F.when(fits, named).otherwise(found)
    return found


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens: the host and its parents, parts of the host, of the path, query keys.

    Digits are read as 0, so that numbered pages share a token.
    """
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    parents = F.transform(
        labels,
        lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."),
    )
    words = F.filter(F.split(host, r"[.\-]"), lambda x: x != "")
    parts = F.filter(F.split(F.regexp_replace(path, r"\d+", "0"), "/"), lambda x: x != "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.filter(
        F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, r"(?s)^[^=]*", 0)),
        lambda x: x != "",
    )

    def marked(mark: str, found: Column) -> Column:
        return F.transform(found, lambda x: F.concat(F.lit(mark), x))

    return F.array_distinct(
        F.concat(
            marked("under:", parents),
            marked("word:", words),
            marked("path:", parts),
            marked("key:", keys),
        )
    )


def mine(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Block rules (tokens, confidence, support, key) from rows (tokens, blocked).

    `key` is the rule's rarest token, under which it is entered in the index. A rule is
    left out if a part of it is a rule, too. There are at most as many rules as
    frequent token sets, a number that min_support bounds and the input does not.
    """
    items = labelled.select(
        F.when(F.col("blocked"), F.array_append("tokens", F.lit(BLOCKED)))
        .otherwise(F.col("tokens"))
        .alias("items")
    ).where(F.size("items") > 0)
    model = FPGrowth(
        itemsCol="items",
        minSupport=min_support,
        minConfidence=min_confidence,
        numPartitions=int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions")),
    ).fit(items)
    frequent = stored(model.freqItemsets, "itemsets")
    single = frequent.where(F.size("items") == 1).select(
        F.col("items")[0].alias("token"), F.col("freq").alias("token_freq")
    )
    found = (
        model.associationRules.where(F.array_contains("consequent", BLOCKED))
        .where(F.col("confidence") >= min_confidence)
        .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    )
    found = stored(found, "rules")
    # A part of a rule shares at least one token with it, so they meet under that token.
    by_token = found.select("tokens", F.explode("tokens").alias("token"))
    part = by_token.select(F.col("tokens").alias("part"), F.col("token").alias("part_token"))
    covered = (
        by_token.join(part, F.col("token") == F.col("part_token"))
        .where(F.size("part") < F.size("tokens"))
        .where(F.size(F.array_except("part", "tokens")) == 0)
        .select(F.col("tokens").alias("covered"))
        .distinct()
    )
    shortest = found.join(covered, F.col("tokens") == F.col("covered"), "left_anti")
    return (
        shortest.withColumn("token", F.explode("tokens"))
        .join(single, "token")
        .groupBy("tokens", "confidence", "support")
        .agg(F.min_by("token", F.struct("token_freq", "token")).alias("key"))
    )


def blocked_by(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The urls of `pages` (url, tokens) that hold all tokens of some rule."""
    index = rules.select(F.col("tokens").alias("rule_tokens"), "key")
    return (
        pages.select("url", "tokens", F.explode("tokens").alias("token"))
        .join(index, F.col("token") == F.col("key"))
        .where(F.size(F.array_except("rule_tokens", "tokens")) == 0)
        .select("url")
        .distinct()
    )


def verdicts(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    labels: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Judge every row: page_id, host, path, rule, verdict, mined.

    The longest written rule that fits decides. Where none fits, the mined rules do:
    block if one matches, else allow. They are learnt from `labels` (url, blocked), or
    without it from the pages that written rules decide; every row counts. A url that
    is null or has no `://` has an empty host and path and is allowed unless a rule
    says otherwise. Repeated rows are judged alike, an empty table gives an empty
    result, and other columns are not read. `mined` tells whether a mined rule
    decided.
    """
    parts = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
    )
    ruled = parts.withColumn("found", written_rule(F.col("host"), F.col("path"), rules))
    own = tokens(F.col("host"), F.col("path"), F.col("url"))
    if labels is None:
        labelled = ruled.where("found is not null").select(
            own.alias("tokens"), (F.col("found.verdict") == "block").alias("blocked")
        )
    else:
        url = F.col("url")
        labelled = labels.select(
            tokens(host_of(url), path_of(url), url).alias("tokens"), "blocked"
        )
    free = ruled.where("found is null and url is not null")
    free = free.select("url", own.alias("tokens")).distinct()
    hits = blocked_by(free, mine(labelled, min_support, min_confidence)).select(
        F.col("url").alias("hit_url")
    )
    open_ = F.col("found").isNull()
    return ruled.join(hits, open_ & (F.col("url") == F.col("hit_url")), "left").select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(
            F.col("found.verdict"),
            F.when(F.col("hit_url").isNotNull(), "block").otherwise("allow"),
        ).alias("verdict"),
        F.col("hit_url").isNotNull().alias("mined"),
    )
