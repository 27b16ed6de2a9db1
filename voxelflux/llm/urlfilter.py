"""URL filter: explicit host/path rules first, association rules mined from labelled URLs for the rest.

Spark's FP-growth mines frequent combinations of URL tokens together with the label. Its rules lead to "blocked" or to
"fine". A rule is judged by its lift: how often its label follows its tokens, as the lower end of a Wilson interval so
that few rows count for less, divided by how often that label occurs at all. Rules whose lift is over 1 are kept, and of
those none that a shorter rule with the same verdict and as high a lift contains. URLs meet rules through an inverted
index: each rule stands under its rarest token, URL tokens are joined with that index, and a rule fits when all its
tokens are there. Of the rules that fit the one with the highest lift decides.

Tokens are those of the whole URL: scheme, every suffix of the host by labels, every segment of the path, every key of the
query. A labelled URL goes to the miner with all of them that enough labelled URLs have to make a rule, so a telling token counts
wherever it stands; rules meet all tokens of a page. FP-growth lists every combination, which is twice as many for each token
more, so it mines labels whose URLs have at most `width` such tokens. Where one has more, by_levels() finds the same rules without
listing the combinations that can't be or lead to one. All rules that remain are kept. The index is broadcast if it has at most `SMALL` rules, as counted, and joined by
token otherwise.

Defined cases: null urls and urls without :// have an empty host and path, no rule and no tokens: they are
allowed, as is what no rule fits. Of equal lifts blocking wins, then the rule whose tokens sort last. Labels that are null
are left out. Repeated rows are judged alike; an empty table gives no rows, and no labels mean no mined rules.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelflux.llm.store import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCKED, FINE = "=blocked", "=fine"
#: The rules that hold before any mined rule
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))

#: An index of so many rules is broadcast.
SMALL = 20_000


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host_col: Column, path_col: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, prefix, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host_col == name) | F.endswith(host_col, F.lit("." + name))) & F.startswith(path_col, F.lit(prefix))
        out = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: scheme, all host suffixes, path segments and query keys; digits in paths become #."""
    h, p = host(url), path(url)
    labels = F.filter(F.split(h, r"\."), lambda x: x != "")
    ends = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))), lambda i: F.concat(F.lit("h:"), F.array_join(F.slice(labels, F.greatest(F.size(labels) - i + 1, F.lit(1)), i), ".")))
    segments = F.transform(F.filter(F.split(F.regexp_replace(p, "[0-9]+", "#"), "/"), lambda x: x != ""), lambda x: F.concat(F.lit("p:"), x))
    query = F.regexp_extract(_rest(url), r"\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1)))
    scheme = F.array(F.concat(F.lit("s:"), F.substring_index(url, "://", 1)))
    return F.when(h != "", F.array_distinct(F.concat(scheme, ends, segments, keys))).otherwise(F.array().cast("array<string>"))


#: With more tokens than these in a labelled URL rules are mined by levels.
WIDTH = 12


def transactions(labelled: DataFrame, least: float, width: int | None = None) -> DataFrame:
    """(items, bad) of labelled (url, bad): a row's tokens that `least` rows or more have, rarest first; all, or `width` if given."""
    rows = settle(labelled.where("bad is not null").select(F.monotonically_increasing_id().alias("row"), tokens(F.col("url")).alias("have"), "bad"), "labelled-urls")
    each = rows.select("row", F.explode("have").alias("token"))
    often = each.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    order = F.array_sort(F.collect_list(F.struct("n", "token")))  # a row's own tokens
    kept = each.join(often, "token").groupBy("row").agg((order if width is None else F.slice(order, 1, width)).alias("kept"))
    items = F.coalesce(F.transform("kept", lambda x: x["token"]), F.array().cast("array<string>"))
    return rows.join(kept, "row", "left").select(items.alias("items"), "bad")


def wilson(p: Column, n: Column, z: float) -> Column:
    """The lower end of the interval of a share p of n rows."""
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def by_levels(items: DataFrame, least: float, shares: dict[str, float], z: float, min_lift: float) -> DataFrame:
    """The rules of (items, bad) that no shorter one contains with as high a lift, in the columns of RULE, by length.

    A part of a row's tokens is extended while that can give a rule. It can't for a verdict that fewer than `least` of its rows
    have, or where the lift of a rule that is right for all of those is no higher than one that the part already contains. A part
    in as many rows as a shorter one of its own has the shorter one's lift, and so has all that contains it. What is left out
    is therefore no rule or pruned as one. shares are those of "block" and "allow" among all rows.
    """
    rows = settle(items.select(F.monotonically_increasing_id().alias("row"), "items", "bad"), "mined-rows")
    each = rows.select("row", "bad", F.explode("items").alias("token"))
    names = settle(each.select("token").distinct().select(F.monotonically_increasing_id().alias("id"), "token"), "mined-tokens")
    held = settle(each.join(names, "token").select("row", "bad", F.array("id").alias("part")), "mined-parts")
    verdicts = [v for v, share in shares.items() if share > 0]
    known, rules = None, []
    while True:
        level = held.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("k_block")).withColumn("k_allow", F.col("n") - F.col("k_block"))
        if known is None:
            level = level.withColumns({f"best_{v}": F.lit(float(min_lift)) for v in verdicts} | {f"live_{v}": F.lit(True) for v in verdicts})
        else:
            shorter = F.transform("part", lambda x: F.array_except("part", F.array(x)))
            prior = known.select(F.col("part").alias("shorter"), F.col("n").alias("of"), *(f"{c}_{v}" for v in verdicts for c in ("best", "live")))
            of = [F.max(f"best_{v}").alias(f"best_{v}") for v in verdicts] + [F.bool_and(f"live_{v}").alias(f"live_{v}") for v in verdicts]
            counts = ["part", "n", "k_block", "k_allow"]
            level = level.withColumn("shorter", F.explode(shorter)).join(prior, "shorter").groupBy(*counts).agg(F.min("of").alias("of"), F.count(F.lit(1)).alias("parts"), *of)
            level = level.where((F.col("parts") == F.size("part")) & (F.col("n") < F.col("of"))).drop("of", "parts")
        for v in verdicts:
            k, best, live = F.col(f"k_{v}"), F.col(f"best_{v}"), F.col(f"live_{v}") & (F.col(f"k_{v}") >= least)
            lift = F.when(live, wilson(k / F.col("n"), F.col("n"), z) / shares[v])
            level = level.withColumns({f"live_{v}": live, f"lift_{v}": F.when(lift > best, lift)})
            best = F.greatest(best, f"lift_{v}")
            sure = k / (k + z * z) / shares[v] * (1 + 1e-9)  # of as many rows, all with the verdict
            level = level.withColumns({f"best_{v}": best, f"live_{v}": live & (sure > best)})
        told = reduce(lambda a, b: a | b, (F.col(f"live_{v}") | F.col(f"lift_{v}").isNotNull() for v in verdicts))
        level = settle(level.where(told), "mined-level")
        rules += [level.where(f"lift_{v} is not null").select("part", F.lit(v).alias("verdict"), F.col(f"lift_{v}").alias("lift"), (F.col(f"k_{v}") / F.col("n")).alias("confidence"), "n") for v in verdicts]
        lives = [f"live_{v}" for v in verdicts]
        known = level.where(" or ".join(lives))
        if known.isEmpty():
            break
        ends = held.join(known.select("part", *lives), "part").select("row", "bad", F.expr("slice(part, 1, size(part) - 1)").alias("head"), F.element_at("part", -1).alias("last"), *lives)
        other = ends.select("row", "head", F.col("last").alias("more"), *(F.col(c).alias(f"also_{c}") for c in lives))
        both = reduce(lambda a, b: a | b, (F.col(c) & F.col(f"also_{c}") for c in lives))
        pairs = ends.join(other, ["row", "head"]).where((F.col("last") < F.col("more")) & both)
        held = settle(pairs.select("row", "bad", F.concat("head", F.array("last", "more")).alias("part")), "mined-parts")
    found = reduce(DataFrame.unionByName, rules)
    named = found.withColumn("id", F.explode("part")).join(names, "id").groupBy("part", "verdict", "lift", "confidence", "n").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    return named.select("tokens", "verdict", "lift", "confidence", "n")


RULE = "tokens array<string>, verdict string, lift double, confidence double, n long"


def mine(labelled: DataFrame, min_support: float = 0.002, min_count: int = 20, z: float = 2.0, min_lift: float = 1.0, width: int = WIDTH, partitions: int | None = None) -> DataFrame:
    """(tokens, verdict, lift, confidence, n) of the rules, from labelled (url, bad); n is the number of labelled rows with the tokens.

    A rule's tokens and label need min_support of the labelled rows and min_count of them. z is the width of the
    interval in standard errors. width chooses how rules are mined, and changes none.
    """
    label = F.when(F.col("bad"), BLOCKED).otherwise(FINE)
    rows, bad = labelled.where("bad is not null").agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0))).first()
    least = max(min_support * rows, min_count)
    if least > rows:  # too few labels for any rule
        return labelled.sparkSession.createDataFrame([], RULE)
    shares = {"block": bad / rows, "allow": 1 - bad / rows}
    seen = transactions(labelled, least).cache()
    if (seen.agg(F.max(F.size("items"))).first()[0] or 0) > width:
        return by_levels(seen, least, shares, z, min_lift)
    items = seen.select(F.array_append("items", label).alias("items"))
    miner = FPGrowth(itemsCol="items", minSupport=(math.ceil(least) - 0.5) / rows, minConfidence=0.0)  # it multiplies and rounds up: 20 / n * n may be 21
    if partitions:
        miner = miner.setNumPartitions(partitions)
    blocks = F.col("consequent")[0] == BLOCKED
    p, n = F.col("confidence"), F.col("n")
    low = wilson(p, n, z)
    found = (
        miner.fit(items).associationRules.where(F.col("consequent")[0].isin(BLOCKED, FINE) & ~F.arrays_overlap("antecedent", F.array(F.lit(BLOCKED), F.lit(FINE))))
        .select(F.array_sort("antecedent").alias("tokens"), F.when(blocks, "block").otherwise("allow").alias("verdict"), "confidence", F.round(F.col("support") * rows / F.col("confidence")).cast("long").alias("n"))
        .withColumn("lift", low / F.when(F.col("verdict") == "block", shares["block"]).otherwise(shares["allow"]))
        .where(F.col("lift") > min_lift).select("tokens", "verdict", "lift", "confidence", "n")
    ).cache()
    # every proper part of a rule, in the order of its tokens, meets the rules that are equal to it
    parts = found.where(F.size("tokens") > 1).withColumn("m", F.explode(F.expr("sequence(1, shiftleft(1, size(tokens)) - 2)")))
    parts = parts.select("tokens", "verdict", "lift", F.expr("filter(tokens, (x, i) -> (shiftright(m, i) & 1) = 1)").alias("part"))
    shorter = found.select(F.col("tokens").alias("part"), "verdict", F.col("lift").alias("as_high"))
    told = parts.join(shorter, ["part", "verdict"]).where("as_high >= lift").select("tokens", "verdict").distinct()
    return found.join(told, ["tokens", "verdict"], "left_anti").select("tokens", "verdict", "lift", "confidence", "n")


def index(rules: DataFrame, urls: DataFrame, small: bool = False) -> DataFrame:
    """The inverted index: (anchor, needs, mined, lift), each rule under the token that fewest urls have."""
    wanted = rules.select("tokens", "verdict", "lift", F.explode("tokens").alias("anchor"))
    anchors = wanted.select("anchor").distinct()
    seen = urls.select(F.explode(tokens(F.col("url"))).alias("anchor")).join(F.broadcast(anchors) if small else anchors, "anchor", "left_semi").groupBy("anchor").count()
    return (
        wanted.join(seen, "anchor", "left").groupBy("tokens", "verdict", "lift")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "anchor")).alias("rarest"))
        .select(F.col("rarest.anchor").alias("anchor"), F.col("tokens").alias("needs"), F.col("verdict").alias("mined"), "lift")
    )


def judge(pages: DataFrame, labelled: DataFrame, **options) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined_rule, lift) for each row of pages (page_id, url).

    labelled has (url, bad). mined_rule are the tokens of the mined rule that fits best, null if none does; where an
    explicit rule fits it is that which decides. Rows are told apart by a number of their own, so repeats stay.
    """
    rules = mine(labelled, **options).cache()
    small = rules.count() <= SMALL
    inverted = index(rules, pages, small)
    inverted = F.broadcast(inverted) if small else inverted
    rows = pages.select("page_id", "url", F.monotonically_increasing_id().alias("row")).withColumn("have", tokens(F.col("url")))
    hit = rows.withColumn("anchor", F.explode_outer("have")).join(inverted, "anchor", "left")
    fits = F.size(F.array_except("needs", "have")) == 0
    best = F.max(F.when(fits, F.struct("lift", F.col("mined"), F.array_join("needs", " ").alias("needs")))).alias("best")
    judged = hit.groupBy("row").agg(F.first("page_id").alias("page_id"), F.first("url").alias("url"), best)
    h, p = host(F.col("url")), path(F.col("url"))
    explicit = rule_of(h, p)
    verdict = F.coalesce(explicit["verdict"], "best.mined", F.lit("allow"))
    return judged.select("page_id", h.alias("host"), p.alias("path"), explicit["rule"].alias("rule"), verdict.alias("verdict"), F.col("best.needs").alias("mined_rule"), F.col("best.lift").alias("lift"))
