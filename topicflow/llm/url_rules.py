"""URL filters: given rules first, then association rules mined from labelled pages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

#: (host, path, verdict): fits the host and its subdomains where the url's path starts with the rule's.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or one without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 2)
    return ascii_lower(rest), path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest fitting rule as struct(rule, verdict), or null."""
    best = F.lit(None)
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        best = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a url: labels of its host, words of its path and the names in its query.

    Runs of digits become ``#``, so that numbered pages share tokens.
    """
    host, path = url_parts(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)

    def named(kind: str, text: Column, cut: str) -> Column:
        words = F.filter(F.split(F.regexp_replace(ascii_lower(text), "[0-9]+", "#"), cut), lambda w: w != "")
        return F.transform(words, lambda w: F.concat(F.lit(kind), w))

    names = F.regexp_replace(query, "=[^&]*", "")
    return F.array_distinct(F.concat(named("h:", host, r"\."), named("p:", path, r"[^a-z#]+"), named("q:", names, "&")))


def _wide_rules(tokens: DataFrame, least_bad: float) -> DataFrame:
    """Combinations of two and more tokens that stand on a wide page, on ``least_bad`` bad pages at least: (rule), sorted.

    ``tokens(id, bad, n, token, wide)`` has a row for each token of a distinct set of ``n`` pages. Level by level sets
    that share all but their last token meet in a join on the pages that have them, so no task holds
    more than its share. A set on the same pages as one of its parts is left out, and so is one with a part on bad pages only, as
    no set on more tokens is a surer rule than these: what is left has the parts of all its sets in the level before.
    """
    counted = lambda held: held.groupBy("rule").agg(F.sum("n").alias("seen"), F.sum(F.col("bad") * F.col("n")).alias("bad_pages"), F.max("wide").alias("wide")).filter((F.col("bad_pages") >= least_bad) & F.col("wide"))
    held = stored(tokens.select("id", "bad", "n", "wide", F.array("token").alias("rule")), "held-sets")
    level, found = stored(counted(held), "level"), []
    while True:
        open_ = level.filter("bad_pages < seen").select("rule", "seen")
        last = held.join(open_.select("rule"), "rule", "left_semi").select("id", "bad", "n", "wide", F.slice("rule", 1, F.size("rule") - 1).alias("head"), F.element_at("rule", -1).alias("last"))
        last = stored(last, "open-sets")
        pairs = last.join(last.select("id", "head", F.col("last").alias("other")), ["id", "head"]).filter("last < other")
        held = stored(pairs.select("id", "bad", "n", "wide", F.concat("head", F.array("last", "other")).alias("rule")), "held-sets")
        more = stored(counted(held), "candidates")
        parts = more.select("rule", "seen", F.explode(F.transform("rule", lambda t: F.array_remove(F.col("rule"), t))).alias("part"))
        wider = parts.join(open_.select(F.col("rule").alias("part"), F.col("seen").alias("before")), "part").filter("before > seen")
        whole = wider.groupBy("rule").agg(F.count("*").alias("parts")).filter("parts = size(rule)")
        level = stored(more.join(whole, "rule", "left_semi"), "level")
        found.append(level.select("rule"))
        if level.isEmpty():
            return reduce(DataFrame.union, found)


def mine_rules(pages: DataFrame, labels: DataFrame, min_support: float = 0.001, min_confidence: float = 0.5, min_pages: int = 5, common: float = 0.9, errors: float = 1.0, widest: int = 12, exact: bool = False) -> DataFrame:
    """Association rules "these tokens -> a bad page": (rule_id, tokens, anchor, pages, confidence).

    A page is bad if its label says quality 0 or toxic 1; pages without a label teach nothing.
    FP-growth finds the token combinations that are frequent among bad pages; each is then
    counted over all labelled pages and stays if it has the support and the confidence, if its
    confidence less ``errors`` standard errors (Wilson's bound) is over the share of bad pages
    among all, so that few pages alone don't make a rule, and if no rule on fewer of its tokens
    is as sure. By default a rule blocks no more good labelled pages than bad ones. Tokens on more than ``common`` of the pages tell
    nothing and are left out.

    What FP-growth holds is bounded. A token of which all labelled pages are bad is a rule by itself, and no
    rule on more tokens is surer: it is not combined with others. Of each page's other tokens, the ``widest`` of
    the highest share of bad pages (the rarer on a tie, then in order) are combined by FP-growth, so that one page has 2**widest
    combinations at most there. With ``exact`` combinations on pages with more tokens are found level by level beside it (``_wide_rules``), so none
    is lost; there may be exponentially many. Every token can be a rule by itself. A page_id on several pages counts for each of them; null ids and null
    urls teach nothing; of labels that repeat an id the worst counts. Tokens that always stand together are one item to FP-growth, or
    their combinations would double with each, and are put into its rules one at a time, each in
    place of the rarest (a rule on two of them is never surer than one on either). ``anchor`` is the rule's rarest token, under which it is indexed.
    """
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    labels = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max(bad.cast("int")).alias("bad"))
    pages = pages.select("page_id", url_tokens(F.col("url")).alias("tokens"))
    seen = stored(pages.join(labels, pages["page_id"] == labels["doc_id"]).groupBy("tokens", "bad").agg(F.count("*").alias("n")), "labelled")
    total = seen.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(min_pages, min_support * total)
    frequent = seen.select(F.explode("tokens").alias("token"), "n").groupBy("token").agg(F.sum("n").alias("seen")).filter((F.col("seen") >= least) & (F.col("seen") <= common * total))
    frequent = stored(frequent, "tokens")  # at most the tokens of all pages over the support: broadcast only while small
    every = seen.select(F.xxhash64("tokens", "bad").alias("id"), "bad", "n", F.explode("tokens").alias("token")).join(frequent, "token")
    every = stored(every, "held")
    kin = every.groupBy("token").agg(F.first("seen").alias("seen"), F.sum(F.col("id").cast("decimal(38,0)")).alias("where"), F.count("*").alias("sets"), F.sum(F.col("bad") * F.col("n")).alias("bad_pages"))
    kin = stored(kin.groupBy("where", "sets").agg(F.min("token").alias("lead"), F.first("bad_pages").alias("bad_pages"), F.array_sort(F.collect_list(F.struct("seen", "token"))).alias("kin")), "kin")
    leads = kin.select(F.col("lead").alias("token"), F.element_at("kin", 1)["seen"].alias("seen"))
    items = every.drop("seen").join(leads, "token")
    items = stored(items.groupBy("id", "bad").agg(F.first("n").alias("n"), F.array_sort(F.collect_set("token")).alias("items")).groupBy("items", "bad").agg(F.sum("n").alias("n")), "items")
    n_bad = items.filter("bad = 1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    schema = "rule_id long, tokens array<string>, anchor string, pages long, confidence double"
    if not n_bad or least * min_confidence > n_bad:
        return pages.sparkSession.createDataFrame([], schema)
    single = kin.select(F.col("lead").alias("token"), F.element_at("kin", 1)["seen"].alias("seen"), "bad_pages")
    single = stored(single.filter(F.col("bad_pages") >= least * min_confidence), "single")
    open_ = single.filter("bad_pages < seen").select("token", F.struct((-F.col("bad_pages") / F.col("seen")).alias("less"), "seen", "token").alias("item"))
    combined = every.filter("bad = 1").drop("seen").join(open_, "token").groupBy("id").agg(F.first("n").alias("n"), F.slice(F.array_sort(F.collect_set("item")), 1, widest).alias("items"))
    combined = combined.select(F.array_sort(F.transform("items", lambda x: x["token"])).alias("items"), "n").filter(F.size("items") > 1)
    combined = stored(combined.groupBy("items").agg(F.sum("n").alias("n")), "combined")
    found = single.select(F.array("token").alias("rule"))
    rows = combined.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if rows:
        # a row for each page: in lots, so that no row holds the numbers of all pages of a hot set
        lots = combined.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / 4096))))
        lots = lots.repartition(F.xxhash64("items", "lot")).withColumn("rows", F.least(F.lit(4096), F.col("n") - F.col("lot") * 4096))
        bad_rows = lots.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).select("items")
        mined = FPGrowth(itemsCol="items", minSupport=min(1.0, least * min_confidence / rows)).fit(bad_rows).freqItemsets
        found = found.union(mined.filter(F.size("items") > 1).select(F.array_sort("items")))
    shown = every.drop("seen").join(open_.select("token"), "token")
    wide = shown.filter("bad = 1").groupBy("id").agg((F.count("*") > widest).alias("wide")).filter("wide")
    wide = stored(wide, "wide") if exact else None
    if wide is not None and not wide.isEmpty():
        marked = shown.join(wide, "id", "left").withColumn("wide", F.coalesce("wide", F.lit(False)))
        found = found.union(_wide_rules(marked, least * min_confidence))
    found = stored(found.distinct().withColumn("rule_id", F.xxhash64("rule")), "itemsets")
    rarity = leads
    anchored = stored(found.select("rule_id", "rule", F.explode("rule").alias("token")).join(rarity, "token").groupBy("rule_id", "rule").agg(F.min_by("token", F.struct("seen", "token")).alias("anchor")), "anchored")
    held = items.select("items", "bad", "n", F.explode("items").alias("anchor")).join(anchored, "anchor")
    held = held.filter(F.size(F.array_except("rule", "items")) == 0).groupBy("rule_id", "rule", "anchor").agg(F.sum("n").alias("pages"), (F.sum(F.col("bad") * F.col("n")) / F.sum("n")).alias("confidence"))
    share = seen.filter("bad = 1").agg(F.sum("n")).first()[0] / total
    p, n, z = F.col("confidence"), F.col("pages"), float(errors)
    bound = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    sure = stored(held.filter((n >= least) & (p >= min_confidence) & (bound > share)), "sure")
    # a rule is left out if dropping one of its tokens leaves a rule that is as sure
    fewer = sure.select("rule_id", "confidence", F.explode(F.transform("rule", lambda t: F.array_remove(F.col("rule"), t))).alias("rule"))
    worse = fewer.alias("a").join(sure.alias("b"), F.col("a.rule") == F.col("b.rule")).filter("b.confidence >= a.confidence").select(F.col("a.rule_id").alias("rule_id")).distinct()
    kept = sure.join(worse, "rule_id", "left_anti").select("rule_id", "pages", "confidence", F.explode("rule").alias("lead")).join(kin.select("lead", "kin"), "lead")
    kept = kept.groupBy("rule_id").agg(F.first("pages").alias("pages"), F.first("confidence").alias("confidence"), F.collect_list("kin").alias("kins"))
    # the rarest token of each of the rule's items, and each of the others in its item's place
    choices = F.expr("""flatten(transform(kins, (k, i) -> transform(k, t -> transform(kins, (other, j) -> if(i = j, t, other[0])))))""")
    one = kept.select("pages", "confidence", F.explode(F.array_distinct(choices)).alias("rule"))
    one = one.select(F.array_sort(F.transform("rule", lambda t: t["token"])).alias("tokens"), F.array_min("rule")["token"].alias("anchor"), "pages", "confidence")
    return one.select(F.xxhash64("tokens").alias("rule_id"), "tokens", "anchor", "pages", "confidence")


def judge_urls(pages: DataFrame, mined: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    A given rule decides where one fits. Else the page is blocked if all tokens of a mined rule
    are in its url. Distinct token sets are matched once: each looks up the rules indexed
    under its tokens, and a rule found is checked in full. A null url has no host, path or
    tokens and is allowed; an empty table gives no rows.
    """
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), url_tokens(F.col("url")).alias("tokens"))
    mined = stored(mined, "rules")
    sets = rows.select("tokens").distinct().select("tokens", F.explode("tokens").alias("anchor"))
    hit = sets.join(mined.select("anchor", F.col("tokens").alias("needs")), "anchor").filter(F.size(F.array_except("needs", "tokens")) == 0)
    hit = stored(hit.select("tokens").distinct().withColumn("hit", F.lit(True)), "blocked")
    judged = rows.join(hit, "tokens", "left").withColumn("given", matching_rule(F.col("host"), F.col("path"), rules))
    other = F.when(F.col("hit"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", F.col("given.rule").alias("rule"), F.coalesce("given.verdict", other).alias("verdict"))
