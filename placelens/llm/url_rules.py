"""URL verdicts: host and path rules, and association rules mined from their labels, with DataFrame functions only.

A rule names a host and a path; it fits that host and all its subdomains if the URL's path starts with the rule's, and the
longest rule that fits wins. URLs that a rule fits are the labelled ones. FP-growth mines which combinations of their tokens (host
labels, host endings, path segments, file endings, query keys, scheme) come with which verdict. Mined rules need `SUPPORT` and `CONFIDENCE`,
and a rule whose tokens contain those of a shorter rule with the same verdict and at least its confidence is dropped. All other URLs
are judged by the mined rule of the highest confidence whose tokens they have (then support, then more tokens), found through an
inverted index: tokens of a URL look up the rules that hold them, and a rule fits when all its tokens were found. Without any such rule a URL
is allowed.

Mining runs over the distinct URLs, so copies prove nothing, and on every token that `SUPPORT` of the labelled ones have. Tokens that
stand in exactly the same labelled URLs are one kind: all rules that differ only in which of them they name are mined as one, which
fits a URL with any of them. A kind all of whose URLs have one verdict is a rule of full confidence by itself; no longer rule with it can
be better, so mining never sees it. What is left are the open kinds, which can only tell in combination. All of them count, when rules are
mined as when they are matched. FP-growth mines them where no labelled URL has more than `OPEN`. Tokens that nearly always come together, as the
query keys of one site, are frequent in every subset of them, which FP-growth would list; where a URL has more open kinds, `searched` finds the same
rules by levels, and leaves out only combinations that it proves to hold no rule that could change a verdict. Tokens are
looked up once for each distinct token set, so a host that holds a third of all pages is looked up as often as its sets differ.

Defined results: a null URL, or one without `://`, has an empty host and path, no token, and is allowed; repeated rows get the same
verdict each; a table without labelled URLs yields no mined rules; an empty table gives no rows; other columns are not
looked at, whatever their names.
"""

import math
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from placelens.llm.common import LOWER, UPPER, measured_join, stored

#: Rules of the contract: verdict, host, path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
SUPPORT = 0.005
CONFIDENCE = 0.8
#: Up to so many open kinds in every labelled URL, FP-growth lists all frequent combinations, at most 2**OPEN for a URL; beyond, `searched` mines.
OPEN = 10
DEFAULT = "allow"


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def fitting_rule(host_col: Column, path_col: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does. Equal lengths go to the longer host."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host_col == name) | host_col.endswith("." + name)) & path_col.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def tokens(url: Column, host_col: Column, path_col: Column) -> Column:
    """The distinct tokens of a URL, each with its kind; none without a host."""
    labels = F.filter(F.split(host_col, r"\."), lambda x: x != "")
    segments = F.filter(F.split(path_col, "/"), lambda x: x != "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.element_at(F.split(x, "="), 1)), lambda x: x != "")
    ending = F.regexp_extract(path_col, r"\.([A-Za-z0-9]{1,8})$", 1)
    scheme = F.regexp_extract(F.coalesce(url, F.lit("")), r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    kinds = [
        F.transform(labels, lambda x: F.concat(F.lit("label:"), x)),
        F.transform(F.slice(F.reverse(labels), 1, 1), lambda x: F.concat(F.lit("ending:"), x)),
        F.transform(segments, lambda x: F.concat(F.lit("segment:"), x)),
        F.transform(keys, lambda x: F.concat(F.lit("key:"), x)),
        F.filter(F.array(F.concat(F.lit("file:"), ending), F.concat(F.lit("scheme:"), F.lower(scheme))), lambda x: ~x.endswith(":")),
    ]
    return F.when(host_col != "", F.array_sort(F.array_distinct(F.concat(*kinds)))).otherwise(F.array().cast("array<string>"))


def parsed(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, url, host, path, known (rule and its verdict, or null) of every row."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    split = rows.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    return split.withColumn("known", fitting_rule(F.col("host"), F.col("path"), rules))


def kinds(labelled: DataFrame, support: float = SUPPORT) -> DataFrame:
    """token, kind, n, verdict (the most frequent), top (how often), rank (how telling the kind is) of every token with `support`; stored.

    `labelled`: tokens, verdict; one row per distinct URL. Tokens of one kind stand in the same rows: they agree in their
    number of rows and in the sum of those rows' hashes. The kind is the first of them by name.
    """
    rows = labelled.select(F.explode("tokens").alias("token"), "verdict", F.xxhash64("tokens").cast("decimal(28,0)").alias("row"))
    told = rows.groupBy("token", "verdict").agg(F.count("*").alias("times"), F.sum("row").alias("rows"))
    counts = told.groupBy("token").agg(
        F.sum("times").alias("n"), F.sum("rows").alias("rows"), F.max(F.struct("times", "verdict")).alias("most")
    )
    frequent = counts.where(F.col("n") >= support * labelled.count())
    members = frequent.groupBy("n", "rows", "most").agg(F.collect_list("token").alias("tokens"))
    named = members.select("tokens", F.array_min("tokens").alias("kind"), "n", "most.verdict", F.col("most.times").alias("top"))
    order = Window.orderBy(F.desc(F.col("top") / F.col("n")), F.desc("n"), "kind")  # at most the tokens of a URL over `support`
    return stored(named.withColumn("rank", F.row_number().over(order)).withColumn("token", F.explode("tokens")).drop("tokens"), "kinds")


def described(rows: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """key, rank, kind: every kind of each row, once; rows without a kind are left out. `rows`: key, tokens."""
    single = measured_join(rows.select(key, F.explode("tokens").alias("token")), names, "token")
    found = single.groupBy(key).agg(F.collect_set(F.struct("rank", "kind")).alias("found"))
    return found.select(key, F.inline("found"))


def _subsets(items: Column) -> Column:
    """All proper, non-empty subsets of an array of at most `OPEN` items, each in the array's order."""
    masks = F.sequence(F.lit(1).cast("bigint"), F.pow(F.lit(2), F.size(items)).cast("bigint") - 2)
    some = F.transform(masks, lambda mask: F.filter(items, lambda _, at: F.getbit(mask, at) == 1))
    return F.when(F.size(items) > 1, some).otherwise(F.array().cast("array<array<string>>"))


def _bounds(rows: DataFrame, child: list[str], least: int) -> DataFrame:
    """`child`, bound: what the confidence of no combination that goes on from `child` exceeds; without one, no row. `rows`: child, rest, pos, n.

    Such a combination fits some of the rows as they are told apart by `rest`, and all of a row that has every kind left; with `least` URLs of the
    verdict among them, the best choice takes rows by their share of it, the last one in part.
    """
    rows = rows.where(F.size("rest") > 0)
    left = rows.select(*child, F.explode("rest").alias("one")).distinct().groupBy(*child).agg(F.count("*").alias("left"))
    told = rows.join(left, child).select(*child, (F.size("rest") == F.col("left")).alias("always"), (F.col("pos") / F.col("n")).alias("share"), "pos", "n")
    steps = told.groupBy(*child, "always", "share").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    upto = Window.partitionBy(*child).orderBy(F.desc("always"), F.desc("share")).rowsBetween(Window.unboundedPreceding, 0)  # one row for each share
    taken = steps.select("*", F.sum("pos").over(upto).alias("_pos"), F.sum("n").over(upto).alias("_n")).where(F.col("_pos") >= least)
    before, before_n = F.col("_pos") - F.col("pos"), F.col("_n") - F.col("n")
    in_part = F.when(~F.col("always") & (before < least), least / (before_n + (least - before) / F.col("share")))
    return taken.groupBy(*child).agg(F.max(F.greatest(F.col("_pos") / F.col("_n"), in_part)).alias("bound"))


def searched(baskets: DataFrame, support: float, confidence: float) -> DataFrame:
    """ranks, verdict, confidence, support of the rules over `baskets` (ranks: sorted open kinds, verdict), one row per URL.

    All rules of FP-growth but some that never decide: a shorter one makes them useless, or outdoes all of other verdicts. A combination grows by kinds behind its last one, and the URLs that it fits are kept
    as counts of what is left of them. It grows no more if its support is short, if its last kind takes only URLs of its verdict away (any rule
    with that kind is then no better than without), or if whatever goes on from it stays below `confidence` or at most reaches that of a rule within it.
    Nor if it cannot reach full confidence and a rule within it beats all rules of other verdicts that are below that: URLs it fits get its verdict,
    or that of a rule of full confidence, in any case. The work has no bound but these: it grows with the combinations that are better than their parts.
    """
    total = baskets.count()
    least = max(1, math.ceil(support * total))
    counted = baskets.groupBy(F.col("ranks").alias("rest"), "verdict").agg(F.count("*").alias("times"))
    told = F.map_from_entries(F.collect_list(F.struct("verdict", "times"))).alias("told")
    patterns = counted.groupBy("rest").agg(F.sum("times").alias("n"), told)
    verdicts = counted.groupBy("verdict").agg((F.lit(total) - F.sum("times")).alias("against"))
    base = patterns.crossJoin(F.broadcast(verdicts)).select(
        "verdict", F.array().cast("array<int>").alias("prefix"), F.lit(0.0).alias("best"), "against", "rest",
        F.coalesce(F.col("told")[F.col("verdict")], F.lit(0)).alias("pos"), "n",
    )
    child, sums = ["verdict", "prefix", "item"], (F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    ranks, levels, most = F.concat("prefix", F.array("item")), [], {}
    while True:
        grown = base.select("*", F.posexplode("rest").alias("at", "item"))
        behind = F.slice("rest", F.col("at") + 2, F.size("rest")).alias("rest")
        rows = stored(grown.select(*child, "best", "against", behind, "pos", "n").groupBy(*child, "best", "against", "rest").agg(*sums), "grown")
        one = rows.groupBy(*child, "best", "against").agg(*sums).join(_bounds(rows, child, least), child, "left")
        if levels:  # rules within the combination that have its last kind; those without it are in `best`
            known = reduce(DataFrame.unionByName, levels).select("verdict", F.element_at("ranks", -1).alias("item"), "ranks", "confidence")
            within = one.select(*child).join(known, ["verdict", "item"]).where(F.size(F.array_except("ranks", ranks)) == 0)
            one = one.join(within.groupBy(*child).agg(F.max("confidence").alias("known")), child, "left")
        else:
            one = one.withColumn("known", F.lit(None).cast("double"))
        one = one.withColumn("beaten", F.greatest("best", F.coalesce("known", F.lit(0.0)))).withColumn("confidence", F.col("pos") / F.col("n"))
        rule = (F.col("pos") >= least) & (F.col("confidence") >= confidence) & (F.col("confidence") > F.col("beaten"))
        one = stored(one.withColumn("rule", rule).withColumn("best", F.when(rule, F.col("confidence")).otherwise(F.col("beaten"))), "children")
        levels.append(one.where("rule").select(ranks.alias("ranks"), "verdict", "confidence", (F.col("pos") / total).alias("support")))
        useful = one.where((F.col("pos") >= least) & (F.col("n") - F.col("pos") < F.col("against")) & (F.col("best") < 1))  # also behind other kinds
        reach = F.least(F.col("bound") * (1 + 1e-12), F.lit(1.0))  # rounding must not lower a bound
        growing = useful.where((reach >= confidence) & (reach > F.col("best")))
        partial = one.where(F.col("rule") & (F.col("confidence") < 1)).groupBy("verdict").agg(F.max("confidence"))
        most |= {verdict: max(top, most.get(verdict, 0.0)) for verdict, top in partial.collect()}  # one row for each verdict, here and below
        tops = dict(growing.groupBy("verdict").agg(F.max(reach)).collect())
        if not tops:
            return reduce(DataFrame.unionByName, levels)
        rivals = {verdict: max([0.0, *(max(most.get(v, 0.0), tops.get(v, 0.0)) for v in {*most, *tops} - {verdict})]) for verdict in tops}
        rival = F.create_map(*(F.lit(x) for pair in rivals.items() for x in pair))[F.col("verdict")]
        decided = (F.col("bound") < 1 - 1e-11) & (F.col("best") > rival + 1e-11)
        growing = stored(growing.where(~decided).select(*child, "best", (F.col("n") - F.col("pos")).alias("against")), "growing")
        if growing.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        tails = useful.groupBy("verdict", "prefix").agg(F.collect_list("item").alias("kept"))  # kinds, not URLs
        held = rows.drop("best", "against").join(growing, child).join(tails, ["verdict", "prefix"])
        rest = F.filter("rest", lambda x: F.array_contains("kept", x)).alias("rest")
        cut = held.select("verdict", ranks.alias("prefix"), "best", "against", rest, "pos", "n").where(F.size("rest") > 0)
        base = stored(cut.groupBy("verdict", "prefix", "best", "against", "rest").agg(*sums), "base")


def _useless(rules: DataFrame) -> DataFrame:
    """rule_id of every rule that contains a shorter one of its verdict and at least its confidence."""
    shorter = rules.select(F.col("tokens").alias("subset"), "verdict", F.col("confidence").alias("_confidence"))
    longer = rules.select("rule_id", "verdict", "confidence", "tokens")
    few = longer.where(F.size("tokens") <= OPEN).withColumn("subset", F.explode(_subsets(F.col("tokens")))).join(shorter, ["subset", "verdict"])
    many = longer.where(F.size("tokens") > OPEN).withColumn("token", F.explode("tokens"))  # too long for all their subsets
    first = shorter.withColumn("token", F.element_at("subset", 1))
    within = (F.size("subset") < F.size("tokens")) & (F.size(F.array_except("subset", "tokens")) == 0)
    found = few.select("rule_id", "confidence", "_confidence").unionByName(
        many.join(first, ["token", "verdict"]).where(within).select("rule_id", "confidence", "_confidence")
    )
    return found.where("_confidence >= confidence").select("rule_id").distinct()


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, names: DataFrame | None = None) -> DataFrame:
    """Association rules: rule_id, tokens, verdict, confidence, support; stored. `labelled`: tokens, verdict; distinct URLs.

    A rule's tokens are kinds, as `names` (of `kinds`) has them.
    """
    names = kinds(labelled, support) if names is None else names
    rows = stored(labelled.withColumn("row", F.monotonically_increasing_id()), "labelled")
    total = rows.count()
    whole = names.where("token = kind AND top = n").select(
        F.array("kind").alias("tokens"), "verdict", F.lit(1.0).alias("confidence"), F.round(F.col("n") / total, 12).alias("support")
    )
    open_names = names.where("top < n")
    open_kinds = described(rows, open_names, "row").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "kind"))).alias("kinds"))
    joined = stored(rows.select("row", "verdict").join(open_kinds, "row", "left").select("verdict", "kinds"), "open-kinds")
    if (joined.agg(F.max(F.size("kinds"))).first()[0] or 0) <= OPEN:
        verdict = F.array(F.concat(F.lit("="), F.col("verdict")))
        baskets = joined.select(F.concat(F.coalesce("kinds.kind", F.array().cast("array<string>")), verdict).alias("items"))
        model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
        told = F.col("consequent")[0]
        found = model.associationRules.where(told.startswith("=") & ~F.exists("antecedent", lambda x: x.startswith("=")))
        found = found.select(F.array_sort("antecedent").alias("tokens"), F.substr(told, F.lit(2)).alias("verdict"), "confidence", "support")
    else:
        ranked = joined.select(F.coalesce("kinds.rank", F.array().cast("array<int>")).alias("ranks"), "verdict")
        combined = searched(ranked, support, confidence).withColumn("rank", F.explode("ranks"))
        named = combined.join(open_names.where("token = kind").select("rank", "kind"), "rank")
        found = named.groupBy("ranks", "verdict", "confidence", "support").agg(F.array_sort(F.collect_list("kind")).alias("tokens")).drop("ranks")
    mined = found.select("tokens", "verdict", F.round("confidence", 12).alias("confidence"), F.round("support", 12).alias("support"))
    rules = stored(mined.unionByName(whole).withColumn("rule_id", F.concat_ws(" ", "tokens", "verdict")), "mined")
    return stored(rules.join(_useless(rules), "rule_id", "left_anti"), "rules")


def matched(token_sets: DataFrame, rules: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """set_id, verdict of the best rule for each set that a rule fits. `token_sets`: set_id, tokens.

    With `names` (of `kinds`), sets are described by all their kinds.
    """
    if names is None:
        single = token_sets.select("set_id", F.explode("tokens").alias("token"))
    else:
        single = described(token_sets, names, "set_id").select("set_id", F.col("kind").alias("token"))
    index = rules.select(F.explode("tokens").alias("token"), "rule_id", F.size("tokens").alias("needed"), "verdict", "confidence", "support")
    looked_up = measured_join(single, index, "token")
    fits = looked_up.groupBy("set_id", "rule_id").agg(
        F.count("*").alias("found"), *(F.first(name).alias(name) for name in ("needed", "verdict", "confidence", "support"))
    ).where(F.col("found") == F.col("needed"))
    best = F.max(F.struct("confidence", "support", "needed", "verdict", "rule_id"))
    return fits.groupBy("set_id").agg(best.alias("best")).select("set_id", "best.verdict")


def judged(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of `pages`: id, host, path, rule, verdict, mined (whether a mined rule gave the verdict)."""
    rows = parsed(pages, rules, id_col, url_col)
    urls = rows.select("url", "host", "path", "known").distinct()
    sets = stored(urls.select("known.verdict", tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens")), "url-tokens")
    labelled = sets.where(F.col("verdict").isNotNull())
    open_sets = sets.where(F.col("verdict").isNull()).select("tokens").distinct()
    keyed = open_sets.withColumn("set_id", F.sha2(F.concat_ws("\n", "tokens"), 256))
    if labelled.isEmpty():
        verdicts = keyed.select("set_id", F.lit(DEFAULT).alias("verdict")).limit(0)
    else:
        names = kinds(labelled)
        verdicts = stored(matched(keyed, mine(labelled, names=names), names), "verdicts")
    mined = verdicts.select("set_id", F.col("verdict").alias("told"))
    with_set = rows.withColumn("set_id", F.sha2(F.concat_ws("\n", tokens(F.col("url"), F.col("host"), F.col("path"))), 256))
    return measured_join(with_set, mined, "set_id", "left").select(
        "id", "host", "path", "known.rule",
        F.coalesce("known.verdict", "told", F.lit(DEFAULT)).alias("verdict"),
        (F.col("known").isNull() & F.col("told").isNotNull()).alias("mined"),
    )
