"""URL filter: fixed host and path rules, and a tree of path templates per host that is judged by labelled URLs.

Segments that are numbers, dates, hashes and the like become typed wildcards row by row; what is left is folded into one
row per host and path before any tree work. Then the paths of every node go on to where they part, and the siblings there
that lead to the same kind of path are compared: those whose labels do not differ significantly from all of them
together, or that have none, become one wildcard. The others are put into tenths of their share of bad labels, and
neighbouring tenths that do not differ significantly are one branch. The same test goes for all children of all nodes. Every
template's share of bad labels is smoothed towards that of its host, and that towards the corpus. Everything runs on
DataFrame functions.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faremill.llm.store import saved

#: Host and path prefix, and the verdict of a URL on that host or a subdomain whose path starts so. The longest fits.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: Chance that any child of a node is told from the others though all have one share, and bins of the told ones.
FALSE_ODD, SHARE_BINS = 0.05, 10
#: Standard errors up to which the bad shares of neighbouring bins count as the same.
SIMILAR = 1.96
#: Labelled rows that the prior of a template weighs, and the purity below which a template is rejected.
PRIOR, PURITY = 8.0, 0.5

#: Typed wildcards, in the order they are tried, by pattern of a segment without its file extension.
TYPES = {
    "{num}": r"^[0-9]+$",
    "{date}": r"^[0-9]{4}-[0-9]{1,2}(-[0-9]{1,2})?$",
    "{uuid}": r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    "{hex}": r"^(?=.*[0-9])[0-9A-Fa-f]{8,}$",
    "{id}": r"^(?=.*[0-9]).{12,}$",
    "{long}": r"^.{33,}$",
}
_EXTENSION = r"\.[A-Za-z][A-Za-z0-9]{0,4}$"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for a null or a text without ``://``."""
    known = F.coalesce(url.contains("://"), F.lit(False))
    rest = F.substr(url, F.instr(url, "://") + 3)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    folded = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(known, folded).otherwise(""), F.when(known, path).otherwise("")


def rule_of(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        site, _, start = rule.partition("/")
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(f"/{start}")
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def segments(path: Column) -> Column:
    """The path's segments, variable ones as typed wildcards; empty segments are none."""

    def shape(segment: Column) -> Column:
        extension = F.regexp_extract(segment, _EXTENSION, 0)
        core = F.regexp_replace(segment, _EXTENSION, "")
        typed = None
        for name, pattern in TYPES.items():
            fits = core.rlike(pattern)
            typed = F.when(fits, F.lit(name)) if typed is None else typed.when(fits, F.lit(name))
        return F.concat(typed.otherwise(core), extension)

    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), shape)


def templates(paths: DataFrame) -> DataFrame:
    """host, shape and its final template, from (host, shape, n, labelled, bad) with one row per host and shape.

    The rounds follow the places where paths part, not their length: what all paths of a node have in common is passed
    in one step, and a path that is alone is done.
    """
    segs = F.when(F.col("shape") == "", F.array().cast("array<string>")).otherwise(F.split("shape", "/"))
    tree = saved(paths.select("*", F.lit("").alias("template"), segs.alias("rest")), "tree")
    done = []
    while True:
        done.append(tree.where(F.size("rest") == 0).select("host", "shape", "template"))
        tree = tree.where(F.size("rest") > 0)
        if tree.isEmpty():
            return reduce(DataFrame.union, done)
        tree = saved(_branched(_to_the_fork(tree)), "tree")


def _to_the_fork(tree: DataFrame) -> DataFrame:
    """``tree`` with the segments that all paths of a node begin with put to its template."""
    # The least and the greatest of some lists have in common what all of them have.
    ends = tree.groupBy("host", "template").agg(F.min("rest").alias("least"), F.max("rest").alias("most"))
    alike = F.transform(F.arrays_zip("least", "most"), lambda z: z["least"].eqNullSafe(z["most"]))
    other = F.array_position(alike, False)
    common = F.when(other > 0, other - 1).otherwise(F.size("least")).cast("int")
    ends = ends.select("host", "template", F.slice("least", 1, common).alias("common"))
    joined = tree.join(ends, ["host", "template"])
    passed = F.concat("template", F.array_join(F.transform("common", lambda s: F.concat(F.lit("/"), s)), ""))
    rest = F.slice("rest", F.size("common") + 1, F.greatest(F.size("rest") - F.size("common"), F.lit(0)))
    return joined.select("host", "shape", "n", "labelled", "bad", passed.alias("template"), rest.alias("rest"))


def _branched(tree: DataFrame) -> DataFrame:
    """``tree`` with the next segment of every path generalised and put to its template."""
    node = ["host", "template"]
    rows = tree.withColumn("child", F.get("rest", F.lit(0)))
    kinds = F.transform(F.slice("rest", 2, F.size("rest")), lambda s: F.when(s.startswith("{"), s).otherwise(F.lit("-")))
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
    # What mostly follows a child says what kind of branch it is.
    tails = rows.where("child IS NOT NULL").groupBy(*node, "child", F.array_join(kinds, "/").alias("tail")).agg(*sums)
    children = tails.groupBy(*node, "child").agg(*sums, F.max(F.struct("n", "tail")).alias("most"))
    children = saved(children.withColumn("tail", F.col("most.tail")).drop("most"), "children")
    kin = [*node, "tail"]
    pooled = children.groupBy(*kin).agg(
        ((F.sum("bad") + 0.5) / (F.sum("labelled") + 1)).alias("usual"), F.count_if(F.col("labelled") > 0).alias("tested")
    )
    # A child is odd where Chernoff's bound, which holds for few labels too, rules the share of all siblings out.
    own = F.col("bad") / F.greatest("labelled", F.lit(1))
    apiece = lambda x, usual: F.when(x > 0, x * F.log(F.greatest(x, F.lit(1e-300)) / usual)).otherwise(0.0)
    excess = F.col("labelled") * (apiece(own, F.col("usual")) + apiece(1 - own, 1 - F.col("usual")))
    odd = (F.col("labelled") > 0) & (excess > F.log(F.greatest(2 * F.col("tested") / FALSE_ODD, F.lit(1.0))))
    tenth = F.least(F.floor(own * SHARE_BINS), F.lit(SHARE_BINS - 1)).cast("int")
    judged = children.join(pooled, kin).select(*kin, "child", "labelled", "bad", F.when(odd, tenth).alias("tenth"))
    groups = judged.groupBy(*kin, "tenth").agg(*sums[1:], F.count("*").alias("children"))
    # At most SHARE_BINS rows of a kin, and one more for what is usual.
    line = Window.partitionBy(*kin, F.col("tenth").isNull()).orderBy("tenth")
    share, size = (F.col("bad") + 0.5) / (F.col("labelled") + 1), F.col("labelled") + 1
    before, count = F.lag(share).over(line), F.lag(size).over(line)
    whole = (share * size + before * count) / (size + count)
    apart = F.coalesce(share - before > SIMILAR * F.sqrt(whole * (1 - whole) * (1 / size + 1 / count)), F.lit(True))
    groups = groups.withColumn("begins", F.when(apart, F.col("tenth")))
    groups = groups.withColumn("branch", F.last("begins", ignorenulls=True).over(line))
    branch = Window.partitionBy(*kin, "branch")
    groups = groups.select(*kin, "tenth", "branch", F.sum("children").over(branch).alias("children"))
    groups = groups.select(*(F.col(c).alias(f"of_{c}") for c in (*kin, "tenth")), "branch", "children")
    same = [judged[c] == groups[f"of_{c}"] for c in kin] + [judged["tenth"].eqNullSafe(groups["of_tenth"])]
    wild = F.when(F.col("branch").isNull(), F.lit("{*}")).otherwise(F.concat(F.lit("{+"), F.col("branch").cast("string"), F.lit("}")))
    name = F.when(F.col("children") > 1, wild).otherwise(F.col("child"))
    names = judged.join(groups, reduce(and_, same)).select(*node, "child", name.alias("name"))
    grown = F.when(F.col("child").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), "name"))
    rest = F.slice("rest", 2, F.greatest(F.size("rest") - 1, F.lit(0)))
    joined = rows.join(names, [*node, "child"], "left")
    return joined.select("host", "shape", "n", "labelled", "bad", grown.alias("template"), rest.alias("rest"))


def purities(tree: DataFrame) -> DataFrame:
    """host, template and the smoothed share of good labels, from (host, template, labelled, bad)."""
    each = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    hosts = each.groupBy("host").agg(F.sum("labelled").alias("host_labelled"), F.sum("bad").alias("host_bad"))
    total = each.agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
    share = total.select((F.coalesce("b", F.lit(0)) + 1) / (F.coalesce("l", F.lit(0)) + 2)).scalar()
    hosts = hosts.withColumn("whole", share).withColumn(
        "host_share", (F.col("host_bad") + PRIOR * F.col("whole")) / (F.col("host_labelled") + PRIOR)
    )
    smoothed = (F.col("bad") + PRIOR * F.col("host_share")) / (F.col("labelled") + PRIOR)
    return each.join(hosts.select("host", "host_share"), "host").select("host", "template", (1 - smoothed).alias("purity"))


def judged(pages: DataFrame, labels: DataFrame, purity: float = PURITY, rules: dict[str, str] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity of every row of ``pages`` (page_id, url).

    ``labels`` has url_key and good (boolean); a URL's key is the number that ends its path. The verdict is the longest
    fitting rule's, else block where the template's smoothed purity is below ``purity``, else allow. A null
    or malformed URL has empty host and path and is judged as such. Repeated rows are judged each and count each. A
    key with several labels is bad if one of them is; null keys and labels are none. Other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    key = F.regexp_extract("path", r"([0-9]{1,18})(/|\.[A-Za-z]+)?$", 1)
    parsed = parsed.withColumn("url_key", F.when(key != "", key.cast("long")))
    parsed = parsed.withColumn("shape", F.array_join(segments(F.col("path")), "/"))
    known = labels.where("url_key IS NOT NULL AND good IS NOT NULL").groupBy("url_key")
    known = known.agg(F.max(F.expr("CAST(NOT good AS LONG)")).alias("bad"))
    parsed = saved(parsed.join(known, "url_key", "left").drop("url_key"), "parsed-urls")
    paths = parsed.groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    paths = saved(paths, "url-paths")
    tree = templates(paths)
    shares = purities(tree.join(paths, ["host", "shape"]))
    verdicts = tree.join(shares, ["host", "template"])
    rule = rule_of(F.col("host"), F.col("path"), rules)
    by_rule = None
    for name, verdict in rules.items():
        fits = F.col("rule") == name
        by_rule = F.when(fits, F.lit(verdict)) if by_rule is None else by_rule.when(fits, F.lit(verdict))
    own = F.when(F.col("purity") < purity, F.lit("block")).otherwise(F.lit("allow"))
    return (
        parsed.drop("bad")
        .withColumn("rule", rule)
        .join(verdicts, ["host", "shape"], "left")
        .select("page_id", "host", "path", "rule", F.coalesce(by_rule, own).alias("verdict"), "template", "purity")
    )
