"""URL filter rules by a sort-merge range join. DataFrame functions only.

A rule (host, path, verdict) fits its host and all subdomains where the url's path starts
with the rule's path. The longest rule (characters of host and path, then of the host) wins.

A host is turned round label by label, each label closed by a dot, so ``example.com`` with all its
subdomains is the interval of the keys that start with ``com.example.``. Inside one rule host, a
rule path is the interval of the paths that start with it. Such intervals nest or
are apart, so both dimensions are one and the same sweep (``sweep``):

* interval starts, interval ends (the prefix closed by byte FF, which no UTF-8 text holds)
  and points are put in key order by a range partitioning, ties apart by a row number, so
  that one url in a third of all rows still spreads over many ranges;
* the running sum of starts less ends is the height of the stack of active intervals;
* entry ``i`` of the stack is the last interval that started at height ``i``; what earlier ranges
  leave on the stack comes from one row per range and height.

The first sweep gives each url the stack of rule hosts above it, the second sweep, over (rule host,
path), the topmost rule of each; the longest of these few is the url's rule.

Defined cases: a null url, or one without ``://``, has an empty host and path, which no rule fits; a
port or user name is part of the host; equal rows are judged one by one; rules with a null host,
path or verdict or an empty host are ignored, any verdict but ``block`` allows, of two equal rules with
both verdicts ``block`` holds; without rules every url gets ``default``; an empty table gives no rows; other columns
of the pages are not read (``keep`` returns them as they are).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common as C

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT = "allow"
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
RULE_SCHEMA = "host string, path string, verdict string"


def rest(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    return F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(rest(url), r"^[^/?#]*([^?#]*)", 1)


def turned(host: Column) -> Column:
    """``www.example.com`` as ``com.example.www.``, bytes."""
    return F.encode(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")), "UTF-8")


def end() -> Column:
    return F.unhex(F.lit("FF"))


def sweep(points: DataFrame, intervals: DataFrame, whole: bool, name: str) -> DataFrame:
    """``points`` (key binary, more) with ``height``, the number of active intervals, and ``iid``: for ``whole``
    one row per entry of the stack, lowest first (``level``), else the topmost entry only. Points
    under no interval keep one row with null. ``intervals``: iid, prefix (binary, distinct)."""
    rid = "_rid"
    more = [c for c in points.columns if c != "key"]
    blank = [F.lit(None).cast(points.schema[c].dataType).alias(c) for c in more]
    starts = intervals.select(F.col("prefix").alias("key"), F.lit(1).alias("move"), "iid", *blank)
    ends = intervals.select(F.concat("prefix", end()).alias("key"), F.lit(-1).alias("move"), F.lit(None).cast("string").alias("iid"), *blank)
    marks = points.select("key", F.lit(0).alias("move"), F.lit(None).cast("string").alias("iid"), *more)
    # a start comes before the points at its key: kind 0 before kind 1
    rows = (marks.unionByName(starts).unionByName(ends).withColumn("kind", F.when(F.col("move") == 0, 1).otherwise(0))
            .withColumn(rid, F.monotonically_increasing_id()))
    order = ["key", "kind", rid]
    ranged = C.materialize(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), name)

    inside = W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    rise = ranged.withColumn("rise", F.sum("move").over(inside))
    # one row per range: at most as many as the shuffle has partitions
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = ranged.groupBy("part").agg(F.sum("move").alias("net")).select("part", F.coalesce(F.sum("net").over(before), F.lit(0)).alias("base"))
    base = C.materialize(base, name + "-heights")
    high = rise.join(base, "part").withColumn("height", (F.col("rise") + F.col("base")).cast("int")).drop("rise", "base")
    high = C.materialize(high, name + "-stack")
    # the last start at each height, by range, and what each range inherits of it
    begun = high.filter("move = 1")
    lasts = begun.groupBy("part", F.col("height").alias("level")).agg(F.max_by("iid", F.struct("key", rid)).alias("last"))
    deep = begun.agg(F.max("height")).first()[0] or 0
    if not deep:
        return points.withColumns({"height": F.lit(0), "level": F.lit(None).cast("int"), "iid": F.lit(None).cast("string")})
    grid = base.select("part", F.explode(F.sequence(F.lit(1), F.lit(deep))).alias("level"))
    earlier = W.partitionBy("level").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carry = (grid.join(lasts, ["part", "level"], "left")
             .select("part", "level", F.last("last", ignorenulls=True).over(earlier).alias("carried")))
    carry = C.materialize(carry, name + "-carry")

    level = F.when(F.col("move") == 1, F.array("height"))
    stack = F.sequence(F.lit(1), F.col("height")) if whole else F.array("height")
    level = level.when(F.col("height") > 0, stack)          # ends and points at height 0 drop out here
    entry = high.filter("move >= 0").withColumn("level", F.explode_outer(level))
    tops = W.partitionBy("part", "level").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = entry.withColumn("seen", F.last(F.when(F.col("move") == 1, F.col("iid")), ignorenulls=True).over(tops))
    hit = seen.filter("move = 0").join(carry, ["part", "level"], "left")
    top = F.when(F.col("level").isNotNull(), F.coalesce("seen", "carried"))
    return hit.select("key", *more, "height", "level", top.alias("iid"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", keys: tuple = ("page_id",), default: str = DEFAULT) -> DataFrame:
    """``keys``, host, path, rule (host and path in one, or null) and verdict of every row."""
    names = {k: f"k_{i}" for i, k in enumerate(keys)}
    good = (rules.filter("host <> '' AND path IS NOT NULL AND verdict IS NOT NULL")
            .groupBy(F.translate("host", UPPER, LOWER).alias("host"), "path")
            .agg(F.max(F.when(F.col("verdict") == "block", "block").otherwise("allow")).alias("verdict"))
            .withColumn("hkey", turned(F.col("host"))))
    good = C.materialize(good, "url-rules")
    seen = pages.select(F.monotonically_increasing_id().alias("row"), *[F.col(k).alias(n) for k, n in names.items()],
                        host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    seen = C.materialize(seen, "url-pages")
    cols = ["row", *names.values(), "host", "path"]

    hosts = good.select(F.hex("hkey").alias("iid"), F.col("hkey").alias("prefix")).distinct()
    under = sweep(seen.withColumn("key", turned(F.col("host"))), hosts, True, "url-hosts")
    under = C.materialize(under.select(*cols, F.unhex("iid").alias("hkey")), "url-under")

    paths = good.select(F.to_json(F.struct("host", "path", "verdict")).alias("iid"),
                        F.concat("hkey", end(), F.encode("path", "UTF-8")).alias("prefix"))
    asked = under.filter("hkey IS NOT NULL")
    found = sweep(asked.withColumn("key", F.concat("hkey", end(), F.encode("path", "UTF-8"))).drop("hkey"), paths, False, "url-paths")
    found = found.withColumn("r", F.from_json("iid", RULE_SCHEMA))
    size = F.when(F.col("iid").isNotNull(), F.struct(F.char_length("r.host") + F.char_length("r.path"), F.char_length("r.host")))
    found = (found.select(*cols, size.alias("size"), F.concat("r.host", "r.path").alias("rule"), F.col("r.verdict").alias("verdict"))
             .groupBy(*cols).agg(F.max(F.struct("size", "rule", "verdict")).alias("best"))
             .select(*cols, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict")))
    free = under.filter("hkey IS NULL").select(*cols, F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    out = found.unionByName(free)
    return out.select(*[F.col(n).alias(k) for k, n in names.items()], "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def keep(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """The rows of ``pages`` whose url is not blocked, all columns as they are; each distinct url is judged once."""
    mark = C.own(pages, [], "blocked_url")
    urls = pages.select(F.col(url)).distinct()
    bad = judge(urls, rules, url, (url,), default).filter("verdict = 'block'").select(F.col(url).alias(mark))
    return pages.join(bad, pages[url].eqNullSafe(bad[mark]), "left_anti")


def fixed_rules(spark) -> DataFrame:
    return spark.createDataFrame(RULES, RULE_SCHEMA)


ORACLE = f"""
WITH r AS (SELECT * FROM (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}) t(rhost, rpath, rverdict)),
u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT row_number() OVER () AS n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT page_id, host, path, rhost || rpath AS rule, coalesce(rverdict, '{DEFAULT}') AS verdict
FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(rhost) + length(rpath) DESC, length(rhost) DESC) = 1
"""
