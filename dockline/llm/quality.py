"""Quality rules with adaptive thresholds (DataFrame functions only).

Per document a few whole-text counts are taken. Their ratios go into
quantile sketches, one per (lang, source): counts per value bin, where a bin
keeps the seven leading bits of the value (relative error under 1/64, at most
a few thousand bins however many rows there are). Sketches are merged by adding
counts, so a source too small to speak for itself takes its language's
sketch, and a small language that of all rows. The sketch is deterministic:
the same rows give the same thresholds in any order of merging.

A ratio is out of line when it lies beyond ``q75 + FENCE * spread`` (word
length also below ``q25 - FENCE * spread``), spread being the interquartile
range of the group, and at least the ratio's ``MIN_SPREAD``, so that a group of
nearly equal clean documents doesn't reject its own small variations. Junk lies on one side: where it
reaches a quartile, that quartile counts as no farther from the median than the other one (or half of
``MIN_SPREAD``). So a group's fence holds with up to half of its rows junk.

Where the lower quartile and the median are equal (most documents have no symbol, no repeated line), the quartiles say
nothing of the group's spread. There the fence is at least ``top + REACH * (top - median)``, ``top`` being the highest of the
quantiles ``HIGH`` that lies within the fence of the quartiles: a tail that hangs together with the bulk widens it, one that lies
apart doesn't.

A group speaks for itself, however much it differs from the others: a source that writes more symbols, longer words or
repeated headings is judged by its own sketch. One case is excepted, a group that is mixed: its median lies beyond the fence of
its language, and is farther above the lower quartile than ``FENCE`` times the distance to the upper one, so most of the group
stands apart from a part that is like the others. Such a group is held to its language's fence, and a mixed language to that of all rows
(but for word length, in which languages differ). A source nearly all of whose rows have the same ratio isn't mixed: that is
its style, and the rule can't tell it from junk of a single kind.

Defined cases: null and blank texts have no words, so all counts are 0 and
the base rule fails; null ``lang`` or ``source`` form groups of their own; repeated
rows are judged row by row; an empty table gives an empty result; columns of
the input that aren't used are neither read nor touched.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common as C

MIN_WORDS = 50              # base rule
MAX_REPEAT_PCT = 50         # base rule
SYMBOLS = r"[#*$%&|<>]"
FENCE = 3
HIGH = (90, 95, 99)         # quantiles, in percent, that may widen a fence
REACH = 2
MIN_GROUP = 100             # documents a group needs for thresholds of its own
# smallest spread per ratio, in the ratio's unit
MIN_SPREAD = {"wlen": 30, "symbol": 50, "dup_line": 100, "repeat": 50, "upper": 50}
EDGES = ("lo", "hi", "up", "down")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _counts(docs: DataFrame, text: str, p: str) -> DataFrame:
    """``docs`` and the counts, each count's column prefixed with ``p``."""
    c = lambda n: F.col(p + n)
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn(p + "w", C.words(F.col(text)))
    df = df.withColumns({
        p + "n_words": F.size(c("w")).cast("long"),
        p + "word_chars": F.char_length(F.array_join(c("w"), "")).cast("long"),
        p + "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
        p + "n_upper": F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long"),
        p + "l": F.filter(F.split(t, "\n"), lambda x: x.rlike(C.HAS_WORD)),
        # hash of the window of three words that begins at each position
        p + "t": F.transform(
            F.slice(c("w"), F.lit(1), F.greatest(F.size(c("w")) - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get(c("w"), i + 1), F.get(c("w"), i + 2))),
    }).drop(p + "w")
    df = df.withColumns({
        p + "n_lines": F.size(c("l")).cast("long"),
        p + "n_dup_lines": (F.size(c("l")) - F.size(F.array_distinct(c("l")))).cast("long"),
        # windows with their positions, sorted so that equal ones meet; only where there are any
        p + "s": F.when(F.size(F.array_distinct(c("t"))) < F.size(c("t")),
                        F.sort_array(F.transform(c("t"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    }).drop(p + "l", p + "t")
    df = df.withColumn(p + "r", F.sort_array(F.transform(
        F.filter(c("s"), lambda x, j: (x["h"] == F.get(c("s"), j + 1)["h"])
                 | ((j > 0) & (x["h"] == F.get(c("s"), F.greatest(j - 1, F.lit(0)))["h"]))),
        lambda x: x["i"]))).drop(p + "s")
    # each repeated window adds the words up to the next one's start, three at most
    adds = F.transform(c("r"), lambda x, j: F.least(F.lit(3), F.coalesce(F.get(c("r"), j + 1) - x, F.lit(3))))
    total = F.coalesce(F.aggregate(adds, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))), F.lit(0))
    return df.withColumn(p + "n_repeat_words", total.cast("long")).drop(p + "r")


def measure(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the counts and ``base_failed``, all named ``prefix`` + name."""
    p = prefix
    df = _counts(docs, text, p)
    return df.withColumn(p + "base_failed", (F.col(p + "n_words") < MIN_WORDS)
                         | (100 * F.col(p + "n_repeat_words") > MAX_REPEAT_PCT * F.col(p + "n_words")))


def ratios(p: str = "") -> dict:
    """Integer ratios: hundredths for the word length, else thousandths."""
    c = lambda n: F.col(p + n)
    per = lambda a, b, k: F.when(c(b) > 0, F.floor(c(a) * k / c(b)).cast("long")).otherwise(F.lit(0))
    return {"wlen": per("word_chars", "n_words", 100), "symbol": per("n_symbols", "n_words", 1000),
            "dup_line": per("n_dup_lines", "n_lines", 1000), "repeat": per("n_repeat_words", "n_words", 1000),
            "upper": per("n_upper", "word_chars", 1000)}


def sketch(measured: DataFrame, p: str = "", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, ratio, bin, n): one quantile sketch per group and ratio, of
    the rows that pass the base rule."""
    rows = measured.filter(~F.col(p + "base_failed")).select(
        F.col(lang).alias("lang"), F.col(source).alias("source"),
        F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), v.alias("v")) for k, v in ratios(p).items()])).alias("x"))
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(F.col("x.v"))) - 7, F.lit(0)))
    return (rows.select("lang", "source", F.col("x.ratio").alias("ratio"), (F.col("x.v") - F.col("x.v") % unit).alias("bin"))
            .groupBy("lang", "source", "ratio", "bin").agg(F.count("*").alias("n")))


def merge(sketches: DataFrame, *keys: str) -> DataFrame:
    """Sketches of coarser groups: the counts of their parts added up."""
    return sketches.groupBy(*keys, "ratio", "bin").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, *keys: str) -> DataFrame:
    """Per group and ratio n_docs, the fence ``lo`` and ``hi``; ``up`` is the median if most of the group stands
    apart above a part of it, ``down`` if below, else null.
    The windows run over the bins of a sketch, a bounded number."""
    g = W.partitionBy(*keys, "ratio")
    cum = sketches.withColumns({"cum": F.sum("n").over(g.orderBy("bin")), "total": F.sum("n").over(g)})
    at = lambda pct: F.min(F.when(100 * F.col("cum") >= pct * F.col("total"), F.col("bin"))).alias(f"q{pct}")
    q = cum.groupBy(*keys, "ratio").agg(F.max("total").alias("n_docs"), *[at(pct) for pct in (25, 50, 75, *HIGH)])
    least = F.coalesce(*[F.when(F.col("ratio") == k, F.lit(v)) for k, v in MIN_SPREAD.items()])
    half = F.floor(least / 2).cast("long")
    below, above = F.col("q50") - F.col("q25"), F.col("q75") - F.col("q50")
    q = q.withColumns({
        "up": F.when(below > FENCE * F.greatest(above, least), F.col("q50")),
        "down": F.when(above > FENCE * F.greatest(below, least), F.col("q50")),
        "one_sided": below == 0,
        "q25": F.greatest("q25", F.col("q50") - F.greatest(above, half)),
        "q75": F.least("q75", F.col("q50") + F.greatest(below, half))})
    spread = F.greatest(F.col("q75") - F.col("q25"), least)
    q = q.withColumns({"lo": F.col("q25") - FENCE * spread, "hi": F.col("q75") + FENCE * spread})
    tops = [F.when(F.col("one_sided") & (F.col(f"q{pct}") <= F.col("hi")), F.col(f"q{pct}")) for pct in HIGH]
    q = q.withColumn("hi", F.greatest("hi", *[t + REACH * (t - F.col("q50")) for t in tops]))      # nulls don't count
    return q.select(*keys, "ratio", "n_docs", *EDGES)


def thresholds(sketches: DataFrame) -> DataFrame:
    """(lang, source, t_lo_*, t_hi_*) for every group met, taken from the finest of
    (lang, source), lang, all that has ``MIN_GROUP`` documents and isn't mixed, else from all."""
    named = lambda df, p: df.select(*[F.col(c).alias(p + c) for c in df.columns])
    by_lang = named(fences(merge(sketches, "lang"), "lang"), "l_")
    df = fences(sketches, "lang", "source").join(
        by_lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("ratio") == F.col("l_ratio")), "left")
    df = df.join(F.broadcast(named(fences(merge(sketches)), "a_")), F.col("ratio") == F.col("a_ratio"), "left")   # a row per ratio

    def own(p: str, side: str, coarser: str):
        """The fence of a level, unless the group is mixed on that side."""
        mixed = F.col(p + "up") > F.col(coarser) if side == "hi" else F.col(p + "down") < F.col(coarser)
        return F.when(F.coalesce(mixed, F.lit(False)), F.col(coarser)).otherwise(F.col(p + side))
    for side in ("lo", "hi"):
        lang = F.when(F.col("ratio") == "wlen", F.col("l_" + side)).otherwise(own("l_", side, "a_" + side))
        df = df.withColumn("b_" + side, F.when(F.col("l_n_docs") >= MIN_GROUP, lang).otherwise(F.col("a_" + side)))
        df = df.withColumn("t_" + side, F.when(F.col("n_docs") >= MIN_GROUP, own("", side, "b_" + side)).otherwise(F.col("b_" + side)))
    one = lambda side, k: F.max(F.when(F.col("ratio") == k, F.col("t_" + side))).alias(f"t_{side}_{k}")
    return df.groupBy("lang", "source").agg(*[one(side, k) for k in MIN_SPREAD for side in ("lo", "hi")])


def judge(measured: DataFrame, edges: DataFrame, p: str = "", lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` with the boolean column ``prefix + kept``: rows that pass the
    base rule and whose ratios all lie within their group's fences."""
    t = edges.select(*[F.col(c).alias(f"{p}__{c}") for c in edges.columns])
    df = measured.join(t, F.col(lang).eqNullSafe(F.col(f"{p}__lang")) & F.col(source).eqNullSafe(F.col(f"{p}__source")), "left")
    r = ratios(p)
    inside = F.lit(True)
    for k, v in r.items():
        inside = inside & (v <= F.col(f"{p}__t_hi_{k}"))
    inside = inside & (r["wlen"] >= F.col(f"{p}__t_lo_wlen"))
    return (df.withColumn(p + "kept", F.coalesce(~F.col(p + "base_failed") & inside, F.lit(False)))
            .drop(*t.columns))


def rules(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, source, the counts, base_failed and kept."""
    m = C.materialize(measure(docs.select("doc_id", "lang", "source", "text")).drop("text"), "quality")
    return judge(m, thresholds(sketch(m))).select("doc_id", "lang", "source", *COUNTS, "base_failed", "kept")


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns. The
    measured documents are written once; the sketch reads only the counts."""
    p = C.own(docs, [], "q9")
    m = C.materialize(measure(docs, prefix=p + "_"), "quality-docs")
    return judge(m, thresholds(sketch(m, p + "_")), p + "_").filter(F.col(f"{p}_kept")).select(*docs.columns)


ORACLE = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
c AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
w3 AS (SELECT rid, i, w[i] AS a, w[i+1] AS b, w[i+2] AS c
       FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM c WHERE len(w) >= 3)),
w3c AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS k FROM w3),
rw AS (SELECT rid, count(*) AS n_repeat_words FROM (
         SELECT DISTINCT rid, i + o AS p FROM w3c, (SELECT unnest([0, 1, 2]) AS o) WHERE k >= 2) GROUP BY rid),
m AS (SELECT c.rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(regexp_extract_all(t, '\p{Lu}')) AS BIGINT) AS n_upper,
             CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM c LEFT JOIN rw ON c.rid = rw.rid),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
             CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS wlen,
             CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS symbol,
             CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_line,
             CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeat,
             CASE WHEN word_chars > 0 THEN 1000 * n_upper // word_chars ELSE 0 END AS upper FROM m),
r AS (SELECT lang, source, unnest(['wlen', 'symbol', 'dup_line', 'repeat', 'upper']) AS ratio,
             unnest([wlen, symbol, dup_line, repeat, upper]) AS v FROM b WHERE NOT base_failed),
s AS (SELECT lang, source, ratio, v - v % (1::BIGINT << greatest(length(bin(v)) - 7, 0)) AS bin FROM r),
g AS (SELECT 1 AS lev, lang, source, ratio, bin FROM s UNION ALL SELECT 2, lang, NULL, ratio, bin FROM s
      UNION ALL SELECT 3, NULL, NULL, ratio, bin FROM s),
k AS (SELECT lev, lang, source, ratio, bin, count(*) AS n FROM g GROUP BY ALL),
cu AS (SELECT *, sum(n) OVER (PARTITION BY lev, lang, source, ratio ORDER BY bin) AS cum,
              sum(n) OVER (PARTITION BY lev, lang, source, ratio) AS total FROM k),
q AS (SELECT lev, lang, source, ratio, max(total) AS n_docs, min(bin) FILTER (100 * cum >= 25 * total) AS q25,
             min(bin) FILTER (100 * cum >= 50 * total) AS q50, min(bin) FILTER (100 * cum >= 75 * total) AS q75,
             min(bin) FILTER (100 * cum >= 90 * total) AS q90, min(bin) FILTER (100 * cum >= 95 * total) AS q95,
             min(bin) FILTER (100 * cum >= 99 * total) AS q99,
             CASE ratio WHEN 'wlen' THEN 30 WHEN 'dup_line' THEN 100 ELSE 50 END AS margin FROM cu GROUP BY ALL),
q2 AS (SELECT *, q50 - q25 > 3 * greatest(q75 - q50, margin) AS apart_above, q75 - q50 > 3 * greatest(q50 - q25, margin) AS apart_below,
              greatest(q25, q50 - greatest(q75 - q50, margin // 2)) AS a25, least(q75, q50 + greatest(q50 - q25, margin // 2)) AS a75
       FROM q),
f0 AS (SELECT *, a25 - 3 * greatest(a75 - a25, margin) AS lo, a75 + 3 * greatest(a75 - a25, margin) AS hi0 FROM q2),
f AS (SELECT *, CASE WHEN q25 < q50 THEN hi0 WHEN q99 <= hi0 THEN greatest(hi0, 3 * q99 - 2 * q50)
                     WHEN q95 <= hi0 THEN greatest(hi0, 3 * q95 - 2 * q50) WHEN q90 <= hi0 THEN greatest(hi0, 3 * q90 - 2 * q50)
                     ELSE hi0 END AS hi FROM f0),
l AS (SELECT l.lang, l.ratio,
             CASE WHEN l.n_docs < 100 OR (l.ratio <> 'wlen' AND l.apart_above AND l.q50 > w.hi) THEN w.hi ELSE l.hi END AS hi,
             CASE WHEN l.n_docs < 100 OR (l.ratio <> 'wlen' AND l.apart_below AND l.q50 < w.lo) THEN w.lo ELSE l.lo END AS lo
      FROM (SELECT * FROM f WHERE lev = 2) l JOIN (SELECT * FROM f WHERE lev = 3) w ON l.ratio = w.ratio),
e AS (SELECT a.lang, a.source, a.ratio,
             CASE WHEN a.n_docs < 100 OR (a.apart_above AND a.q50 > l.hi) THEN l.hi ELSE a.hi END AS hi,
             CASE WHEN a.n_docs < 100 OR (a.apart_below AND a.q50 < l.lo) THEN l.lo ELSE a.lo END AS lo
      FROM (SELECT * FROM f WHERE lev = 1) a JOIN l ON a.lang IS NOT DISTINCT FROM l.lang AND a.ratio = l.ratio),
x AS (SELECT rid, bool_and(v.val <= e.hi AND (v.ratio <> 'wlen' OR v.val >= e.lo)) AS ok
      FROM (SELECT rid, lang, source, unnest(['wlen', 'symbol', 'dup_line', 'repeat', 'upper']) AS ratio,
                   unnest([wlen, symbol, dup_line, repeat, upper]) AS val FROM b WHERE NOT base_failed) v
      JOIN e ON v.lang IS NOT DISTINCT FROM e.lang AND v.source IS NOT DISTINCT FROM e.source AND v.ratio = e.ratio
      GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND coalesce(ok, false)) AS kept
FROM b LEFT JOIN x ON b.rid = x.rid
"""
