"""Line dedup by an exact set-similarity join (DataFrame functions only).

A line is the set of its words. A line goes if an earlier one (smaller
doc_id, or higher up in its own document) has a Jaccard similarity of ``THRESHOLD`` or
more, judged on the input, whether or not the earlier one goes itself.

1. Words become numbers whose top bits are a rarity level: words are
   counted in ``2 ** BUCKET_BITS`` hashed buckets, whatever the size of the vocabulary, and
   the level of a bucket is the binary logarithm of its count. The table of levels
   (a number per bucket) is the only thing that leaves Spark, and comes back as a literal.
   Sorted numbers are the words by rarity; a rough order costs time, never a result.
2. Lines with equal sets are one set from here on; its later lines go. Sets are numbered
   in the order of their first lines.
3. Prefix filter: two sets that similar share one of their first ``n - ceil(THRESHOLD n) + 1``
   numbers. Length and position filters are part of the join's condition, and so is a bitmap
   filter: each word flips one of 64 bits, and sets that differ in k words differ in k bits
   at most. Sets of over ``WIDE`` words, which fill 64 bits, carry 128 more.
4. Each set is first compared with the earliest set that has each of its prefix words.
   That settles most: a set needs one earlier match only, so a group of near copies costs
   comparisons as its size, not as its square.
5. Sets still undecided are joined with all earlier sets by prefix, and verified. That join runs in ``SLICES``
   parts, each over all sets and its share of the prefix words, so that disk holds the shuffle of one part only; both
   sides of a part are one shuffle.

Only prefixes are shuffled. The words of a line are taken from its document again when
one of its pairs is verified. Tables go as soon as nothing reads them again.

Defined cases: a line without words stays and matches nothing; null texts stay null; a document
all of whose words go keeps an empty text; null doc_ids come last in order; rows equal in
doc_id are ordered by a hash of their text and count as documents of their own, but equal
rows are one document; an empty table gives an empty result; other columns are kept as they are.
"""
from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

THRESHOLD = 0.8
BUCKET_BITS = 16
HASH_BITS = 57
WIDE = 64
SLICES = 4


def _need(n: Column) -> Column:
    """Words a match of a set of n must share with it, at least: ceil(THRESHOLD n)."""
    return F.floor((n * 4 + 4) / 5)


def _key(docs: DataFrame) -> list[Column]:
    return [F.coalesce(F.col("doc_id"), F.lit(2 ** 63 - 1)).alias("d"), F.xxhash64("text").alias("t")]


def _set(line: Column) -> Column:
    """The distinct word hashes of a line."""
    mask = F.lit((1 << HASH_BITS) - 1)
    return F.array_distinct(F.transform(C.words(line), lambda x: F.xxhash64(x).bitwiseAND(mask)))


def lines(texts: DataFrame) -> DataFrame:
    """(d, t, i, w): document, line number from 0, distinct word hashes of each line with a word."""
    one = texts.select("d", "t", F.posexplode(F.split(F.col("text"), "\n")).alias("i", "line")).filter(F.col("line").rlike(C.HAS_WORD))
    return one.select("d", "t", "i", _set(F.col("line")).alias("w"))


def line_sets(texts: DataFrame, at: DataFrame) -> DataFrame:
    """(id, w, m, n): the word hashes of the lines that ``at`` (id, d, t, i) names, and of no others, their bitmap and number."""
    of = at.groupBy("d", "t").agg(F.collect_list(F.struct("i", "id")).alias("of"))     # lines of one document
    of = C.materialize(of, "line-wanted")                                              # its size decides how it is joined
    named = texts.join(of, ["d", "t"]).select("of", F.split("text", "\n").alias("l"))
    one = named.select(F.explode(F.transform("of", lambda o: F.struct(o["id"].alias("id"), F.get(F.col("l"), o["i"]).alias("line")))).alias("o"))
    w = one.select("o.id", _set(F.col("o.line")).alias("w")).dropDuplicates(["id"])
    w = C.materialize(w.withColumn("m", _mask(8)).withColumn("n", F.size("w")), "line-words")
    C.discard(of)
    return w


def levels(texts: DataFrame) -> list[int]:
    """The rarity level of every bucket of word hashes."""
    size = 1 << BUCKET_BITS
    rows = (texts.select(F.explode(C.words(F.col("text"))).alias("x")).groupBy(F.xxhash64("x").bitwiseAND(F.lit(size - 1)).alias("b"))
            .agg(F.floor(F.log2(F.count("*"))).cast("int").alias("level")).collect())
    out = [0] * size
    for r in rows:
        out[r.b] = r.level
    return out


def _mask(longs: int) -> Column:
    """Parity bitmap of the set ``w``, 64 bits a long: two bitmaps differ in at most as many bits as the sets in words."""
    return F.expr(f"transform(sequence(0, {longs - 1}), j -> aggregate(w, 0L, (a, x) -> "
                  f"if((shiftright(x, 30) & {longs - 1}) = j, a ^ shiftleft(1L, cast(shiftright(x, 24) & 63 as int)), a)))")


def prefixes(texts: DataFrame, table: list[int]) -> DataFrame:
    """(d, t, i, n, k1, k2, b, m0, m1, p): per line the size, key and bitmaps of its set, and its prefix, rarest words first.

    ``m0`` and ``m1`` are null for sets of up to ``WIDE`` words. The prefix holds 32-bit hashes: words that share one
    cost a comparison, never a result."""
    level = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")

    def number(x):
        at = x.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)).cast("int")
        return F.shiftleft(F.get(level, at).cast("long"), HASH_BITS).bitwiseOR(x)
    n = F.size("w")
    bits = F.expr("aggregate(w, 0L, (a, x) -> a ^ shiftleft(1L, cast(shiftright(x, 24) & 63 as int)))")
    return (lines(texts).withColumn("w", F.sort_array(F.transform("w", number)))
            .withColumn("m", F.when(n > WIDE, _mask(2)))
            .select("d", "t", "i", n.alias("n"), F.xxhash64("w").alias("k1"), F.xxhash64(F.lit(1), F.col("w")).alias("k2"),
                    bits.alias("b"), F.get("m", F.lit(0)).alias("m0"), F.get("m", F.lit(1)).alias("m1"),
                    F.transform(F.slice("w", F.lit(1), (n - _need(n) + 1).cast("int")), lambda x: F.hash(x)).alias("p")))


def _fits(x: str, y: str) -> Column:
    """Length, position and bitmap filters for the postings ``x`` and ``y``: what can still be shared suffices."""
    c = lambda s, k: F.col(f"{s}.{k}")
    n1, n2 = c(x, "n"), c(y, "n")
    return ((9 * F.bit_count(c(x, "b").bitwiseXOR(c(y, "b"))) <= n1 + n2) & (5 * n1 >= 4 * n2) & (5 * n2 >= 4 * n1)
            & (9 * F.least(n1 - c(x, "p"), n2 - c(y, "p")) >= 4 * (n1 + n2)))


def _verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(id) of the pairs (id, other) that are similar; the words come from the documents of the lines named. A long line fills
    the bitmap of the postings, so wider ones go first: word sets are shuffled for pairs that pass these only."""
    ids = pairs.select(F.explode(F.array("id", "other")).alias("id")).distinct()
    w = line_sets(texts, sets.select("id", "at.*").join(ids, "id"))
    side = lambda i, *cols: w.select(F.col("id").alias(i), *[F.col(c).alias(c + ("1" if i == "id" else "2")) for c in cols])
    apart = F.aggregate(F.zip_with("m1", "m2", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda a, x: a + x)
    near = pairs.join(side("id", "m", "n"), "id").join(side("other", "m", "n"), "other").filter(9 * apart <= F.col("n1") + F.col("n2"))
    near = C.materialize(near.select("id", "other"), "line-near")
    both = near.join(side("id", "w"), "id").join(side("other", "w"), "other").withColumn("c", F.size(F.array_intersect("w1", "w2")))
    done = C.materialize(both.filter(9 * F.col("c") >= 4 * (F.size("w1") + F.size("w2"))).select("id").distinct(), "line-done")
    C.discard(w, near)
    return done


def matched(docs: DataFrame) -> DataFrame:
    """(d, t, i) of the lines that have an earlier match."""
    texts = docs.select(*_key(docs), "text")
    each = C.materialize(prefixes(texts, levels(texts)), "line-prefixes")
    # one row per set, with the line it first occurs on; equal lines have equal n, b and p
    sets = each.groupBy("k1", "k2").agg(
        F.min(F.struct("d", "t", "i")).alias("at"), F.count("*").alias("lines"), *[F.any_value(k).alias(k) for k in ("n", "b", "m0", "m1", "p")])
    sets = C.materialize(sets.sort("at").withColumn("id", F.monotonically_increasing_id()), "line-sets")

    post = sets.select("id", "n", "b", F.posexplode("p").alias("p", "x"))
    early = (post.groupBy("x").agg(F.count("*").alias("sets"), F.min(F.struct("id", "n", "b", "p")).alias("e"))
             .filter("sets > 1").select("x", "e.*"))
    early = C.materialize(early, "line-earliest")
    x, y = post.alias("x"), early.alias("y")
    found = lambda x, y: (x.join(y, (F.col("x.x") == F.col("y.x")) & (F.col("y.id") < F.col("x.id")) & _fits("x", "y"))
                          .select(F.col("x.id").alias("id"), F.col("y.id").alias("other")).distinct())
    easy = C.materialize(found(x, y), "line-pairs")
    C.discard(early)
    done = _verified(easy, sets, texts)

    # a set that is done meets no earlier ones, but later ones meet it: s is its number, less than 0 if it is done. Both sides
    # have the same columns and rows (the join would ask for an s in one of them only), so that one shuffle serves both
    todo = sets.join(done.select("id", F.lit(True).alias("done")), "id", "left")
    todo = todo.select(F.when(F.col("done").isNull(), F.col("id")).otherwise(-1 - F.col("id")).alias("s"), "n", "b", "m0", "m1", "p")
    todo = C.materialize(todo, "line-open")
    x, y = F.col("x.x"), F.col("y.x")
    other = F.greatest(F.col("y.s"), -1 - F.col("y.s"))
    apart = sum(F.bit_count(F.col(f"x.{m}").bitwiseXOR(F.col(f"y.{m}"))) for m in ("m0", "m1"))
    wide = 9 * F.coalesce(apart, F.lit(0)) <= F.col("x.n") + F.col("y.n")
    parts = []
    for k in range(SLICES):
        post = todo.select("s", "n", "b", "m0", "m1", F.posexplode("p").alias("p", "x")).filter((F.pmod("x", F.lit(SLICES)) == k) & F.col("s").isNotNull())
        meet = post.alias("x").join(post.alias("y"), (x == y) & (other < F.col("x.s")) & _fits("x", "y") & wide)
        parts.append(C.materialize(meet.select(F.col("x.s").alias("id"), other.alias("other")).distinct(), "line-part"))
    C.discard(todo)
    hard = functools.reduce(DataFrame.union, parts).distinct()
    hard = C.materialize(hard.join(easy, ["id", "other"], "left_anti"), "line-pairs")
    more = _verified(hard, sets, texts)
    near = sets.select("id", "at.*").join(done.union(more), "id").select("d", "t", "i")
    # lines with a set met before; equal rows repeat the first line itself, which stays
    first = sets.filter("lines > 1").select(F.col("k1").alias("f1"), F.col("k2").alias("f2"), "at")
    same = (each.select("k1", "k2", "d", "t", "i").join(first, (F.col("k1") == F.col("f1")) & (F.col("k2") == F.col("f2")))
            .filter(F.struct("d", "t", "i") != F.col("at")).select("d", "t", "i"))
    out = C.materialize(near.union(same).distinct(), "line-matches")
    C.discard(each, sets, easy, done, hard, more, *parts)
    return out


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with the text that is left, and ``n_lines`` and ``n_removed`` as further columns."""
    names = {k: C.own(docs, [], k) for k in ("_d", "_t", "_gone", "n_lines", "n_removed")}
    gone = matched(docs.select("doc_id", "text")).groupBy(F.col("d").alias(names["_d"]), F.col("t").alias(names["_t"])).agg(
        F.array_sort(F.collect_list("i")).alias(names["_gone"]))
    d, t = _key(docs)
    g = F.col(names["_gone"])
    df = docs.join(gone, (d == F.col(names["_d"])) & (t == F.col(names["_t"])), "left")
    left = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(g, i))
    text = F.when(F.size(g) > 0, F.array_join(left, "\n")).otherwise(F.col("text"))
    return df.select(*[text.alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns],
                     F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias(names["n_lines"]),
                     F.greatest(F.coalesce(F.size(g), F.lit(0)), F.lit(0)).alias(names["n_removed"]))


def remove_lines(docs: DataFrame) -> DataFrame:
    """``docs``, same columns, without the matched lines (``n_chars`` follows); documents that lose their last word go."""
    out = dedup(docs)
    lost = (F.col(out.columns[-1]) > 0) & ~F.col("text").rlike(C.HAS_WORD)
    out = out.filter(~F.coalesce(lost, F.lit(False)))
    if "n_chars" in docs.columns:
        changed = F.col(out.columns[-1]) > 0
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


ORACLE = r"""
WITH l AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
  FROM documents),
s AS (SELECT doc_id, i, list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS w
      FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
f AS (SELECT w, min({'d': doc_id, 'i': i}) AS pos FROM s GROUP BY w),
o AS (SELECT w, pos, row_number() OVER () AS id, len(w) AS n FROM f),
tok AS (SELECT id, n, pos, unnest(w) AS x FROM o),
df AS (SELECT x, count(*) AS k FROM tok GROUP BY x),
ord AS (SELECT id, n, pos, tok.x, row_number() OVER (PARTITION BY id ORDER BY k, tok.x) AS p FROM tok JOIN df ON tok.x = df.x),
pre AS (SELECT * FROM ord WHERE p <= n - (n * 4 + 4) // 5 + 1),
c AS (SELECT DISTINCT a.id AS a, b.id AS b FROM pre a JOIN pre b ON a.x = b.x AND b.pos < a.pos
        AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
v AS (SELECT DISTINCT c.a FROM c JOIN o x ON x.id = c.a JOIN o y ON y.id = c.b
      WHERE 9 * len(list_intersect(x.w, y.w)) >= 4 * (x.n + y.n)),
gone AS (SELECT pos.d AS doc_id, pos.i AS i FROM o WHERE id IN (SELECT a FROM v)
         UNION SELECT s.doc_id, s.i FROM s JOIN f ON s.w = f.w WHERE {'d': s.doc_id, 'i': s.i} <> f.pos),
n AS (SELECT doc_id, count(*) AS k FROM gone GROUP BY doc_id),
kept AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) AS t FROM l
         WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = l.doc_id AND g.i = l.i) GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN n.k IS NULL THEN d.text ELSE coalesce(kept.t, '') END AS text,
       CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS INTEGER) AS n_lines, CAST(coalesce(n.k, 0) AS INTEGER) AS n_removed
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
