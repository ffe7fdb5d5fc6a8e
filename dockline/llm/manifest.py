"""Merkle manifest of a table: leaves, group roots, a root over the groups, and a proof per row.

A leaf is H (lower-case hex SHA-256) over the row's fields, each as ``-`` where it is
null, else as UTF-8 byte count, ``:`` and value. The leaves of a group stand by
(order, leaf); every ``fanout`` neighbours become H of their digests, as often as
more than one node remains. The roots of the groups, null first and then bytewise, go
through the same tree once more.

The tree is built by slot pivots, several levels in one shuffle:

1. Leaves get their place in their group from a range partitioning: a running number inside
   each (range, group), plus the rows of that group in the ranges before.
2. Conditional aggregates spread the ``fanout ** levels`` descendants of a node into one column
   each. The inner levels are hashes over runs of these columns, inside the row.
3. Downwards each node joins its ancestor's row, whose columns without the
   node's own slot are its siblings, and takes over that row's path to the root.

A node row never holds more than ``WIDTH`` digests, whatever the size of a group, and
a group of a third of all rows is split like any other. The driver sees one number, the most
levels a group has.

Defined cases: nulls in any field are ``-``; rows with equal keys stand by leaf, and
equal rows are leaves of their own; null keys come first; a group of one row has its
leaf as root and no siblings there; an empty table gives no rows; columns that
are not fields are not read, whatever their names.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common as C

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
WIDTH = 16                 # descendants spread into one row


def field(value: Column) -> Column:
    v = value.cast("string")
    return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def siblings_hash(path: Column) -> Column:
    """H of the siblings, level by level to the root and left to right in each."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(digest: Column, path: Column) -> Column:
    """The root that ``digest`` leads to along ``path``."""
    return F.aggregate(path, digest, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``idx``, the place in its group from 0, and ``n``, the group's rows. Rows that tie
    in ``order`` stand in any order."""
    tie, part = C.own(df, [], "_tie"), C.own(df, [], "_part")
    ranged = (df.withColumn(tie, F.monotonically_increasing_id())
              .repartitionByRange(group, *order, tie).withColumn(part, F.spark_partition_id()))
    ranged = C.materialize(ranged, name)
    every = W.partitionBy(group)
    before = every.orderBy(part).rowsBetween(W.unboundedPreceding, W.currentRow)
    base = (ranged.groupBy(group, part).agg(F.count("*").alias("_in"))
            .select(group, part, (F.sum("_in").over(before) - F.col("_in")).alias("_base"), F.sum("_in").over(every).alias("n")))
    at = F.row_number().over(W.partitionBy(group, part).orderBy(*order, tie)).cast("long") - 1
    return (ranged.withColumn("idx", at).join(base, [group, part])
            .withColumn("idx", F.col("idx") + F.col("_base")).drop("_base", tie, part))


class Tree:
    """``nodes``: g, idx, n, digest and what else is carried; one tree per g."""

    def __init__(self, nodes: DataFrame, fanout: int, name: str):
        self.name, self.k = name, fanout
        self.stride = 1
        while fanout ** (self.stride + 1) <= WIDTH:
            self.stride += 1
        self.w = fanout ** self.stride
        powers = F.array(*[F.lit(fanout ** i) for i in range(63) if fanout ** i < 1 << 63])
        self.nodes = C.materialize(nodes.withColumn("levels", F.size(F.filter(powers, lambda p: p < F.col("n")))).drop("n"), name)
        self.rows = []                               # node rows, one table per stride
        most = self.nodes.agg(F.max("levels")).first()[0] or 0
        cur = self.nodes
        for t in range(-(-most // self.stride)):
            cur = C.materialize(self._pivot(cur, t), f"{name}-up")
            self.rows.append(cur)
        # what is left of each tree
        self.roots = cur.filter("idx = 0").select("g", F.col("digest").alias("subroot"))

    def _col(self, j: int, i: int) -> str:
        return f"s{j}_{i}"

    def _pivot(self, cur: DataFrame, t: int) -> DataFrame:
        slot = F.pmod("idx", F.lit(self.w))
        spread = [F.max(F.when(slot == i, F.col("digest"))).alias(self._col(0, i)) for i in range(self.w)]
        df = cur.groupBy("g", "levels", F.floor(F.col("idx") / self.w).alias("up")).agg(*spread).withColumnRenamed("up", "idx")
        for j in range(self.stride):
            runs = {}
            for i in range(self.w // self.k ** (j + 1)):
                run = [F.col(self._col(j, i * self.k + s)) for s in range(self.k)]
                h = F.when(run[0].isNotNull(), F.sha2(F.concat(*[F.coalesce(c, F.lit("")) for c in run]), 256))
                # where a tree has ended already, its root goes up as it is
                runs[self._col(j + 1, i)] = F.when(F.lit(t * self.stride + j) < F.col("levels"), h).otherwise(run[0])
            df = df.withColumns(runs)
        return df.withColumnRenamed(self._col(self.stride, 0), "digest")

    def _own_path(self, t: int) -> Column:
        """Siblings of child ``idx`` inside its ancestor's row, from its own level up."""
        out = []
        for j in range(self.stride):
            pos = F.floor(F.pmod("idx", F.lit(self.w)) / self.k ** j)
            first, slot = F.floor(pos / self.k) * self.k, F.pmod(pos, F.lit(self.k))
            row = F.array(*[F.coalesce(F.col(self._col(j, i)), F.lit("")) for i in range(self.w // self.k ** j)])
            left = F.slice(row, (first + 1).cast("int"), slot.cast("int"))
            right = F.slice(row, (first + slot + 2).cast("int"), (self.k - 1 - slot).cast("int"))
            step = F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))
            out.append(F.when(F.lit(t * self.stride + j) < F.col("levels"), step))
        return F.array_compact(F.array(*out))

    def paths(self, tops: DataFrame) -> DataFrame:
        """``nodes`` with ``path`` from the node to the end of ``tops.path``; ``tops`` (g, path, and more)
        has one row per tree, and its columns go to every node."""
        carried = [c for c in tops.columns if c not in ("g", "path")]
        up = tops.withColumn("up", F.lit(0).cast("long"))
        if not self.rows:
            return self.nodes.join(tops, "g")
        held = self.rows[-1].withColumnRenamed("idx", "up").drop("digest", "levels").join(up, ["g", "up"])
        for t in reversed(range(len(self.rows))):
            below = self.rows[t - 1] if t else self.nodes
            keep = [c for c in below.columns if c != "up"]
            # the child's own columns of the same names belong to its children
            inner = [self._col(j, i) for j in range(self.stride) for i in range(self.w // self.k ** j)]
            mine = below.withColumn("up", F.floor(F.col("idx") / self.w))
            mine = mine.withColumnsRenamed({c: "own_" + c for c in inner if c in below.columns})
            j = mine.join(held, ["g", "up"]).withColumn("path", F.concat(self._own_path(t), F.col("path")))
            j = j.drop(*inner).withColumnsRenamed({"own_" + c: c for c in inner})
            j = j.select(*keep, "path", *carried)
            if t == 0:
                return j
            held = C.materialize(j.drop("digest", "levels").withColumnRenamed("idx", "up"), f"{self.name}-down")


def manifest(docs: DataFrame, fields=FIELDS, group: str = "lang", order: str = "doc_id", fanout: int = FANOUT,
             extra: dict[str, Column] | None = None) -> DataFrame:
    """``group``, ``order``, leaf, subroot, root and path of every row of ``docs``: ``path`` lists, from
    the leaf's level to the root's, the siblings to the left and to the right. ``extra``: further columns to compute."""
    extra = extra or {}
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))          # null first, then bytewise
    leaves = docs.select(g.alias("g"), F.col(group).alias("_group"), F.col(order).alias("_order"),
                         leaf([F.col(f) for f in fields]).alias("digest"), *[e.alias(f"_x_{c}") for c, e in extra.items()])
    # written before the range partitioning, whose sampling would hash all texts once more
    leaves = C.materialize(leaves, "merkle-hashed")
    tree = Tree(numbered(leaves, "g", ["_order", "digest"], "merkle-leaves"), fanout, "merkle")
    subroots = tree.roots.select(F.lit(0).alias("_one"), "g", F.col("subroot"))
    over = numbered(subroots, "_one", ["g"], "merkle-groups").select(
        F.lit("").alias("g"), F.col("g").alias("_of"), "idx", "n", F.col("subroot").alias("digest"))
    top = Tree(over, fanout, "merkle-top")
    ends = top.roots.select("g", F.col("subroot").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    ends = top.paths(ends).select(F.col("_of").alias("g"), F.col("digest").alias("subroot"), "root", "path")
    out = tree.paths(C.materialize(ends, "merkle-subroots"))
    return out.select(F.col("_group").alias(group), F.col("_order").alias(order), F.col("digest").alias("leaf"), "subroot", "root", "path",
                      *[F.col(f"_x_{c}").alias(c) for c in extra])


def tampered_leaf() -> Column:
    """Leaf of a document after the trial tampering: ``n_chars`` grows by 1 where 7 divides the id's crc32."""
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    more = F.when(hit, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars").cast("decimal(20,0)"))
    return leaf([more.cast("decimal(20,0)") if f == "n_chars" else F.col(f) for f in FIELDS])


def audit(docs: DataFrame) -> DataFrame:
    """Proof of every document, and whether its row, tampered with or not, still leads to the root."""
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    m = manifest(docs, extra={"shown": F.when(hit, tampered_leaf())})
    folded = m.withColumn("folded_root", fold(F.coalesce("shown", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", siblings_hash(F.col("path")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


# crc32 of the decimal digits, bit by bit; the tree as lists per group, halved until one digest is left
ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang,
    coalesce(strlen(doc_id::varchar)::varchar || ':' || doc_id, '-') || coalesce(strlen(source)::varchar || ':' || source, '-')
      || coalesce(strlen(lang)::varchar || ':' || lang, '-') AS head,
    n_chars, coalesce(strlen(text)::varchar || ':' || text, '-') AS tail,
    xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda ch: ord(ch)::bigint)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
        lambda x, z: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END::bigint)))) AS crc
  FROM documents),
h AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::varchar)::varchar || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN crc % 7 = 0 THEN sha256(head || coalesce(strlen((n_chars + 1)::varchar)::varchar || ':' || (n_chars + 1), '-') || tail) END AS shown
  FROM d),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM h),
lv AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY i) AS l FROM leaves GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, len(l), 2), lambda x: sha256(l[x + 1] || coalesce(l[x + 2], ''))) FROM lv WHERE len(l) > 1),
subs AS (SELECT lang, level AS height, l[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM lv WHERE len(l) = 1),
tv AS (
  SELECT 0 AS level, list(subroot ORDER BY i) AS l FROM subs
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(l), 2), lambda x: sha256(l[x + 1] || coalesce(l[x + 2], ''))) FROM tv WHERE len(l) > 1),
climb AS (
  SELECT doc_id, leaf, shown, lang, i, 0 AS level, coalesce(shown, leaf) AS acc, '' AS proof, false AS top FROM leaves
  UNION ALL
  SELECT doc_id, leaf, shown, lang, ni, nlevel, CASE WHEN moves THEN sha256(CASE WHEN pos % 2 = 0 THEN acc || sib ELSE sib || acc END) ELSE acc END,
    proof || sib, ntop
  FROM (
    SELECT c.*, c.i AS pos, NOT c.top AND c.level = s.height AS hop,
      CASE WHEN NOT c.top AND c.level = s.height THEN s.i ELSE c.i // 2 END AS ni,
      CASE WHEN NOT c.top AND c.level = s.height THEN 0 ELSE c.level + 1 END AS nlevel,
      c.top OR c.level = s.height AS ntop,
      NOT (NOT c.top AND c.level = s.height) AS moves,
      CASE WHEN NOT c.top AND c.level = s.height THEN ''
        ELSE coalesce((CASE WHEN c.top THEN t.l ELSE v.l END)[xor(c.i, 1) + 1], '') END AS sib
    FROM climb c JOIN subs s ON s.lang IS NOT DISTINCT FROM c.lang
    LEFT JOIN lv v ON v.lang IS NOT DISTINCT FROM c.lang AND v.level = c.level
    LEFT JOIN tv t ON t.level = c.level
    WHERE NOT (c.top AND c.level = (SELECT max(level) FROM tv))))
SELECT c.doc_id, c.leaf, s.subroot, r.root, sha256(c.proof) AS proof_sha256, c.acc AS folded_root, c.acc = r.root AS verified
FROM climb c JOIN subs s ON s.lang IS NOT DISTINCT FROM c.lang, (SELECT l[1] AS root FROM tv WHERE len(l) = 1) r
WHERE c.top AND c.level = (SELECT max(level) FROM tv)
"""
