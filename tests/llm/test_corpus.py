"""The corpus operators against brute force, on small hand-made tables."""
import collections
import gzip
import hashlib
import os
import random
import unicodedata
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from dockline.llm import (archive, components, decontaminate, licenses, linedup, mixing, neardup, quality, repeats,
                          suffix, surrogates, toxicity)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, pool=400):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def docs_of(spark, texts, ids=None, **extra):
    rows = [(i if ids is None else ids[i], t, "en", f"s{i % 3}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [" ".join(words(rng, rng.randrange(20, 160))) for _ in range(40)]
    near = []
    for t in base[:12]:
        w = t.split()
        for _ in range(3):
            v = list(w)
            v[rng.randrange(len(v))] = "edit%d" % rng.randrange(10 ** 6)
            near.append(" ".join(v))
    return base + near + base[:5] + [None, "", "  \n\t ", "one", "a b c d", "a b c d", "x " * 500]


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2 ** 63, 400).astype(np.uint64)
    b = np.concatenate([a[:320], rng.integers(0, 2 ** 63, 80).astype(np.uint64)])
    sig = neardup.signatures(np.concatenate([a, b]), np.ones(800), np.array([400, 400]), 2000)
    assert abs((sig[0] == sig[1]).mean() - 320 / 480) < 0.05
    ids, own = neardup.cells(a[:3], np.array([2.5, 0.5, 1.0]))
    ids2, own2 = neardup.cells(a[:3], np.array([1.0, 0.5, 2.0]))
    sig = neardup.signatures(np.concatenate([ids, ids2]), np.concatenate([own, own2]), np.array([len(ids), len(ids2)]), 4000)
    assert abs((sig[0] == sig[1]).mean() - 2.5 / 5.0) < 0.05


def test_near_duplicates_equal_brute_force(spark, texts):
    def units(t):
        w = (t or "").split()
        return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else None
    u = [units(t) for t in texts]
    label = list(range(len(texts)))
    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(u)):
        for j in range(i):
            if u[i] and u[j] and sum((u[i] & u[j]).values()) >= 0.8 * sum((u[i] | u[j]).values()):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    docs = docs_of(spark, texts)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert got == {i: find(i) for i in range(len(texts))}
    left = neardup.keep_one(docs.withColumn("key", F.lit(1)).withColumn("tid", F.lit(2)))
    assert left.columns == docs.columns + ["key", "tid"]
    assert sorted(r.doc_id for r in left.collect()) == sorted({find(i) for i in range(len(texts))})
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_leftover_classes_meet_by_prefix(spark):
    rng = random.Random(3)
    core = [f"c{i}" for i in range(60)]
    sets = [set(core[:50]) | {f"u{k}-{i}" for i in range(rng.randrange(0, 14))} for k in range(30)]
    num = {w: i for i, w in enumerate(sorted(set().union(*sets)))}
    u = spark.createDataFrame([(k, sorted(num[w] for w in s)) for k, s in enumerate(sets)], "tid long, u array<long>")
    labels = u.select("tid", F.col("tid").alias("label"))
    got = {(r.a, r.b) for r in neardup._similar(neardup._across(u, labels), u).collect()}
    assert got == {(i, j) for j in range(30) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}


def test_texts_apart_in_one_group_do_not_meet(spark):
    rng = random.Random(8)
    core = [rng.randrange(-2 ** 63, 2 ** 63) for _ in range(200)]
    sets = [rng.sample(core, 180) + [rng.randrange(-2 ** 63, 2 ** 63) for _ in range(20)] for _ in range(50)]
    sets += [s[:190] + [rng.randrange(-2 ** 63, 2 ** 63) for _ in range(10)] for s in sets[:5]]
    u = spark.createDataFrame([(k, s) for k, s in enumerate(sets)], "tid long, u array<long>")
    pairs = neardup._across(u, u.select("tid", F.col("tid").alias("label")))
    want = {(i, j) for j in range(55) for i in range(j) if len({*sets[i]} & {*sets[j]}) >= 0.8 * len({*sets[i]} | {*sets[j]})}
    assert {(r.a, r.b) for r in neardup._similar(pairs, u).collect()} == want and len(want) >= 5
    assert pairs.count() <= 2 * len(want)


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (7, 9), (20, 3), (5, 5)], "a long, b long")
    assert {r.node: r.label for r in components.components(e).collect()} == {1: 1, 2: 1, 3: 1, 20: 1, 7: 7, 8: 7, 9: 7, 5: 5}


def test_suffix_array_and_prefixes():
    rng = random.Random(2)
    for _ in range(300):
        n, k = rng.randrange(0, 50), rng.choice((1, 2, 4, 300))
        t = [rng.randrange(k) for _ in range(n)]
        want = sorted(range(n), key=lambda i: t[i:])
        assert suffix.suffix_array(np.array(t, dtype=np.int64)).tolist() == want
        assert n < 2 or suffix.suffix_array(np.array(t, dtype=np.int64), 1000).tolist() == want
    sa = suffix.suffix_array(np.frombuffer(b"banana", np.uint8))
    assert suffix.permuted_lcp(b"banana", sa, 2).tolist() == [0, 2, 2, 1, 0, 0]


def brute_repeats(texts):
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        mark = bytearray(len(b))
        for i in range(len(b) - 99):
            if b[i:i + 100] in seen:
                mark[i:i + 100] = b"\1" * 100
            seen.add(b[i:i + 100])
        out.append((len(b), sum(mark), sum(1 for i in range(len(b)) if mark[i] and not (i and mark[i - 1])),
                    bytes(x for x, m in zip(b, mark) if not m)))
    return out


@pytest.mark.parametrize("most", [8192, 2])
def test_repeats_equal_brute_force(spark, texts, most, monkeypatch):
    monkeypatch.setattr(repeats, "MOST", most)
    passage = " ".join(words(random.Random(9), 40))
    rng = random.Random(4)
    t = texts + [" ".join(words(rng, 30)) + " " + passage + " " + " ".join(words(rng, 30)) for _ in range(12)]
    t += ["é" * 130, "z" * 1000, "é" * 120 + "q", passage[:99], passage[:100]]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(docs_of(spark, t)).collect()}
    assert got == dict(enumerate(brute_repeats(t)))
    assert repeats.remove_repeats(docs_of(spark, t).limit(0)).count() == 0


def test_repeated_rows_are_one_document(spark):
    t = " ".join(words(random.Random(8), 60))
    rows = repeats.remove_repeats(docs_of(spark, [t, t, "other " + t], ids=[1, 1, None])).collect()
    assert sorted(r.n_removed for r in rows) == [0, 0, len(t)]


def test_repeats_in_a_text_longer_than_a_piece(spark):
    rng = random.Random(14)
    passage = " ".join(words(rng, 40))
    long = " ".join(rng.choices([f"w{i}" for i in range(50_000)], k=170_000)).encode()[:repeats.PIECE - 150].decode()
    t = [passage, long + passage + " " + " ".join(words(rng, 2000)) + passage, "tail " + long[-400:] + passage[:60]]
    assert len(t[1]) > repeats.PIECE
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(docs_of(spark, t)).collect()}
    assert got == dict(enumerate(brute_repeats(t)))


def test_segments_that_share_no_string_are_left_out():
    rng = random.Random(15)
    gram = bytes(rng.choices(b"abcdef", k=repeats.GRAM))
    h = int(repeats.grams(np.frombuffer(gram, np.uint8))[0].astype(np.int64))
    side = lambda n, letters=b"abcdef": bytes(rng.choices(letters, k=n))
    for back in range(repeats.SPAN):
        a = side(68 - back) + (core := side(back) + gram + side(68 - back)) + side(back)
        b = side(68 - back, b"ghijkl") + core + side(back, b"ghijkl")
        rows = [(h, i, 0, 5, x) for i, x in enumerate([a, b, side(68, b"mnopqr") + gram + side(68, b"mnopqr")])]
        assert [r[1] for r in repeats.agreeing(rows)] == [0, 1]
        got = repeats.repeats_in(rows)
        assert got.values.tolist() == [[1, 0, 5 + 68 - back, 1]]


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(6)
    pool = [" ".join(words(rng, rng.randrange(1, 25), 60)) for _ in range(25)]
    t = []
    for _ in range(40):
        ls = []
        for _ in range(rng.randrange(1, 6)):
            w = rng.choice(pool).split()
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = f"w{rng.randrange(60)}"
            ls.append(" ".join(w))
        t.append("\n".join(ls))
    t += [None, "", "\n \n", t[0]]
    seen, want = [], {}
    for d, x in enumerate(t):
        keep = []
        for line in (x or "").split("\n"):
            s = set(line.split())
            if not s or not any(len(s & o) >= 0.8 * len(s | o) - 1e-9 for o in seen):
                keep.append(line)
            if s:
                seen.append(s)
        want[d] = None if x is None else "\n".join(keep)
    docs = docs_of(spark, t).withColumn("n_lines", F.lit(7))
    out = linedup.dedup(docs)
    assert out.columns == docs.columns + ["n_lines_", "n_removed"]
    assert {r.doc_id: r.text for r in out.collect()} == want
    left = {r.doc_id: r for r in linedup.remove_lines(docs_of(spark, t)).collect()}
    assert set(left) == {d for d, x in want.items() if (x or "").split() or not (t[d] or "").split()}
    assert all(r.n_chars == len(r.text or "") for r in left.values())
    assert linedup.dedup(docs.limit(0)).count() == 0


def test_long_lines_that_differ_are_not_paired(spark, monkeypatch):
    rng = random.Random(7)
    lines = [" ".join(words(rng, 260, 3000)) for _ in range(60)]
    near = [" ".join(["new", *line.split()[3:]]) for line in lines[:4]]
    pairs, kept = [], linedup.C.materialize

    def counted(df, name):
        out = kept(df, name)
        pairs.extend([out.count()] if name == "line-pairs" else [])
        return out
    monkeypatch.setattr(linedup.C, "materialize", counted)
    out = {r.doc_id: r.text for r in linedup.dedup(docs_of(spark, lines + near)).collect()}
    assert [out[k] for k in range(60)] == lines and all(out[60 + k] == "" for k in range(4))
    assert len(pairs) == 2 and pairs[1] <= 30           # of the join of all that is left


def test_line_dedup_joins_in_parts_and_drops_its_tables(spark, monkeypatch, tmp_path):
    rng = random.Random(8)
    lines = [" ".join(words(rng, 30, 90)) for _ in range(50)]
    docs = docs_of(spark, lines + [" ".join([*x.split()[:-1], "new"]) for x in lines[:9]])
    names, rows, kept = [], [], linedup.C.materialize

    def seen(df, name):
        names.append(name)
        out = kept(df, name)
        rows.extend([out.count()] if name == "line-part" else [])
        return out
    monkeypatch.setattr(linedup.C, "materialize", seen)
    monkeypatch.setattr(linedup.C.SESSION, "shared_path", lambda spark, name: f"{tmp_path}/a b/{name}-{len(names)}")
    got = {}
    for k in (1, 4):                                    # parts of the join of all that is left
        monkeypatch.setattr(linedup, "SLICES", k)
        del names[:], rows[:]
        got[k] = linedup.dedup(docs).sort("doc_id").collect()
        assert names.count("line-part") == k and sum(rows)
        assert {x.rsplit("-", 1)[0] for x in os.listdir(f"{tmp_path}/a b")} == {"llm-line-matches"}
    assert got[1] == got[4] and sum(r.n_removed for r in got[4]) == 9


def test_line_dedup_shuffles_a_part_once(spark, monkeypatch):
    rng = random.Random(9)
    lines = [" ".join(words(rng, 30, 90)) for _ in range(50)]
    plans, kept = [], linedup.C.materialize

    def seen(df, name):
        if name == "line-part":
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name)
    monkeypatch.setattr(linedup.C, "materialize", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = linedup.dedup(docs_of(spark, lines + [" ".join([*x.split()[:-1], "new"]) for x in lines[:9]])).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(r.n_removed for r in out) == 9 and len(plans) == linedup.SLICES
    assert all("ReusedExchange" in p for p in plans)


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(12)
    items = [words(rng, n, 5000) for n in (5, 9, 20, 40, 40)]
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(9, None), (10, " ")], "item_id long, text string")
    t, want = [], set()
    for d in range(60):
        w, i = words(rng, 80, 5000), rng.randrange(len(items))
        x, k = list(items[i]), rng.choice((0, 0, decontaminate.limit(len(items[i])), 2 * decontaminate.limit(len(items[i])) + 2))
        for j in rng.sample(range(len(x)), min(k, len(x))):
            x[j] = f"e{rng.randrange(10 ** 6)}"
        t.append(" ".join(w[:40] + x + w[40:]).upper() + ".")
        if k <= decontaminate.limit(len(items[i])):
            want.add((d, i))
    docs = docs_of(spark, t + [None, "", "short"])
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    assert got <= want and len(got) >= 0.97 * len(want)
    left = {r.doc_id for r in decontaminate.drop_leaking(docs, bench).collect()}
    assert left == set(range(63)) - {d for d, _ in got}
    assert decontaminate.leaks(docs.limit(0), bench).count() == 0 and decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_decontamination_recall_holds_for_each_length(monkeypatch):
    """A few long items in a pool of short ones are found as often; above the most walks the exact check finds all."""
    rng = random.Random(23)
    sizes = [20] * 300 + [16] * 4 + [60] * 4 + [200] * 4 + [400] * 4
    items = [words(rng, n, 5000) for n in sizes]
    index = decontaminate.Index([(i, " ".join(x)) for i, x in enumerate(items)])
    assert index.walks[400] is None or index.walks[400] > index.walks[20]

    def missed(index, copies):
        want, texts = [], []
        for i in range(300, len(items)):
            for _ in range(copies):
                copy = [items[i][x] if x < 10 ** 9 else f"e{x}" for x in decontaminate.edited(np.arange(len(items[i])), rng)]
                want.append(i)
                texts.append(" ".join(words(rng, 30, 5000) + copy + words(rng, 30, 5000)))
        got = {(n, i) for n, i, *_ in index.search(texts)}
        return collections.Counter(len(items[i]) for n, i in enumerate(want) if (n, i) not in got)
    lost = missed(index, 15)                                  # 60 copies of each length
    assert all(lost[n] <= 3 for n in (16, 60, 200, 400)), lost
    monkeypatch.setattr(decontaminate, "MOST_WALKS", 0)
    exact = decontaminate.Index([(i, " ".join(x)) for i, x in enumerate(items) if len(x) != 400])
    assert set(exact.walks.values()) == {None}
    lost = missed(exact, 3)
    assert not any(lost[n] for n in (16, 60, 200))


def test_edit_distance_to_substring():
    rng = random.Random(1)
    def full(a, b):
        p = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            q = [i]
            for j, y in enumerate(b, 1):
                q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
            p = q
        return p[-1]
    for _ in range(60):
        a, b = [rng.randrange(3) for _ in range(rng.randrange(1, 6))], [rng.randrange(3) for _ in range(rng.randrange(0, 8))]
        d, lo, hi = decontaminate.edits(np.array(a), np.array(b, dtype=np.int64))
        assert d == min(full(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1)) == full(a, b[lo:hi])


def test_mixing(spark, texts):
    docs = docs_of(spark, [t for t in texts for _ in range(3)])
    rows = mixing.mix(docs, block=16, shards=4).taken().collect()
    again = mixing.mix(docs, block=16, shards=4).taken().collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)
    by = collections.defaultdict(lambda: [0, 0, 0, 0])
    for r in rows:
        assert r.taken <= 3 * r.size
        b = by[r.source]
        b[0], b[1], b[2], b[3] = b[0] + r.size, b[1] + r.taken, r.target, r.source_size
    assert all(b[0] == b[3] and b[2] <= 3 * b[3] + 1e-6 and abs(b[1] - b[2]) <= 0.05 * b[2] + 32 for b in by.values())
    assert abs(sum(b[2] for b in by.values()) - sum(b[0] for b in by.values())) < 1e-6
    m = mixing.mix(docs.limit(20).filter("text IS NOT NULL"), block=16, shards=3)
    assert all(len(r.text.split()) == r.n_words for r in mixing.texts(m, docs.limit(20).dropDuplicates(["doc_id"])).collect())
    assert mixing.mix(docs.limit(0)).taken().count() == 0
    for n in (1, 2, 7, 100):
        assert sorted(mixing.permute(np.arange(n), np.full(n, n), np.full(n, 99)).tolist()) == list(range(n))


def test_targets_are_shared_again_until_none_is_above():
    t = mixing.targets({"a": 10, "b": 500, "c": 490, None: 0})
    assert t["a"] == 30 and t[None] == 0 and abs(sum(t.values()) - 1000) < 1e-9 and abs(t["b"] / t["c"] - 2) < 1e-9


def test_quality_groups(spark):
    rng = random.Random(7)
    clean = [" ".join(words(rng, 80)) for _ in range(150)]
    junk = ["## " * 30 + " ".join(words(rng, 50)), " ".join(words(rng, 60)).upper(), "ab cd ef " * 40, "few words", None, ""]
    docs = docs_of(spark, clean + junk).withColumn("n_words", F.lit("x")).withColumn("kept", F.lit("y"))
    got = {r.doc_id: r for r in quality.rules(docs).collect()}
    assert all(got[i].kept for i in range(150)) and not any(got[i].kept for i in range(150, 156))
    assert got[152].n_repeat_words == 120 and got[152].base_failed and got[154].n_words == 0
    left = quality.keep(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == set(range(150))
    assert quality.rules(docs.limit(0)).count() == 0


def test_toxicity_learns_and_ignores_the_held_out(spark):
    rng = random.Random(11)
    t = [" ".join(words(rng, 60) + (["idiot", "moron"] if i % 3 == 0 else [])) for i in range(240)]
    docs = docs_of(spark, t + [None, ""])
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(240)] + [(0, 1, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [r for r in got.values() if r.held_out and r.doc_id < 240]
    pairs = [(a.score, b.score) for a in held for b in held if a.doc_id % 3 == 0 and b.doc_id % 3]
    assert len(got) == 242 and sum(a > b for a, b in pairs) >= 0.85 * len(pairs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    m = toxicity.fit(t, [int(i % 3 == 0) for i in range(240)])
    assert m.scores([t[1] + " idi0t mmoron"])[0] > m.scores([t[1]])[0]
    assert toxicity.fit(["a"], [1]).scores(["a"])[0] == 0.5


def test_toxicity_bags_are_packed_and_bounded():
    rng = np.random.default_rng(3)
    for n in (0, 1, 8191, 8192, 100_000, toxicity.BUCKETS):
        b = np.sort(rng.choice(toxicity.BUCKETS, n, replace=False))
        assert len(toxicity.pack(b)) <= toxicity.BUCKETS // 8 and np.array_equal(toxicity.unpack(toxicity.pack(b)), b)
    bags, y = [np.arange(10)] * 12, [0] * 8 + [1] * 4
    assert sorted(toxicity.bounded(bags, y, 10_000).tolist()) == list(range(12))
    assert sorted(toxicity.bounded(bags, y, 60).tolist()) == [0, 1, 2, 3, 8, 9]
    assert toxicity.bounded([], [], 5).tolist() == []


def test_toxicity_long_texts_teach_and_odd_tables(spark):
    rng = random.Random(13)
    t = [" ".join(words(rng, 60) + (["idiot", "moron"] if i % 3 == 0 else []) + words(rng, 5500 if i < 60 else 10)) for i in range(120)]
    assert all(len(x) > 20_000 for x in t[:60])
    odd = lambda df: df.withColumns({c: F.lit("x") for c in ("y", "_id", "toxic", "score", "held_out", "bag", "_h")})
    docs = odd(docs_of(spark, [*t, t[0], None, ""], ids=[*range(120), 0, 120, 121]))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(1, 0), (None, 1), (120, 1)], "doc_id long, toxic int").withColumn("text", F.lit("z"))
    rows = toxicity.sample(docs, labels).collect()
    want = {(i, int(i % 3 == 0)) for i in range(60) if zlib.crc32(str(i).encode()) % 5}
    assert {(r.doc_id, r.toxic) for r in rows} == want and len(rows) == len(want)
    assert all(np.array_equal(toxicity.unpack(r.bag), toxicity.bag(t[r.doc_id])) for r in rows)
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 123 and len({r.score for r in got if r.doc_id == 0}) == 1
    assert len({r.score for r in got if r.doc_id in (120, 121)}) == 1
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.5}


def test_archives_round_trip(spark, scratch):
    html = ["<p>" + "é" * 60 + "</p>", "x" * 100, "x" * 100, "small", "small", None, "a\r\n\r\nWARC/1.1\r\nx" + "y" * 200, "x" * 100]
    pages = spark.createDataFrame([(10 - i, f"http://h/{i} b" if i else None, h) for i, h in enumerate(html)] + [(None, "u", "x" * 100)],
                                  "page_id long, url string, html string")
    for version in ("1", "2"):
        d = f"{scratch}/v{version}"
        archive.export_arc(pages, d + "/arc", version)
        archive.convert(spark, d + "/arc", d + "/warc")
        rows = archive.read_warc(spark, d + "/warc").collect()
        assert len(rows) == 9 and all(r.intact for r in rows) and len({r.record_id for r in rows}) == 9
        assert {bytes(r.payload) for r in rows if r.page_id == 4} == {html[6].encode()}
    got = {r.page_id: r for r in archive.round_trip(pages, scratch + "/r").collect()}
    assert got[3].record_type == "response" and all(got[k].refers_to == 3 for k in (8, 9, None))
    assert got[7].record_type == got[6].record_type == "response" and got[5].payload_bytes == 0
    assert got[8].payload_digest == hashlib.sha256(b"x" * 100).hexdigest() and got[8].payload_bytes == 100
    assert archive.round_trip(pages.limit(0), scratch + "/e").count() == 0


def test_archives_are_packed_without_a_shuffle(spark, scratch, monkeypatch):
    monkeypatch.setattr(archive, "FILE_BYTES", 2000)
    pages = spark.createDataFrame([(i, f"http://h/{i}", "z" * (50 + 37 * i % 400)) for i in range(60)], "page_id long, url string, html string")
    archive.export_arc(pages.coalesce(1), scratch + "/arc")
    datas = [archive._unpacked(bytes(r.content)) for r in archive.files(spark, scratch + "/arc").collect()]
    ids = [[int(archive.http_parts(body)[2]["x-page-id"]) for _, body in archive.arc_records(data)] for data in datas]
    assert len(ids) > 5 and sorted(sum(ids, [])) == list(range(60)) and all(x == list(range(x[0], x[0] + len(x))) for x in ids)
    assert len({h["archive"] for data in datas for h, _ in archive.arc_records(data)}) == len(ids)
    got = archive.round_trip(pages, scratch + "/r").collect()
    assert sorted(r.page_id for r in got) == list(range(60)) and all(r.intact for r in got)


def test_damaged_arc_records_are_skipped():
    head = "1 0 o\nURL IP-address Archive-date Content-type Archive-length\n"
    ok = "http://a/x y 1.2.3.4 20200101000000 text/html 3\nabc\n"
    data = f"filedesc://f.arc 0.0.0.0 20200101000000 text/plain {len(head)}\n{head}\n".encode()
    got = list(archive.arc_records(data + ok.encode() + b"broken line\n" + ok.encode() + b"http://b 1.2.3.4 20200101000000 text/html 99\nab"))
    assert [(h["url"], b) for h, b in got] == [("http://a/x y", b"abc")] * 2
    assert archive._unpacked(gzip.compress(data)) == data


def test_arc_records_keep_their_kind(spark, scratch):
    head = "1 0 o\nURL IP-address Archive-date Content-type Archive-length\n"
    dns, http = "20200101000000\nh.example. 300 IN A 1.2.3.4\n" + "z" * 100, "HTTP/1.1 200 OK\r\nX-Page-Id: 7\r\n\r\n" + "y" * 150
    data = f"filedesc://f.arc 0.0.0.0 20200101000000 text/plain {len(head)}\n{head}\n"
    for url, mime, body in (("dns:h.example", "text/dns", dns), ("http://h/", "text/html", http), ("dns:h.example", "text/dns", dns), ("http://h/2", "text/html", http)):
        data += f"{url} 1.2.3.4 20200101000000 {mime} {len(body)}\n{body}\n"
    os.makedirs(scratch + "/arc")
    with open(scratch + "/arc/f.arc", "w", newline="") as f:
        f.write(data)
    archive.convert(spark, scratch + "/arc", scratch + "/warc")
    rows = archive.read_warc(spark, scratch + "/warc", info=True).collect()
    assert sorted(r.record_type for r in rows) == ["resource", "resource", "response", "revisit", "warcinfo"]
    assert all(r.intact for r in rows) and all(bytes(r.payload) == dns.encode() for r in rows if r.record_type == "resource")
    raw = b"".join(archive._unpacked(bytes(r.content)) for r in archive.files(spark, scratch + "/warc").collect())
    kinds = {h["warc-type"]: h for h, _ in archive.warc_records(raw)}
    assert kinds["resource"]["content-type"] == "text/dns" and kinds["resource"]["warc-target-uri"] == "dns:h.example"
    assert kinds["warcinfo"]["content-type"] == "application/warc-fields" and kinds["warcinfo"]["warc-filename"] == "f.arc"
    assert len(archive.read_warc(spark, scratch + "/warc").collect()) == 4


def test_license_templates(spark):
    rng = random.Random(2)
    mit = licenses.TEMPLATES[1][1]
    cut = mit.split()
    cut[10] = "changed"
    t = [" ".join(words(rng, 33)) + "\n" + x + "\n" + " ".join(words(rng, 20)) for _, x in licenses.TEMPLATES]
    t += [" ".join(words(rng, 33) + cut + words(rng, 9)), " ".join(words(rng, 50)), None, "", "MIT License"]
    got = collections.defaultdict(set)
    for r in licenses.scan(docs_of(spark, t)).collect():
        got[r.doc_id].add(r.template)
        assert 5 * r.shared >= 4 * r.n_shingles
    assert all(i in got[i] for i in range(len(licenses.TEMPLATES)))
    assert 1 in got[len(licenses.TEMPLATES)] and not set(got) - set(range(len(licenses.TEMPLATES) + 1))
    assert licenses.scan(docs_of(spark, t).limit(0)).count() == 0


def test_surrogates(spark):
    t = ["Mail Bob.Ray@mail3.example.com or bob.ray@mail3.example.com now, +1 (743) 555-3824 or +17435553824.",
         "Card 4111111111111111 at 10.1.2.3 and 8.8.8.8, password=ab12cd34ef token = \"XYZ_12345678\"",
         "Mary Jones met John Jones. Mrs. Jones left; Анна Петрова and Herr Weber stayed.", None, "", "nothing here",
         "bob.ray@mail3.example.com"]
    got = {r.doc_id: r for r in surrogates.replace(docs_of(spark, t)).collect()}
    a = got[0].text.split()
    assert a[1].lower() == a[3] == got[6].text and a[1] != a[3] and a[3].endswith(".com") and "bob" not in a[3]
    assert surrogates.canonical("phone", got[0].text.split("now, ")[1].split(" or ")[0]) == surrogates.canonical("phone", got[0].text.split(" or ")[-1])
    card = got[1].text.split()[1]
    assert card != "4111111111111111" and card[0] == "4" and surrogates.luhn(card) and "10." in got[1].text and "8.8.8.8" not in got[1].text
    assert "ab12cd34ef" not in got[1].text and "XYZ_12345678" not in got[1].text
    w = got[2].text.replace(".", "").replace(";", "").split()
    assert w[1] == w[4] == w[6] != "Jones" and w[0] in surrogates.GIVEN["latin", "f"] and w[3] in surrogates.GIVEN["latin", "m"]
    assert surrogates.script(w[8]) == surrogates.script(w[9]) == "cyrillic"
    assert got[3].text is None and got[5].text == "nothing here" and got[5].n_entities == 0


def test_surrogates_stay_distinct(spark):
    ents = spark.createDataFrame([("surname-latin", f"Name{i}") for i in range(300)] + [("given-f-latin", f"N{i}") for i in range(60)]
                                 + [("ssn", f"{i:09d}") for i in range(50)], "kind string, canon string")
    rows = surrogates.assign(ents).collect()
    assert len(rows) == 410 and len({(r.kind.split("-")[0], r.found) for r in rows}) == 410


def test_surrogates_find_every_name():
    found = lambda t: [t[a:b] for a, b, _ in surrogates.find(t)]
    for lead in ("Contact", "President", "Hello", "The Honourable"):
        assert found(f"{lead} Mary Smith today.") == ["Mary", "Smith"]
    assert found("Hello Anna") == ["Anna"] and found("CALL MARY SMITH") == ["MARY", "SMITH"]
    assert found("Mary Smith called. Mary said") == ["Mary", "Smith", "Mary"]
    assert found("Weber knew. Dr. Anna Weber spoke, Weber left, WEBER's car") == ["Weber", "Anna", "Weber", "Weber", "WEBER"]
    assert found("Prof. Dr. Weber and John Q. Public, Mrs. Smith-Miller, Peter van Dyke") == \
        ["Weber", "John", "Public", "Smith-Miller", "Peter", "Dyke"]
    assert found("Anna Maria Lopez met Thomas Martin. The Dr was in") == ["Anna", "Maria", "Lopez", "Thomas", "Martin"]
    assert found("Contact President Lincoln Street") == [] and found("Ask Анна Петрова") == ["Анна", "Петрова"]
    assert surrogates.canonical("surname-latin", "SMITH") == surrogates.canonical("surname-latin", "Smith")


def test_surrogates_keep_the_script(spark):
    t = ["Dr. Anna Weber came. Weber left, ANNA WEBER too.", "Mr. 王伟 and Mr. محمد met Mr. כהן"]
    got = {r.doc_id: r.text for r in surrogates.replace(docs_of(spark, t)).collect()}
    w = got[0].replace(".", "").replace(",", "").split()
    assert w[2] == w[4] != "Weber" and w[6:8] == [w[1].upper(), w[2].upper()] and not {"Anna", "ANNA"} & set(w)
    w = got[1].split()
    for new, old in ((w[1], "王伟"), (w[4], "محمد"), (w[7], "כהן")):
        kind = lambda s: {unicodedata.name(c).split(" ")[0] for c in s}
        assert new != old and kind(new) == kind(old)


def test_surrogates_end_when_a_shape_runs_out(spark, monkeypatch):
    calls, write = [], surrogates.C.materialize

    def few(df, name):
        calls.append(name)
        assert len(calls) < 60, "rounds without end"
        return write(df, name)
    monkeypatch.setattr(surrogates.C, "materialize", few)
    abc = "abcdefghijklmnopqrstuvwxyz"
    ents = [("email", f"{a}@{b}.de") for a in abc for b in abc] + [("phone", f"1{i:04d}") for i in range(10000)]
    ents += [("ip", f"192.168.{i}.{j}") for i in range(1, 255) for j in range(1, 255, 2)]
    rows = surrogates.assign(spark.createDataFrame(ents, "kind string, canon string")).collect()
    assert len(rows) == len({(r.kind, r.found) for r in rows}) == len(ents)
    assert not {(r.kind, r.found) for r in rows} & set(ents)
    assert all(r.found.startswith(("192.168.", "10.", "24", "25")) for r in rows if r.kind == "ip")
    assert surrogates.fitted("phone", "10000", "1234567", "+1 00-00") == "+1 23-4567"


def test_quality_junk_does_not_move_the_fence(spark):
    rng = random.Random(13)
    text = lambda: " ".join(words(rng, 80))
    junk = [lambda: " ".join(w + " ###" for w in words(rng, 60)), lambda: text().upper(),
            lambda: " ".join(w + "x" * 60 for w in words(rng, 60)),
            lambda: "\nx\n".join(" ".join(words(rng, 8)) for _ in range(9))]
    rows = []
    for k, bad in enumerate(junk):                            # a source of each kind of junk, 40% of its rows
        rows += [(bad() if i < 80 else text(), "en", f"mixed{k}", i < 80) for i in range(200)]
    rows += [(junk[i % 2](), "en", "hot", True) for i in range(1200)]           # a third of all rows, all junk
    rows += [(text(), lang, f"clean{i % 3}", False) for lang in ("en", "de") for i in range(900)]
    docs = spark.createDataFrame([(i, t, lang, source, len(t)) for i, (t, lang, source, _) in enumerate(rows)], DOCS)
    got = {r.doc_id: r for r in quality.rules(docs).collect()}
    wrong = [(i, r[2], r[3]) for i, r in enumerate(rows) if got[i].kept == r[3]]
    assert not wrong and not any(got[i].base_failed for i, r in enumerate(rows) if r[3])


def test_quality_a_source_may_differ(spark):
    """Clean sources unlike all others are kept by their own sketches; a mixed one is held to its language's."""
    rng = random.Random(19)
    text = lambda: " ".join(words(rng, 80))
    code = lambda: " ".join(w + (" #" if i % 2 else "") for i, w in enumerate(words(rng, 80)))
    long = lambda: " ".join(w + "abcdefgh" for w in words(rng, 80))
    junk = lambda: " ".join(w + " ###" for w in words(rng, 60))
    rows = [(text(), "en", "web", True) for _ in range(700)] + [(code(), "en", "code", True) for _ in range(300)]
    rows += [(long(), "en", "papers", True) for _ in range(150)] + [(junk(), "en", "code", False) for _ in range(40)]
    rows += [(junk() if i < 110 else text(), "en", "mixed", i >= 110) for i in range(200)]
    rows += [(code(), None, "small", False) for _ in range(20)]          # too few to speak for themselves
    docs = spark.createDataFrame([(i, t, lang, source, len(t)) for i, (t, lang, source, _) in enumerate(rows)], DOCS)
    got = {r.doc_id: r for r in quality.rules(docs).collect()}
    assert not [(i, r[2], r[3]) for i, r in enumerate(rows) if got[i].kept != r[3]]
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.execute(quality.ORACLE).df().set_index("doc_id")["kept"].to_dict()
    assert want == {i: r.kept for i, r in got.items()}
    measured = quality.measure(docs).drop("text").cache()        # measured once, as the operator does by writing it
    edges = quality.thresholds(quality.sketch(measured)).collect()
    assert len({r.t_hi_symbol for r in edges}) >= 2 and len({r.t_hi_wlen for r in edges}) >= 2


def test_license_passages_across_windows(spark):
    rng = random.Random(17)
    mit, texts = licenses.TEMPLATES[1][1].split(), []
    for added in (16, 24, 32, 60):
        for lead in range(45):
            texts.append(" ".join(words(rng, lead) + mit[:25] + words(rng, added) + mit[25:] + words(rng, 50)))
    split = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    grams = lambda w: [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    want = set()
    for no, (_, template) in enumerate(licenses.TEMPLATES):
        known = grams(split(template))
        for i, t in enumerate(texts):
            g = grams(split(t))
            if any(5 * len(set(g[a:a + 2 * len(known)]) & set(known)) >= 4 * len(set(known)) for a in range(len(g))):
                want.add((i, no))
    rows = licenses.scan(docs_of(spark, texts)).collect()
    assert {(r.doc_id, r.template) for r in rows} == want and {(i, 1) for i in range(135)} <= want
    for r in rows:
        known = grams(split(licenses.TEMPLATES[r.template][1]))
        assert r.shared == len(set(grams(split(texts[r.doc_id]))[r.start:r.start + 2 * len(known)]) & set(known))


def test_license_runs_equal_the_sql(spark):
    rng = random.Random(18)
    split = lambda x: x.split()
    t = [None, "", "the MIT License", "Released under the MIT License. " * 3]
    for no, (_, x) in enumerate(licenses.TEMPLATES):
        w = split(x)
        for lead in (0, 1, 2, 7):
            t.append(" ".join(words(rng, lead) + w))                                       # ends the text
            cut = rng.randrange(len(w))
            t.append(" ".join(words(rng, lead) + w[:cut] + words(rng, rng.randrange(len(w))) + w[cut:] + words(rng, 20)))
        t.append(" ".join(w[:-3] + words(rng, 30) + w + words(rng, 9) + w))                # best, then first
        t.append(x.upper() + "\n" + licenses.TEMPLATES[no - 1][1])
    docs = docs_of(spark, [*t, t[5]], ids=[*range(len(t)), 5]).withColumns({c: F.lit(7) for c in ("h", "s", "g", "m", "start", "t", "at", "template")})
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    cols = "doc_id, license, template, start, shared, n_shingles"
    want = con.execute(f"SELECT {cols} FROM ({licenses.oracle()})").fetchall()
    got = [tuple(r) for r in licenses.scan(docs).select(*cols.split(", ")).collect()]
    assert sorted(got) == sorted(want) and {r[2] for r in got} == set(range(len(licenses.TEMPLATES)))
    empty = spark.createDataFrame([], docs.schema)
    assert licenses.scan(empty).count() == 0
    long = docs_of(spark, [" ".join(" ".join(words(rng, 5000)) + " " + x for _, x in licenses.TEMPLATES)])
    got = {r.template: (r.start, r.shared) for r in licenses.scan(long).collect()}
    assert set(got) == set(range(len(licenses.TEMPLATES))) and got[0] == (5000, 1)


def test_toxicity_tells_a_few_words_in_long_texts():
    rng = random.Random(12)
    t = [" ".join(words(rng, 400) + (["idiot"] * 2 if i % 4 == 0 else [])) for i in range(200)]
    m = toxicity.fit(t[:160], [int(i % 4 == 0) for i in range(160)])
    s = m.scores(t[160:] + [" ".join(words(rng, 100_000) + ["idiiot", "idiot"]), None, ""])
    assert sum(a > b for a in s[0:40:4] for i, b in enumerate(s[:40]) if i % 4) >= 0.95 * 300
    assert s[-1] == s[-2] and 0 < s[-1] < 1
    # a text longer than a piece gives the bag of the whole
    long = " ".join(words(rng, 90_000)) + " last-word"
    assert len(long) > toxicity.PIECE
    parts = [toxicity.bag(p) for p in (long[:len(long) // 2].rsplit(" ", 1)[0], long[len(long[:len(long) // 2].rsplit(" ", 1)[0]):])]
    assert set(toxicity.bag(long)) == set(np.concatenate(parts))


def test_names_are_found_and_ordinary_words_stay():
    found = lambda t: [t[a:b] for a, b, _ in surrogates.find(t)]
    assert found("Contact Sarah Johnson and Michael Brown today") == ["Sarah", "Johnson", "Michael", "Brown"]
    assert found("Emily Clark wrote to James Wilson") == ["Emily", "Clark", "James", "Wilson"]
    assert found("Dear Robert, yours William") == ["Robert", "William"]
    assert found("Victor Monday called. Monday is a holiday") == ["Victor", "Monday"]
    assert found("John Street lives on Main Street near Oak Street.") == ["John", "Street"]
    assert found("Mary Baker asked the baker. Baker said no, Mary left.") == ["Mary", "Baker", "Mary"]
    assert found("Mary Weber called. Weber said so.") == ["Mary", "Weber", "Weber"]


def test_surrogate_key_and_iban(spark):
    good = "DE89370400440532013000"
    assert surrogates.iban_check("DE", good[4:]) == "89" and surrogates.iban_check("GB", "WEST12345698765432") == "82"
    new = surrogates.surrogate("iban", good, 0, b"k")
    assert new != good and new[:2] == "DE" and surrogates.iban_check("DE", new[4:]) == new[2:4]
    docs = docs_of(spark, ["SSN 123-45-6789", "SSN 123-45-6789", None, ""]).withColumn("t", F.lit(1)).withColumn("marks", F.lit(2))
    old = spark.conf.get(surrogates.KEY_CONF, None)
    try:
        spark.conf.unset(surrogates.KEY_CONF)
        free = [r.text for r in surrogates.replace(docs).orderBy("doc_id").collect()]
        assert free[0] == free[1] != "SSN 123-45-6789" and free[2:] == [None, ""]
        assert [r.text for r in surrogates.replace(docs).orderBy("doc_id").collect()] == free        # kept for the session
        for key, same in (("one", None), ("two", None), ("one", 0)):
            spark.conf.set(surrogates.KEY_CONF, key)
            got = surrogates.replace(docs).filter("doc_id = 0").first().text
            first = got if same is None and key == "one" else first
            assert (got == first) == (key == "one")
        assert surrogates.replace(docs.limit(0)).count() == 0
    finally:
        spark.conf.unset(surrogates.KEY_CONF)
        if old:
            spark.conf.set(surrogates.KEY_CONF, old)
