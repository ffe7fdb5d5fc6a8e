"""Merkle manifest, URL rules and collocations against plain Python on small hand-made tables."""
import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from dockline.llm import manifest, phrases, urlrules

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---- Merkle manifest -----------------------------------------------------
def leaf_of(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree_of(digests, k):
    """(root, path of every leaf as (left, right) from the leaf's level up)."""
    paths, at, cur = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(cur) > 1:
        for i, a in enumerate(at):
            run = cur[a // k * k:a // k * k + k]
            paths[i].append(("".join(run[:a % k]), "".join(run[a % k + 1:])))
        cur = [H(*cur[i:i + k]) for i in range(0, len(cur), k)]
        at = [a // k for a in at]
    return cur[0], paths


def plain_manifest(rows, k):
    groups = collections.defaultdict(list)
    for doc_id, text, lang, source, n in rows:
        groups[lang].append((doc_id is not None, doc_id or 0, leaf_of([doc_id, source, lang, n, text]), (doc_id, source, lang, n, text)))
    langs = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    trees = {v: (sorted(groups[v], key=lambda g: g[:3]),) for v in langs}
    trees = {v: (g, *tree_of([x[2] for x in g], k)) for v, (g,) in trees.items()}
    root, tops = tree_of([trees[v][1] for v in langs], k)
    out = []
    for i, v in enumerate(langs):
        for (_, _, leaf, row), path in zip(trees[v][0], trees[v][2]):
            path = path + tops[i]
            acc, tampered = leaf, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
            if tampered:
                acc = leaf_of([row[0], row[1], row[2], row[3] + 1, row[4]])
            for left, right in path:
                acc = H(left, acc, right)
            out.append((row[0], leaf, trees[v][1], root, H(*[x for s in path for x in s]), acc, acc == root, path))
    return out


def manifest_rows():
    rng = random.Random(2)
    rows = [(i, f"text {rng.randrange(9)} " + "ü" * rng.randrange(4), rng.choice(["en"] * 6 + ["de", "zz"]), "s", 5) for i in range(90)]
    rows += [(200, None, "en", None, None), (201, "", None, "s", 0), (None, "n", "en", "s", 1), (None, "n", "en", "s", 1), (None, None, None, None, None)]
    rows += [(7, "twin", "en", "s", 2)] * 3 + [(7, "other", "en", "s", 2), (300, "alone", "éa", "s", 1), (301, "x" * 3_000_000, "fr", "s", 2 ** 63 - 1)]
    return rows


def test_manifest_equals_plain_tree(spark):
    rows = manifest_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumn("leaf", F.lit(1)).withColumn("g", F.lit(2)).withColumn("idx", F.lit(3)).repartition(5)
    got = sorted(map(tuple, manifest.audit(docs).collect()), key=str)
    want = plain_manifest(rows, 2)
    assert got == sorted([w[:7] for w in want], key=str)
    assert any(w[6] for w in want) and not all(w[6] for w in want)
    assert {g[0] for g in got if not g[6]} == {i for i, _, _, _, n in rows if i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0}


@pytest.mark.parametrize("k", [3, 5])
def test_manifest_of_any_fanout(spark, k):
    rows = manifest_rows()[:60]
    got = [(r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.path]) for r in manifest.manifest(spark.createDataFrame(rows, DOCS), fanout=k).collect()]
    assert sorted(got) == sorted((w[1], w[2], w[3], w[7]) for w in plain_manifest(rows, k))


def test_manifest_of_no_or_one_row(spark):
    docs = spark.createDataFrame(manifest_rows()[:1], DOCS)
    assert manifest.audit(docs.limit(0)).count() == 0
    r = manifest.audit(docs).first()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == H("")


# ---- URL rules -----------------------------------------------------------
def plain_verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group(0)
    path = re.match(r"[^?#]*", rest[len(host):]).group(0)
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules
           if h and p is not None and v and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit) if fit else None
    return host, path, best and best[3], best[4] if best else default


URLS = ["http://example.com", "http://example.com/", "https://WWW.Example.COM/en/x?y=/en/", "http://a.b.example.com/en/", "http://notexample.com/en/1",
        "http://example.com./en/", "http://x.net/es/", "http://x.net/ESP", "http://net/fr/", "ftp://u:p@x.net:80/fr/a#b", "no scheme/en/", "://com/a", "x://",
        None, "", "http://?q", "http://é.com/ü/ßß", "http://É.com/ü/", "http://a..com/", "a://b://c.net/es/", "http://x.com/en/\n/z", "HTTP://.com/en", "http://com/"]


def test_url_rules_equal_plain_search(spark):
    rng = random.Random(4)
    rules = list(urlrules.RULES)
    for _ in range(120):
        host = ".".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) + rng.choice([".com", ".net", ".org"])
        rules.append((host, "/" + "".join(rng.choice("xy/") for _ in range(rng.randrange(0, 6))), rng.choice(["allow", "block"])))
    rules += rules[5:25] + [(h, p, "block" if v == "allow" else "allow") for h, p, v in rules[30:40]]
    rules += [(None, "/", "block"), ("", "/", "block"), ("com", None, "block"), ("net", "/", None), ("é.com", "/ü", "block"), ("org", "", "block")]
    urls = list(URLS)
    for _ in range(600):
        host = ".".join(rng.choice("abc") for _ in range(rng.randrange(0, 6))) + rng.choice([".com", ".net", ".org", ".de"])
        urls.append("http://" + host + "/" + "".join(rng.choice("xy/") for _ in range(rng.randrange(0, 8))))
    urls += ["http://a.com/x"] * 400 + ["http://a.com/" + "x" * 200_000]
    ids = [None if i % 97 == 5 else i // 2 for i in range(len(urls))]
    pages = spark.createDataFrame(list(zip(ids, urls, range(len(urls)), urls)), "page_id long, url string, host int, key string").repartition(6)
    got = urlrules.judge(pages, spark.createDataFrame(rules, urlrules.RULE_SCHEMA))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    norm = [(h and "".join(c.lower() if "A" <= c <= "Z" else c for c in h), p, v) for h, p, v in rules]
    want = collections.Counter((i, *plain_verdict(u, norm)) for i, u in zip(ids, urls))
    assert collections.Counter(map(tuple, got.collect())) == want
    kept = urlrules.keep(pages, spark.createDataFrame(rules, urlrules.RULE_SCHEMA))
    assert kept.columns == pages.columns
    assert collections.Counter(r.url for r in kept.collect()) == collections.Counter(u for u in urls if plain_verdict(u, norm)[3] == "allow")


def test_url_rules_of_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/"), (1, None)], "page_id long, url string")
    rules = urlrules.fixed_rules(spark)
    assert urlrules.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in urlrules.judge(pages, rules.limit(0), default="block").collect()} == {"block"}


def test_url_rules_use_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    plan = urlrules.judge(pages, urlrules.fixed_rules(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


# ---- collocations --------------------------------------------------------
def plain_phrases(rows, max_words, min_count, top, cover):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang, text = lang or "und", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    cand = {g: a for g, a in f.items() if len(g) > 2 and a >= min_count}
    inside = collections.defaultdict(int)
    for g, a in cand.items():
        for k in range(2, len(g) - 1):
            for i in range(1, len(g) - k + 1):
                part = (g[0], *g[i:i + k])
                inside[part] = max(inside[part], a)
    out = collections.defaultdict(list)
    for g, a in cand.items():
        if inside[g] and cover[1] * inside[g] >= cover[0] * a:
            continue
        cuts = [(10 ** 6 * a * a // (f[g[:k + 1]] * f[(g[0], *g[k + 1:])]), k, f[g[:k + 1]], f[(g[0], *g[k + 1:])]) for k in range(1, len(g) - 1)]
        score, _, l, r = min(cuts)
        out[g[0]].append((-score, -a, " ".join(g[1:]).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, v in out.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:top]))


def phrase_rows():
    rng = random.Random(8)
    vocab = ["The", "the", "of", "New", "York", "CITY", "über", "Ärger", "a", "x-y", "don't", "\u00a0", "日本"]
    rows = []
    for _ in range(300):
        parts = []
        for _ in range(rng.randrange(0, 40)):
            parts.append(rng.choice([rng.choice(vocab), "New York City", "state of the art", rng.choice(vocab)]))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ; ", "\x0b", "\r\n"]))
        rows.append((rng.choice(["en", "en", "de", None, "und"]), "".join(parts)))
    return rows + [("en", None), ("en", ""), ("de", " .,\n\t"), ("fr", "one two"), ("en", "hot pair " * 3000)] + [("en", "same row again")] * 40


@pytest.mark.parametrize("max_words", [2, 3, 4])
def test_collocations_equal_plain_counts(spark, max_words):
    rows = phrase_rows()
    docs = spark.createDataFrame([(t, v, 1, 2) for v, t in rows], "text string, lang string, n int, w1 int").repartition(7)
    got = phrases.collocations(docs, max_words=max_words, top=25)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, max_words, 10, 25, (50, 100))
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_collocations_of_a_text_longer_than_a_slice(spark):
    rows = [("en", "big apple pie, " * (phrases.SLICE // 12)), ("en", "big apple"), ("de", "ab cd " * 50)]
    docs = spark.createDataFrame([(t, v) for v, t in rows], "text string, lang string").coalesce(1)
    assert sorted(map(tuple, phrases.collocations(docs).collect())) == plain_phrases(rows, 3, 10, 2000, (50, 100))


def test_phrase_scores_beyond_64_bits(spark):
    big = 3_000_000_000_017
    d = spark.createDataFrame([(big, big + 5, big + 11)], "a long, l long, r long").select(
        phrases._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first().s
    assert d == 10 ** 6 * big * big // ((big + 5) * (big + 11))
