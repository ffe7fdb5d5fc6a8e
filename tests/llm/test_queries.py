"""The corpus queries on the smallest tables, against DuckDB where SQL states them, and the pipeline."""
import collections
import os
import random
import re
import sys

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline as P
from dockline.llm import decontaminate, mixing
from dockline.llm import queries as Q

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from check_oracle import rows_of  # noqa: E402

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    return c


def test_every_operator_has_its_query():
    assert sorted(int(k[2:].split("_")[0]) for k in Q.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(Q.ORACLE))
def test_matches_oracle(spark, con, key):
    df = Q.QUERIES[key](spark, D)
    rows = df.collect()
    res = con.execute(Q.ORACLE[key])
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, rows) == rows_of(cols, res.fetchall())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    assert len(P.STAGES) == 5
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, D)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), D).count() == 0
    rows = P.run(spark, D).collect()
    assert 0 < len(rows) < docs.count() and len({r.doc_id for r in rows}) == len(rows)
    assert all(r.taken <= 3 * r.size for r in rows)


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _one_of_each(texts):
    """The ids of ``texts`` that are the smallest of their class of near duplicates, over all pairs."""
    units = {}
    for d, t in texts.items():
        w = _words(t)
        units[d] = collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()
    label = {d: d for d in texts}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    ids = sorted(texts)
    size = {d: sum(u.values()) for d, u in units.items()}
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if 5 * min(size[a], size[b]) >= 4 * max(size[a], size[b]) > 0:
                both = sum((units[a] & units[b]).values())
                if 5 * both >= 4 * (size[a] + size[b] - both):
                    x, y = find(a), find(b)
                    label[max(x, y)] = min(x, y)
    return {d for d in ids if find(d) == d}


def _distance(item, text):
    """Fewest edits, in words, from ``item`` to any run of ``text``: a row of the table for each word of the item."""
    row, step = np.zeros(len(text) + 1, np.int64), np.arange(len(text) + 1)
    for i, w in enumerate(item):
        new = np.concatenate([[i + 1], np.minimum(row[1:] + 1, row[:-1] + (text != w))])
        row = np.minimum.accumulate(new - step) + step
    return row.min()


def test_pipeline_equals_a_plain_chain(spark, tmp_path):
    docs, bench = pq.read_table(f"{D}/documents.parquet"), pq.read_table(f"{D}/benchmark.parquet")
    rows, items = docs.to_pylist(), [x for x in bench["text"].to_pylist() if x]
    long = [r for r in rows if len(_words(r["text"])) > 80]
    more, rng = [], random.Random(5)
    for n, r in enumerate(long[:45]):                      # copies; the same words in other lines; other texts with a benchmark item
        w = _words(r["text"])
        if n >= 30:
            rng.shuffle(w)
            w[40:40] = _words(items[n % len(items)])
        text = "\n".join(" ".join(w[k:k + 27]) for k in range(0, len(w), 27))
        more.append({**r, "doc_id": 100_000 + n, "text": r["text"] if n < 15 else text})
    more += [{**rows[0], "doc_id": 200_000 + n, "text": t} for n, t in enumerate((None, "", " \n "))]
    pq.write_table(pa.Table.from_pylist(rows + more, docs.schema), f"{tmp_path}/documents.parquet")
    pq.write_table(bench, f"{tmp_path}/benchmark.parquet")
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    documents = c.execute("SELECT doc_id, lang, source, text FROM documents").fetchall()
    # quality rules and line dedup by their SQL, each over what the stage before left
    kept = {d for d, ok in c.execute(f"SELECT doc_id, kept FROM ({Q.ORACLE['op9_quality_rules']})").fetchall() if ok}
    c2 = duckdb.connect()
    c2.execute(f"CREATE TABLE documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet') WHERE doc_id IN ({', '.join(map(str, kept))})")
    lines = c2.execute(f"SELECT doc_id, text, n_removed FROM ({Q.ORACLE['op4_line_dedup']})").fetchall()
    texts = {d: t for d, t, n in lines if not n or _words(t)}
    left = _one_of_each(texts)
    items = [decontaminate.tokens(t) for (t,) in c.execute("SELECT text FROM benchmark").fetchall()]
    number = collections.defaultdict(lambda: len(number))
    items = [np.array([number[w] for w in x]) for x in items if x]
    toks = {d: np.array([number[w] for w in decontaminate.tokens(texts[d])], np.int64) for d in left}
    clean = {d for d in left if not any(_distance(x, toks[d]) <= decontaminate.limit(len(x)) for x in items)}
    assert len(kept) < len(documents) and any(n for *_, n in lines)
    assert len(left) < len(texts) and len(clean) < len(left)
    source, size = {d: s for d, _, s, _ in documents}, {d: len(_words(texts[d])) for d in clean}
    totals = collections.Counter()
    for d in clean:
        totals[source[d]] += size[d]
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weigh, share = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, {}
    while True:                                            # targets over three times their source stop there
        rest = [s for s in order if s not in share]
        per = (sum(totals.values()) - sum(share.values())) / (sum(weigh[s] for s in rest) or 1)
        over = {s: 3 * totals[s] for s in rest if per * weigh[s] > 3 * totals[s]}
        if not over:
            break
        share.update(over)
    share.update({s: per * weigh[s] for s in rest})
    rows = P.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.size, r.source_size) for r in rows} == {d: (size[d], totals[source[d]]) for d in clean}
    taken = collections.Counter()
    for r in rows:
        assert abs(r.target - share[source[r.doc_id]]) < 1e-6 and r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - share[s]) <= 0.05 * share[s] + 2 * mixing.BLOCK_WORDS for s in order)
