"""Filter interaction audit, exact top-k search and source divergence audit against plain definitions."""
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from riskframe.llm import filter_audit, source_divergence, topk_search

AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit_brute(docs, labels):
    """docs: (doc_id, text, source); every order is run, filter by filter."""
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    label = defaultdict(lambda: [0, 0])
    for d, good, toxic in labels:
        label[d][0] |= good == 1
        label[d][1] |= toxic == 1
    rows = defaultdict(list)
    for d, t, s in docs:
        t = t or ""
        w = brute.words_ws(t)
        fails = {x for x, bad in zip("ABCDE", (
            len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            re.search("[#$%&*|]", t), d is not None and d > first[t])) if bad}
        rows[s or ""].append((fails, *(label[d] if d is not None else (0, 0))))
    out, total = [], Counter()
    for part, all_docs in rows.items():
        for order in map("".join, itertools.permutations("ABCDE")):
            left = all_docs
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[0]]
                left = [r for r in left if x not in r[0]]
                total[part, x] += len(gone)
                fail = sum(x in r[0] for r in all_docs)
                out.append([part, order, step, len(left), len(gone), fail - len(gone), sum(r[0] == {x} for r in all_docs),
                            sum(r[1] for r in gone), sum(r[2] for r in gone), x])
    return [(*r[:-1], total[r[0], r[-1]]) for r in out]


def test_filter_audit_runs_every_order(spark, documents, odd_docs, no_docs, same):
    schema = "doc_id long, quality int, toxic int, n int"
    odd = [(1, 1, 0, 0), (1, 0, 1, 0), (None, 1, 1, 0), (4, None, None, 0), (9, 1, 1, 0), (11, 0, 1, 0), (999, 1, 1, 0)]
    given = [(r.doc_id, r.quality, r.toxic, 0) for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()]
    for docs, labels in ((documents, given), (odd_docs, odd)):
        rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
        got = filter_audit.audit(docs, spark.createDataFrame(labels, schema))
        same(got, AUDIT, audit_brute(rows, [x[:3] for x in labels]))
    none = spark.createDataFrame([], schema)
    assert filter_audit.audit(no_docs, none).count() == 0


def test_potential_gives_the_mean_over_orders(spark):
    """Any number of filters: n! times the Shapley value is the sum over the orders of what is removed."""
    rnd = random.Random(3)
    rows = [("p", m, rnd.randrange(50), 0, 0) for m in range(8)]
    games = filter_audit.games(spark.createDataFrame(rows, "part string, mask int, n long, good long, toxic long"), "XYZ")
    r = filter_audit.potentials(games, "XYZ").first()
    count = {m: n for _, m, n, _, _ in rows}
    for i in range(3):
        want = 0
        for order in itertools.permutations(range(3)):
            before = sum(1 << j for j in order[:order.index(i)])
            want += sum(n for m, n in count.items() if m >> i & 1 and not m & before)
        assert r.potential[7] - r.potential[7 ^ 1 << i] == want


def topk_brute(rows, every=50, k=5):
    ok = [(n, i, [math.floor(256 * float(x)) for x in v]) for n, (i, v) in enumerate(rows)
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q in ok:
        if i is None or i % every:
            continue
        scores = [(-sum(a * b for a, b in zip(q, v)), j is None, j) for m, j, v in ok if m != n and len(v) == len(q)]
        best = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out += [(i, at, j, -s) for at, (s, _, j) in enumerate(best, 1)]
    return out


TOPK = ["query_id", "rank", "vec_id", "score"]


def test_topk_search_equals_all_products(spark, same):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    same(topk_search.search_table(vectors), TOPK, topk_brute(rows))
    # several blocks of queries, k of one, nothing left out: each row is its own best or better
    got = topk_search.top_k(vectors, vectors.where("vec_id < 30"), 1, leave_out_self=False, query_block=7).collect()
    ints = {i: np.floor(256 * np.array(v, dtype=float)) for i, v in rows}
    assert {(r.query_id, r.score) for r in got} == {(i, max(int(ints[i] @ x) for x in ints.values())) for i in range(30)}


def test_topk_search_odd_vectors(spark, same):
    rnd = random.Random(5)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(6)]) for i in range(150)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(200, 320)]               # a third are one vector: ties
    rows += [(100, [0.5] * 6), (100, [0.5] * 6), (100, [0.25] * 6), (50, rows[50][1])]   # repeated ids, repeated rows
    rows += [(400, None), (401, [0.1, None, 0.2, 0.3, 0.1, 0.1]), (450, [float("nan")] + [0.0] * 5),
             (402, [float("inf")] + [0.0] * 5), (None, [2.0] * 6), (500, [1.0, -1.0]), (501, [-1.0, 1.0]), (550, []), (551, []),
             (-50, [0.0] * 6), (600, [9.0] * 6), (650, [1e5, -1e6, 3e6] * 2), (651, [1e6, 1e6, 1e6] * 2)]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, rank int, vec string").repartition(5)
    same(topk_search.search_table(df), TOPK, topk_brute(rows))
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    same(topk_search.search_table(few), TOPK, [(0, 1, 1, 256 * 512)])
    assert topk_search.search_table(few.limit(0)).count() == 0


def test_topk_scores_past_64_bits_are_the_nearest(spark, same):
    df = spark.createDataFrame([(0, [1e12, 1.0]), (1, [1e12, 0.0]), (2, [-1e12, 0.0])], "vec_id long, embedding array<double>")
    same(topk_search.search_table(df), TOPK, [(0, 1, 1, 2 ** 63 - 1), (0, 2, 2, -2 ** 63)])


def divergence_brute(docs, least=3, top=200):
    langs = defaultdict(list)
    for t, lang, source in docs:
        langs[lang or ""].append((source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", brute.lower(t or "")))))
    out = []
    for lang, rows in langs.items():
        df = Counter(t for _, c in rows for t in c)
        kept = sorted(t for t in df if df[t] >= least)
        groups = defaultdict(Counter)
        for s, c in rows:
            groups[s].update(c)
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def share(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (n + len(kept)) for t in kept}
        p, of_lang = {s: share(c) for s, c in groups.items()}, share(whole)

        def f(a, b):
            return (a - b) ** 2 // b
        for s, c in groups.items():
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, f(p[s][t], of_lang[t])) for t in kept if c[t] > 0 and p[s][t] > of_lang[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, at) for at, (i, v) in enumerate(items[:limit], 1)]
    return out


DIVERGENCE = ["lang", "source", "part", "item", "value", "rank"]


@pytest.mark.parametrize("spill,tile", [(source_divergence.SPILL_CELLS, source_divergence.GROUP_TILE), (50, 2)])
def test_source_divergence(spark, odd_docs, same, spill, tile):
    """Bounds of memory (cells before a spill, groups in a broadcast) do not change the result."""
    rnd = random.Random(1)
    words = ["Alpha", "beta", "Ärger", "日本", "x1y", "the", "THE", "don't", "zeta", "\U0001f600"]
    rows = [(" ".join(rnd.choices(words, k=rnd.randrange(30))), rnd.choice(["en", "de", None, ""]), rnd.choice("abc"), i) for i in range(60)]
    rows += [("only here only here", "fr", "one", 0), (None, "en", "without terms", 0), ("!!! 123", "en", None, 0), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string, value long").repartition(3)
    for d in (docs, odd_docs.selectExpr("text", "CAST(NULL AS STRING) AS lang", "source")):
        given = [(r.text, r.lang, r.source) for r in d.collect()]
        same(source_divergence.audit(d, spill_cells=spill, group_tile=tile), DIVERGENCE, divergence_brute(given))


def test_source_divergence_of_the_table(documents, no_docs, same):
    given = [(r.text, r.lang, r.source) for r in documents.collect()]
    same(source_divergence.audit(documents), DIVERGENCE, divergence_brute(given))
    assert source_divergence.audit(no_docs).count() == 0


def test_shares_are_exact_beyond_64_bit_products():
    c, n, v = np.array([0, 5, 10 ** 12, 10 ** 13], dtype=np.int64), 10 ** 14, 10 ** 7
    assert [int(x) for x in source_divergence.share(c, np.int64(n), v)] == [1 + 10 ** 9 * (int(x) + 1) // (n + v) for x in c]
