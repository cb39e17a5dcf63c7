"""Near duplicates and repeated strings against all-pairs definitions."""
import random
import re

import brute
import numpy as np
import pytest

from riskframe.llm import neardup as N
from riskframe.llm import suffix_dedup as S

NEAR = ["doc_id", "n_shingles", "component_id", "kept"]
CUT = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


@pytest.fixture(scope="module")
def families(spark):
    """Copies, near copies at many similarities, chains, and loose families that share most of a template."""
    rnd, rows = random.Random(4), []
    vocabulary = [f"v{i}" for i in range(400)]
    for f in range(6):
        base = [rnd.choice(vocabulary) for _ in range(120)]
        for k in range(14):
            words = list(base)
            for _ in range(k // 2):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            rows.append((1000 * f + rnd.randrange(900), " ".join(words)))
            if k % 3 == 0:
                base = words
    return spark.createDataFrame([(d, t) for d, t in dict(rows).items()], "doc_id long, text string")


def test_near_components(documents, odd_docs, no_docs, families, pairs, same):
    for docs in (documents, odd_docs, families):
        same(N.near_components(docs, 4), NEAR, brute.near(pairs(docs)))
    assert N.near_components(no_docs, 4).count() == 0


def test_hidden_links_are_found_in_blocks(families, pairs, same, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_SHINGLES", 300)
    same(N.near_components(families, 4), NEAR, brute.near(pairs(families)))


def test_keep_one(odd_docs, documents):
    out = N.keep_one(odd_docs)
    assert out.columns == odd_docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert len([d for d in ids if d is not None]) == len({d for d in ids if d is not None})
    assert ids.count(None) == 2


def test_keep_one_judges_texts_that_share_a_doc_id(spark):
    near = " ".join(f"w{i}" for i in range(100))
    rows = [(1, near), (2, near + " end"), (2, "a unique text of words that no other row of this table has"), (3, None), (3, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(repr, map(tuple, N.keep_one(docs).collect())))
    assert got == sorted(map(repr, [rows[0], rows[2], rows[3], rows[5]]))
    other = spark.createDataFrame([(1, near), (1, rows[2][1]), (2, near + " end")], "doc_id long, text string")
    assert {tuple(r) for r in N.keep_one(other).collect()} == {(1, near), (1, rows[2][1])}


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 200_000, dtype=np.uint64)
    whole = N.registers(N.minima([x]))
    parts = N.merge(N.registers(N.minima([x[:90_000]])), N.registers(N.minima([x[70_000:]])))
    assert (whole == parts).all()
    for j in (0.3, 0.6, 0.8, 0.95):
        n = 2000
        k = int(round(2 * n * j / (1 + j)))
        got = []
        for t in range(30):
            y = rng.integers(0, 2**63, 2 * n - k, dtype=np.uint64)
            a, b = N.registers(N.minima([y[:n], y[n - k:]]))
            est, ok = N.plausible(a[None], b[None], np.array([n]), np.array([n]))
            got.append(est[0])
            assert ok[0] or j < 0.8
        assert abs(np.mean(got) - j) < 0.03


def test_components_of_chains(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 4999)]
    rnd = random.Random(2)
    name = list(range(6000))
    rnd.shuffle(name)
    df = spark.createDataFrame([(name[a], name[b]) for a, b in edges], "a long, b long")
    got = {r.v: r.label for r in N.components(df).collect()}
    for group in (range(n + 1), range(1000, 1200), (4999, 5000)):
        least = min(name[i] for i in group)
        assert all(got[name[i]] == least for i in group)


@pytest.mark.parametrize("batches,many", [(1, S.MANY_RUNS), (3, 1)])
def test_repeats(documents, odd_docs, no_docs, pairs, same, batches, many):
    for docs in (documents, odd_docs):
        same(S.digest(docs, batches, many), CUT, brute.repeats(pairs(docs)))
    assert S.digest(no_docs).count() == 0


@pytest.mark.parametrize("block,many,batches", [(64, 10_000, 1), (1000, 0, 4), (37, 2, 5)])
def test_repeats_of_short_strings(spark, pairs, same, block, many, batches):
    """Small windows over texts full of overlaps, periods and shared passages."""
    rnd, rows = random.Random(block), []
    passages = ["".join(rnd.choice("abcdé") for _ in range(rnd.randrange(8, 60))) for _ in range(12)]
    for d in range(60):
        t = ""
        for _ in range(rnd.randrange(6)):
            t += rnd.choice(passages)[rnd.randrange(5):] + "".join(rnd.choice("xyz") for _ in range(rnd.randrange(9)))
        rows.append((d, t + "ab" * rnd.randrange(30) * (d % 7 == 0) + "q" * rnd.randrange(90) * (d % 9 == 0)))
    rows += [rows[3], (3, "another text under the same id " + passages[0] * 2), (None, passages[1] * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(S.digest(docs, batches, many, length=20, gram=11, block=block), CUT, brute.repeats(rows, 20))


def test_levels_merge_geometrically(spark, documents):
    family = S.indexed(documents.limit(60), batches=6)
    assert [n for n, _ in family.levels] == [4, 2]


def test_drop_repeats_keeps_columns(odd_docs):
    out = S.drop_repeats(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()


def test_words_and_strings_of_special_structure_stay_apart(spark):
    """Hashes modulo 2^64 take a Thue-Morse word and its complement for equal, whatever their constants."""
    word, other = ("".join(x[bin(i).count("1") % 2] for i in range(2048)) for x in ("ab", "ba"))
    docs = spark.createDataFrame([(1, word), (2, other), (3, word)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in N.near_components(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    apart = spark.createDataFrame([(1, word[:1024]), (2, other[:1024])], "doc_id long, text string")
    brute_rows = brute.repeats([(1, word[:1024]), (2, other[:1024])])
    got = sorted(tuple(r)[:4] for r in S.digest(apart).select("doc_id", "n_bytes", "n_removed", "n_spans").collect())
    assert got == sorted(r[:4] for r in brute_rows)


def test_window_prints_are_equal_where_bytes_are():
    rnd = np.random.default_rng(2)
    x = rnd.integers(0, 3, 4000).astype(np.uint8)
    p = S.window_prints(x, 7)
    by_bytes, by_print = {}, {}
    for i in range(len(p)):
        by_bytes.setdefault(x[i:i + 7].tobytes(), set()).add(int(p[i]))
        by_print.setdefault(int(p[i]), set()).add(x[i:i + 7].tobytes())
    assert all(len(v) == 1 for v in by_bytes.values()) and all(len(v) == 1 for v in by_print.values())


def test_columns_named_like_working_columns_pass(spark):
    from riskframe.llm import decontaminate, line_dedup, quality
    line = "the same line is in four documents here\n"
    text = " ".join(f"Word{i} is, here." for i in range(60))
    rows = [(i, f"{line}{text} {i}", *range(10 * i, 10 * i + 7)) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __hits int, __q_t int, __drop int, __d int, __spans int, __doc int, c0 int")
    extra = {r[0]: r[2:] for r in rows}
    bench = spark.createDataFrame([(1, "nothing of it")], "item_id long, text string")
    for out in (decontaminate.drop_contaminated(docs, bench), quality.keep_good(docs), line_dedup.dedup_lines(docs),
                N.keep_one(docs), S.drop_repeats(docs)):
        assert out.columns == docs.columns
        got = out.collect()
        assert all(tuple(r)[2:] == extra[r.doc_id] for r in got)


def test_suffix_query_scans_and_merges_levels(spark, tmp_path, monkeypatch):
    """The registered query inserts in batches, so levels are scanned and merged in it, and matches across batches are found."""
    from riskframe.llm import queries, suffix_dedup
    shared = "".join(chr(97 + i * i % 23) for i in range(30)) + "".join(f"{i * 7919 % 1000003} " for i in range(120))
    rows = [(i, f"head {i} {i * i} " + (shared if i % 2 else "") + f" tail {i * 31}") for i in range(24)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    families = []
    first = suffix_dedup.SuffixFamily.insert

    def insert(self, docs):
        families.append((self, [n for n, _ in self.levels]))
        first(self, docs)
    monkeypatch.setattr(suffix_dedup.SuffixFamily, "insert", insert)
    got = {r.doc_id: r.n_removed for r in queries.op2_suffix_dedup(spark, str(tmp_path)).collect()}
    assert [levels for _, levels in families] == [[], [1], [2]] and [n for n, _ in families[-1][0].levels] == [2, 1]
    assert all((n >= len(shared)) == bool(i % 2) and (i % 2 or n == 0) for i, n in got.items())
    whole = suffix_dedup.digest(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    assert {r.doc_id: r.n_removed for r in whole.collect()} == got


@pytest.mark.parametrize("many", [S.MANY_RUNS, 0])
def test_texts_move_once_after_indexing(spark, tmp_path, monkeypatch, many):
    """Fetching runs and cutting spans read one exchange of the texts, and no fingerprints of windows are written."""
    shared = "".join(f"{i * 7919 % 1000003} " for i in range(120))
    rows = [(i, f"head {i} {i * i} " + (shared if i % 2 else "") + f" tail {i * 31}") for i in range(24)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    kept, first = [], S.written

    def written(df, name):
        kept.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return first(df, name)
    monkeypatch.setattr(S, "written", written)
    out = S.digest(spark.read.parquet(f"{tmp_path}/documents.parquet"), many_runs=many)
    got = [tuple(r) for r in out.select(CUT).collect()]
    assert sorted(got) == sorted(brute.repeats(rows)) and any(r[2] for r in got)
    assert all("text#" not in plan for name, plan in kept if name != "suffix-level")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"FileScan parquet \[doc_id#\d+L?,text#", plan)) == 1 and "ReusedExchange" in plan


def test_prints_of_joined_runs_are_those_of_each():
    rnd = np.random.default_rng(5)
    runs = [rnd.integers(0, 256, n).astype(np.uint8).tobytes() for n in (9, 400, 7, S._JOINED + 50, 8, 30)]
    for a, b in zip(S.prints_of(runs, 7), runs):
        assert (a == S.window_prints(np.frombuffer(b, np.uint8), 7)).all()
