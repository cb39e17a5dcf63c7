import brute
import duckdb
import numpy as np
import pytest

from riskframe.llm import line_dedup as L

COLS = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]


def test_against_brute_force(documents, odd_docs, no_docs, pairs, same):
    for docs in (documents, odd_docs):
        same(L.dedup_digest(docs), COLS, brute.lines(pairs(docs)))
    assert L.dedup_digest(no_docs).count() == 0


def test_oracle_agrees(documents, same):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = [tuple(r) for r in con.execute(L.ORACLE).fetchall()]
    same(L.dedup_digest(documents), COLS, want)


def test_clean_keeps_columns_and_matches_digest(odd_docs):
    out = L.dedup_lines(odd_docs)
    assert out.columns == odd_docs.columns
    got = sorted((repr(r.doc_id), brute.sha(r.text or "")) for r in out.collect())
    assert got == sorted((repr(r.doc_id), r.kept_sha256) for r in L.dedup_digest(odd_docs).collect())


@pytest.mark.parametrize("shard_keys", [L.SHARD_KEYS, 1])
def test_deletion_reverses_insertion(spark, pairs, same, shard_keys):
    rows = [(i, f"this is a shared licence line {i % 4}\nown line of document number {i:04d}\n") for i in range(40)]
    first = spark.createDataFrame(rows[:25], "doc_id long, text string")
    more = spark.createDataFrame(rows[25:], "doc_id long, text string")
    gone = spark.createDataFrame([r for r in rows if r[0] % 4 == 1 and r[0] > 4], "doc_id long, text string")
    index = L.LineIndex(spark, shard_keys=shard_keys)
    index.insert(first)
    same(index.digest(first), COLS, brute.lines(rows[:25]))
    index.insert(more)
    both = first.union(more)
    same(index.digest(both), COLS, brute.lines(rows))
    index.delete(gone)                                   # line 1 is in one document now: nothing of it is dropped
    left = [r for r in rows if not (r[0] % 4 == 1 and r[0] > 4)]
    same(index.digest(spark.createDataFrame(left, "doc_id long, text string")), COLS, brute.lines(left))
    index.insert(gone)
    same(index.digest(both), COLS, brute.lines(rows))


def test_cuckoo_filter_inserts_and_deletes():
    rng = np.random.default_rng(3)
    k = rng.integers(-2**62, 2**62, (5000, 2))
    f = L.CuckooFilter.build(k[:, 0], k[:, 1])
    assert f.contains(k[:, 0], k[:, 1]).all()
    other = rng.integers(-2**62, 2**62, (20000, 2))
    assert f.contains(other[:, 0], other[:, 1]).mean() < 0.002
    f.delete(k[:2500, 0], k[:2500, 1])
    assert f.contains(k[2500:, 0], k[2500:, 1]).all()
    assert f.contains(k[:2500, 0], k[:2500, 1]).mean() < 0.01
    assert L.CuckooFilter.of(f.raw()).contains(k[2500:, 0], k[2500:, 1]).all()
