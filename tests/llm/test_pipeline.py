import base64
import hashlib

import brute
import public_tokenizers as P

import corpus_pipeline
from riskframe.llm import quality

SF = "/root/testdata/sf0.001"


def test_run_against_plain_definitions(spark, documents, pairs, same):
    import tiktoken
    kept = {r.doc_id for r in quality.score_documents(documents).where("kept").collect()}      # itself tested against plain EM
    rows = [(d, t) for d, t in pairs(documents) if d in kept]
    rows = brute.drop_lines(rows)
    near = brute.near(rows, 5)
    rows = [r for r, n in zip(rows, near) if n[3]]
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r, c in zip(rows, brute.contaminated(rows, items)) if not c[-1]]
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for d, t in rows:
        ids = enc.encode_ordinary(t)
        want.append((d, len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), brute.sha(t)))
    assert 0 < len(want) < documents.count()
    same(corpus_pipeline.run(spark, SF), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], want)


def test_stages_keep_columns_and_survive_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
            docs = spark.createDataFrame(out.collect(), out.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
