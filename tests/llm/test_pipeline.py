from __future__ import annotations

import os

import pytest
from conftest import ODD

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    import __spark_entry__ as e

    names = set(e.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no shared test tables")
def test_stages_keep_the_columns_and_act(spark, tmp_path):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    assert len(p.STAGES) == 5
    for k, (name, stage) in enumerate(p.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
        assert k == 4 or docs.columns == columns
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0 and counts[4] == counts[5] > 0
    assert {"doc_id", "ids", "begins", "ends"} <= set(docs.columns)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no shared test tables")
def test_stages_take_odd_and_empty_documents(spark, docs, tmp_path):
    import corpus_pipeline as p

    for texts in (ODD, []):
        for _, stage in p.STAGES:
            stage(spark, docs(texts).withColumnRenamed("score", "_stage_score"), SF).count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no shared test tables")
def test_every_stage_equals_a_plain_version(spark, tmp_path):
    """One row at a time, all pairs, and the library itself, over the smallest tables."""
    import zlib
    from collections import Counter

    import corpus_pipeline as p
    import sentencepiece
    import xxhash
    from waymark.llm import mixing, quality, simhash, toxicity
    from waymark.llm.queries import sentencepiece_model

    stages = dict(p.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    learnt = lambda k: zlib.crc32(str(k).encode()) % 4 != 2

    def through(name, frame):
        stages[name](spark, frame, SF).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    ids = lambda frame: sorted(r.doc_id for r in frame.select("doc_id").collect())
    all_rows = docs.collect()
    scores = {r.doc_id: r.score for r in quality.score_documents(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    good = through("quality_classifier", docs)
    assert ids(good) == sorted(r.doc_id for r in all_rows if scores[r.doc_id] >= 0.7)

    rows = good.collect()
    place = lambda k: (xxhash.xxh64_intdigest(k.to_bytes(8, "little"), 42) + 2**63) % 2**64 - 2**63
    sample = sorted((place(r.doc_id), r.doc_id, r.text, labels[r.doc_id].toxic) for r in rows if r.doc_id in labels and learnt(r.doc_id) and len(r.text or "") <= toxicity.LONGEST)
    model = toxicity.fit([x[2:] for x in sample])
    decent = through("toxicity", good)
    assert ids(decent) == sorted(r.doc_id for r in rows if toxicity.score(model, r.text) < 0.3)

    rows = decent.collect()
    sets = {r.doc_id: set(simhash.shingle_hashes(r.text, 5).tolist()) for r in rows}
    root = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and (len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    apart = through("simhash_near_dedup", decent)
    assert ids(apart) == sorted(set(root.values()))

    copies = {r.doc_id: r.copies for r in mixing.mix(apart).collect()}
    mixed = through("mixing", apart)
    assert Counter(ids(mixed)) == Counter({k: n for k, n in copies.items() if n})

    library = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model())
    texts = {r.doc_id: r.text for r in mixed.collect()}
    out = through("sentencepiece", mixed).collect()
    assert Counter(r.doc_id for r in out) == Counter(ids(mixed))
    assert all(r.ids == library.encode(texts[r.doc_id] or "", add_bos=True, add_eos=True) for r in out)
