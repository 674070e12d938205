"""Each stage against its definition, on what the stage before kept."""

import corpus_pipeline as P
from ledgerloom.llm import queries
from ledgerloom.llm.exact_dedup import text_digest
from ledgerloom.llm.near_dedup import similar_groups
from ledgerloom.llm.toxicity import score

from .test_tokens import check_pieces


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, []
    for number, (name, stage) in enumerate(P.STAGES):
        out = f"file://{tmp_path}/{number}"
        stage(spark, docs, sf_dir).write.parquet(out)
        before, docs = docs, spark.read.parquet(out)
        rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()} if name != "packing" else {}
        kept.append((before, docs, rows))
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact dedup", "near dedup", "mixing", "packing"]
    for _, after, rows in kept[:-1]:
        assert after.columns == columns and after.count() == len(rows)

    all_docs, _, clean = kept[0]
    scores = {r.doc_id: r.score for r in score(all_docs, queries.toxicity_model(spark, all_docs, sf_dir)).collect()}
    assert set(clean) == {k for k, s in scores.items() if s < 0.3}

    largest = {}
    for k, t in clean.items():
        largest[text_digest(t)] = max(k, largest.get(text_digest(t), k))
    assert set(kept[1][2]) == set(largest.values())

    groups = {r.doc_id: r.component_id for r in similar_groups(kept[2][0]).collect()}
    assert set(kept[2][2]) == set(groups.values())

    tokens = {k: len((t or "").split()) for k, t in kept[2][2].items()}
    taken = sum(tokens[k] for k in kept[3][2])
    assert set(kept[3][2]) <= set(tokens) and 0.85 * sum(tokens.values()) < taken <= sum(tokens.values())

    check_pieces(kept[4][1].collect(), kept[3][2].items())


def test_run(spark, sf_dir):
    got = P.run(spark, sf_dir)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.count() > 0


def test_stages_on_empty_documents(spark, sf_dir, empty):
    for _, stage in P.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
