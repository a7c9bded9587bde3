import corpus_pipeline as C
from jobsight.llm.decontaminate import normal
from tests.conftest import SF_SMALL
from tests.llm.test_minhash import shingles
from tests.llm.test_pii import literal


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [normal(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = {}
    from jobsight.llm.common import saved

    for name, stage in C.STAGES[:-1]:
        out = saved(stage(spark, docs, SF_SMALL), "stage")
        assert out.columns == docs.columns
        kept[name] = {r["doc_id"]: r["text"] for r in out.collect()}
        docs = out
    good = kept["quality"]
    assert sum(label.get(d, 1) for d in good) >= 0.95 * len(good) and len(good) > 150
    # Near-duplicates: no two survivors are linked, and every one that went is linked to a group with a survivor.
    sets = {d: shingles(t) for d, t in good.items()}
    stay = kept["near_dedup"]

    def linked(a, b):
        return bool(sets[a] and sets[b]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])

    ids = sorted(stay)
    assert not [1 for i, a in enumerate(ids) for b in ids[:i] if linked(a, b)]
    assert all(any(linked(d, e) for e in good if e < d) for d in good if d not in stay)
    # Benchmark passages: exactly the documents with one are gone (this table holds them verbatim).
    clean = kept["decontaminate"]
    assert {d for d in stay if not any((i if len(i) >= 20 else f" {i} ") in f" {normal(stay[d])} " for i in items if i)} == set(clean)
    assert set(kept["personal_data"]) == set(clean)
    assert all(not [x for x in literal(t) if x[0] == "email"] for t in kept["personal_data"].values())
    packed = C.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert {r["doc_id"] for r in packed} == set(clean) and all(len(r["ids"]) == r["length"] for r in packed)


def test_run_gives_the_last_stage(spark):
    got = C.run(spark, SF_SMALL)
    assert {"doc_id", "piece", "ids", "sequence_id", "offset"} <= set(got.columns) and got.count() > 100
