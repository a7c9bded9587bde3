import numpy as np

from jobsight.llm.quality import STATS, compiled, extract_rules, fit, holds, keep_good, op7_rule_ensemble, score_quality, statistics
from tests.conftest import SF_MID
from tests.llm.helpers import EDGE, documents


def test_held_out_accuracy_and_shape(spark):
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    got = op7_rule_ensemble(spark, SF_MID).collect()
    assert len(got) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    held = [r for r in got if r["held_out"] and r["doc_id"] in label]
    assert len(held) > 60 and np.mean([r["predicted"] == label[r["doc_id"]] for r in held]) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got)


def test_compiled_expression_equals_the_model(spark):
    rng = np.random.default_rng(0)
    x = rng.random((400, len(STATS)))
    y = ((x[:, 2] > 0.4) & (x[:, 5] < 0.7)).astype(float)
    intercept, rules = fit(x, y)
    assert rules and len(rules) < len(extract_rules(x, y))  # the penalty drops most
    want = 1 / (1 + np.exp(-(intercept + sum(w * holds(r, x) for r, w in rules))))
    assert ((want >= 0.5) == y).mean() > 0.97
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{s} double" for s in STATS))
    got = [r[0] for r in df.coalesce(1).select(compiled((intercept, rules)).alias("p")).collect()]
    assert np.allclose(got, want)


def test_edge_rows(spark):
    labels = spark.createDataFrame([(4, 0), (4, 1), (7, 1), (9, None), (None, 1), (99, 0)], "doc_id long, quality int")
    docs = documents(spark, EDGE)
    assert score_quality(docs, labels).count() == len(EDGE)
    none = labels.limit(0)
    assert {r["score"] for r in score_quality(docs, none).collect()} == {1.0}
    assert keep_good(docs, none).columns == docs.columns and keep_good(docs, none).count() == len(EDGE)
    assert score_quality(documents(spark, []), labels).count() == 0


def test_statistics_of_nothing_are_finite():
    assert all(np.isfinite(statistics(t)).all() for t in ("", " ", "\n", "a", "!!"))


def test_one_row_of_an_id_teaches(spark, monkeypatch):
    from jobsight.llm import quality

    docs = [(i, f"clean words here and there {i}. " * 5 if i % 2 else "!!@@ ## %% " * 9 + str(i)) for i in range(40)]
    docs += [(1, f"row {i} of one id") for i in range(3000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y, **how: seen.append(len(x)) or fit(x, y, **how))
    scored = quality.score_quality(documents(spark, docs), labels, max_rows=40)
    assert scored.count() == len(docs) and 0 < seen[0] <= 40


def test_scores_equal_the_rules_applied_by_hand(spark):
    from jobsight.llm.quality import learn

    docs = [(i, f"Clean words stand here, line {i}.\n" * (3 + i % 5) if i % 3 else "zz@@ 77## " * (5 + i % 9)) for i in range(300)]
    table, labels = documents(spark, docs), spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)], "doc_id long, quality int")
    intercept, rules = learn(table, labels)
    assert rules
    for r in score_quality(table, labels).collect():
        x = statistics(docs[r["doc_id"]][1])
        total = intercept + sum(w for rule, w in rules if all((x[s] <= cut) == at_most for s, at_most, cut in rule))
        assert abs(r["score"] - 1 / (1 + np.exp(-total))) < 1e-12 and r["predicted"] == (r["score"] >= 0.7)
