"""The queries themselves: over the small tables, over empty ones, and what their models tell of labels they have not seen."""

import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from qualia.llm import ordinal, queries  # noqa: E402

SF = "/root/testdata/sf0.001"
ROWS = {"op2_main_text": "pages", "op4_toxicity": "documents", "op6_token_files": "documents", "op10_ordinal_grades": "documents", "op11_align_tokenizers": "documents",
        "op13_periodic_runs": "documents"}


@pytest.mark.parametrize("name", sorted(ROWS))
def test_a_row_for_each_row(spark, name):
    assert queries.QUERIES[name](spark, SF).count() == queries.read(spark, SF, ROWS[name]).count()


def test_token_counts_and_nearest(spark):
    docs = queries.read(spark, SF, "documents").count()
    got = queries.op3_token_counts(spark, SF).collect()
    assert sum(r.docs for r in got) == docs == max(r.docs_up_to for r in got)
    vectors = queries.read(spark, SF, "embeddings")
    near = queries.op5_nearest(spark, SF).collect()
    v = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect()}
    asked = [q for q in v if q % 20 == 0]
    assert len(near) == 20 * len(asked)
    hit = []
    for q in asked:
        ids = np.array([k for k in sorted(v) if k != q])
        best = set(ids[np.argsort(-np.stack([v[k] for k in ids]) @ v[q], kind="stable")[:20]].tolist())
        hit.append(len(best & {r.vec_id for r in near if r.query_id == q}) / 20)
    assert np.mean(hit) >= 0.95


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "pages", "labels", "benchmark", "embeddings"):
        queries.read(spark, SF, t).limit(0).write.parquet(f"file://{path}/{t}.parquet")
    return f"file://{path}"


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op9_near_duplicates"}))
def test_empty_tables_give_no_rows(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).count() == 0


def test_toxicity_of_documents_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = queries.read(spark, sf, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    got = queries.op4_toxicity(spark, sf).where("held_out").join(labels, "doc_id").where("toxic is not null").collect()
    toxic, clean = [r for r in got if r.toxic == 1], [r for r in got if r.toxic == 0]
    assert len(toxic) > 10 and len(clean) > 100
    a, b = (np.array([r.score for r in x]) for x in (toxic, clean))
    above = np.mean([(x > b).mean() + (x == b).mean() / 2 for x in a])  # of a toxic one against a clean one
    print("area", above, "found", np.mean(a >= 0.3), "clean marked", np.mean(b >= 0.3))
    assert above >= 0.9 and np.mean(a >= 0.3) >= 0.8 and np.mean(b >= 0.3) <= 0.02


def test_grades_of_documents_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs = queries.read(spark, sf, "documents").select("doc_id", "text")
    labels = ordinal.rated(queries.read(spark, sf, "labels"))
    model = ordinal.train(docs, labels.where("doc_id % 4 <> 2"), ordinal.label_grade(), ordinal.LEVELS)
    held = labels.where("doc_id % 4 = 2").withColumn("grade", ordinal.label_grade()).where("grade is not null").select("doc_id", "grade").dropDuplicates(["doc_id"])
    got = ordinal.score(docs.join(held, "doc_id"), model).collect()
    poor, good = [r for r in got if r.grade == 0], [r for r in got if r.grade == 2]
    assert len(poor) > 10 and len(good) > 100
    assert np.mean([r.tail_probability[0] < 0.5 for r in poor]) >= 0.9
    assert np.mean([r.tail_probability[0] >= 0.5 for r in good]) >= 0.95


def test_ordinal_fit_is_the_least_of_its_loss():
    """The loss written out plainly, no parameter of the fit moved by a little makes it less."""
    rng = np.random.default_rng(1)
    n, levels = 300, 4
    bucket = rng.integers(0, 6, 2 * n)
    who = np.repeat(np.arange(n), 2)
    grade = np.clip((np.bincount(who, bucket) + rng.integers(-2, 3, n)) // 4, 0, levels - 1).astype(np.int64)
    value = np.full(2 * n, 0.7)
    m = ordinal.fit(who, bucket, value, grade, levels, steps=2000, ridge=1e-3)

    def loss(w, t):
        tail = 1 / (1 + np.exp(-(np.bincount(who, w[bucket] * value)[:, None] - t[None, :])))
        p = -np.diff(np.concatenate([np.ones((n, 1)), tail, np.zeros((n, 1))], 1), axis=1)
        return -np.log(p[np.arange(n), grade]).mean() + 1e-3 * ((w / 10) ** 2).sum() / 2

    best = loss(m.weights, m.thresholds)
    for k in range(6):
        for step in (-0.3, 0.3):
            w = m.weights.copy()
            w[k] += step
            assert loss(w, m.thresholds) > best - 1e-4
    for k in range(levels - 1):
        for step in (-0.2, 0.2):
            t = m.thresholds.copy()
            t[k] += step
            assert loss(m.weights, t) > best - 1e-4
