import numpy as np

from chainsift.llm import cotraining


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet").collect()
    train = [r for r in labels if r.doc_id % 3]
    test = {r.doc_id: int(r.quality == 1 and not r.toxic) for r in labels if not r.doc_id % 3}
    got = {r.row.doc_id: r.score for r in cotraining.score_documents(docs, spark.createDataFrame(train)).collect()}
    assert len(got) == docs.count()
    right = {y: np.mean([(got[i] >= 0.5) == bool(y) for i, t in test.items() if t == y]) for y in (0, 1)}
    print(right)
    assert right[1] > 0.98 and right[0] > 0.85


def test_calibration_and_fit(rng):
    x = np.array([rng.gauss(0, 1) for _ in range(4000)])
    y = np.array([rng.random() < 1 / (1 + np.exp(-(2 * a - 1))) for a in x]).astype(int)
    assert np.allclose(cotraining.calibrate(x, y), [2, -1], atol=0.25)
    rows = [np.array([0, 2] if k % 2 else [1, 2]) for k in range(100)]
    p = cotraining.sigmoid(cotraining.margin(rows, cotraining.fit(rows, np.arange(100) % 2, 3)))
    assert (p[1::2] > 0.9).all() and (p[::2] < 0.1).all()


def test_odd_rows(spark):
    schema = "doc_id long, text string, source string, lang string, n_chars long, score int"
    docs = spark.createDataFrame([(1, None, None, None, None, 1), (None, "", "a", "b", -1, 2), (2, "x " * 50_000, "a", "b", 100_000, 3), (2, "x", "a", "b", 1, 3)], schema)
    marks = spark.createDataFrame([(1, 1, None), (None, 0, 0), (2, None, 1), (2, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    got = cotraining.score_documents(docs, marks).collect()
    assert len(got) == 4 and {r.score for r in got} == {0.5}
    assert {r.score for r in cotraining.score_documents(docs, marks.limit(0)).collect()} == {1.0}
    assert cotraining.score_documents(docs.limit(0), marks).count() == 0
    many = spark.createDataFrame([(i, "good words" if i % 2 else "bad words", "s", None, i, 0) for i in range(64)] + [(None, None, None, None, None, None)], schema)
    tags = spark.createDataFrame([(i, i % 2, 0) for i in range(48)], "doc_id long, quality int, toxic int")
    got = {r.row.doc_id: r.score >= 0.5 for r in cotraining.score_documents(many, tags).collect()}
    assert all(got[i] == bool(i % 2) for i in range(64)) and None in got


def test_scores_read_documents_alone(spark, tmp_path):
    schema = "doc_id long, text string, source string, lang string, n_chars long"
    docs = spark.createDataFrame([(i, "good words" if i % 2 else "bad words", "s", None, i) for i in range(64)], schema)
    docs.write.parquet(f"{tmp_path}/documents")
    docs = spark.read.parquet(f"{tmp_path}/documents")
    tags = spark.createDataFrame([(i, i % 2, 0) for i in range(48)], "doc_id long, quality int, toxic int")
    for marks in (tags, tags.where("quality = 1")):
        found = cotraining.score_documents(docs, marks)
        assert set(found.inputFiles()) == set(docs.inputFiles())  # no working copy of the rows
        assert found.count() == 64
