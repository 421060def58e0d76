import numpy as np

from freshcat.llm import quality_classifier as C
from freshcat.llm.common import table
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, score string, kept string"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = C.fit_on_labels(docs, labels.where("doc_id % 5 != 0"))
    rated = labels.where("doc_id % 5 = 0").select("doc_id", C.grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    got = C.grade_documents(docs, model).join(rated, "doc_id").toPandas()
    good = got["grade"] == 2
    assert got.loc[good, "kept"].mean() >= 0.95
    assert 1 - got.loc[~good, "kept"].mean() >= 0.8
    means = got.groupby("grade")["expected_grade"].mean()
    assert means[0] < means[2] and means[1] < means[2]


def test_gradient_finds_the_maximum_of_a_small_problem():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 6, 3)) for _ in range(400)]
    true = np.array([2.0, -2.0, 1.0, -1.0, 0.0, 0.5])
    score = np.array([true[r].sum() for r in rows]) + rng.logistic(size=400)
    grades = np.digitize(score, [-1.0, 1.0])
    model = C.fit(rows, grades, size=6, rounds=800, decay=1e-5)

    def loss(w, theta):
        s = np.array([w[r].sum() for r in rows])
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        cdf = lambda x: 1 / (1 + np.exp(-np.clip(x, -50, 50)))
        return -np.mean(np.log(cdf(edge[grades + 1] - s) - cdf(edge[grades] - s)))

    best = loss(model.weights, model.thresholds)
    assert model.thresholds[0] < model.thresholds[1]
    for k in range(6):
        for step in (0.1, -0.1):
            moved = model.weights.copy()
            moved[k] += step
            assert loss(moved, model.thresholds) >= best - 1e-4
    assert best < loss(np.zeros(6), np.array([-1.0, 1.0]))


def test_hard_rows(spark):
    docs = spark.createDataFrame([(1, None, "a", "b"), (2, "", "", ""), (None, "good text here", "", ""), (3, "bad " * 5000, "", ""), (3, "bad " * 5000, "", "")], SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 0), (3, 0, 0), (3, 0, 0), (9, 1, 1)], "doc_id long, quality int, toxic int")
    got = C.grade_documents(docs, C.fit_on_labels(docs, labels)).collect()
    assert len(got) == 5 and all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in got)
    none = C.fit_on_labels(docs, labels.where("false"))
    assert all(r.kept for r in C.grade_documents(docs, none).collect())
    assert C.grade_documents(spark.createDataFrame([], SCHEMA), none).collect() == []


def slow_features(text, size):
    """Features of a text word by word, in plain Python."""
    def bucket(kind, word):
        import xxhash

        h = xxhash.xxh64_intdigest(word.encode(), xxhash.xxh64_intdigest(kind.encode(), 42))
        return (h - (1 << 64) if h >> 63 else h) % size

    import re

    words = re.findall("[^\x20\x09-\x0d]+", text)
    plain = re.split(r"(?:[\W_])+", text.lower())
    share = 10 * len(set(words)) // max(len(words), 1)
    return {bucket("written", w) for w in words}, {bucket("plain", w) for w in plain}, bucket("distinct", str(share))


def test_scores_of_every_row_from_features_in_plain_python(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = C.fit_on_labels(docs, table(spark, "/root/testdata/sf0.001", "labels"))
    assert np.count_nonzero(model.weights) > 50
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in C.grade_documents(docs, model).collect():
        written, plain, share = slow_features(texts[r.doc_id], len(model.weights))
        score = sum(model.weights[list(written)]) + sum(model.weights[list(plain)]) + model.weights[share]
        tails = [1 / (1 + np.exp(t - score)) for t in model.thresholds]
        assert max(abs(r.score - score), abs(r.expected_grade - sum(tails)), abs(r.tail_probability - tails[1])) < 3e-6
        assert r.kept == (r.tail_probability >= 0.5)


def test_the_fit_uses_all_of_a_very_long_text(spark):
    """Words at every place of texts of 50,000 words get a weight; chunks of sums change nothing."""
    long = " ".join(f"u{k}" for k in range(50_000))
    docs = spark.createDataFrame([(k, (long if k < 3 else "short text") + f" own{k}", "", "") for k in range(6)], SCHEMA)
    labels = spark.createDataFrame([(k, int(k >= 3), 0) for k in range(6)], "doc_id long, quality int, toxic int")
    model = C.fit_on_labels(docs, labels)
    written, plain, _ = slow_features(long, len(model.weights))
    assert all(model.weights[f] != 0 for f in written | plain)
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 300, 40)) for _ in range(200)]
    grades = rng.integers(0, 3, 200)
    whole = C.fit(rows, grades, size=300, rounds=20)
    C.CHUNK, kept = 501, C.CHUNK
    try:
        parts = C.fit(rows, grades, size=300, rounds=20)
    finally:
        C.CHUNK = kept
    assert np.allclose(whole.weights, parts.weights) and np.allclose(whole.thresholds, parts.thresholds)
