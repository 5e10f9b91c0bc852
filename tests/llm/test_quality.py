import numpy as np

from varloom.llm import quality, queries

SF = "/root/testdata/sf0.01"


def test_trees_walk_like_plain_loops():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, quality.STATISTICS))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = quality.fit(x, y)
    got = trees.scores(x)
    for i in range(0, 800, 80):
        total = trees.start
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if x[i, f[node]] > t[node] else 1)
            total += leaf[node - len(f)]
        assert abs(got[i] - 1 / (1 + np.exp(-total))) < 1e-12
    assert ((got > 0.5) == y).mean() > 0.97


def test_held_out_labels_are_told_apart(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = queries.op4_quality(spark, SF)
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert scored.filter("score < 0 or score > 1 or score is null or predicted != int(score >= 0.3)").count() == 0
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_nulls_empties_repeats_no_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1), (2, 0), (9, None), (None, 1)], "doc_id long, quality int")
    trees = quality.learn(docs, labels)
    scores = [r.s for r in docs.select(quality.score(trees).alias("s")).collect()]
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
    none = quality.learn(docs, labels.limit(0))
    assert {r.s for r in docs.select(quality.score(none).alias("s")).collect()} == {0.5}
    one = quality.learn(docs, labels.filter("quality = 1"))
    assert min(r.s for r in docs.select(quality.score(one).alias("s")).collect()) > 0.9
    assert docs.limit(0).select(quality.score(trees).alias("s")).collect() == []
    assert quality.statistics("") == [0.0] * quality.STATISTICS and len(quality.statistics("a\n\nb")) == quality.STATISTICS
