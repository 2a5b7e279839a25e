import zlib

import numpy as np
from pyspark.sql import functions as F

from cohortlift.llm import toxicity
from cohortlift.llm.common import read

LARGER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = read(spark, LARGER, "documents"), read(spark, LARGER, "labels")
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert len(toxic) > 20
    # 352 toxic rows to learn from; some families of words have a few rows each
    assert np.mean([r.predicted for r in toxic]) >= 0.7 and np.mean([r.predicted for r in clean]) <= 0.04
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = read(spark, "/root/testdata/sf0.001", "documents"), read(spark, "/root/testdata/sf0.001", "labels")
    s = toxicity.Settings(rounds=20, mean_rounds=10)
    turned = labels.withColumn("toxic", F.when(toxicity.is_held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert np.array_equal(toxicity.fit(docs, labels, s), toxicity.fit(docs.withColumn("lang", F.lit("zz")), turned.repartition(3), s))


def test_misspellings_share_ngrams():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(300)]
    texts, y = [], []
    for i in range(300):
        t = list(rng.choice(words, 40))
        if i % 2:
            t[int(rng.integers(40))] = "scoundrel"
        texts.append(" ".join(t))
        y.append(i % 2)
    s = toxicity.Settings()
    scorer = toxicity.Scorer(toxicity.train(texts, np.array(y), s), s)
    plain = " ".join(words[:24])
    assert scorer.score(plain) < 0.5 < scorer.score(plain + " scoundrel")
    assert scorer.score(plain + " scoundrell") > 0.5 and scorer.score(plain + " sc0undrels") > scorer.score(plain)


def test_odd_cases(spark, odd, nothing):
    labels = spark.createDataFrame([(4, 1), (4, None), (None, 1), (6, 0), (7, 0)], "doc_id long, toxic int")
    for marked in (labels, labels.where("false")):
        rows = toxicity.toxicity(odd, marked).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
        assert all(r.held_out for r in rows if r.doc_id is None)
    assert toxicity.toxicity(nothing, labels).count() == 0
