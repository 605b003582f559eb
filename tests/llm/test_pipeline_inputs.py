"""What stages of the pipeline do with inputs that share few labels, or whose ids are null or repeated."""
import random

from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import jaccard, quality


def test_stages_learn_from_their_own_labels_or_keep_all(spark, tmp_path):
    rng = random.Random(3)
    good, bad = "clear plain words of a fine text", "junk spam buy cheap click now"
    docs = spark.createDataFrame([(i, " ".join(rng.sample((good if i % 2 else bad).split(), 5)), None if i else "en") for i in range(60)],
                                 "doc_id long, text string, lang string")
    labels = spark.range(20_000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    labels.write.parquet(f"{tmp_path}/some/labels.parquet")
    labels.where("doc_id >= 60").write.parquet(f"{tmp_path}/none/labels.parquet")
    model = quality.train(docs, labels, per_label=10)
    assert model.learned and all(r.predicted == r.doc_id % 2 for r in quality.predict(docs, model).collect())
    stages = dict(corpus_pipeline.STAGES)
    assert stages["quality"](spark, docs, f"{tmp_path}/none").count() == 60
    bare = docs.withColumn("lang", F.lit(None).cast("string")).unionByName(spark.createDataFrame([(99, "1 2", None)], docs.schema))
    assert stages["language_id"](spark, bare, "").count() == 60


def test_rows_with_null_or_repeated_ids_are_told_apart(spark):
    a, b, c, d = (" ".join(f"{p}{i}" for i in range(30)) for p in "abcd")
    rows = [(1, a), (1, b), (2, a), (3, b), (None, c), (None, d), (None, a), (4, c), (5, ""), (5, ""), (5, None), (6, ""), (None, ""), (7, d + " x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    single = sorted(((r.doc_id or 0), r.text or "-") for r in corpus_pipeline.near_copies(spark, docs, "").collect())
    assert single == sorted([(1, a), (1, b), (4, c), (7, d + " x"), (5, "-"), (5, "-"), (6, "-"), (0, "-")])
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard.jaccard_components(docs).collect())
    n = len(set(a.split())) - 4
    assert found == sorted([(1, n, 1), (1, n, 1), (2, n, 1), (3, n, 1), (0, n, 4), (0, n, 7), (0, n, 1), (4, n, 4), (7, n + 1, 7),
                            (5, 0, 5), (5, 0, 5), (5, 0, 5), (6, 0, 6), (0, 0, 0)])
