"""Model records (R1): a configured model without metrics is kept and ranks last."""
from riskloom.operators import compare as CMP


def test_a_model_without_metrics_is_kept(spark):
    configs = CMP.config_table(spark, [CMP.ModelConfig(k, k, "rule") for k in ("a", "b", "c")])
    names = CMP.RECORD_METRICS
    rows = [(k, part, *[v] * len(names)) for k, v in (("a", 0.2), ("c", 0.4)) for part in ("validation", "test")]
    metrics = spark.createDataFrame(rows, "model_key string, split string, " + ", ".join(f"{m} double" for m in names))
    flagged = CMP.champion_flags(CMP.rank_models(CMP.model_records(metrics, configs)))
    got = [(r.model_key, r["rank"], r.is_champion, r.validation_average_precision) for r in flagged.orderBy("rank").collect()]
    assert got == [("c", 1, True, 0.4), ("a", 2, False, 0.2), ("b", 3, False, None)]
