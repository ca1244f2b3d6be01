"""Post-training rollout tables on Spark: DataFrame-in, DataFrame-out operators."""
