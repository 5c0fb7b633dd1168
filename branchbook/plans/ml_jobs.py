"""Models without a SQL oracle (checked by invariants in tests)."""

from __future__ import annotations

from pyspark.sql import functions as F

from branchbook.operators import features as fe
from branchbook.operators import ml
from branchbook.plans.catalog import register
from branchbook.plans.enrichment import contract_frame
from branchbook.plans.oracle_base import with_ctes
from branchbook.sources.star import star

ISO_FEATURES = ["SUMMA", "CNT"]
ROW_ID = ["filial_id", "inc_gk", "operation_date", "sender_category", "SUMMA", "CNT", "WEIGHT"]


def eda_rows(spark, sf_dir):
    f = star(spark, sf_dir).fact()
    return f.select("filial_id", "inc_gk", "operation_date", "sender_category",
                    F.col("summa").alias("SUMMA"), F.col("cnt").alias("CNT"), F.col("weight").alias("WEIGHT"))


@register("isolation_forest", "M5")
def q_isolation_forest(spark, sf_dir):
    return ml.isolation_forest(eda_rows(spark, sf_dir), ISO_FEATURES, id_cols=ROW_ID)


@register("anomaly_summary", "M7 M5 M6")
def q_anomaly_summary(spark, sf_dir):
    return ml.anomaly_summary(q_isolation_forest(spark, sf_dir), "SUMMA")


def named_fact(spark, sf_dir):
    s = star(spark, sf_dir)
    return s.fact().select("filial_id", "period", "period_idx", "summa").join(
        F.broadcast(s.dim_filials().select("filial_id", "filial_name")), "filial_id")


def branch_clusters(spark, sf_dir):
    nf = named_fact(spark, sf_dir)
    # the pivot values: the months present (bounded by the calendar)
    months = [r[0] for r in nf.select("period_idx").distinct().orderBy("period_idx").collect()]
    return ml.kmeans_branches(ml.branch_vectors(nf, months))


@register("kmeans_branches", "M8 A9 X3")
def q_kmeans_branches(spark, sf_dir):
    labels, inertia = branch_clusters(spark, sf_dir)
    return labels.withColumn("inertia", F.round(F.lit(inertia), 4))


@register("cluster_stats", "M9 A10 J8 A7")
def q_cluster_stats(spark, sf_dir):
    labels, _ = branch_clusters(spark, sf_dir)
    return ml.cluster_stats(named_fact(spark, sf_dir), labels)


def forecast_frame(spark, sf_dir):
    c = fe.temporal_features(contract_frame(spark, sf_dir).select("filial_id", "period", "revenue"))
    lf, feats = fe.lag_frame(c)
    lf = fe.standardise(lf, feats, suffix="_scaled")  # as in the reference; trees ignore it
    return lf, [f"{x}_scaled" for x in feats], feats


@register("rf_forecast_cv", "M12 M13 X4 W11 A13")
def q_rf_forecast_cv(spark, sf_dir):
    lf, scaled, names = forecast_frame(spark, sf_dir)
    return ml.rf_cross_validate(lf, scaled, "revenue", ["filial_id", "period"], names=names)


@register("feature_importance", "M14 M12")
def q_feature_importance(spark, sf_dir):
    lf, scaled, names = forecast_frame(spark, sf_dir)
    imp = ml.rf_importances(lf, scaled, "revenue")
    mapping = dict(zip(scaled, names))
    return imp.replace(mapping, subset=["feature"])


@register("model_report", "M12 M13 M14 S5")
def q_model_report(spark, sf_dir):
    """The model document as written and read back: nested metrics and a map of importances, one row of JSON."""
    from branchbook.sources.warehouse import new_root, write_report

    lf, scaled, names = forecast_frame(spark, sf_dir)
    metrics = ml.rf_cross_validate(lf, scaled, "revenue", ["filial_id", "period"], names=names)
    importance = ml.rf_importances(lf, scaled, "revenue").replace(dict(zip(scaled, names)), subset=["feature"])
    doc = ml.model_document(metrics, importance)
    path = f"{new_root(spark, 'model_report')}/model_performance"
    write_report(doc, path)
    return spark.read.schema(doc.schema).json(path)


@register("cluster_totals", "M9 A10 J8", with_ctes("""
select cast(count(distinct d.filial_name) as bigint) as filial_count, cast(3 as bigint) as clusters, round(cast(sum(f.summa) as double), 0) + 0.0 as total_revenue
from fact_operations f join dim_filials d on f.filial_id = d.filial_id
""", "fact_operations", "dim_filials"))
def q_cluster_totals(spark, sf_dir):
    """What must hold of the cluster statistics however the clusters fall: every branch in one of three, all revenue in them."""
    st = q_cluster_stats(spark, sf_dir)
    return st.agg(F.sum("filial_count").cast("bigint").alias("filial_count"), F.count_if(F.col("cluster").isNotNull()).alias("clusters"),
                  (F.round(F.sum("total_revenue"), 0) + F.lit(0.0)).alias("total_revenue"))
