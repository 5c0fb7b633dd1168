"""The three runs of the original project, composed from the query functions.

* ``analysis_run``: profile -> features -> forecast model metrics (L1).
* ``eda_run``: correlations, anomalies, clusters, the top branch's trend,
  period totals and product shares (L2).
* ``monthly_etl``: the monthly warehouse load (L3), see ``sources.warehouse``.

Each returns lazy DataFrames (the model steps run their fits when called);
``write_reports`` saves any of them as JSON (S5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchbook.plans import catalog


def _q(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog.load_all()
    return catalog.QUERIES[key](spark, sf_dir)


def analysis_run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Profile, features and forecast metrics."""
    return {
        "profile": _q("dataset_profile", spark, sf_dir),
        "temporal_features": _q("temporal_features", spark, sf_dir),
        "interaction_features": _q("interaction_features", spark, sf_dir),
        "scaled_features": _q("scaled_features", spark, sf_dir),
        "model_metrics": _q("rf_forecast_cv", spark, sf_dir),
        "feature_importances": _q("feature_importance", spark, sf_dir),
    }


def eda_run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The exploratory report's tables; the trend is that of the branch with the largest revenue."""
    top = _q("top_branch", spark, sf_dir).select("filial_name")
    trend = _q("trend_summary", spark, sf_dir).join(top, "filial_name", "left_semi")
    seasonal = _q("seasonal_decompose", spark, sf_dir).join(top, "filial_name", "left_semi")
    return {
        "correlation": _q("corr_pairs", spark, sf_dir),
        "anomalies": _q("anomaly_summary", spark, sf_dir),
        "clusters": _q("cluster_stats", spark, sf_dir),
        "trend": trend.join(seasonal.drop("n_periods"), "filial_name", "left"),
        "period_totals": _q("period_totals", spark, sf_dir),
        "product_share": _q("product_share", spark, sf_dir),
    }


def monthly_etl(spark: SparkSession, root: str, landed_raw: DataFrame, stg_branches: DataFrame,
                dim_products: DataFrame, as_of, now) -> DataFrame:
    """The monthly load against the warehouse under ``root``; returns the step report."""
    from branchbook.sources.warehouse import monthly_load

    return monthly_load(spark, root, landed_raw, stg_branches, dim_products, as_of, now)


def write_reports(frames: dict[str, DataFrame], folder: str) -> None:
    """Each (small) result as JSON under ``folder/<name>``."""
    from branchbook.sources.warehouse import write_report

    for name, df in frames.items():
        write_report(df.select(*[F.col(f"`{c}`") for c in df.columns]), f"{folder.rstrip('/')}/{name}")
