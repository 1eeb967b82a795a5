"""Build and write every feature table.

    spark-submit --py-files cartloom.zip cartloom/jobs/feature_tables.py --data <CSV folder> --out <folder>
"""

from __future__ import annotations

import argparse

from cartloom.jobs.session import open_session, open_tables
from cartloom.operators.profile import label_distribution
from cartloom.plans import exports, features
from cartloom.sources.schema import Tables
from cartloom.sources.sinks import export_csv, validate_outputs, write_table

FEATURE_TABLES = (
    "prior_full",
    "user_features",
    "product_features",
    "user_product_features",
    "train_dataset",
    "rfv_features",
    "baskets",
)


def feature_job(
    tables: Tables,
    out: str,
    token: str = "organic",
    departments: tuple[str, str] = features.RATIO_DEPARTMENTS,
) -> dict[str, str]:
    """Write the seven tables in dependency order and return their paths.

    Each table is read back from storage by the ones built on it. The wide fact is therefore
    computed once, scans of it are pruned to the columns needed, and a lost executor costs a
    re-read instead of a recomputation of the joins.
    """
    spark = tables.orders.sparkSession
    paths = {name: f"{out.rstrip('/')}/{name}" for name in FEATURE_TABLES}

    def stored(name: str, df):
        write_table(df, paths[name])
        return spark.read.parquet(paths[name])

    fact = stored("prior_full", features.prior_full(tables, token))
    users = stored("user_features", features.user_features(fact, departments))
    products = stored("product_features", features.product_features(fact))
    pairs = stored("user_product_features", features.user_product_features(fact, users))
    stored("train_dataset", features.train_dataset(tables, pairs, users, products))
    stored("rfv_features", features.rfv_features(tables, users))
    stored("baskets", features.baskets(tables))
    return paths


def export_job(tables: Tables, out: str, token: str = "organic", k: int = 500) -> dict[str, str]:
    """Write the three dashboard tables as CSV."""
    results = {
        "hourly_heatmap": exports.hourly_heatmap(tables),
        "top_products": exports.top_products(tables, k, token),
        "department_stats": exports.department_stats(tables),
    }
    paths = {name: f"{out.rstrip('/')}/{name}" for name in results}
    for name, df in results.items():
        export_csv(df, paths[name])
    return paths


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build basket feature tables.")
    parser.add_argument("--data", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--sample-fraction", type=float, default=1.0)
    parser.add_argument("--seed", type=int, default=42)
    options = parser.parse_args(arguments)

    spark = open_session("cartloom-feature-tables")
    tables = open_tables(spark, options.data, options.sample_fraction, options.seed)
    paths = feature_job(tables, f"{options.out}/features")
    export_job(tables, f"{options.out}/exports")
    validate_outputs(spark, paths).show(truncate=False)
    label_distribution(spark.read.parquet(paths["train_dataset"]), "reordered").show()


if __name__ == "__main__":
    main()
