"""Catalog tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import materialize, run_path
from ..sources import readers, writers
from .registry import query, table


@query(
    "K1 K2 K5 S1 S2 S5",
    "SELECT lang, count(*) AS n_rows, sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY lang",
)
def table_round_trip(spark, sf):
    """Saved as a table of a database of its own, overwritten once, read by name and by SQL."""
    database = f"promptloom_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{run_path(spark, 'database')}'")
    name = f"{database}.documents"
    writers.drop_table(spark, name)
    docs = readers.load_dataset(spark, f"{sf}/documents.parquet")
    writers.save_table(docs.select("doc_id", "lang"), name)
    writers.save_table(docs.select("lang", "n_chars"), name, overwrite=True)
    by_name = readers.load_dataset(spark, name).groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))
    by_sql = spark.sql(f"SELECT lang, sum(n_chars) AS n_chars FROM {name} GROUP BY lang")
    # Kept as a small table, so that the database can go.
    result = materialize(by_name.join(by_sql, "lang"), "round-trip")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return result


@query("K3 K6 A2", "SELECT role, count(*) AS n_rows FROM conversations GROUP BY role")
def cached_counts(spark, sf):
    """Counted once, kept, and computed through the no-output sink."""
    counts = table(spark, sf, "conversations").groupBy("role").agg(F.count(F.lit(1)).alias("n_rows"))
    kept = writers.cached(counts)
    result = materialize(kept, "counts")
    kept.unpersist()
    return result
