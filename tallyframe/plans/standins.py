"""The driver's tables in the roles of the domain's tables, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: SQL that DuckDB and Spark both read; keys are the views' names.
VIEWS = {
    "counts": "SELECT concat('S', l_suppkey % 8) AS sample_id, l_partkey AS feature_id, sum(l_quantity) AS value FROM lineitem GROUP BY concat('S', l_suppkey % 8), l_partkey",
    "features": "SELECT p_partkey AS feature_id, p_name AS name, p_type AS biotype, p_brand AS gene, CAST(100 + 50 * p_size AS BIGINT) AS length FROM part",
    "samples": "SELECT concat('S', s_suppkey) AS sample_id, r_name AS sample_group, n_name AS batch FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey < 8",
    "cells": "SELECT user_id AS barcode, event_type AS feature, event_id % 50 AS umi, value FROM events",
    "cellcounts": "SELECT user_id AS barcode, event_type AS feature, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY user_id, event_type",
    "taxa": "SELECT r_name AS level1, n_name AS level2, c_mktsegment AS level3, c_custkey AS taxon_id, sum(o_totalprice) AS value FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name, c_mktsegment, c_custkey",
    "otus": "SELECT concat('S', l_suppkey % 8) AS sample_id, p_type AS phylum, p_brand AS genus, p_partkey AS feature_id, CAST(count(*) AS DOUBLE) AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY concat('S', l_suppkey % 8), p_type, p_brand, p_partkey",
    "intervals": "SELECT o_orderkey AS name, concat('chr', o_custkey % 10) AS contig, datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS start, datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 1 + o_orderkey % 7 AS stop, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, o_orderstatus AS class FROM orders",
    "positions": "SELECT l_orderkey * 10 + l_linenumber AS name, concat('chr', l_suppkey % 10) AS contig, datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS pos, l_quantity AS qual FROM lineitem",
    "pileup": "SELECT concat('chr', l_suppkey % 4) AS contig, datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 400 AS pos, 'A' AS ref, CASE WHEN (l_partkey + l_linenumber) % 5 < 3 THEN 'A' WHEN l_partkey % 2 = 0 THEN 'C' ELSE 'G' END AS base, l_quantity AS qual, l_suppkey AS barcode FROM lineitem",
    "calls": "SELECT user_id AS barcode, caller, CASE (event_id * (caller + 1)) % 3 WHEN 0 THEN 'singlet' WHEN 1 THEN 'doublet' ELSE 'unassigned' END AS call FROM (SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id) e CROSS JOIN (SELECT CAST(n_nationkey AS BIGINT) AS caller FROM nation WHERE n_nationkey < 3) c WHERE (event_id + caller) % 11 <> 0",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in as a DataFrame; nothing is registered in the session's catalogue."""
    text, frames = VIEWS[name].replace("datediff('day',", "datediff(DAY,"), {}
    for t in TABLES:
        for word in ("FROM", "JOIN"):
            if f"{word} {t} " in text + " ":
                text = (text + " ").replace(f"{word} {t} ", f"{word} {{{t}}} ").strip()
                frames[t] = table(spark, sf_dir, t)
    return spark.sql(text, **frames)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})
