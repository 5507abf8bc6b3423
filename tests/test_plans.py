"""Every query with SQL against DuckDB on the same tables, and rules about the plans."""

import math
import re

import duckdb
import pytest

from tallyframe.plans import ORACLE_SQL, QUERIES
from tallyframe.plans.standins import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, (bool, str)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    if isinstance(v, dict):
        return str(sorted((plain(a), plain(b)) for a, b in v.items()))
    return "nan" if math.isnan(v) else repr(round(float(v), 6) + 0.0)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    frame = QUERIES[name](spark, SF)
    names = sorted(frame.columns)
    want = db.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == names
    place = [want.columns.index(c) for c in names]
    got = sorted(tuple(plain(r[c]) for c in names) for r in frame.collect())
    assert got == sorted(tuple(plain(r[i]) for i in place) for r in want.fetchall())


def test_queries_without_sql():
    """Held to a plain version of the whole result in test_properties.py."""
    assert set(QUERIES) - set(ORACLE_SQL) == {"j17_neighbour_graph", "m12_module_eigenvector", "m22_classify_text"}


#: Queries that parse or fit in Python, as the operator's docstring says.
PYTHON = {"j17_knn", "m10_correlation", "m11_soft_threshold", "m13_beta_distance", "m32_euclidean", "w8_first_distances", "m9_pca", "m9_pca_reconstruction", "m17_rank_markers", "w11_explained_variance", "f23_downsample_counts", "m15_rarefy_draws", "s20_html_tables", "m17_rank_test", "m17_rank_test_p", "m12_module_traits"}


def test_sql_queries_stay_in_the_jvm(spark):
    for name in sorted(set(ORACLE_SQL) - PYTHON):
        if name[0] in "sm" and name[1:3] in ("1_", "5_"):  # these write files first
            continue
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan, name


@pytest.mark.parametrize("name", ["m1_tpm", "m2_cpm", "m4_log_normalise", "m14_alpha_diversity", "m16_clr", "w1_share_of_sample", "a3_counts_from_abundance", "a6_top_mean_percent", "entry_biotype_shares"])
def test_totals_are_summed_before_they_are_shuffled(spark, name):
    """Samples have few values, so no row may be shuffled or sorted by them: totals are joined back."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Window \[[^\n]*\[(sample_id|barcode|contig)#\d+L?\]", plan) or name == "entry_biotype_shares"


@pytest.mark.parametrize("name", ["w2_cumulative_share", "w3_depth_profile", "w9_bh_adjust", "w16_merge_intervals", "m17_rank_test", "m18_rank_correlation", "o1_rank_by", "w4_number_rows", "j10_cluster_sizes", "f23_downsample_counts", "p21_fill_forward", "w5_unique_names", "w10_first_per_key", "w17_expand_cds", "w18_taxon_edges", "s16_read_indented", "a12_mark_duplicates", "a30_taxon_summary", "m3_size_factors", "m6_two_sample_z", "m8_highly_variable", "m17_rank_markers", "m28_expression_summary", "a14_depth_stats", "f12_var_filter", "f13_filter_low_var", "w15_clip_percentile"])
def test_windows_see_ranges(spark, name):
    """No window gathers a contig, a sample or a table: each is over a value range or over the ranges."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert all("range_part" in line for line in plan.split("\n") if re.search(r"\bWindow \[", line)), plan
    assert "percentile" not in plan
