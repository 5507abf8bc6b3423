"""Properties and rules that SQL on the driver's tables doesn't show."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.functions import columns as C
from tallyframe.operators import aggregates as A
from tallyframe.operators import filters as Q
from tallyframe.operators import joins as J
from tallyframe.operators import least_squares as L
from tallyframe.operators import normalise as N
from tallyframe.operators import windows as W
from tallyframe.operators import ranges as X
from tallyframe.plans import QUERIES
from tallyframe.plans.standins import view
from tallyframe.sources import readers as R
from tallyframe.sources import writers as S

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def counts(spark):
    return view(spark, SF, "counts").cache()


def sums(df, group, value):
    return [r.s for r in df.groupBy(group).agg(F.sum(value).alias("s")).collect()]


def test_shares_and_tpm_sum_up(spark, counts):
    assert all(math.isclose(s, 1) for s in sums(N.share_of_sample(counts), "sample_id", "share"))
    assert all(math.isclose(s, 1e6) for s in sums(N.tpm(counts, view(spark, SF, "features"), 100), "sample_id", "tpm"))
    assert all(math.isclose(s, 1e6) for s in sums(N.cpm(counts), "sample_id", "cpm"))


def test_distances_are_symmetric_and_bounded(counts):
    rows = N.beta_distance(counts).collect()
    assert len(rows) == 28 and all(0 <= r.distance <= 1 for r in rows)


def test_fractional_counts_keep_the_total(spark):
    seqs = spark.createDataFrame([(3, ["a", "b", "a"]), (4, ["b"]), (5, [])], "count long, annotations array<string>")
    assert {r.feature: r.value for r in A.fractional_counts(seqs).collect()} == {"a": 1.5, "b": 5.5, "no-annotation": 5.0}
    odd = spark.createDataFrame([(2, None), (3, ["", "a"]), (1, ["", None])], "count long, annotations array<string>")
    assert {r.feature: r.value for r in A.fractional_counts(odd, split=False).collect()} == {"a": 3.0, "no-annotation": 3.0}


def test_bh_is_monotone_and_keeps_nulls(spark):
    rows = spark.createDataFrame([("g", p) for p in (0.01, 0.04, 0.03, 0.5, None, 0.04)], "grp string, p double")
    got = sorted((r.p, r.padj) for r in W.bh_adjust(rows, "grp").collect() if r.p is not None)
    assert [b for _, b in got] == sorted(b for _, b in got) and W.bh_adjust(rows, "grp").where("padj is null").count() == 1
    assert math.isclose(got[0][1], 0.05) and math.isclose(got[1][1], 0.05)


def test_depth_sums_to_lengths(spark):
    rows = view(spark, SF, "intervals")
    depth = W.depth_profile(rows).agg(F.sum((F.col("stop") - F.col("start")) * F.col("depth"))).first()[0]
    assert depth == rows.agg(F.sum(F.col("stop") - F.col("start"))).first()[0]


def test_rollup_root_is_the_total(spark):
    taxa = view(spark, SF, "taxa")
    root = A.clade_rollup(taxa, ["level1", "level2"]).where("level1 is null").first().value
    assert math.isclose(root, taxa.agg(F.sum("value")).first()[0])


def test_downsampled_totals_are_equal(counts):
    least = min(sums(counts, "sample_id", "value"))
    assert set(sums(Q.downsample_counts(counts), "sample_id", "value")) == {least}


def test_rarefaction_at_full_depth_is_richness(spark):
    rows = spark.createDataFrame([("s", k, float(v)) for k, v in enumerate([5, 3, 1, 1])], "sample_id string, feature_id long, value double")
    got = {r.depth: r.expected for r in N.rarefy_expected(rows, [1, 10]).collect()}
    assert math.isclose(got[1.0], 1, rel_tol=1e-6) and math.isclose(got[10.0], 4, rel_tol=1e-6)


def test_tails():
    assert math.isclose(N._gamma_q(0.5, 3.841458820694124 / 2), 0.05, rel_tol=1e-9)
    assert math.isclose(N._t_p(2.2281388519649385, 10), 0.05, rel_tol=1e-9)
    assert N._t_p(0.0, 5) == 1.0


def test_pca_keeps_the_variance(counts):
    grid = J.complete_grid(counts)
    parts = N.pca(grid, 8).groupBy("component").agg(F.max("variance").alias("variance"), F.sum(F.col("score") * F.col("score")).alias("s"))
    total = grid.withColumn("c", F.col("value") - N._over(F.avg("value"), "feature_id")).agg(F.sum(F.col("c") * F.col("c"))).first()[0]
    assert math.isclose(parts.agg(F.sum("variance")).first()[0], total, rel_tol=1e-6)
    assert all(math.isclose(r.variance, r.s, rel_tol=1e-6, abs_tol=1e-3) for r in parts.collect())


def test_fit_features_recovers_coefficients(spark):
    rows = spark.createDataFrame([(1, 2.0 + 3 * x - z + 1e-3 * (-1) ** k, float(x), float(z)) for k, (x, z) in enumerate([(0, 0), (1, 0), (0, 1), (1, 1), (2, 1), (2, 0)])], "feature_id long, y double, x double, z double")
    got = {r.term: r.coefficient for r in L.fit_features(rows, ["x", "z"]).collect()}
    assert math.isclose(got["intercept"], 2, abs_tol=0.01) and math.isclose(got["x"], 3, abs_tol=0.01) and math.isclose(got["z"], -1, abs_tol=0.01)


def test_checks_raise(spark, counts):
    with pytest.raises(ValueError):
        J.attach_one_to_one(counts, counts.select("sample_id", F.col("value").alias("v")), "sample_id", "_x")
    with pytest.raises(ValueError):
        J.align_samples(counts, spark.createDataFrame([("none",)], "sample_id string"))
    text = spark.createDataFrame([(1, "good\nrow\n\nbad\nrow")], "doc long, text string")
    with pytest.raises(ValueError):
        R.read_blocks(text, ["good"])


def test_ties_of_votes_are_unassigned(spark):
    calls = spark.createDataFrame([(1, 0, "singlet"), (1, 1, "doublet"), (1, 2, "singlet"), (2, 0, "singlet"), (2, 1, "doublet"), (3, 0, "singlet")], "barcode long, caller int, call string")
    assert {r.barcode: r.vote for r in W.majority_vote(calls, 3).collect()} == {1: "singlet", 2: "unassigned", 3: "unassigned"}


def test_overlap_join_emits_each_pair_once(spark):
    a = spark.createDataFrame([("c", 0, 100, "x"), ("c", 5, 6, "y")], "contig string, start long, stop long, name string")
    b = spark.createDataFrame([("c", 3, 90, "p"), ("c", 100, 120, "q"), ("d", 0, 9, "r")], "contig string, start long, stop long, name string")
    got = sorted((r.a_name, r.b_name, r.overlap) for r in J.overlap_join(a, b, 8).collect())
    assert got == [("x", "p", 87), ("y", "p", 1)]


def test_readers(spark, tmp_path):
    gff = tmp_path / "a.gff"
    gff.write_text("# c\nchr1\t.\tmiRNA\t5\t9\t.\t+\t.\tID=M1;Name=let-7;Alias=x\n")
    row = R.read_gff3(spark, f"file://{gff}").first()
    assert row.attributes["name"] == "let-7" and row.start == 5
    fasta = tmp_path / "a.fa"
    fasta.write_text(">one > two\nACG\nT\n>three\n\n")
    assert [(r.name, r.seq) for r in R.read_fasta(spark, f"file://{fasta}").collect()] == [("one > two", "ACGT"), ("three", "")]
    skip = tmp_path / "t.tsv"
    skip.write_text("junk\nhead\n1\tx\n2\ty\n")
    assert sorted(tuple(r) for r in R.read_skip(spark, f"file://{skip}", 2, "a int, b string").collect()) == [(1, "x"), (2, "y")]
    vcf = tmp_path / "v.vcf"
    vcf.write_text("##x\n#CHROM\nchr2\t7\t.\tA\tC\t5\tPASS\tDP=3;DB\n")
    row = R.read_vcf(spark, f"file://{vcf}").first()
    assert row.key == "2:7" and row.info["DP"] == "3" and row.info["DB"] is None
    lines = spark.createDataFrame([("f", k, t) for k, t in enumerate(["a\t1", "   b\t2", "      c\t3", "d\t4", "   e\t5"])], "file string, line int, text string")
    assert [(r.level1, r.level2, r.level3) for r in R.read_indented(lines, 3).orderBy("line").collect()] == [("a", None, None), ("a", "b", None), ("a", "b", "c"), ("d", None, None), ("d", "e", None)]


def test_fastq_mates_and_mtx(spark, tmp_path):
    for k in (1, 2):
        (tmp_path / f"r{k}.fastq").write_text("".join(f"@r{i}/{k}\nAC{'G' * i}\n+\nII{'I' * i}\n" for i in range(3)))
    one, two = (R.read_fastq(spark, f"file://{tmp_path}/r{k}.fastq").drop("file") for k in (1, 2))
    rows = R.interleave(one, two, ["ordinal"]).orderBy("ordinal", "mate").collect()
    assert [(r.ordinal, r.mate, r.name) for r in rows] == [(i, k, f"@r{i}/{k}") for i in range(3) for k in (1, 2)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    many = tmp_path / "many.fastq"
    many.write_text("".join(f"@r{i}\nA{'C' * (i % 7)}\n+\n@{'I' * (i % 7)}\n" for i in range(100)))
    got = R.read_fastq(spark, f"file://{many}").orderBy("ordinal").collect()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.ordinal, r.name, len(r.seq), r.qual[0]) for r in got] == [(i, f"@r{i}", 1 + i % 7, "@") for i in range(100)]
    cells = spark.createDataFrame([("b1", "g1", 2.0), ("b2", "g1", 3.0), ("b2", "g2", 0.5)], "barcode string, feature string, value double")
    S.write_mtx(cells, f"file://{tmp_path}/mtx")
    assert {tuple(r) for r in R.read_mtx(spark, f"file://{tmp_path}/mtx").collect()} == {tuple(r) for r in cells.collect()}


def test_column_rules(spark):
    row = spark.createDataFrame([("NNACGTN", 0x1 | 0x40 | 0x10, "D_0__A; k__B;")], "s string, f int, l string")
    edge, ranks = C.edge_run(F.col("s")), C.split_lineage(F.col("l"), ["a", "b", "c"])
    got = row.select(edge["leading"].alias("l5"), edge["trailing"].alias("l3"), C.reverse_complement(F.col("s")).alias("rc"), C.read_strand(F.col("f")).alias("st"), *[c.alias(n) for n, c in ranks.items()]).first()
    assert (got.l5, got.l3, got.rc, got.st, got.a, got.b, got.c) == (2, 1, "NACGTNN", "-", "A", "B", None)


def test_empty_tables(spark, counts):
    none = counts.limit(0)
    for df in (N.share_of_sample(none), N.cpm(none), N.size_factors(none), N.beta_distance(none), N.alpha_diversity(none), A.top_features(none), Q.var_filter(none), Q.filter_cpm(none), J.complete_grid(none), W.dominant_feature(none)):
        assert df.count() == 0


def one(spark, value, kind, *columns):
    return tuple(spark.createDataFrame([(value,)], f"x {kind}").select(*columns).first())


def test_annotation_names(spark):
    """Rules at the start or end of a name, and names that only look like them."""
    names = {
        "outlet x": ("unknown", "outlet x", "outlet x", "outlet x"),
        "let-7a (1-22)": ("miRNA", "let-7a (1-22)", "let-7a", "let-7a"),
        "hsa-miR-1 (A->G)": ("miRNA", "hsa-miR-1 (A->G)", "hsa-miR-1 (A->G)", "hsa-miR-1"),
        "piR-cluster(a->b)": ("piRNA", "piR-cluster(a->b)", "piR-cluster", "piR-cluster"),
        "a-(2)b": ("unknown", "a-(2)b", "a-(2)b", "a-"),
        "x-(3)": ("unknown", "x-(3)", "x", "x-"),
        "tRNA-Leu-TAAx": ("tRNA", "tRNA-Leu-TAAx", "tRNA-Leu-TAA", "tRNA-Leu-TAAx"),
        "tRNA-Lys-TT1-2": ("tRNA", "tRNA-Lys-TT1-2", "tRNA-Lys-TT1", "tRNA-Lys-TT1-2"),
        "rRNA|5S": ("rRNA", "5S", "rRNA|5S", "rRNA|5S"),
        "a(b)c": ("unknown", "a(b)c", "a(b)c", "a"),
        " a (b) (c": ("unknown", " a (b) (c", " a (b) (c", "a"),
    }
    x = F.col("x")
    rows = spark.createDataFrame([(n,) for n in names], "x string").select("x", C.feature_class(x), C.feature_name(x), C.clean_annotation(x), C.base_name(x)).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == names
    assert one(spark, "hsa-miR-1 (A->G)", "string", C.clean_annotation(x, simplify_mirna=True)) == ("hsa-miR-1 ",)
    assert one(spark, "tRNA-Leu-TAAx", "string", C.clean_annotation(x, simplify_trna=False)) == ("tRNA-Leu-TAAx",)


@pytest.mark.parametrize("flag,first,second", [(0x11, None, None), (0xC1, None, None), (0, "+", "-"), (0x10, "-", "+"), (0x41, "+", "-"), (0x51, "-", "+"), (0x81, "-", "+"), (0x91, "+", "-")])
def test_read_strand(spark, flag, first, second):
    assert one(spark, flag, "int", C.read_strand(F.col("x")), C.read_strand(F.col("x"), 2)) == (first, second)


def test_collapsed_groups_keep_the_order_of_rows(spark):
    rows = [("New1", k, 10 + k, 0.5, n, b) for k, (n, b) in enumerate([("z", "x"), ("y", "y"), ("z", "x"), ("a", "y")])]
    rows += [("New2", k, 5, 0.1, "same", "protein_coding" if k < 2 else "x") for k in range(4)] + [("G1", 0, 7, 0.2, "g", "x"), ("New3", 0, 1, None, None, None)]
    got = {r.key: r for r in A.collapse_groups(spark.createDataFrame(rows, "key string, line int, length int, gc double, name string, biotype string"), "key", "New").collect()}
    assert (got["New1"].name, got["New1"].biotype, got["New1"].length) == ("z;y;z;a", "x;y;x;y", 13)
    assert (got["New2"].name, got["New2"].biotype) == ("same", "protein_coding") and got["G1"].name == "g" and got["New3"].name is None


def test_running_sums_over_skewed_ranges(spark):
    """Values in one narrow place and a few far away: ranges are quantiles, sums don't depend on them."""
    rng = random.Random(1)
    values = [1e12, -5.0, None] + [rng.random() for _ in range(3000)]
    rows = spark.createDataFrame([(rng.choice("ab"), v, rng.randint(1, 5)) for v in values] + [(None, 0.5, 3)], "g string, v double, n int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = X.ranged(rows, "v")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in parts.groupBy(X.PART).count().collect()) < 1500
    total = {}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    summed = X.running_sum(rows, ["g"], ["v"], "n").collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for r in sorted(summed, key=lambda r: (str(r.g), r.v is not None, r.v)):
        assert r.before == total.get(r.g, 0)
        total[r.g] = total.get(r.g, 0) + r.n
    assert [r.number for r in X.numbered(rows.select("v").distinct(), "v").orderBy("v").collect()] == list(range(1, len(set(values) | {0.5}) + 1))


def test_intervals_and_p_values_equal_loops(spark):
    rng = random.Random(2)
    spans = [(rng.choice("xy"), a, a + rng.randint(1, 30)) for a in (rng.randint(0, 4000) for _ in range(400))] + [("x", 0, 3000)]
    rows = spark.createDataFrame(spans, "contig string, start long, stop long")
    depth = {}
    for c, a, b in spans:
        for i in range(a, b):
            depth[c, i] = depth.get((c, i), 0) + 1
    got = {(r.contig, i): r.depth for r in W.depth_profile(rows).collect() for i in range(r.start, r.stop) if r.depth}
    assert got == depth
    merged = [(r.contig, r.start, r.stop) for r in W.merge_intervals(rows).collect()]
    assert sum(b - a for _, a, b in merged) == len(depth) and len(merged) == len({(c, i) for c, i in depth if (c, i - 1) not in depth})
    points = [(rng.choice("xy"), rng.randint(-50, 300)) for _ in range(500)]
    near = J.cluster_sizes(spark.createDataFrame(points, "contig string, pos long"), 7).collect()
    assert len(near) == 500 and all(r.near == sum(c == r.contig and abs(p - r.pos) <= 7 for c, p in points) for r in near)
    tested = [(rng.choice("ab"), k, rng.choice([None, round(rng.random(), 2), rng.random() ** 3])) for k in range(800)]
    want = {}
    for g in "ab":
        some = sorted((p, k) for h, k, p in tested if h == g and p is not None)
        low = 1.0
        for i in range(len(some), 0, -1):
            p, k = some[i - 1]
            last = max(j for j in range(len(some)) if some[j][0] == p) + 1
            low = min(low, p * len(some) / last)
            want[k] = low
    found = {r.k: r.padj for r in W.bh_adjust(spark.createDataFrame(tested, "grp string, k int, p double"), "grp").collect()}
    assert len(found) == 800 and all(found[k] is None if p is None else math.isclose(found[k], want[k]) for _, k, p in tested)


def test_substring_joins_equal_loops(spark):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abé\n😀" if rng.random() < 0.1 else "ab") for _ in range(n))
    docs = {k: text(rng.randint(0, 400)) for k in range(60)} | {60: None, 61: ""}
    probes = {docs[k][a : a + n] for k in range(40) for a, n in [(rng.randint(0, 40), rng.randint(0, 60))] if docs[k]} | {text(40) for _ in range(20)}
    reads = spark.createDataFrame(list(docs.items()), "read_id long, text string")
    panel = spark.createDataFrame([(p,) for p in probes] + [(None,)], "probe string")
    for seed in (16, 5):
        got = sorted((r.read_id, r.probe) for r in J.contains_join(reads, panel, seed).collect())
        assert got == sorted((k, p) for k, t in docs.items() if t is not None for p in probes if p in t)
    entries = dict(enumerate(sorted(probes)))
    panel = spark.createDataFrame(list(entries.items()), "panel_id long, text string")
    for k in (12, 15, 31):
        cut = lambda t: {t[i : i + k] for i in range(len(t or "") - k + 1)}  # noqa: B023, E731
        mine = {d: cut(t) for d, t in docs.items()}
        want = {e: n for e, t in entries.items() if (n := sum(bool(cut(t) & m) for m in mine.values()))}
        assert {r.panel_id: r.hits for r in J.ngram_screen(reads, panel, k).collect()} == want
    adapters = [p for p in sorted(probes) if p][:12]
    pairs = {k: (t[: len(t) // 2], t[len(t) // 2 :]) for k, t in docs.items() if t is not None}
    kept = Q.filter_residual(spark.createDataFrame([(k, *v) for k, v in pairs.items()], "id long, r1 string, r2 string"), spark.createDataFrame([(a,) for a in adapters], "adapter string"), "id", 6)
    bad = lambda m: any(a in m or (len(m) >= 6 and m[-6:] in a) for a in adapters)
    assert {r.id for r in kept.collect()} == {k for k, v in pairs.items() if not any(map(bad, v))}


def test_lines_are_numbered_across_blocks(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    (tmp_path / "a.txt").write_text("".join(f"{k}\tx{'y' * (k % 5)}\n" for k in range(300)))
    got = R.numbered_lines(spark, f"file://{tmp_path}/a.txt").collect()
    body = R.read_skip(spark, f"file://{tmp_path}/a.txt", 7, "a int, b string").count()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 300 and all(r.text.startswith(f"{r.line}\t") for r in got) and body == 293


def test_field_rules(spark):
    lines = spark.createDataFrame([("f", "n 3"), ("f", "n 4"), ("f", " n 9"), ("g", "x")], "file string, text string")
    values, bad = R.extract_fields(lines, [("low", r"n (\d)", "int", "min", True), ("one", r"n (\d)", "int", None, False)])
    assert {r.file: (r.low, r.one) for r in values.collect()} == {"f": (3, 3), "g": (None, None)}
    assert sorted(tuple(r) for r in bad.collect()) == [("f", "one", 2), ("g", "low", 0)]


def test_subsamples_and_draws(spark):
    reads = spark.createDataFrame([(k, m, (k * 7) % 101) for k in range(101) for m in (1, 2)], "k long, mate int, place long")
    some = {r.k for r in Q.subsample_reads(reads, "k", n=10).collect()}
    assert len(some) == 10 and Q.subsample_reads(reads, "k", n=10).count() == 20
    kept = {r.k for r in Q.subsample_reads(reads, "k", 0.5).collect()}
    assert 25 < len(kept) < 76 and Q.subsample_reads(reads, "k", 1.0).count() == 202 and Q.subsample_reads(reads, "k", 0.0).count() == 0
    head = {r.k for r in Q.subsample_reads(reads, "k", 0.5, 5, order="place").collect()}
    assert head == set(sorted(kept, key=lambda k: (k * 7) % 101)[:5])
    otus = spark.createDataFrame([("s", k, float(v)) for k, v in enumerate([40, 1, 1, 8, 50])] + [("t", 0, 3.0)], "sample_id string, feature_id long, value double")
    assert N.rarefaction_depths(otus, steps=3) == [1, 13, 25] and N.rarefaction_depths(otus, 5, 20) == [1, 2, 3, 4, 5] and N.rarefaction_depths(otus.limit(0)) == []
    rows = N.rarefy(otus, [3, 100], 4).collect()
    assert sorted((r.sample_id, r.depth, r.iteration) for r in rows) == sorted([("s", d, i) for d in (3, 100) for i in range(1, 5)] + [("t", 3, i) for i in range(1, 5)])
    assert all(r.observed == 5 for r in rows if r.depth == 100) and all(1 <= r.observed <= 3 for r in rows if r.depth == 3)


def test_checks_of_designs_and_calls(spark):
    samples = spark.createDataFrame([("a", "p1"), ("b", "p1"), ("a", "p2"), ("a", "p2"), ("b", "p3")], "grp string, pair string")
    assert sorted(tuple(r) for r in N.design_checks(samples, "grp", "a", "pair").collect()) == [("condition repeats in pair", "p2"), ("pair not of two", "p3")]
    results = spark.createDataFrame([("t", 1.0, 0.01), ("t", -1.0, 0.01), ("t", -2.0, 0.2), ("t", 3.0, None), ("t", 0.0, 0.001)], "term string, lfc double, padj double")
    assert tuple(N.significance_counts(results).first()) == ("t", 1, 3, 1)
    calls = spark.createDataFrame([("c1", "b", 1), ("c1", "b", 1), ("c2", "b", 1), ("c2", "d", None)], "chromosome string, barcode string, molecule int")
    assert sorted(tuple(r) for r in W.call_counts(calls, "barcode").collect()) == [("b", 2, 3), ("d", 0, 1)]
    assert sorted(tuple(r) for r in W.call_counts(calls, "chromosome").collect()) == [("c1", 1, 2), ("c2", 1, 2)]


def test_module_eigenvectors_equal_numpy(spark, counts):
    """The whole query against a decomposition of each module's matrix, and its eigen equation."""
    modules = {r.feature_id: r.gene for r in view(spark, SF, "features").where("biotype = 'PROMO'").collect()}
    values = {}
    for r in counts.collect():
        if r.feature_id in modules:
            values.setdefault(r.feature_id, {})[r.sample_id] = r.value
    wide = {}
    for feature, row in values.items():
        x = np.array(list(row.values()))
        if len(x) > 1 and x.std(ddof=1) > 0:
            wide.setdefault(modules[feature], []).append({s: (v - x.mean()) / x.std(ddof=1) for s, v in row.items()})
    got = {}
    for r in QUERIES["m12_module_eigenvector"](spark, SF).collect():
        got.setdefault(r.module, {})[r.sample_id] = r.profile
    assert set(got) == set(wide)
    for module, rows in wide.items():
        names = sorted({s for row in rows for s in row})
        z = np.array([[row.get(s, 0.0) for s in names] for row in rows])
        v = np.array([got[module][s] for s in names])
        top = np.linalg.svd(z, compute_uv=False)[0] ** 2
        assert math.isclose(np.linalg.norm(v), 1, abs_tol=1e-3) and math.isclose(v @ z.T @ z @ v, top, rel_tol=1e-3, abs_tol=1e-6)
        assert v @ z.mean(axis=0) >= -1e-3


def test_eigenvectors_of_lopsided_modules(spark):
    """A module of one feature, one of fewer samples than directions, one with a third of all cells, a null one; no pandas group."""
    rng, shapes = np.random.default_rng(3), {"one": (1, 9), "few": (12, 3), "wide": (4, 60), "tall": (80, 7)}
    cells, members, z = [], [], {}
    for m, (p, n) in shapes.items():
        x = rng.normal(size=(p, 1)) * rng.normal(size=(1, n)) * 2 + rng.normal(size=(p, n))
        z[m] = (x - x.mean(axis=1, keepdims=True)) / x.std(axis=1, ddof=1, keepdims=True)
        cells += [(f"s{j:02}", f"{m}{i}", float(x[i, j])) for i in range(p) for j in range(n)]
        members += [(f"{m}{i}", m) for i in range(p)]
    counts = spark.createDataFrame([*cells, ("s00", "lost", 1.0), ("s01", "lost", 2.0)], "sample_id string, feature_id string, value double")
    modules = spark.createDataFrame([*members, ("lost", None)], "feature_id string, module string")
    frame = N.module_eigenvector(counts, modules)
    assert "Pandas" not in frame._jdf.queryExecution().optimizedPlan().toString()
    got = {}
    for r in frame.collect():
        got.setdefault(r.module, []).append((r.sample_id, r.profile))
    assert set(got) == set(shapes)
    for m, (p, n) in shapes.items():
        v = np.array([x for _, x in sorted(got[m])])
        want = np.linalg.svd(z[m], full_matrices=False)[2][0]
        want *= np.sign(want @ z[m].mean(axis=0))
        assert len(v) == n and np.allclose(v, want, atol=1e-4), m
    assert N.module_eigenvector(counts.limit(0), modules).count() == 0


def test_p_values_of_columns_equal_single_ones(spark):
    """Series, fractions, ends and nulls in one batch; closed forms of the tails where they have one."""
    rows = [(float(x), float(n)) for x in (0, 0.1, 1, 3.7, 20, 150, 800) for n in (1, 2, 3, 10, 300)]
    frame = spark.createDataFrame([*rows, (None, 3.0), (1.0, None), (1.0, 0.0)], "x double, n double").coalesce(1)
    got = frame.select("x", "n", N.chi2_sf(F.col("x"), F.col("n")).alias("q"), N.t_p_value(F.col("x"), F.col("n")).alias("t")).collect()
    for r in got:
        if r.x is None or r.n is None:
            assert r.q is None and r.t is None
        elif r.n == 0:
            assert r.q == 0 and r.t is None
        else:
            assert r.q == N._gamma_q(r.n / 2, r.x / 2) and r.t == N._t_p(r.x, r.n) and 0 <= r.q <= 1 and 0 <= r.t <= 1
            if r.n == 2:
                assert math.isclose(r.q, math.exp(-r.x / 2), rel_tol=1e-9, abs_tol=1e-300)
                assert math.isclose(r.t, 1 - r.x / math.sqrt(2 + r.x * r.x), rel_tol=1e-6, abs_tol=1e-12)
            if r.n == 1:
                assert math.isclose(r.q, math.erfc(math.sqrt(r.x / 2)), rel_tol=1e-9, abs_tol=1e-300)
                assert math.isclose(r.t, 1 - 2 * math.atan(r.x) / math.pi, rel_tol=1e-9, abs_tol=1e-12)


def test_classified_texts_equal_naive_bayes(spark):
    """The whole query against multinomial naive Bayes over exact 3-mers; hashing may change a few texts in a hundred."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    cut = lambda t: [t[i : i + 3] for i in range(len(t or "") - 2)]
    size, seen, priors = 1 << 14, {}, {}
    for r in docs:
        if r.doc_id % 5 == 0 and r.lang is not None:
            priors[r.lang] = priors.get(r.lang, 0) + 1
            for g in cut(r.text):
                seen.setdefault(r.lang, {}).setdefault(g, 0)
                seen[r.lang][g] += 1
    total = {k: sum(v.values()) for k, v in seen.items()}

    def best(text):
        score = {k: math.log(priors[k] + 1) + sum(math.log((seen[k].get(g, 0) + 1) / (total[k] + size)) for g in cut(text)) for k in sorted(priors)}
        return max(score, key=score.get)

    got = {r.id: r.predicted for r in QUERIES["m22_classify_text"](spark, SF).collect()}
    assert len(got) == len(docs)
    assert sum(got[r.doc_id] == best(r.text) for r in docs) >= 0.95 * len(docs)
    held = [r for r in docs if r.doc_id % 5 and r.lang is not None]
    assert sum(got[r.doc_id] == r.lang for r in held) >= 0.95 * len(held)


def test_quantiles_are_exact_for_any_group(spark):
    """Ties, one row, nulls, a null group and one that holds most rows; against numpy."""
    rng = random.Random(11)
    rows = [("big", float(rng.randint(0, 40))) for _ in range(3000)] + [("one", 3.0), ("none", None), ("two", 1.0), ("two", 2.0), (None, -1.5), (None, 7.0), (None, 7.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    shares = [0.0, 0.1, 0.25, 0.5, 0.995, 1.0]
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    for discrete, method in ((False, "linear"), (True, "inverted_cdf")):
        got = {r.g: r.quantiles for r in X.quantiles(df, ["g"], "v", shares, discrete).collect()}
        assert set(got) == set(groups)
        for g, v in groups.items():
            assert np.allclose(got[g], np.quantile(v, shares, method=method)), (g, discrete)
        every = [v for vs in groups.values() for v in vs]
        assert np.allclose(X.quantiles(df, [], "v", shares, discrete).first().quantiles, np.quantile(every, shares, method=method))
    assert X.quantiles(df.limit(0), [], "v", [0.5]).first().quantiles == [None] and X.quantiles(df.limit(0), ["g"], "v", [0.5]).count() == 0


def test_values_are_carried_across_ranges(spark):
    rng = random.Random(12)
    rows = [(rng.choice(["a", None]), k, rng.choice([None] * 60 + ["x", "y"]), rng.choice([None, k])) for k in range(2000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = X.carried(spark.createDataFrame(rows, "g string, k long, s string, n long"), ["g"], ["k"], last_s=F.col("s"), last_n=F.when(F.col("n") % 50 == 0, F.struct("n"))).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want, last = {}, {}
    for g, k, s, n in rows:
        want[k] = last.get(g, (None, None))
        a, b = want[k]
        last[g] = (s or a, n if n is not None and n % 50 == 0 else b)
    assert {r.k: (r.last_s, r.last_n and r.last_n.n) for r in got} == want
