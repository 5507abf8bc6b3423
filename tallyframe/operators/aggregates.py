"""Aggregations over counts, reads, intervals, pileups and taxa."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import quantiles, ranged, running_max, running_sum, with_totals


def collapse_junctions(junctions: DataFrame) -> DataFrame:
    """One row per junction over all samples: sums of mappers, largest overhang, samples."""
    keys = ["contig", "start", "stop", "strand", "motif", "known"]
    return junctions.groupBy(*keys).agg(F.sum("unique_mappers").alias("unique_mappers"), F.sum("multi_mappers").alias("multi_mappers"), F.max("overhang").alias("max_overhang"), F.count(F.lit(1)).alias("samples_detected"))


def summarize_to_gene(tx: DataFrame, tx2gene: DataFrame) -> DataFrame:
    """Gene counts and abundance are sums; length is the abundance-weighted mean, the plain mean without abundance."""
    rows = tx.join(tx2gene, "transcript_id")
    weight = F.sum("abundance")
    length = F.when(weight > 0, F.sum(F.col("length") * F.col("abundance")) / weight).otherwise(F.avg("length"))
    return rows.groupBy("sample_id", "gene_id").agg(F.sum("count").alias("count"), weight.alias("abundance"), length.alias("length"))


def counts_from_abundance(tx: DataFrame, mode: str = "scaledTPM") -> DataFrame:
    """Adds ``scaled``: abundance (times the feature's mean length) rescaled to the sample's total count."""
    rows = tx
    raw = F.col("abundance")
    if mode == "lengthScaledTPM":
        rows = with_totals(tx, ["feature_id"], mean_length=F.avg("length"))
        raw = raw * F.col("mean_length")
    rows = with_totals(rows, ["sample_id"], all_counts=F.sum("count"), all_raw=F.sum(raw))
    return rows.withColumn("scaled", raw * F.col("all_counts") / F.col("all_raw")).drop("mean_length", "all_counts", "all_raw")


def biotype_totals(counts: DataFrame, features: DataFrame, rel: float = 0.01, frac: float = 0.5) -> DataFrame:
    """``(sample_id, biotype, value)``: biotypes with a share of ``rel`` or more in more than floor(n * frac) samples; the rest is "other"."""
    sums = counts.join(features.select("feature_id", "biotype"), "feature_id").groupBy("sample_id", "biotype").agg(F.sum("value").alias("value"))
    shares = sums.withColumn("share", F.col("value") / F.sum("value").over(Window.partitionBy("sample_id")))
    n = counts.agg(F.floor(F.countDistinct("sample_id") * frac).alias("least"))
    kept = shares.groupBy("biotype").agg(F.count_if(F.col("share") >= rel).alias("k")).crossJoin(F.broadcast(n)).where("k > least").select("biotype", F.lit(True).alias("kept"))
    named = shares.join(kept, "biotype", "left").withColumn("biotype", F.when(F.col("kept"), F.col("biotype")).otherwise("other"))
    return named.groupBy("sample_id", "biotype").agg(F.sum("value").alias("value"))


def top_features(counts: DataFrame, n: int = 10) -> DataFrame:
    """``(sample_id, feature, value)``: the features with the largest totals by name, all others as "other"."""
    top = counts.groupBy("feature_id").agg(F.sum("value").alias("t")).orderBy(F.desc("t"), "feature_id").limit(n).select("feature_id", F.lit(True).alias("top"))
    named = counts.join(top, "feature_id", "left").withColumn("feature", F.when(F.col("top"), F.col("feature_id").cast("string")).otherwise("other"))
    return named.groupBy("sample_id", "feature").agg(F.sum("value").alias("value"))


def top_mean_percent(counts: DataFrame, n: int = 10) -> DataFrame:
    """Features by mean percentage over the samples that have them."""
    share = with_totals(counts, ["sample_id"], total=F.sum("value")).withColumn("p", 100 * F.col("value") / F.col("total"))
    return share.groupBy("feature_id").agg(F.avg("p").alias("mean_percent")).orderBy(F.desc(F.round("mean_percent", 9)), "feature_id").limit(n)


def pivot_counts(rows: DataFrame, index: str, column: str, values: list, agg=F.avg, fill: float = 0.0) -> DataFrame:
    """Wide table; several values of a cell are averaged (or as ``agg`` says), absent ones are ``fill``."""
    return rows.groupBy(index).pivot(column, values).agg(agg("value")).fillna(fill)


#: Fixed value: the feature of sequences without an annotation.
NO_ANNOTATION = "no-annotation"


def fractional_counts(seqs: DataFrame, split: bool = True) -> DataFrame:
    """``(feature, value)``: a sequence's count shared equally by its distinct annotations, or whole for each.

    Empty and null annotations don't count; a sequence without any other counts
    for "no-annotation", so shared counts keep the total.
    """
    named = F.array_distinct(F.filter(F.coalesce("annotations", F.array().cast("array<string>")), lambda a: a != ""))
    rows = seqs.withColumn("annotations", F.when(F.size(named) > 0, named).otherwise(F.array(F.lit(NO_ANNOTATION))))
    share = F.col("count") / F.size("annotations") if split else F.col("count").cast("double")
    return rows.select(share.alias("value"), F.explode("annotations").alias("feature")).groupBy("feature").agg(F.sum("value").alias("value"))


def _swept(reads: DataFrame, features: DataFrame, group: list[str], label: str) -> tuple[DataFrame, list[str]]:
    """Distinct places of reads (kind 0) and stops of features by start and label (kind 1), dealt out by group and ``place``, with the order.

    A read stands at its stop, before features that start there.  So the
    features before it start before its stop, and it meets those of them whose
    stop is behind its start: how far they reach tells it, and no pair of a
    read and a feature is ever a row.
    """
    named = [F.col(c).isNotNull() for c in group]
    some = lambda d: d.where(reduce(and_, [F.col("start") < F.col("stop"), *named]))
    held = some(features).where(F.col(label).isNotNull()).groupBy(*group, F.col("start").alias("place"), label).agg(F.max("stop").alias("reach")).withColumn("kind", F.lit(1))
    asked = some(reads).select(*group, "start", "stop").distinct().withColumn("place", F.col("stop")).withColumn("kind", F.lit(0))
    order = ["place", "kind", label, "start"]
    return ranged(held.unionByName(asked, allowMissingColumns=True), *group, *order), order


def assign_reads(reads: DataFrame, exons: DataFrame, stranded: int = 0) -> DataFrame:
    """``(gene, reads)``: reads that overlap exactly one gene; strand 1 must equal, 2 must differ, 0 is ignored.

    Rows of one name are parts of one read.
    """
    group = ["contig", "strand"] if stranded else ["contig"]
    if stranded == 2:
        strands = reads.select(F.col("strand").alias("other")).where("other is not null").distinct()  # a few
        exons = exons.join(F.broadcast(strands), F.col("strand") != F.col("other")).withColumn("strand", F.col("other"))
    rows, order = _swept(reads, exons, group, "gene")
    held = F.col("kind") == 1
    rows = running_max(rows, group, order, top=F.when(held, F.struct("reach", "gene")))
    # of two genes the one that reaches less far is beaten: the furthest beaten stop is that of the second gene
    beaten = F.when(held & (F.col("gene") != F.col("top.gene")), F.least("reach", "top.reach"))
    rows = running_max(rows, group, order, second=beaten).where("kind = 0 and top.reach > start")
    met = rows.select(*group, "start", "stop", F.when(F.coalesce(F.col("second") > F.col("start"), F.lit(False)), F.lit(2)).otherwise(1).alias("n"), F.col("top.gene").alias("gene"))
    reads_ = reads.select("name", *group, "start", "stop").join(met, [*group, "start", "stop"]).groupBy("name").agg(F.max("n").alias("n"), F.min("gene").alias("gene"), F.max("gene").alias("last"))
    return reads_.where("n = 1 and gene = last").groupBy("gene").agg(F.count(F.lit(1)).alias("reads"))


def umi_count(cells: DataFrame) -> DataFrame:
    return cells.groupBy("barcode", "feature").agg(F.countDistinct("umi").alias("n"))


def collapse_reads(reads: DataFrame) -> DataFrame:
    """Identical sequences as one row with their number."""
    return reads.groupBy("seq").agg(F.count(F.lit(1)).alias("n"))


def mark_duplicates(reads: DataFrame) -> DataFrame:
    """Adds ``duplicate``: all but the best read (quality, then name) of a contig, position and strand; rows of that quality and name are that read."""
    mine = F.struct((-F.col("quality")).alias("less"), F.col("name"))
    rows = with_totals(reads, ["contig", "start", "strand"], best_read=F.min(mine))
    return rows.withColumn("duplicate", ~mine.eqNullSafe(F.col("best_read"))).drop("best_read")


def count_by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def depth_stats(depth: DataFrame) -> DataFrame:
    """Mean, median and range of depth, the share of positions at 100 or more, and positions in fixed depth bins."""
    d = F.col("depth")
    edges = [0, 10, 100, 1000, 2000, 10000]
    bins = [F.count_if(d == 0).alias("depth_0")]
    bins += [F.count_if((d > a) & (d <= b)).alias(f"depth_{b}") for a, b in zip(edges, edges[1:])]
    bins.append(F.count_if(d > edges[-1]).alias("depth_more"))
    middle = quantiles(depth, ["contig"], d, [0.5]).select(F.col("contig").alias("of"), F.get("quantiles", F.lit(0)).alias("median"))
    rest = depth.groupBy("contig").agg(F.avg(d).alias("mean"), F.min(d).alias("min"), F.max(d).alias("max"), F.avg((d >= 100).cast("double")).alias("share_100"), *bins)
    return rest.join(middle, F.col("contig").eqNullSafe(F.col("of")), "left").drop("of")


def qc_per_cell(cells: DataFrame, mt: Column) -> DataFrame:
    """Totals, number of features and mitochondrial percentage of each barcode."""
    return cells.groupBy("barcode").agg(F.sum("value").alias("total"), F.countDistinct("feature").alias("n_features"), (100 * F.sum(F.when(mt, F.col("value")).otherwise(0.0)) / F.sum("value")).alias("pct_mt"))


def tax_glom(otus: DataFrame, rank: str) -> DataFrame:
    """Sums at a rank, with the sorted list of what was merged."""
    return otus.groupBy("sample_id", rank).agg(F.sum("value").alias("value"), F.array_join(F.sort_array(F.collect_set(F.col("feature_id").cast("string"))), "_").alias("origin"))


def merge_reports(reports: DataFrame) -> DataFrame:
    return reports.groupBy("tax_id").agg(F.sum("value").alias("value"))


def clade_rollup(taxa: DataFrame, levels: list[str]) -> DataFrame:
    """Sums of every ancestor; levels below it are null."""
    return taxa.rollup(*levels).agg(F.sum("value").alias("value"))


def nearest_level(rows: DataFrame, length: str, target: float) -> DataFrame:
    """The row whose length is nearest to the target; ties take the smaller."""
    return rows.agg(F.min_by(length, F.struct(F.abs(F.col(length) - target), F.col(length))).alias("nearest"))


def first_level(reports: DataFrame, order: str = "SGFOCPKU") -> DataFrame:
    """Per sample the first rank letter present, in the order given."""
    place = F.expr(f"nullif(instr('{order}', rank), 0)")
    return reports.withColumn("place", place).where("place is not null").groupBy("sample_id").agg(F.min_by("rank", "place").alias("level"))


def _single_or_joined(column: str, order: str) -> Column:
    """The only value of a group, else all its values with repeats in the order of the rows; nulls are left out."""
    values = F.transform(F.array_sort(F.collect_list(F.when(F.col(column).isNotNull(), F.struct(order, column)))), lambda x: x[column])
    return F.when(F.countDistinct(column) <= 1, F.min(column)).otherwise(F.array_join(values, ";"))


def collapse_groups(rows: DataFrame, key: str, prefix: str, order: str = "line") -> DataFrame:
    """Rows of new groups collapsed: largest length, mean GC, voted biotype, joined names; other rows stay.

    A biotype wins with over 0.7 of the votes (0.5 or more if protein_coding);
    otherwise all are joined, as names are, with repeats and in the order of the
    rows (column ``order``), unless only one is there.  A group is a cluster of
    transcripts whose joined text is the result, so it is gathered as one row.
    """
    new = rows.where(F.col(key).startswith(prefix))
    votes = new.where("biotype is not null").groupBy(key, "biotype").agg(F.count(F.lit(1)).alias("v"))
    share = F.col("v") / F.sum("v").over(Window.partitionBy(key))
    wins = (share > 0.7) | ((F.col("biotype") == "protein_coding") & (share >= 0.5))
    winner = votes.withColumn("wins", wins).groupBy(key).agg(F.max(F.when(F.col("wins"), F.col("biotype"))).alias("winner"))
    merged = new.groupBy(key).agg(F.max("length").alias("length"), F.avg("gc").alias("gc"), _single_or_joined("name", order).alias("name"), _single_or_joined("biotype", order).alias("all"))
    merged = merged.join(winner, key, "left").withColumn("biotype", F.coalesce("winner", "all"))
    columns = [key, "length", "gc", "name", "biotype"]
    return merged.select(*columns).unionByName(rows.where(~F.col(key).startswith(prefix)).select(*columns))


def combine_qc(rows: DataFrame, mates: str) -> DataFrame:
    """Worst of PASS < WARN < FAIL and sum of two mates' checks; one missing value counts as 0, two as null."""
    level = F.expr("CASE status WHEN 'FAIL' THEN 2 WHEN 'WARN' THEN 1 WHEN 'PASS' THEN 0 END")
    worst = F.element_at(F.array(F.lit("PASS"), F.lit("WARN"), F.lit("FAIL")), F.max(level) + 1)
    return rows.groupBy(mates, "check").agg(worst.alias("status"), F.sum("reads").alias("reads"), (F.min("reads") != F.max("reads")).alias("mismatch"))


def allele_counts(pileup: DataFrame, min_maf: float = 0.1, min_count: int = 20) -> DataFrame:
    """Per barcode and site: reference, most frequent other base and remaining depth, on common sites only."""
    site = pileup.groupBy("contig", "pos", "base").agg(F.count(F.lit(1)).alias("n"), F.first("ref").alias("ref"))
    alt = site.where("base <> ref").groupBy("contig", "pos").agg(F.max_by("base", F.struct("n", "base")).alias("alt"), F.max("n").alias("alt_n"))
    total = site.groupBy("contig", "pos").agg(F.sum("n").alias("depth"))
    common = total.join(alt, ["contig", "pos"]).where((F.col("depth") >= min_count) & (F.least(F.col("alt_n") / F.col("depth"), 1 - F.col("alt_n") / F.col("depth")) >= min_maf))
    rows = pileup.join(common.select("contig", "pos", "alt"), ["contig", "pos"])
    is_ref, is_alt = F.col("base") == F.col("ref"), F.col("base") == F.col("alt")
    return rows.groupBy("barcode", "contig", "pos", "alt").agg(F.count_if(is_ref).alias("ref_n"), F.count_if(is_alt).alias("alt_n"), F.count_if(~is_ref & ~is_alt).alias("other_n"))


def _base_shares(pileup: DataFrame) -> DataFrame:
    bases = pileup.groupBy("contig", "pos", "base").agg(F.count(F.lit(1)).alias("n"), F.first("ref").alias("ref"))
    return bases.withColumn("depth", F.sum("n").over(Window.partitionBy("contig", "pos")))


def consensus(pileup: DataFrame, share: float = 0.75, min_depth: int = 10) -> DataFrame:
    """``(contig, pos, base)``: the base with the share at enough depth, else N."""
    best = _base_shares(pileup).groupBy("contig", "pos").agg(F.max_by("base", F.struct("n", "base")).alias("base"), F.max("n").alias("n"), F.first("depth").alias("depth"))
    sure = (F.col("depth") >= min_depth) & (F.col("n") >= share * F.col("depth"))
    return best.select("contig", "pos", F.when(sure, F.col("base")).otherwise("N").alias("base"))


def call_variants(pileup: DataFrame, share: float = 0.25, min_depth: int = 10, min_quality: float = 20) -> DataFrame:
    """``(contig, variant, frequency)`` of other bases with the share; the name is reference, position and base."""
    good = _base_shares(pileup.where(F.col("qual") >= min_quality)).where("base <> ref and base <> ''")
    frequency = F.col("n") / F.col("depth")
    return good.where((F.col("depth") >= min_depth) & (frequency >= share)).select("contig", F.concat("ref", F.col("pos").cast("string"), "base").alias("variant"), frequency.alias("frequency"))


def nuclear_fraction(layers: DataFrame) -> DataFrame:
    """Unspliced over spliced and unspliced per barcode; null without either."""
    layer = lambda n: F.sum(F.when(F.col("layer") == n, F.col("value")).otherwise(0.0))
    u, s = layer("unspliced"), layer("spliced")
    return layers.groupBy("barcode").agg((u / F.nullif(u + s, F.lit(0.0))).alias("nuclear_fraction"))


def histogram(rows: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """``(bin, n)`` in equal bins; 0 is below, ``bins`` + 1 at or above the range."""
    return rows.groupBy(F.width_bucket(F.col(column), F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def read_distribution(reads: DataFrame, features: DataFrame, priority: list[str]) -> DataFrame:
    """``(class, reads)``: each read in the first class of the priority list it overlaps, else "intergenic".

    Rows of one name are parts of one read, and each is counted.
    """
    rows, order = _swept(reads, features.where(F.col("class").isin(priority)), ["contig"], "class")
    names = [f"reach_{k}" for k in range(len(priority))]
    rows = running_max(rows, ["contig"], order, **{n: F.when((F.col("kind") == 1) & (F.col("class") == c), F.col("reach")) for n, c in zip(names, priority)})
    place = F.coalesce(*[F.when(F.col(n) > F.col("start"), F.lit(k)) for k, n in enumerate(names)])
    met = rows.where("kind = 0").select("contig", "start", "stop", place.alias("place"))
    each = reads.select("name", "contig", "start", "stop").join(met, ["contig", "start", "stop"], "left").groupBy("name").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n"))
    found = F.get(F.array(*[F.lit(p) for p in priority]), F.when(F.col("name").isNotNull(), F.col("place")))
    return each.groupBy(F.coalesce(found, F.lit("intergenic")).alias("class")).agg(F.sum("n").alias("reads"))


def saturation(rows: DataFrame, key: str, feature: str, steps: int = 10) -> DataFrame:
    """Distinct features seen in growing subsamples of 1/steps, 2/steps, ... of the keys (by remainder)."""
    first = rows.groupBy(feature).agg(F.min(F.pmod(F.col(key), F.lit(steps))).alias("first"))
    return first.withColumn("step", F.explode(F.sequence(F.col("first").cast("int") + 1, F.lit(steps)))).groupBy("step").agg(F.count(F.lit(1)).alias("n"))


def taxon_summary(reads: DataFrame, covered: float = 0.9, special: str = "(?i)plasmid|phage") -> DataFrame:
    """Per file: best taxon, its percentage to one decimal, how many taxa cover the share, how many match the special names."""
    per = reads.groupBy("file", "taxon").agg(F.count(F.lit(1)).alias("n"))
    rows = with_totals(running_sum(per, ["file"], [F.desc("n"), "taxon"], "n"), ["file"], total=F.sum("n"))
    return rows.groupBy("file").agg(
        F.min_by("taxon", F.struct((-F.col("n")).alias("less"), "taxon")).alias("best"),
        F.floor(F.max(F.col("n") * 1000 / F.col("total")) + 0.5).alias("per_mille"),
        F.count_if(F.col("before") < covered * F.col("total")).alias("covering"),
        F.count_if(F.col("taxon").rlike(special)).alias("special"),
    )


def sample_groups(samples: DataFrame, column: str) -> DataFrame:
    """``(grp, samples array)``: comma lists split, and "all_samples" beside them."""
    split = samples.select(F.explode(F.split(column, r"\s*,\s*")).alias("grp"), "sample_id").unionByName(samples.select(F.lit("all_samples").alias("grp"), "sample_id"))
    return split.groupBy("grp").agg(F.sort_array(F.collect_set("sample_id")).alias("samples"))


def psi(isomirs: DataFrame) -> DataFrame:
    """Adds ``psi``: share of a variant within its parent, the text before the first ``;``."""
    rows = isomirs.withColumn("parent", F.split_part("name", F.lit(";"), F.lit(1)))
    total = F.sum("value").over(Window.partitionBy("sample_id", "parent"))
    return rows.withColumn("psi", F.coalesce(F.col("value") / F.nullif(total, F.lit(0.0)), F.lit(0.0)))
