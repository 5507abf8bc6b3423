"""Filters: each keeps or drops rows by a rule over rows, features, samples or reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialise
from .ranges import first_keys, quantiles, running_sum

def filter_junctions(junctions: DataFrame, min_unique: float = 3, min_overhang: float = 0, min_samples: float = 0.2) -> DataFrame:
    """All criteria are strict; below 1, ``min_samples`` is a fraction of the largest sample count, cut to an integer."""
    strict = (F.col("unique_mappers") > min_unique) & (F.col("max_overhang") > min_overhang)
    if min_samples >= 1:
        return junctions.where(strict & (F.col("samples_detected") > min_samples))
    most = junctions.agg(F.floor(F.max("samples_detected") * min_samples).alias("least"))
    return junctions.crossJoin(F.broadcast(most)).where(strict & (F.col("samples_detected") > F.col("least"))).drop("least")


def junction_criteria(junctions: DataFrame, min_unique: float, min_overhang: float, min_samples: float) -> DataFrame:
    """One row: how many junctions pass each criterion."""
    passed = lambda c, v: F.count_if(F.col(c) > v)
    return junctions.agg(F.count(F.lit(1)).alias("total"), passed("unique_mappers", min_unique).alias("unique_ok"), passed("max_overhang", min_overhang).alias("overhang_ok"), passed("samples_detected", min_samples).alias("samples_ok"))


def keep_features(counts: DataFrame, condition: Column) -> DataFrame:
    """Rows of the features whose aggregate over all samples meets ``condition``."""
    good = counts.groupBy("feature_id").agg(condition.alias("ok")).where("ok").select("feature_id")
    return counts.join(good, "feature_id", "left_semi")


def filter_low_features(counts: DataFrame, min_count: float, min_samples: int) -> DataFrame:
    return keep_features(counts, F.count_if(F.col("value") >= min_count) >= min_samples)


def filter_total(counts: DataFrame, min_total: float) -> DataFrame:
    return keep_features(counts, F.sum("value") > min_total)


def filter_cpm(counts: DataFrame, min_cpm: float = 1, min_samples: int = 3) -> DataFrame:
    from .normalise import cpm

    return keep_features(cpm(counts), F.count_if(F.col("cpm") > min_cpm) >= min_samples).drop("cpm")


def filter_cells(cells: DataFrame, flags: DataFrame, min_features: int, min_cells: int, max_pct_mt: float, min_total: float, max_total: float) -> DataFrame:
    """In order: cells with enough features, features in enough cells, then totals and mitochondrial share."""
    rich = cells.where("value > 0").groupBy("barcode").agg(F.countDistinct("feature").alias("n")).where(F.col("n") >= min_features)
    kept = cells.join(rich, "barcode", "left_semi")
    common = kept.where("value > 0").groupBy("feature").agg(F.countDistinct("barcode").alias("n")).where(F.col("n") >= min_cells)
    kept = kept.join(common, "feature", "left_semi")
    marked = kept.join(flags.where("mt").select("feature", F.lit(1).alias("mt")), "feature", "left")
    total = F.sum("value")
    good = marked.groupBy("barcode").agg(total.alias("total"), (100 * F.sum(F.when(F.col("mt") == 1, F.col("value")).otherwise(0)) / total).alias("pct"))
    good = good.where((F.col("pct") < max_pct_mt) & (F.col("total") > min_total) & (F.col("total") < max_total))
    return kept.join(good, "barcode", "left_semi")


def drop_zero(cells: DataFrame, above: float = 0) -> DataFrame:
    """Barcodes with a larger total, then features with a larger total among those."""
    rows = cells.join(cells.groupBy("barcode").agg(F.sum("value").alias("t")).where(F.col("t") > above), "barcode", "left_semi")
    return rows.join(rows.groupBy("feature").agg(F.sum("value").alias("t")).where(F.col("t") > above), "feature", "left_semi")


def filter_taxonomy(taxa: DataFrame, min_confidence: float, exclude: str = "chloroplast|mitochondria", phylum_token: str | None = None) -> DataFrame:
    """Drops unsure rows, excluded names in any case, and rows without a phylum (or its token)."""
    good = (F.col("confidence") >= min_confidence) & ~F.col("taxon").rlike(f"(?i){exclude}")
    has = F.col("taxon").contains(phylum_token) if phylum_token else F.size(F.split("taxon", ";")) > 1
    return taxa.where(good & has)


def filter_table(counts: DataFrame, min_frequency: float, min_features: int, feature_frequency: float, feature_samples: int, include: DataFrame | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """Samples by frequency and features, then features by frequency and samples, then lists."""
    good = counts.where("value > 0").groupBy("sample_id").agg(F.sum("value").alias("t"), F.count(F.lit(1)).alias("n")).where((F.col("t") >= min_frequency) & (F.col("n") >= min_features))
    rows = counts.join(good, "sample_id", "left_semi")
    good = rows.where("value > 0").groupBy("feature_id").agg(F.sum("value").alias("t"), F.count(F.lit(1)).alias("n")).where((F.col("t") >= feature_frequency) & (F.col("n") >= feature_samples))
    rows = rows.join(good, "feature_id", "left_semi")
    if include is not None:
        rows = rows.join(include, "feature_id", "left_semi")
    return rows if exclude is None else rows.join(exclude, "feature_id", "left_anti")


def filter_abundance(otus: DataFrame, above: float, share: float, groups: int) -> DataFrame:
    """Features above a value in more than a share of all samples, within the largest groups (phyla)."""
    n = otus.agg(F.countDistinct("sample_id").alias("samples"))
    seen = otus.groupBy("feature_id").agg(F.count_if(F.col("value") > above).alias("k")).crossJoin(F.broadcast(n)).where(F.col("k") > share * F.col("samples"))
    rows = otus.join(seen, "feature_id", "left_semi")
    top = rows.groupBy("phylum").agg(F.sum("value").alias("t")).orderBy(F.desc("t"), "phylum").limit(groups)
    return rows.join(top, "phylum", "left_semi")


def require_taxa(taxa: DataFrame, required: dict[str, str], excluded: dict[str, str]) -> DataFrame:
    """Ranks that must equal a value and ranks that must differ from one; null ranks fail either test."""
    tests = [F.col(c) == v for c, v in required.items()] + [F.col(c) != v for c, v in excluded.items()]
    return taxa.where(reduce(lambda a, b: a & b, tests, F.col("value") > 0))


def min_group_total(counts: DataFrame, group: str, least: float) -> DataFrame:
    """Drops groups (regions) whose total isn't above ``least``."""
    good = counts.groupBy(group).agg(F.sum("value").alias("t")).where(F.col("t") > least)
    return counts.join(good, group, "left_semi")


def var_filter(counts: DataFrame, fraction: float = 0.5, lowest: float = 0.1) -> DataFrame:
    """``(feature_id, total, variance, rank)``: features above the lowest decile of totals, then the most variable fraction, 3 at least.  Counts them when it is called."""
    stats = counts.groupBy("feature_id").agg(F.sum("value").alias("total"), F.var_samp("value").alias("variance"))
    stats = materialise(stats, "feature-variances")
    floor = quantiles(stats, [], "total", [lowest]).select(F.get("quantiles", F.lit(0)).alias("floor"))
    rows = stats.crossJoin(F.broadcast(floor)).where("total > floor and variance is not null").drop("floor")
    n = int(rows.count() * fraction)
    top = rows.orderBy(F.desc(F.round("variance", 9)), "feature_id").limit(max(3, n))
    return top


def filter_low_var(counts: DataFrame, top: float, min_mean: float = 5) -> DataFrame:
    """Features with a mean above ``min_mean`` and among the top fraction by median absolute deviation."""
    middle = lambda rows, v, n: quantiles(rows, ["feature_id"], v, [0.5]).select("feature_id", F.get("quantiles", F.lit(0)).alias(n))
    large = counts.groupBy("feature_id").agg(F.avg("value").alias("m")).where(F.col("m") > min_mean)
    rows = counts.join(large, "feature_id", "left_semi")
    mads = middle(rows.join(middle(rows, "value", "median"), "feature_id"), F.abs(F.col("value") - F.col("median")), "mad")
    edge = quantiles(mads, [], "mad", [1 - top]).select(F.get("quantiles", F.lit(0)).alias("edge"))
    return mads.crossJoin(F.broadcast(edge)).where("mad >= edge").drop("edge")


def length_cutoff(lengths: DataFrame, cutoff: float) -> DataFrame:
    """Features whose length isn't above the cutoff in more than half the samples are dropped."""
    n = lengths.agg(F.countDistinct("sample_id").alias("n"))
    short = lengths.groupBy("feature_id").agg(F.count_if(F.col("length") <= cutoff).alias("k")).crossJoin(F.broadcast(n)).where("k > n / 2")
    return lengths.join(short, "feature_id", "left_anti")


def host_classes(alignments: DataFrame, contig: str) -> DataFrame:
    """Class of each primary alignment: target (the contig), unmapped or host."""
    primary = F.col("flag").bitwiseAND(F.lit(0x900)) == 0
    kind = F.when(F.col("flag").bitwiseAND(F.lit(4)) != 0, "unmapped").when(F.col("contig") == contig, "target").otherwise("host")
    return alignments.where(primary).withColumn("class", kind)


def filter_host_reads(alignments: DataFrame, contig: str) -> DataFrame:
    return host_classes(alignments, contig).where("class <> 'host'")


def host_summary(alignments: DataFrame, contig: str) -> DataFrame:
    counted = host_classes(alignments, contig).groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("percent", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))


def filter_flags(alignments: DataFrame, min_quality: int = 10, exclude: int = 3844) -> DataFrame:
    return alignments.where((F.col("mapq") >= min_quality) & (F.col("flag").bitwiseAND(F.lit(exclude)) == 0))


def filter_residual(pairs: DataFrame, adapters: DataFrame, key: str, k: int = 10) -> DataFrame:
    """Drops pairs of which a mate contains an adapter, or ends in k bases that occur in one.

    Both tests are equi joins on substrings; ``key`` tells the pairs apart.
    """
    from .joins import all_kmers, contains_join

    reads = [pairs.select(F.struct(key, F.lit(m).alias("mate")).alias("read_id"), F.col(m).alias("text")) for m in ("r1", "r2")]
    reads = reads[0].unionByName(reads[1])
    inside = contains_join(reads, adapters.select(F.col("adapter").alias("probe"))).select(F.col(f"read_id.{key}").alias(key))
    ends = reads.where(F.length("text") >= k).select(F.col(f"read_id.{key}").alias(key), F.expr(f"right(text, {k})").alias("end"))
    known = adapters.select(F.explode(all_kmers(F.col("adapter"), k)).alias("end")).distinct()
    return pairs.join(inside.unionByName(ends.join(known, "end", "left_semi").select(key)), key, "left_anti")


def grep_headers(seqs: DataFrame, patterns: list[str], invert: bool = False) -> DataFrame:
    found = F.col("name").rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns))
    return seqs.where(~found if invert else found)


def filter_vcf_af(calls: DataFrame, least: float) -> DataFrame:
    """All rows of the keys that have an allele frequency above ``least``."""
    return calls.join(calls.where(F.col("af") > least).select("key").distinct(), "key", "left_semi")


def harmonise_contig(contig: Column) -> Column:
    return F.regexp_replace(contig, "^chr", "")


def keep_common_contigs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` on contigs of ``b``, whatever their prefix; the contig is written as in ``b``."""
    names = b.select(F.col("contig").alias("other")).distinct()
    return a.join(names, harmonise_contig(F.col("contig")) == harmonise_contig(F.col("other"))).drop("contig").withColumnRenamed("other", "contig")


def subset(rows: DataFrame, selectors: list[str]) -> DataFrame:
    """``"column::value"`` keeps, ``"column::!value"`` removes: the union of the keeps without the removes."""
    keep, drop = [], []
    for s in selectors:
        column, _, value = s.partition("::")
        (drop if value.startswith("!") else keep).append(F.col(column) == value.removeprefix("!"))
    kept = reduce(lambda a, b: a | b, keep, F.lit(not keep))
    gone = reduce(lambda a, b: a | b, drop, F.lit(False))
    return rows.where(kept & ~F.coalesce(gone, F.lit(False)))


def _draw(key: str, seed: int) -> Column:
    """The order of a draw: md5 of seed and key, the same for mates of a pair and in any other engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def subsample_reads(reads: DataFrame, key: str, fraction: float | None = None, n: int | None = None, order: str | None = None, seed: int = 0) -> DataFrame:
    """Keeps a fraction of the keys, or ``n`` of them, by hash, so that mates of a pair stay together.

    With a fraction and ``n``: the first ``n`` of the keys that the fraction
    keeps, in the order of column ``order`` (the key itself without one), which
    must be the same for all rows of a key.
    """
    rows = reads
    if fraction is not None:
        rows = reads.where(F.substring(_draw(key, seed), 1, 8) < f"{min(int(fraction * 2**32), 2**32 - 1):08x}") if fraction < 1 else reads
    if n is None:
        return rows
    if fraction is None:
        return first_keys(rows, key, _draw(key, seed), n)
    if order is None:
        return first_keys(rows, key, F.col(key), n)
    keys = running_sum(rows.groupBy(key).agg(F.min(order).alias("place")), [], ["place", key], F.lit(1))
    return rows.join(keys.where(F.col("before") < n).select(key), key, "left_semi")


def subsample_every(reads: DataFrame, key: str, step: int) -> DataFrame:
    return reads.where(F.col(key) % step == 0)


def downsample_counts(counts: DataFrame, group: str = "sample_id", seed: int = 0, replace: bool = True) -> DataFrame:
    """Each group thinned to the smallest group's total by random draws, with replacement unless told otherwise.

    The smallest group (the first by name, if several are) stays as it is.
    """
    from .draws import draw

    rows = counts.where("value > 0").select(group, "feature_id", F.col("value").cast("long").alias("value"))
    totals = rows.groupBy(group).agg(F.sum("value").alias("total"))
    least = totals.agg(F.min(F.struct("total", group)).alias("least"))  # one row
    runs = totals.crossJoin(F.broadcast(least)).where(~F.col(group).eqNullSafe(F.col(f"least.{group}"))).select(group, F.lit(0).alias("run"), F.col("least.total").alias("depth"))
    smallest = rows.join(F.broadcast(least), F.col(group).eqNullSafe(F.col(f"least.{group}"))).select(group, "feature_id", F.col("value").cast("double").alias("value"))
    thinned = draw(rows, runs, group, seed, replace)
    return thinned.select(group, "feature_id", F.col("drawn").cast("double").alias("value")).unionByName(smallest)


def trim_reads(reads: DataFrame, trim_5: int, min_length: int, min_quality: float, min_complexity: float) -> DataFrame:
    """Trims the start, then keeps reads long, good and complex enough (share of bases unlike the next one)."""
    rows = reads.withColumn("seq", F.expr(f"substring(seq, {trim_5 + 1})"))
    n, chars = F.length("seq"), F.split("seq", "")
    pairs = F.greatest(n - 1, F.lit(0))
    differ = F.zip_with(F.slice(chars, 1, pairs), F.slice(chars, 2, pairs), lambda x, y: (x != y).cast("int"))
    rows = rows.where((n >= min_length) & (F.col("qual") >= min_quality))
    share = F.aggregate(differ, F.lit(0), lambda a, x: a + x) / F.nullif(pairs, F.lit(0))
    return rows.withColumn("complexity", F.coalesce(share, F.lit(0.0))).where(F.col("complexity") >= min_complexity)


def select_assembly(assemblies: DataFrame) -> DataFrame:
    """Per species: the reference genome, else a representative, else all others merged."""
    rank = F.when(F.col("category") == "reference genome", 1).when(F.col("category") == "representative genome", 2).otherwise(3)
    best = assemblies.withColumn("rank", rank).withColumn("best", F.min("rank").over(Window.partitionBy("species"))).where("rank = best")
    merged = F.array_join(F.sort_array(F.collect_set("accession")), ",")
    return best.groupBy("species", "rank").agg(F.when(F.col("rank") == 3, merged).otherwise(F.min("accession")).alias("accession")).select("species", "accession")


def marker_list(features: DataFrame, prefix: str, biotype: str) -> DataFrame:
    """Distinct ids whose name starts with the prefix, in any case, or whose biotype matches."""
    return features.where(F.col("name").rlike(f"(?i)^{prefix}") | F.col("biotype").rlike(f"(?i){biotype}")).select("feature_id").distinct()


def significant(results: DataFrame, max_p: float, min_lfc: float, drop: str = "MT-") -> DataFrame:
    return results.where(F.col("padj").isNotNull() & (F.col("padj") < max_p) & (F.abs("lfc") > min_lfc) & ~F.col("name").startswith(drop))


def filter_detected(counts: DataFrame, above: float = 1, share: float = 0.1) -> DataFrame:
    """Features above a value in more than max(1, round(share * samples)) samples."""
    n = counts.agg(F.greatest(F.lit(1), F.bround(F.countDistinct("sample_id") * share).cast("int")).alias("least"))
    seen = counts.groupBy("feature_id").agg(F.count_if(F.col("value") > above).alias("k")).crossJoin(F.broadcast(n)).where("k > least")
    return counts.join(seen, "feature_id", "left_semi")
