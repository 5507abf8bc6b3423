"""Windows, ranking, ordering and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import PART, by_range, carried, numbered, quantiles, ranged, running_sum, sum_before, with_totals


def cumulative_share(rows: DataFrame, group: str, share: float = 0.9) -> DataFrame:
    """The largest values of a group until they cover the share, the one that crosses it included; ties by key."""
    placed = running_sum(rows.withColumn("low", -F.col("value")), [group], ["low", "key"], "value").drop("low")
    return with_totals(placed, [group], total=F.sum("value")).where(F.col("before") < share * F.col("total")).drop("before", "total")


def depth_profile(intervals: DataFrame) -> DataFrame:
    """``(contig, start, stop, depth)``: runs of equal depth of half-open intervals, depth 0 inside included."""
    ends = intervals.select("contig", F.col("start").alias("pos"), F.lit(1).alias("d")).unionByName(intervals.select("contig", F.col("stop").alias("pos"), F.lit(-1).alias("d")))
    parts = ranged(ends.groupBy("contig", "pos").agg(F.sum("d").alias("d")), "contig", "pos")
    rows = sum_before(parts, ["contig"], ["pos"], "d", "before").withColumn("depth", F.col("before") + F.col("d"))
    following = parts.groupBy("contig", PART).agg(F.min("pos").alias("first"))
    following = following.withColumn("next_range", F.lead("first").over(Window.partitionBy("contig").orderBy(PART))).drop("first")
    within = F.lead("pos").over(Window.partitionBy("contig", PART).orderBy("pos"))
    rows = by_range(rows.withColumn("within", within), following, ["contig", PART]).withColumn("stop", F.coalesce("within", "next_range"))
    return rows.where("stop is not null").select("contig", F.col("pos").alias("start"), "stop", "depth")


def number_rows(rows: DataFrame, order: str, name: str = "number") -> DataFrame:
    """Adds consecutive numbers from 1 by an ordered key."""
    return numbered(rows, order, name=name)


def unique_names(rows: DataFrame, name: str, order: str, separator: str = "_") -> DataFrame:
    """The second and later rows of a name get their number as a suffix."""
    placed = running_sum(rows, [name], [order], F.lit(1), "earlier")
    return placed.withColumn("unique_name", F.when(F.col("earlier") == 0, F.col(name)).otherwise(F.concat_ws(separator, F.col(name), F.col("earlier").cast("string")))).drop("earlier")


def dominant_feature(counts: DataFrame) -> DataFrame:
    """The most abundant feature of each sample and its percentage; ties go to the smaller id."""
    best = F.min_by("feature_id", F.struct((-F.col("value")).alias("v"), "feature_id"))
    return counts.groupBy("sample_id").agg(best.alias("feature_id"), (100 * F.max("value") / F.sum("value")).alias("percent"))


def first_differences(rows: DataFrame, subject: str, state: str) -> DataFrame:
    """Adds ``difference`` to the previous state of the subject; first states are left out."""
    w = Window.partitionBy(subject).orderBy(state)
    return rows.withColumn("difference", F.col("value") - F.lag("value").over(w)).where("difference is not null")


def first_distances(states: DataFrame, distances: DataFrame) -> DataFrame:
    """``(subject, state, sample_id, distance)`` between successive samples of a subject."""
    w = Window.partitionBy("subject").orderBy("state")
    pairs = states.withColumn("previous", F.lag("sample_id").over(w)).where("previous is not null")
    keyed = pairs.withColumn("a", F.least("sample_id", "previous")).withColumn("b", F.greatest("sample_id", "previous"))
    return keyed.join(distances, ["a", "b"]).select("subject", "state", "sample_id", "distance")


def bh_adjust(rows: DataFrame, group: str, p: str = "p") -> DataFrame:
    """Adds ``padj``: Benjamini-Hochberg within each group; null p-values stay null and don't count.

    Ranks and minima are taken over the distinct p-values of a group, in ranges.
    """
    per = with_totals(rows.where(F.col(p).isNotNull()).groupBy(F.col(group).alias("bh_group"), F.col(p).alias("bh_p")).agg(F.count(F.lit(1)).alias("t")), ["bh_group"], n=F.sum("t"))
    parts = ranged(per, "bh_group", "bh_p")
    placed = sum_before(parts, ["bh_group"], ["bh_p"], "t", "before").withColumn("raised", F.col("bh_p") * F.col("n") / (F.col("before") + F.col("t")))
    lowest = placed.groupBy("bh_group", PART).agg(F.min("raised").alias("lowest"))
    later = lowest.withColumn("later", F.min("lowest").over(Window.partitionBy("bh_group").orderBy(PART).rowsBetween(1, Window.unboundedFollowing))).drop("lowest")
    here = F.min("raised").over(Window.partitionBy("bh_group", PART).orderBy("bh_p").rowsBetween(0, Window.unboundedFollowing))
    adjusted = by_range(placed.withColumn("here", here), later, ["bh_group", PART]).select("bh_group", "bh_p", F.least(F.lit(1.0), "here", "later").alias("padj"))
    return rows.join(adjusted, F.col(group).eqNullSafe(F.col("bh_group")) & (F.col(p) == F.col("bh_p")), "left").drop("bh_group", "bh_p")


def first_per_key(rows: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """The first row of each key by ascending ``order``, nulls first."""
    first = rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("first_row"))
    return first.select("first_row.*")


def chunk_profile(depth: DataFrame, size: int = 2500) -> DataFrame:
    """Mean depth of fixed chunks."""
    return depth.groupBy("contig", F.floor(F.col("pos") / size).alias("chunk")).agg(F.avg("depth").alias("depth"))


def majority_vote(calls: DataFrame, callers: int) -> DataFrame:
    """``(barcode, vote)``: the most frequent call; absent callers vote "unassigned", and so does every tie."""
    counted = calls.groupBy("barcode", "call").agg(F.count(F.lit(1)).alias("n"))
    absent = calls.groupBy("barcode").agg((F.lit(callers) - F.count(F.lit(1))).alias("n")).where("n > 0").select("barcode", F.lit("unassigned").alias("call"), "n")
    votes = counted.unionByName(absent).groupBy("barcode", "call").agg(F.sum("n").alias("n"))
    top = votes.withColumn("r", F.rank().over(Window.partitionBy("barcode").orderBy(F.desc("n")))).where("r = 1")
    return top.groupBy("barcode").agg(F.when(F.count(F.lit(1)) == 1, F.min("call")).otherwise("unassigned").alias("vote"))


def final_droplet(votes: DataFrame) -> DataFrame:
    """Adds ``final``: singlets take the donor vote, unassigned donors the best-singlet vote; other votes stay."""
    donor = F.when(F.coalesce(F.col("donor"), F.lit("unassigned")) != "unassigned", F.col("donor")).otherwise(F.coalesce("best_singlet", F.lit("unassigned")))
    return votes.withColumn("final", F.when(F.col("vote") == "singlet", donor).otherwise(F.col("vote")))


def clip_percentile(rows: DataFrame, p: float = 0.995) -> DataFrame:
    """Adds ``clipped``: values within 0 and the percentile over all rows."""
    top = quantiles(rows, [], "value", [p]).select(F.get("quantiles", F.lit(0)).alias("top"))
    return rows.crossJoin(F.broadcast(top)).withColumn("clipped", F.greatest(F.lit(0.0), F.least("value", "top"))).drop("top")


def call_counts(calls: DataFrame, by: str) -> DataFrame:
    """``(by, molecules, calls)`` of ``(chromosome, barcode, molecule)`` call rows, by chromosome or barcode.

    A molecule's number is its own within a chromosome; a call without one is
    counted as a call only.
    """
    molecule = F.when(F.col("molecule").isNotNull(), F.struct("chromosome", "molecule"))
    return calls.groupBy(by).agg(F.countDistinct(molecule).alias("molecules"), F.count(F.lit(1)).alias("calls"))


def merge_intervals(intervals: DataFrame) -> DataFrame:
    """Overlapping and touching intervals of a contig as one."""
    parts = ranged(intervals.select("contig", "start", "stop").distinct(), "contig", "start", "stop")
    earlier = (Window.unboundedPreceding, -1)
    far = parts.groupBy("contig", PART).agg(F.max("stop").alias("far"))
    far = far.withColumn("range_far", F.max("far").over(Window.partitionBy("contig").orderBy(PART).rowsBetween(*earlier))).drop("far")
    inner = F.max("stop").over(Window.partitionBy("contig", PART).orderBy("start", "stop").rowsBetween(*earlier))
    reached = by_range(parts.withColumn("inner_far", inner), far, ["contig", PART]).withColumn("new", F.coalesce((F.col("start") > F.greatest("range_far", "inner_far")).cast("int"), F.lit(1)))
    islands = sum_before(reached, ["contig"], ["start", "stop"], "new", "before").withColumn("island", F.col("before") + F.col("new"))
    return islands.groupBy("contig", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("island")


def expand_cds(rows: DataFrame) -> DataFrame:
    """Each CDS row takes the latest gene row before it and gives gene, CDS, transcript and exon rows; codons pass.

    ``rows`` is (contig, line, feature, start, stop, strand, id).
    """
    own = F.when(F.col("feature") == "gene", F.struct("id", "start", "stop"))
    known = carried(rows, ["contig"], ["line"], gene=own).withColumn("gene", F.coalesce(own, "gene"))
    cds = known.where("feature = 'CDS' and gene is not null")
    parts = F.explode(F.array(*[F.lit(x) for x in ("gene", "CDS", "transcript", "exon")])).alias("feature")
    whole = F.col("feature") == "gene"
    out = cds.select("contig", "line", "start", "stop", "strand", "id", "gene", parts).select(
        "contig", "line", "feature", F.when(whole, F.col("gene.start")).otherwise(F.col("start")).alias("start"), F.when(whole, F.col("gene.stop")).otherwise(F.col("stop")).alias("stop"), "strand", F.col("gene.id").alias("gene_id"), F.col("id").alias("transcript_id")
    )
    codons = known.where("feature in ('start_codon', 'stop_codon')").select("contig", "line", "feature", "start", "stop", "strand", F.col("gene.id").alias("gene_id"), F.col("id").alias("transcript_id"))
    return out.unionByName(codons)


def taxon_edges(report: DataFrame, ranks: list[str]) -> DataFrame:
    """``(file, line, name, parent, path)``: a row's parent is the latest row before it one rank up, two if there is none."""
    rows = carried(report, ["file"], ["line"], **{f"last_{k}": F.when(F.col("rank") == r, F.struct("name", "line")) for k, r in enumerate(ranks)})
    # what stands before the current domain doesn't count
    top = F.when(F.col("rank") == ranks[0], F.col("line")).otherwise(F.col("last_0.line"))
    rows = rows.withColumn("top", top).withColumns({f"last_{k}": F.when(F.col("top").isNull() | (F.col(f"last_{k}.line") >= F.col("top")), F.col(f"last_{k}.name")) for k in range(len(ranks))})
    parent = F.lit(None).cast("string")
    path = F.col("name")
    for k in range(len(ranks) - 1, 0, -1):
        up = F.coalesce(*[F.col(f"last_{i}") for i in range(k - 1, max(k - 3, -1), -1)])
        parent = F.when(F.col("rank") == ranks[k], up).otherwise(parent)
        path = F.when(F.col("rank") == ranks[k], F.concat_ws(";", *[F.col(f"last_{i}") for i in range(k)], F.col("name"))).otherwise(path)
    return rows.select("file", "line", "rank", "name", parent.alias("parent"), path.alias("path"))


def rank_by(rows: DataFrame, key: str, agg: Column) -> DataFrame:
    """``(key, amount, rank)`` by an aggregate, largest first; ties by key."""
    sums = rows.groupBy(key).agg(agg.alias("amount")).withColumn("low", -F.round("amount", 9))
    return numbered(sums, "low", key, name="rank").drop("low")


def take_with_overflow(items: Column, n: int = 8) -> Column:
    """The first n - 1 items and how many more there are; all of them if they are n or fewer."""
    rest = F.concat(F.lit("(+ "), (F.size(items) - (n - 1)).cast("string"), F.lit(" more)"))
    return F.when(F.size(items) > n, F.concat(F.slice(items, 1, n - 1), F.array(rest))).otherwise(items)


def order_by_list(rows: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Adds ``place``, a name's position in the list; rows of other names are left out."""
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(column))
    return rows.withColumn("place", place).where("place > 0")


def head(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows by an order."""
    return rows.orderBy(*order).limit(n)


def union_fill(frames: list[DataFrame], fill: float = 0) -> DataFrame:
    """Rows of all tables over the union of their columns; absent numbers are ``fill``."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).fillna(fill)


def union_rekey(frames: dict[str, DataFrame], key: str = "barcode") -> DataFrame:
    """All rows with the table's name as the key's suffix; repeats stay."""
    named = [f.withColumn(key, F.concat(F.col(key).cast("string"), F.lit(f"-{n}"))) for n, f in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), named)


def intersect_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def difference_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).subtract(b.select(key))


def symmetric_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Values of one side only; empty if both have the same set."""
    return difference_ids(a, b, key).union(difference_ids(b, a, key))


def merge_sorted(frames: list[DataFrame], contigs: list[str]) -> DataFrame:
    """Union of call tables with the place of each row in contig and position order."""
    rows = order_by_list(reduce(lambda a, b: a.unionByName(b), frames), "contig", contigs)
    return rows.orderBy("place", "pos")
