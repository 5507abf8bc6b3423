"""Projections and column rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranges import carried


def feature_table(gtf: DataFrame, kind: str, drop: list[str] = ()) -> DataFrame:
    """Rows of one feature kind, its id first, ``seqname`` as ``chrom``."""
    rows = gtf.where(F.col("feature") == kind).drop("feature", *drop).withColumnRenamed("seqname", "chrom")
    key = f"{kind}_id"
    return rows.select(key, *[c for c in rows.columns if c != key])


def relabel_mito(seqname: Column, biotype: Column) -> Column:
    return F.when((seqname == "MT") & (biotype == "protein_coding"), F.lit("Mt_protein_coding")).otherwise(biotype)


def versioned_id(name: Column, version: Column) -> Column:
    return F.concat_ws(".", name.cast("string"), version.cast("string"))


def feature_length(start: Column, stop: Column) -> Column:
    """stop - start, without the one more of closed intervals."""
    return stop - start


def drop_blacklisted(rows: DataFrame, names: list[str]) -> DataFrame:
    """Drops columns by name in any case."""
    low = {n.lower() for n in names}
    return rows.select([c for c in rows.columns if c.lower() not in low])


#: Texts that mean a missing value.
MISSING = ("", "nan", "NaN", "NA", "N/A", "None", "null")


def drop_empty_columns(rows: DataFrame, digits: int = 2) -> DataFrame:
    """Missing-value texts to null, all-null columns dropped (found by one pass when this is called), numbers rounded, remaining nulls as ''."""
    text = [c for c, t in rows.dtypes if t == "string"]
    rows = rows.withColumns({c: F.when(~F.col(c).isin(*MISSING), F.col(c)) for c in text})
    filled = rows.agg(*[F.count(F.col(c)).alias(c) for c in rows.columns]).first()
    kept = [c for c in rows.columns if filled[c]]
    numbers = {c: F.round(F.col(c), digits) for c, t in rows.dtypes if c in kept and t in ("double", "float")}
    return rows.select(*kept).withColumns(numbers).fillna("")


def drop_duplicate_columns(rows: DataFrame, key: str) -> DataFrame:
    """Of columns with equal contents the first stays; one pass of checksums over (key, value) when this is called."""
    names = [c for c in rows.columns if c != key]
    if not names:
        return rows
    sums = rows.agg(*[F.struct(F.bit_xor(F.xxhash64(key, F.col(c).cast("string"))), F.sum(F.xxhash64(F.col(c).cast("string"), key).cast("decimal(38,0)"))).alias(c) for c in names]).first()
    seen, kept = set(), []
    for c in names:
        if sums[c] not in seen:
            seen.add(sums[c])
            kept.append(c)
    return rows.select(key, *kept)


def gene_flags(name: Column) -> dict[str, Column]:
    """Mitochondrial, ribosomal and haemoglobin genes by their lower-case symbol."""
    low = F.lower(name)
    return {"mt": low.startswith("mt-"), "ribo": low.startswith("rps") | low.startswith("rpl"), "hb": low.rlike("^hb[^(p)]")}


def feature_class(name: Column) -> Column:
    """RNA class of an annotation name; ``a|b`` gives a, other names "unknown"."""
    return (
        F.when(name.contains("miR") | name.startswith("let"), "miRNA")
        .when(name.contains("piR"), "piRNA")
        .when(name.rlike("tRNA|tRF|-tR"), "tRNA")
        .when(name.contains("|"), F.split_part(name, F.lit("|"), F.lit(1)))
        .otherwise("unknown")
    )


def feature_name(name: Column) -> Column:
    """The feature's own name: b of ``a|b`` where a is its class, else the whole name."""
    split = name.contains("|") & ~(name.rlike("miR|piR|tRNA|tRF|-tR") | name.startswith("let"))
    return F.when(split, F.split_part(name, F.lit("|"), F.lit(2))).otherwise(name)


def clean_annotation(name: Column, simplify_trna: bool = True, simplify_mirna: bool = False) -> Column:
    """Without `` (d-d)``, ``-(d)`` and ``(...->...)`` at the end; of tRNA names the core ``tRNA-XXX-YYY``.

    The last rule is for miRNA names only if asked, the core only if not switched off.
    """
    plain = F.regexp_replace(F.regexp_replace(name, r"\s\(\d+-\d+\)$", ""), r"-\(\d+\)$", "")
    short = F.regexp_replace(plain, r"\(.*->.*\)$", "")
    out = short if simplify_mirna else F.when(plain.contains("miR"), plain).otherwise(short)
    core = F.regexp_extract(out, r"^.*(tRNA-\w{3}-\w{3})", 1)
    return F.when(name.contains("tRNA") & (core != ""), core).otherwise(out) if simplify_trna else out


def rewrite_header(name: Column, kind: str) -> Column:
    return F.concat(F.lit(f"{kind}|"), F.replace(F.replace(name, F.lit("|"), F.lit("::")), F.lit("_"), F.lit("")))


def base_name(name: Column) -> Column:
    """What stands before the last group in parentheses, without outer white space."""
    before = F.when(name.rlike(r"\(.*\)"), F.regexp_extract(name, r"^(.*)\(.*\)", 1)).otherwise(name)
    return F.btrim(before, F.lit(" \t\n\x0b\f\r"))


def barcode_postfix(rows: DataFrame, mode: str, numbers: DataFrame | None = None) -> DataFrame:
    """Re-keys ``bases-postfix``: "numeric" keeps it, "trimmed" drops it, "sample" takes the sample of
    ``numbers(number, sample_id)``, a table of one row per library."""
    bases, post = F.split_part("barcode", F.lit("-"), F.lit(1)), F.split_part("barcode", F.lit("-"), F.lit(2))
    if mode == "numeric":
        return rows
    if mode == "trimmed":
        return rows.withColumn("barcode", bases)
    keyed = rows.withColumn("number", F.expr("try_cast(split_part(barcode, '-', 2) AS bigint)"))
    return keyed.join(numbers, "number", "left").withColumn("barcode", F.concat(bases, F.lit("-"), F.coalesce("sample_id", post))).drop("number", "sample_id")


def strand_from_coords(start: Column, stop: Column) -> dict[str, Column]:
    return {"strand": F.when(start < stop, "+").when(start > stop, "-"), "start": F.least(start, stop), "stop": F.greatest(start, stop)}


def read_strand(flag: Column, stranded_mate: int = 1) -> Column:
    """Strand of the fragment from SAM flag bits; flipped for reads of the other mate.

    Null for paired reads that are marked as neither mate or as both.
    """
    bit = lambda b: flag.bitwiseAND(F.lit(b)) != 0
    mate = F.when(~bit(0x1), 1).when(bit(0x40) & ~bit(0x80), 1).when(bit(0x80) & ~bit(0x40), 2)
    reverse = bit(0x10) != (mate != stranded_mate)
    return F.when(reverse, "-").when(~reverse, "+")


def edge_run(seq: Column, letter: str = "N") -> dict[str, Column]:
    n, s = F.length(seq), F.lit(letter)
    return {"leading": n - F.length(F.ltrim(seq, s)), "trailing": n - F.length(F.rtrim(seq, s))}


def to_dna(seq: Column) -> Column:
    return F.translate(seq, "Uu", "Tt")


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def gc_percent(seq: Column) -> Column:
    return 100.0 * F.length(F.regexp_replace(seq, "[^GCgc]", "")) / F.nullif(F.length(seq), F.lit(0))


def split_lineage(lineage: Column, ranks: list[str]) -> dict[str, Column]:
    """Ranks of a ``;`` lineage without ``D_n__`` and ``k__`` prefixes; unassigned ones are null."""
    parts = F.transform(F.split(lineage, r"\s*;\s*"), lambda p: F.regexp_replace(p, "^(D_[0-9]+__|[a-z]__)", ""))
    unassigned = F.lower(lineage) == "unassigned"
    return {r: F.when(~unassigned, F.nullif(F.get(parts, k), F.lit(""))) for k, r in enumerate(ranks)}


def assembly_paths(path: Column, organism: Column) -> dict[str, Column]:
    """File name, genome and annotation paths of an assembly folder; species in lower case."""
    base = F.regexp_extract(path, "([^/]+)/?$", 1)
    root = F.regexp_replace(path, "/$", "")
    return {"base": base, "genome": F.concat(root, F.lit("/"), base, F.lit("_genomic.fna.gz")), "annotation": F.concat(root, F.lit("/"), base, F.lit("_genomic.gff.gz")), "species": F.replace(F.lower(organism), F.lit(" "), F.lit("_"))}


def flag_qc(value: Column, passes: float, warns: float) -> Column:
    """PASS, WARN or FAIL by two thresholds; MISSING for null."""
    return F.when(value.isNull(), "MISSING").when(value >= passes, "PASS").when(value >= warns, "WARN").otherwise("FAIL")


def fill_forward(rows: DataFrame, column: str, group: str, order: str, name: str) -> DataFrame:
    """Adds ``name``: the column, or where it is null its last value before that in the group's order."""
    return carried(rows, [group], [order], **{name: F.col(column)}).withColumn(name, F.coalesce(column, name))


def clean_names(name: Column) -> Column:
    """Trimmed, underscores as spaces, title case unless all upper case."""
    trimmed = F.trim(F.translate(name, "_", " "))
    return F.when(trimmed == F.upper(trimmed), trimmed).otherwise(F.initcap(trimmed))


def tile(seqs: DataFrame, size: int) -> DataFrame:
    """``(name, tile, seq)``: fixed tiles from 1, the last one shorter."""
    starts = F.when(F.length("seq") > 0, F.sequence(F.lit(0), F.floor((F.length("seq") - 1) / size).cast("int")))
    return seqs.select("name", "seq", F.explode(starts).alias("k")).select("name", (F.col("k") + 1).alias("tile"), F.substr("seq", F.col("k") * size + 1, F.lit(size)).alias("seq"))


def side_from_suffix(name: Column) -> dict[str, Column]:
    low = F.lower(name)
    return {"strand": F.when(name.endswith("R"), "-").otherwise("+"), "side": F.when(low.contains("_left"), "forward").when(low.contains("_right"), "reverse")}


def mask_intervals(seqs: DataFrame, intervals: DataFrame, letter: str = "N") -> DataFrame:
    """Positions (from 0) covered by ``intervals(name, start, stop)`` replaced; a sequence's merged intervals stay in its row."""
    from ..operators.windows import merge_intervals

    merged = merge_intervals(intervals.withColumnRenamed("name", "contig")).groupBy(F.col("contig").alias("name")).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))

    def put(seq: Column, span: Column) -> Column:
        n = F.length(seq)
        a, b = F.least(F.greatest(span["start"], F.lit(0)), n), F.least(F.greatest(span["stop"], F.lit(0)), n)
        return F.concat(F.substr(seq, F.lit(1), a.cast("int")), F.repeat(F.lit(letter), (b - a).cast("int")), F.substr(seq, (b + 1).cast("int"), n))

    masked = F.when(F.col("spans").isNull(), F.col("seq")).otherwise(F.aggregate("spans", F.col("seq"), put))
    return seqs.join(merged, "name", "left").select("name", masked.alias("seq"))


def append_attributes(gtf: DataFrame, biotype: str, exons_to_genes: bool = False) -> DataFrame:
    """Gene and transcript biotype in the attributes of every row; exon rows as gene rows if asked."""
    more = F.create_map(F.lit("gene_biotype"), F.lit(biotype), F.lit("transcript_biotype"), F.lit(biotype))
    kept = F.map_filter("attributes", lambda k, v: ~k.isin("gene_biotype", "transcript_biotype"))
    rows = gtf.withColumn("attributes", F.map_concat(kept, more))
    return rows.withColumn("feature", F.when(F.col("feature") == "exon", "gene").otherwise(F.col("feature"))) if exons_to_genes else rows


def lookup_rows(species: DataFrame, division: str) -> DataFrame:
    return species.select("species", "assembly", F.lit(division).alias("division"))


def normalise_call(code: Column, codes: dict[str, str]) -> Column:
    """A tool's code as singlet, doublet or unassigned; unknown and null codes are unassigned."""
    out = F.lit("unassigned")
    for k, v in codes.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def posterior_call(probs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``(barcode, call, best_singlet)`` of ``(barcode, donor, p)``: best donor above the threshold, ``a+b`` is a doublet."""
    best = probs.groupBy("barcode").agg(
        F.max("p").alias("p"),
        F.min_by("donor", F.struct((-F.col("p")).alias("q"), "donor")).alias("donor"),
        F.min_by(F.when(~F.col("donor").contains("+"), F.col("donor")), F.when(~F.col("donor").contains("+"), F.struct((-F.col("p")).alias("q"), "donor"))).alias("best_singlet"),
    )
    call = F.when(F.col("p") <= threshold, "unassigned").when(F.col("donor").contains("+"), "doublet").otherwise(F.col("donor"))
    return best.select("barcode", call.alias("call"), "best_singlet")


#: The letters each IUPAC nucleotide code stands for.
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "R": "[AG]", "Y": "[CT]", "S": "[CG]", "W": "[AT]", "K": "[GT]", "M": "[AC]", "B": "[CGT]", "D": "[AGT]", "H": "[ACT]", "V": "[ACG]", "N": "[ACGT]", "I": "[ACGT]"}


def iupac_regex(primer: str) -> str:
    return "".join(IUPAC.get(c, c) for c in primer)


def extract_region(seq: Column, forward: str, reverse: str) -> Column:
    """The part between two primers (as patterns), the first on each side; null if there is none."""
    return F.nullif(F.regexp_extract(seq, f"{forward}(.*?){reverse}", 1), F.lit(""))


def demultiplex(pairs: DataFrame, primers: list[tuple[str, str, str]]) -> DataFrame:
    """Adds ``region`` (first whose patterns open both mates, else "unknown") and the trimmed mates."""
    region, r1, r2 = F.lit("unknown"), F.col("r1"), F.col("r2")
    t1, t2 = r1, r2
    for name, fwd, rev in reversed(primers):
        hit = r1.rlike(f"^(?:{fwd})") & r2.rlike(f"^(?:{rev})")
        region = F.when(hit, name).otherwise(region)
        t1 = F.when(hit, F.regexp_replace(r1, f"^(?:{fwd})", "")).otherwise(t1)
        t2 = F.when(hit, F.regexp_replace(r2, f"^(?:{rev})", "")).otherwise(t2)
    return pairs.withColumns({"region": region, "trimmed_1": t1, "trimmed_2": t2})


#: Bytes of sequences that one task of :func:`dereplicate` tells apart.
TASK_BYTES = 64 << 20


def dereplicate(seqs: DataFrame, floors: DataFrame) -> DataFrame:
    """Distinct (sequence, taxonomy) pairs at least as long as their domain's floor; ``floors`` has a row per domain.

    Floors go to every task, as domains are few and a join by them would put
    all sequences of a domain into one.  The sequences' size is summed up when
    this is called: tasks are as many as keep their share bounded.
    """
    rows = seqs.join(F.broadcast(floors), "domain").where(F.length("seq") >= F.col("floor")).select("domain", "seq")
    size = rows.agg(F.sum(F.octet_length("seq").cast("long"))).first()[0] or 0
    tasks = -(-size // TASK_BYTES)
    if tasks > int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        rows = rows.repartition(tasks, "domain", "seq")
    return rows.distinct()
