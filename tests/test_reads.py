"""Reads against features, without their pairs."""

import random

from tallyframe.sources import readers as R
from tallyframe.operators import aggregates as A


def _tables(spark, seed):
    draw = random.Random(seed)
    span = lambda most: (lambda a: (a, a + draw.randint(0, most)))(draw.randint(0, 60))
    reads = [(draw.choice([None, *range(60)]), draw.choice(["c", "d", None]), *span(5), draw.choice("+-.")) for _ in range(120)]
    exons = [(draw.choice(["g1", "g2", "g3", None]), draw.choice("POFX"), draw.choice("cd"), *span(draw.choice([3, 40])), draw.choice("+-")) for _ in range(14)]
    return reads, exons, spark.createDataFrame(reads, "name long, contig string, start long, stop long, strand string"), spark.createDataFrame(exons, "gene string, class string, contig string, start long, stop long, strand string")


def _meets(r, e):
    return r[1] == e[2] and r[2] < r[3] and e[3] < e[4] and r[2] < e[4] and e[3] < r[3]


def test_reads_and_features_equal_all_pairs(spark):
    for seed in range(4):
        reads, exons, r, e = _tables(spark, seed)
        for stranded in (0, 1, 2):
            genes = {}
            for x in reads:
                for y in exons:
                    if _meets(x, y) and (not stranded or (x[4] == y[5]) == (stranded == 1)):
                        genes.setdefault(x[0], set()).update({y[0]} - {None})
            want = {}
            for found in genes.values():
                if len(found) == 1:
                    want[min(found)] = want.get(min(found), 0) + 1
            assert dict(map(tuple, A.assign_reads(r, e, stranded).collect())) == want
        want, order = {}, ["P", "O", "F"]
        for x in reads:
            best = [order.index(y[1]) for z in reads if z[0] == x[0] is not None for y in exons if _meets(z, y) and y[1] in order]
            name = order[min(best)] if best else "intergenic"
            want[name] = want.get(name, 0) + 1
        assert dict(map(tuple, A.read_distribution(r, e, order).collect())) == want


def test_reads_meet_no_feature_in_a_pair(spark):
    _, _, r, e = _tables(spark, 9)
    for frame in (A.assign_reads(r, e), A.read_distribution(r, e, ["P"])):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "levels_there" not in plan and "_bin" not in plan


def test_folder_names_are_cut_without_a_pattern(spark, tmp_path):
    """A pattern that ends at the end of a path took most of the time of a line."""
    for sample in ("s a", "s%b"):
        (tmp_path / sample).mkdir()
        (tmp_path / sample / "quant.txt").write_text("#x\nGeneid\tChr\tStart\tEnd\tStrand\tLength\tn\nG1\tc\t1\t9\t+\t7\t3\nG2\tc\t1\t9\t+\n")
    found = R.read_quant(spark, f"{tmp_path}/*/*.txt", "featurecounts")
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert [(r.feature_id, r.value, r.length) for r in found.collect()] == [("G1", 3.0, 7)] * 2
    assert len({r.sample_id for r in found.collect()}) == 2
