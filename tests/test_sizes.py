"""What a task holds and what is written, where both once grew with the input or beyond need."""

import glob

from pyspark.sql import functions as F

from tallyframe.functions import columns as C
from tallyframe.plans import QUERIES


def test_dereplicate_deals_by_sequence_and_size(spark, monkeypatch):
    rows = [("en", f"a{i % 50:03}") for i in range(200)] + [("fr", "b"), ("fr", "bbbb"), (None, "cccc"), ("de", "dddd"), ("en", None)]
    seqs = spark.createDataFrame(rows, "domain string, seq string")
    floors = spark.createDataFrame([("en", 4), ("fr", 4), ("xx", 1)], "domain string, floor int")
    want = {("en", f"a{i:03}") for i in range(50)} | {("fr", "bbbb")}
    for size in (C.TASK_BYTES, 100):
        monkeypatch.setattr(C, "TASK_BYTES", size)
        found = C.dereplicate(seqs, floors)
        got = [tuple(r) for r in found.collect()]
        assert len(got) == len(want) and set(got) == want
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(domain#" in plan and ", seq#" in plan.split("hashpartitioning(")[1].split(")")[0]
    most = found.withColumn("task", F.spark_partition_id()).groupBy("task").count().agg(F.max("count")).first()[0]
    assert most < 30 and ", 9)" in plan


def test_fastq_files_are_compressed(spark, monkeypatch, tmp_path):
    from tallyframe.plans import q_sources

    paths = []
    monkeypatch.setattr(q_sources, "folder", lambda s, name: paths.append(f"{tmp_path}/{name}-{len(paths)}") or paths[-1])
    QUERIES["s10_read_fastq_interleave"](spark, "/root/testdata/sf0.001")
    files = [f for p in paths for f in glob.glob(f"{p}/lane=*/*")]
    assert len(paths) == 2 and files and all(f.endswith(".gz") for f in files)
