"""What a task of the nearest-neighbour pass holds at once."""

import numpy as np
import pyarrow as pa

from tallyframe.operators import joins as J


def test_rows_are_compared_a_block_at_a_time():
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(1300))], ["vec_id"])
    parts = list(J._sliced(iter([batch, batch.slice(0, 0), batch.slice(0, 5)])))
    assert [p.num_rows for p in parts] == [512, 512, 276, 5] and parts[1].column("vec_id")[0].as_py() == 512


def test_nearest_over_blocks_equals_all_at_once(spark):
    x = np.random.default_rng(3).standard_normal((1300, 6))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").coalesce(1)
    found = {(r.vec_id, r["rank"]): r.neighbour for r in J.knn(vectors.where("vec_id % 100 = 0"), vectors, 4).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, 1300, 100):
        s = unit @ unit[i]
        s[i] = -2
        assert [found[i, k] for k in range(1, 5)] == np.argsort(-s)[:4].tolist()
