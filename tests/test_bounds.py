"""What one task holds, compares or carries at once."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.operators import density, events, search, tables


def test_visits_are_given_out_in_bounded_batches():
    """Where no bound leaves a unit out, a block of points visits all of them."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("vec", T.ArrayType(T.DoubleType())), T.StructField("dp", T.DoubleType())])

    class Points:
        columns = schema.names

        def __init__(self):
            self.schema = schema

        def mapInArrow(self, run, out):  # noqa: N802
            return run

    n, units = 300, 200
    vec = np.zeros((n, 4))
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(vec.tolist(), pa.list_(pa.float64())), pa.array(np.zeros(n))],
                                       names=schema.names)
    held = density.Units(np.zeros((units, 4)), np.arange(units), np.ones(units), np.ones(units))
    got = list(density._visits(Points(), held, np.arange(units), ["id", "vec"])(iter([batch])))
    assert max(b.num_rows for b in got) <= density.VISIT_ROWS
    assert sum(b.num_rows for b in got) == n * units


def test_near_components_are_those_of_all_pairs(monkeypatch):
    """matrix products link what single distances link, ties included."""
    monkeypatch.setattr(events, "BLOCK_CELLS", 900)
    r = np.random.default_rng(3)
    for dim, eps in ((1, 0.03), (2, 0.1), (6, 1.5)):
        v, group = np.round(r.standard_normal((150, dim)), 2), r.integers(0, 2, 150)
        near = (np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1)) <= eps) & (group[:, None] == group[None])
        star = np.arange(150)
        while True:
            least = np.where(near, star[None], 150).min(1)
            if (least == star).all():
                break
            star = least
        assert (events.near_components(v, group, eps) == star).all()


def test_a_row_that_is_its_own_order_is_carried_once(spark):
    """batches are ordered by all columns; the row is not sent beside its order."""
    rows = [(1, "b", 2), (1, None, 3), (1, None, 2), (2, "x", None), (None, "y", 1), (None, "x", 9)]
    df = spark.createDataFrame(rows, "k long, text string, n int")
    got = tables.dedupe_first_by_key(df, ["k"], ["n", "text"])
    assert got.columns == df.columns
    assert {tuple(x) for x in got.collect()} == {(1, None, 2), (2, "x", None), (None, "y", 1)}
    assert "min_by" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_the_norm_of_a_vector_is_summed_once(spark):
    """the sum of squares stands outside the function that is called for every value."""
    df = spark.createDataFrame([("a b b",), ("...",), (None,)], "text string")
    got = search.embed(df, "text", "e", search.hashing_encoder(8))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "array_repeat(sqrt(aggregate(" in plan.lower()
    norms = [sum(x * x for x in r["e"]) for r in got.orderBy(F.col("text").desc_nulls_last()).collect()]
    assert [round(x, 5) for x in norms] == [1.0, 0.0, 0.0]
