"""What is dear is computed once."""

from pyspark.sql import functions as F

from riskloom.operators import statistics as st


def test_a_histogram_computes_its_values_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def dear(x):
        seen.add(1)
        return float(x)

    rows = st.histogram(spark.range(100).select(dear.asNondeterministic()("id").alias("v")), "v", 4).collect()
    assert seen.value == 100 and sorted((r.bin, r.n) for r in rows) == [(0, 25), (1, 25), (2, 25), (3, 25)]
