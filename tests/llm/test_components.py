from pyspark.sql import functions as F

from branchlens.llm.components import _signature


def test_signature_of_very_many_links(spark):
    edges = spark.range(1 << 25, numPartitions=8).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    some = edges.where("a != 12345")
    assert _signature(edges) == _signature(edges.repartition(3))
    assert _signature(edges)[0] == 1 << 25 and _signature(some) != _signature(edges)
    moved = some.union(spark.createDataFrame([(12345, 7)], "a long, b long"))
    assert _signature(moved)[0] == 1 << 25 and _signature(moved) != _signature(edges)
    assert _signature(edges.limit(0))[0] == 0
