import random
import time

from pyspark.sql import functions as F
from tests.llm.data import Union

from riskweave.llm.common import checkpoint, components


def test_against_plain_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in range(40)]  # a chain
    edges += [(2000, 2001 + i) for i in range(50)] + [(5, 5), (None, 3), (3, None)] + edges[:9]
    up = Union()
    for a, b in edges:
        if a is not None and b is not None and a != b:
            up.join(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: up.find(x) for x in up.up}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_a_checkpoint_leaves_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = manager.getAllFiles()
        return {x for x in (found.apply(i).getName() for i in range(found.size())) if x.startswith("shuffle_")}

    frame = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = files()
    kept = checkpoint(frame)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert kept.count() == 7
