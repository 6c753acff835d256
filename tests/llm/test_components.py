import random

from brute import least_roots
from riskledger.llm.components import components
from riskledger.llm.storage import Scratch


def found(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    return {r.node: r.component for r in components(df, Scratch(spark, "test"), "c").collect()}


def test_paths_stars_loops_and_repeats(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)]
    edges += [(7, 7), (5, 200), (200, 5)] + [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)]
    rnd.shuffle(edges)
    nodes = {x for e in edges for x in e}
    assert found(spark, edges) == least_roots(nodes, edges)


def test_no_edges(spark):
    assert found(spark, []) == {}
