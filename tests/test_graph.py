"""Graph building (H5-H7) and its invariants."""

import pytest
from pyspark.sql import functions as F

from cliqueflow.operators import graph
from conftest import rows

REFS = [("1", "2"), ("1", "2"), ("1", None), ("3", "1")]


def refs(spark, data=REFS):
    return spark.createDataFrame(data, "src string, dst string")


def seeds(spark, data):
    return spark.createDataFrame(data, "id string, label string, prelabelled boolean")


def test_h5_edges_and_vertices(spark):
    assert rows(graph.build_edges(refs(spark)), "src", "dst", "weight") == [
        ("1", "2", 2), ("1", None, 1), ("3", "1", 1)]
    v = rows(graph.build_vertices(refs(spark), seeds(spark, [("9", "Trump", True)])))
    assert v == [("1", "1", False), ("2", "2", False), ("3", "3", False), ("9", "Trump", True)]


def test_h6_empty_seed_list(spark):
    v = rows(graph.build_vertices(refs(spark), seeds(spark, [])))
    assert v == [("1", "1", False), ("2", "2", False), ("3", "3", False)]


def test_h7_duplicate_seed_is_an_error(spark):
    with pytest.raises(ValueError, match="more than once"):
        graph.build_vertices(refs(spark), seeds(spark, [("9", "A", True), ("9", "B", True)]))


def test_seed_replaces_unlabelled_vertex(spark):
    v = rows(graph.build_vertices(refs(spark), seeds(spark, [("2", "Biden", True)])))
    assert ("2", "Biden", True) in v and ("2", "2", False) not in v


def test_legacy_column_names(spark):
    legacy = spark.createDataFrame([("1", "2")], "id string, reply_id string")
    assert rows(graph.build_edges(legacy)) == [("1", "2", 1)]


def test_weight_sum_equals_reference_count(spark):
    from cliqueflow.plans import catalog
    from cliqueflow.sources.social import SocialTables

    t = SocialTables(spark, "/root/testdata/sf0.001")
    r = catalog.refs_of(t)
    total = graph.build_edges(r).agg(F.sum("weight")).first()[0]
    assert total == r.count()
