"""Keyed tables through a connector: a data source in this process that upserts by key, with commit and abort."""

import json
import os
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from cliqueflow.plans.stages import StageOptions, run_stage
from cliqueflow.schemas import Paths


# workers cannot import a test module
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class KeyedStore(DataSource):
    """Tables as folders of committed batches; the last batch that has a key wins."""

    @classmethod
    def name(cls):
        return "keyed_store"

    def schema(self):
        return "id string"

    def writer(self, schema, overwrite):
        return KeyedWriter(dict(self.options))


class Part(WriterCommitMessage):
    def __init__(self, path):
        self.path = path


class KeyedWriter(DataSourceWriter):
    def __init__(self, options):
        self.root = os.path.join(options["root"], options["table"])
        self.key = options["key.column"]
        self.fail_on = options.get("fail_on")
        os.makedirs(self.root, exist_ok=True)

    def write(self, rows):
        path = os.path.join(self.root, f"part-{uuid.uuid4().hex}")
        with open(path, "w") as out:
            for r in rows:
                if r[self.key] == self.fail_on:
                    raise RuntimeError("the store went away")
                out.write(json.dumps(r.asDict()) + "\n")
        return Part(path)

    def commit(self, messages):
        table = os.path.join(self.root, "table.json")
        rows = json.load(open(table)) if os.path.exists(table) else {}
        for m in messages:
            for line in open(m.path):
                row = json.loads(line)
                rows[row[self.key]] = row
            os.remove(m.path)
        with open(table, "w") as out:
            json.dump(rows, out)

    def abort(self, messages):
        for m in messages:
            if m is not None:
                os.remove(m.path)


def stored(root, table):
    path = os.path.join(root, table, "table.json")
    return json.load(open(path)) if os.path.exists(path) else None


@pytest.fixture
def store(spark, tmp_path):
    spark.dataSource.register(KeyedStore)
    return Paths(str(tmp_path)), str(tmp_path / "store")


def options(root, **more):
    return StageOptions(kv_format="keyed_store", kv_mode="append", kv_options={"root": root, **more})


def test_both_tables_go_through_a_connector_by_key(spark, store):
    paths, root = store
    spark.createDataFrame([(str(i), "AB"[i % 2]) for i in range(20)], "id string, label string").repartition(3).write.parquet(paths["labelled"])
    spark.createDataFrame([("A", ["x", "y, z"], 2)], "name string, influencers array<string>, size int").write.parquet(paths["communities"])
    run_stage(spark, "database", paths, options(root))
    users = stored(root, "user")
    assert users == {str(i): {"id": str(i), "label": "AB"[i % 2]} for i in range(20)}  # plain ids, no prefix
    assert stored(root, "communities") == {"A": {"name": "A", "influencers": ["x", "y, z"], "size": 2}}
    spark.createDataFrame([("3", "C"), ("99", "C")], "id string, label string").write.mode("overwrite").parquet(paths["labelled"])
    run_stage(spark, "vertices", paths, options(root))
    assert stored(root, "user") == users | {"3": {"id": "3", "label": "C"}, "99": {"id": "99", "label": "C"}}


def test_a_failed_write_leaves_nothing(spark, store):
    paths, root = store
    lab = spark.range(40).select(F.col("id").cast("string").alias("id"), F.lit("A").alias("label"))
    lab.repartition(4).write.parquet(paths["labelled"])
    with pytest.raises(Exception, match="went away"):
        run_stage(spark, "vertices", paths, options(root, fail_on="17"))
    assert stored(root, "user") is None
    lab.unionByName(lab.limit(1)).write.mode("overwrite").parquet(paths["labelled"] + "-2")
    twice = Paths(str(paths.root), labelled="labelled-2")
    with pytest.raises(ValueError, match="not unique"):
        run_stage(spark, "vertices", twice, options(root))
    assert stored(root, "user") is None
