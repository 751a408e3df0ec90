import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cliqueflow.session import build_session

    s = build_session("cliqueflow-tests", cpus="*", shuffle_partitions=8, driver_memory="8g")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted tuples of ``cols`` (default: all columns)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: [(v is None, v) for v in t])


def vertices(spark, spec):
    """'A:Trump* x' -> (id, label, prelabelled); a bare id labels itself."""
    out = []
    for token in spec.split():
        vid, _, label = token.partition(":")
        locked = label.endswith("*")
        out.append((vid, (label.rstrip("*") or vid), locked))
    return spark.createDataFrame(out, "id string, label string, prelabelled boolean")


def edges(spark, triples):
    return spark.createDataFrame(triples, "src string, dst string, weight long")
