from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cliqueflow.llm import exact_dedup

TEXT = "doc_id long, text string"


def weak(text):
    """A hash with three values, so most classes collide."""
    return F.unhex(F.lpad(F.hex(F.length(text) % 3), 32, "0"))


def rows():
    rng = random.Random(8)
    out = [(rng.choice([i, i, i, i // 3, None]), rng.choice([None, "", "a", "b", "é", "é", "aa", "A", "a ", "\n", "word " * 30_000])) for i in range(300)]
    return out + [(7, "a")] * 60 + [(None, "only null")] * 3 + [(900 + i, "hot") for i in range(200)]


def copies(data, largest):
    groups = defaultdict(list)
    for i, t in data:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        stays = (max(known) if largest else min(known)) if known else None
        left = 1
        for i in ids:
            kept = i == stays and left > 0
            left -= kept
            out.append((i, stays, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("digest", [exact_dedup.content_hash, weak])
def test_classes_equal_plain_grouping(spark, largest, digest):
    data = rows()
    df = spark.createDataFrame([(*r, "x") for r in data], TEXT + ", kept string").repartition(5)
    got = exact_dedup.find_copies(df, largest=largest, digest=digest)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == copies(data, largest)


def test_normalised_texts_and_empty_table(spark):
    df = spark.createDataFrame([(1, "A"), (2, "a"), (3, None)], TEXT)
    got = {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in exact_dedup.find_copies(df, normal=F.lower).collect()}
    sha = hashlib.sha256(b"a").hexdigest()
    assert got == {1: (1, 2, sha), 2: (1, 2, sha), 3: (3, 1, hashlib.sha256(b"").hexdigest())}
    assert exact_dedup.find_copies(df.limit(0)).count() == 0


def test_rows_that_stay_keep_their_columns(spark):
    data = [(i, t, i, "h") for i, t in rows()]
    df = spark.createDataFrame(data, TEXT + ", _row long, _hash string").repartition(3)
    got = exact_dedup.drop_copies(df)
    assert got.schema == df.schema
    stay = {(i, sha) for i, _, _, kept, sha in copies(rows(), False) if kept}
    assert {(r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in got.collect()} == stay
    assert got.select(F.coalesce("text", F.lit(""))).distinct().count() == got.count() == len({t or "" for _, t in rows()})


def test_main_path_is_native(spark, capsys):
    exact_dedup.find_copies(spark.createDataFrame([(1, "a")], TEXT)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan
