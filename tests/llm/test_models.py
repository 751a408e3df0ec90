"""The trained models against plain forms: the convolution by loops, Kneser-Ney by dictionaries."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from cliqueflow.llm import kneser_ney, toxicity

from . import brute


def test_convolution_equals_loops():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choice(words, rng.integers(0, 9))) for _ in range(40)] + ["", "W1 w1", "x! w2,w3"]
    hashed, bounds = toxicity.buckets([w.encode() for w in words])
    bucket = {w: int(hashed[b + 1]) for w, b in zip(words, bounds)}
    known = np.array(sorted(bucket[w] for w in words[:9]), dtype=np.uint64)  # the others embed as zero
    embed = rng.normal(0, 1, (known.size + 1, toxicity.DIM)).astype(np.float32)
    embed[toxicity.UNKNOWN] = 0
    filters = {k: rng.normal(0, 1, (k, toxicity.DIM, toxicity.FILTERS)).astype(np.float32) for k in toxicity.WIDTHS}
    n = toxicity.FILTERS * len(toxicity.WIDTHS)
    model = toxicity.Model(known, embed, filters, rng.normal(0, 1, n).astype(np.float32), rng.normal(0, 1, n).astype(np.float32), 0.3)
    rows = {w: embed[np.searchsorted(known, bucket[w]) + 1] for w in words[:9]}
    got = model.scores([t.encode() for t in texts], model.tables())
    for text, score in zip(texts, got):
        tokens = text.lower().replace("!", " ").replace(",", " ").split()
        padded = [None, *tokens, None, None]
        vectors = [rows.get(t, np.zeros(toxicity.DIM)) for t in padded]
        pooled = [
            max(sum(float(vectors[i + j] @ filters[k][j][:, f]) for j in range(k)) for i in range(len(padded) - 2))
            for k in toxicity.WIDTHS
            for f in range(toxicity.FILTERS)
        ]
        z = sum(max(p + float(b), 0) * float(o) for p, b, o in zip(pooled, model.bias, model.out)) + 0.3
        assert math.isclose(score, 1 / (1 + math.exp(-z)), abs_tol=1e-5), text


def plain_kneser_ney(train, texts):
    """log10 probability of every text by modified Kneser-Ney bigrams over whole dictionaries."""
    end, unknown = object(), object()
    vocabulary = {w for t in train for w in t}
    pairs = Counter()
    for t in train:
        pairs.update(zip([end, *t], [*t, end]))
    d = kneser_ney.discounts(*[sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4)])
    cut = lambda c, d: 0.0 if c == 0 else d[min(c, 3) - 1]
    into = Counter(w for _, w in pairs)
    own = kneser_ney.discounts(*[sum(c == k for c in into.values()) for k in (1, 2, 3, 4)])
    total, used = sum(into.values()), len(vocabulary) + 2
    spare = sum(cut(c, own) for c in into.values()) / total / used
    low = defaultdict(lambda: spare, {w: (c - cut(c, own)) / total + spare for w, c in into.items()})
    seen, left = Counter(), Counter()
    for (b, _), c in pairs.items():
        seen[b] += c
        left[b] += cut(c, d)
    out = []
    for t in texts:
        t = [w if w in vocabulary else unknown for w in t]
        p = 0.0
        for b, w in zip([end, *t], [*t, end]):
            c = pairs[b, w]
            p += math.log10((c - cut(c, d) + left[b] * low[w]) / seen[b] if seen[b] else low[w])
        out.append(p)
    return out


def test_quality_model_equals_plain_counts(spark):
    rng = random.Random(6)
    voc = [f"w{int(rng.paretovariate(0.7))}" for _ in range(300)]
    rows = [(i, " ".join(rng.choice(voc) for _ in range(rng.randint(0, 40))), "en") for i in range(120)]
    rows += [(500, "never seen words here", "en"), (501, None, "de")]
    labels = spark.createDataFrame([(i, int(i < 50 or i == 60)) for i in range(100)], "doc_id long, quality int")
    got = {r.doc_id: (r.n_tokens, r.log10_prob) for r in kneser_ney.perplexities(spark.createDataFrame(rows, "doc_id long, text string, lang string"), labels).collect()}
    tokens = [brute.WORD.findall(t or "") for _, t, _ in rows]
    train = [t for (i, _, _), t in zip(rows, tokens) if (i < 50 or i == 60) and zlib.crc32(str(i).encode()) % kneser_ney.HELD_FOLD]
    for (i, _, _), t, want in zip(rows, tokens, plain_kneser_ney(train, tokens)):
        assert got[i][0] == len(t) + 1 and math.isclose(got[i][1], want, rel_tol=1e-5), i


def test_quality_model_numbers_every_word(spark):
    """More words than one part holds, contexts that nobody knows, and several copies of the model."""
    rows = [(i, " ".join(f"v{(i * j) % 211}" for j in range(1, 30)), "en") for i in range(90)]
    rows += [(200, "x y z v1 x v2 y", "en"), (201, "", "en")]
    labels = spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int")
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = {r.doc_id: r.log10_prob for r in kneser_ney.perplexities(df, labels, docs_per_copy=20, part=16).collect()}
    tokens = [brute.WORD.findall(t) for _, t, _ in rows]
    train = [t for (i, _, _), t in zip(rows, tokens) if i < 60 and zlib.crc32(str(i).encode()) % kneser_ney.HELD_FOLD]
    assert len({w for t in train for w in t}) > 10 * 16
    for (i, _, _), want in zip(rows, plain_kneser_ney(train, tokens)):
        assert math.isclose(got[i], want, rel_tol=1e-5), i


def test_quality_model_learns_every_trusted_document(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "MAX_TRAIN", 10, raising=False)  # the bound that was
    monkeypatch.setattr(kneser_ney, "SHARDS", 4)
    monkeypatch.setattr(kneser_ney, "DOCS_PER_MODEL", 20, raising=False)
    rows = [(i, " ".join(f"v{(i * j) % 97}" for j in range(1, 12)), "en") for i in range(90)]
    labels = spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int")
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r.log10_prob for r in kneser_ney.perplexities(df, labels, docs_per_copy=10).collect()}
    tokens = [brute.WORD.findall(t) for _, t, _ in rows]
    train = [t for (i, _, _), t in zip(rows, tokens) if i < 60 and zlib.crc32(str(i).encode()) % kneser_ney.HELD_FOLD]
    assert len(train) > 40
    for (i, _, _), want in zip(rows, plain_kneser_ney(train, tokens)):
        assert math.isclose(got[i], want, rel_tol=1e-5), i


def test_quality_model_has_no_more_shards_than_memory_needs():
    """Every shard that a block asks sends a number for each of its documents."""
    assert kneser_ney.model_shards(0) == kneser_ney.model_shards(60_000) == kneser_ney.SHARDS
    assert kneser_ney.model_shards(600_000) > kneser_ney.SHARDS  # the shards grow with the trusted documents


def test_bigram_counts_merge_a_few_times(monkeypatch):
    """Counts of many blocks come out right, and not every block sorts the whole shard again."""
    monkeypatch.setattr(kneser_ney, "MERGED", 50, raising=False)
    rng, want, rows, sorts, unique = np.random.default_rng(8), Counter(), [], [], np.unique
    for shard in (1, 1, 1, 2):
        for _ in range(100):
            keys, n = unique(kneser_ney.key_of(rng.integers(0, 40, 12), rng.integers(0, 40, 12)), return_counts=True)
            want.update({(shard, int(k)): int(c) for k, c in zip(keys, n)})
            rows.append((shard, keys.size, kneser_ney.pack_arrays(kneser_ney.deltas(keys), n.astype("<u4"))))
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["shard", "n", "blob"])
    monkeypatch.setattr(np, "unique", lambda *a, **b: sorts.append(1) or unique(*a, **b))
    got = {}
    for out in kneser_ney.add_counts(iter([batch])):
        (row,) = out.to_pylist()
        data = kneser_ney.expand(row["blob"])
        counts = kneser_ney.unplanes(data[8 * row["n"] :], "<u4").tolist()
        got |= {(row["shard"], int(k)): c for k, c in zip(kneser_ney.keys_of(data, row["n"]), counts)}
        assert [row[f"n{k}"] for k in (1, 2, 3, 4)] == [counts.count(k) for k in (1, 2, 3, 4)]
    assert got == want
    assert len(sorts) < 60  # 400 rows


def test_packed_bigrams_come_back():
    rng = np.random.default_rng(3)
    for size, most in ((0, 5), (1, 1), (300, 6), (300, 1 << 31)):
        keys = np.sort(kneser_ney.key_of(rng.integers(0, most, size), rng.integers(0, most, size)))
        assert (kneser_ney.keys_of(kneser_ney.planes(kneser_ney.deltas(keys)), size) == keys).all()


def test_toxicity_counts_every_labelled_text(spark, monkeypatch):
    """All labelled texts are counted, long ones too, and copies once; one worker or many."""
    monkeypatch.setattr(toxicity, "MAX_TRAIN", 10, raising=False)  # the bounds that were
    monkeypatch.setattr(toxicity, "MAX_TRAIN_CHARS", 50, raising=False)
    monkeypatch.setattr(toxicity, "TEXTS_PER_WORKER", 40, raising=False)
    monkeypatch.setattr(toxicity, "EPOCHS", 2)
    own = lambda i: " ".join(f"n{i}x{j}" for j in range(20))
    rows = [(i, f"{own(i)} {'bad' if i % 2 else 'good'}", "en") for i in range(200)]
    rows += [(1000 + i, rows[i][1], "en") for i in range(50)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(1000 + i, i % 2) for i in range(50)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = toxicity.fit(docs, labels, lambda k: k.isNotNull())
    hashed, _ = toxicity.buckets([b"bad", b"good"])
    assert set(hashed[hashed > 0].tolist()) <= set(model.known.tolist())
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert min(got[i] for i in range(1, 200, 2)) > max(got[i] for i in range(0, 200, 2))


def test_toxicity_passes_run_once_over_texts_dealt_once(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(toxicity, "TEXTS_PER_WORKER", 40)
    monkeypatch.setattr(toxicity, "EPOCHS", 3)
    real, seen = toxicity.one_pass, str(tmp_path)

    def noted(shared, nth, share):
        run = real(shared, nth, share)

        def again(batches):
            import tempfile

            tempfile.mkstemp(prefix=f"pass{nth}-", dir=seen)
            return run(batches)

        return again

    monkeypatch.setattr(toxicity, "one_pass", noted)
    rows = [(i, f"{' '.join(f'n{i}x{j}' for j in range(9))} {'bad' if i % 2 else 'good'}", i % 2) for i in range(120)]
    used = spark.createDataFrame(rows, "_h long, _text string, _toxic int")
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = toxicity.train(used, 60, 60)
    assert Counter(p.name[:5] for p in tmp_path.iterdir()) == {f"pass{nth}": 3 for nth in range(3)}  # three workers
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    low, high = model.scores([b"good", b"bad"], model.tables())
    assert low < high


def test_toxicity_mean_of_states_is_weighted(spark):
    states = [{"a": np.full(3, v, np.float32), "t": np.array([v])} for v in (1.0, 4.0)]
    rows = [(0, 10, toxicity.squeeze(toxicity.pickle.dumps(states[0]))), (1, 5, toxicity.squeeze(toxicity.pickle.dumps(states[1])))]
    got = toxicity.mean_state(spark.createDataFrame(rows, "worker long, n long, state binary"), states[0])
    assert got["a"].dtype == np.float32 and got["a"].tolist() == [2.0] * 3 and got["t"].tolist() == [2.0]
