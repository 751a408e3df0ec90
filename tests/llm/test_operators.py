"""Every corpus operator against a plain version, with nulls, empty and very long texts, ties, repeats and extra columns."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from cliqueflow.llm import jaccard_join, kneser_ney, lm_scoring, packing, pieces, pii, quality_rules, substring_dedup, topk, toxicity
from cliqueflow.llm.words import Words

from . import brute

TEXT = "doc_id long, text string"


def by_text(rows):
    return sorted(rows, key=str)


def passages(seed=4):
    rng = random.Random(seed)
    voc = ["a", "b", "é", "cc", "d😀"]
    base = [rng.choice(voc) for _ in range(400)]
    rows = []
    for i in range(150):
        k, s, n = rng.random(), rng.randint(0, 380), rng.randint(0, 60)
        w = base[s : s + n] if k < 0.5 else [rng.choice(voc) for _ in range(n)] if k < 0.8 else ["x"] * rng.randint(0, 200)
        text = rng.choice([" ", "\n", ""]) + rng.choice([" ", "\t ", "\n"]).join(w)
        rows.append((rng.choice([None, i, i, i, i // 2]), None if rng.random() < 0.03 else text))
    return rows + [(7777, " ".join(str(rng.random()) for _ in range(20_000)) + " " + " ".join(base))]


@pytest.mark.parametrize("limit", [substring_dedup.BUCKET_LIMIT, 2000])
def test_substring_dedup(spark, limit):
    rows = passages()
    df = spark.createDataFrame([(*r, "k") for r in rows], TEXT + ", kept string").repartition(4)
    got = substring_dedup.dedup_substrings(df, limit=limit).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert by_text(map(tuple, got.collect())) == by_text(brute.substring_dedup(rows))
    assert substring_dedup.dedup_substrings(df.limit(0)).count() == 0


def test_pii_base_spans(spark):
    rng = random.Random(1)
    parts = ["a", "1", ".", "@", "-", " ", "+", "2", "5", "é", "😀", "(", "4111 1111 1111 1111", "1.2.3.4", "b@c.d", " iban "]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(500)]
    rows += [(900, None), (901, ""), (902, "a@b" + ".c" * 20_000), (903, "1" * 50_000), (904, "+1" + "(" * 20_000), (905, "1.2.3.4 " * 2_000)]
    got = pii.find_pii(spark.createDataFrame(rows, TEXT)).selectExpr("doc_id", "filter(_spans, x -> x.k < 4) AS b")
    found = {r[0]: r[1] for r in got.select("doc_id", pii.listed(pii.F.col("b"))).collect()}
    assert found == {i: brute.base_spans(t) for i, t in rows}


def test_pii_checksums_context_and_redaction(spark):
    rows = [(1, "pay to iban DE89 3704 0044 0532 0130 00 now"), (2, "DE89 3704 0044 0532 0130 01"), (3, "ssn 123-45-6789"), (4, "part 123-45-6789"), (5, "mail a@b.c or d@e.f!")]
    df = pii.find_pii(spark.createDataFrame(rows, TEXT))
    got = {r[0]: (r[1], r[2]) for r in df.select("doc_id", pii.listed(pii.F.col("_spans")), pii.redacted(pii.F.col("text"), pii.F.col("_spans"))).collect()}
    assert got[1][0].startswith("iban:12:39") and got[1][1] == "pay to iban <IBAN> now"
    assert "iban" not in got[2][0]
    assert got[3][0] == "ssn:4:15" and got[4][0] == ""
    assert got[5] == ("email:5:10,email:14:19", "mail <EMAIL> or <EMAIL>!")


def test_pii_iban_ends(spark):
    german, british, norwegian = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"
    solid, maltese = german.replace(" ", ""), "MT84MALT011000012345MTLCAST001S"
    cases = [
        ("", german, " Please pay"), ("", german, " BIC COBADEFFXXX"), ("", solid, " 500 EUR"), ("Pay é😀 ", german, "."),
        ("to ", solid, ""), ("", german, "\n12 MAY"), ("REF NO12 3456 ", german, " A"), ("AB12 3456 7890 ", british, " 7 DAYS"),
        ("", norwegian, " KR 100"), ("", maltese, " X"), ("", "DE89\t3704 0044 0532 0130 00", None), ("", solid + "X", None), ("", solid + "x", None),
        ("", german[:-1] + "1 Please pay", None),
    ]
    rows = [(i, a + b + (c or "")) for i, (a, b, c) in enumerate(cases)]
    rows += [(50, f"{german} {british} {norwegian}"), (51, f"{german} " * 1000)]
    got = {r[0]: r[1] for r in pii.find_pii(spark.createDataFrame(rows, TEXT)).selectExpr("doc_id", "filter(_spans, x -> x.k = 4)").collect()}
    found = {i: [t[s.s : s.e] for s in got[i]] for i, t in rows}
    assert [found[i] for i in range(len(cases))] == [[b] * (c is not None) for _, b, c in cases]
    assert found[50] == [german, british, norwegian]
    assert [(s.s, s.e) for s in got[51]] == [(28 * i, 28 * i + 27) for i in range(1000)]


def test_pii_context_on_both_sides_and_in_lists(spark):
    one, gap = "123-45-6789", " " * pii.CONTEXT
    cases = [
        (f"SSN: {one}, {one}, {one}", 3), (f"{one} (SSN)", 1), (f"é😀 {one}, {one} taxpayer", 2), ("SSN:" + f" {one}," * 1000, 1000),
        (f"{one};\n" * 1000 + "social security", 1000), (f"{one}{gap} ssn", 0), (f"ssn {one}{gap}{one}", 2), (f"ssn {one}{gap} {one}", 1),
        (f"ssn {gap}{one}", 0), (f"part {one}, {one}", 0), (f"{one} a {one}{gap} {one} ssn", 1), (f"{one} ssnumber{gap}. {one}", 1), (f"lessn {one}", 0),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], TEXT)
    got = {r[0]: r[1] for r in pii.find_pii(df).selectExpr("doc_id", "filter(_spans, x -> x.k = 5)").collect()}
    assert [len(got[i]) for i in range(len(cases))] == [n for _, n in cases]
    assert all(cases[i][0][s.s : s.e] == one for i, found in got.items() for s in found)
    mails = spark.createDataFrame([(1, "a@b.c (mail)"), (2, "a@b.c now"), (3, "iban: none, a@b.c"), (4, "DE89 3704 0044 0532 0130 00 KONTO")], TEXT)
    scores = {r[0]: [round(x, 2) for x in r[1]] for r in pii.find_pii(mails).selectExpr("doc_id", "transform(filter(_spans, x -> x.k in (0, 4)), x -> x.score)").collect()}
    assert scores == {1: [1.05], 2: [0.7], 3: [0.7], 4: [0.95]}


def test_pieces_equal_the_library_and_tile_the_source(spark):
    rng = random.Random(3)
    parts = [" ", "  ", "a", "▁", "the", "\n", "😀", "é", "\t", "ing", "<s>", "\x00", "ﬁ", "　"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)] + [None, "", " ", "a ", " " * 500, "ab " * 5000]
    rows = list(enumerate(texts))
    model = pieces.encoder(pieces.model_path()).model
    for r in pieces.encode_texts(spark.createDataFrame(rows, TEXT), pieces.model_path()).collect():
        ids = model.encode(texts[r.doc_id] or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == model.decode(ids)
        starts, ends = np.frombuffer(r.starts, "<u4")[1:-1], np.frombuffer(r.ends, "<u4")[1:-1]
        assert (starts[1:] == ends[:-1]).all() and (not ids[1:-1] or ends[-1] == len(texts[r.doc_id].encode()))


def test_character_map_takes_the_longest_prefix():
    # one trie with "a" -> "x" and "ab" -> "y": units at root 0, 'a' node, its leaf, 'b' node, its leaf
    units = [0] * 1024
    units[0] = 1 << 10  # root: children at 0 ^ 1
    a = 1 ^ ord("a")
    units[a] = (((a ^ 256) << 10) | (1 << 8) | ord("a")) & 0xFFFFFFFF
    leaf = a ^ (a ^ 256)
    units[leaf] = (1 << 31) | 0
    b = leaf ^ ord("b")
    units[b] = ((512 << 10) | (1 << 8) | ord("b")) & 0xFFFFFFFF
    units[b ^ 512] = (1 << 31) | 2
    blob = np.array(units, "<u4").tobytes()
    cmap = pieces.CharMap(len(blob).to_bytes(4, "little") + blob + b"x\0y\0")
    assert cmap.longest(b"abc", 0) == (2, b"y") and cmap.longest(b"ac", 0) == (1, b"x") and cmap.longest(b"ca", 0) is None


def test_packing_round_trip(spark):
    texts = [None, "", "a", "word " * 3000, "<|endoftext|> x", "é😀" * 50]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)] + [(2, "a", 9)], TEXT + ", length int")
    got = packing.pack(df.drop("length"), *packing.vocabulary_files()).collect()
    _, whole = packing._encoders(*packing.vocabulary_files())
    assert len({r.sequence_id for r in got}) == len(got)
    assert all(r.length & (r.length - 1) == 0 and r.length <= 1024 and r.offset == 0 and 4 * r.length == len(r.ids) for r in got)
    for i, t in enumerate(texts):
        mine = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        ids = (whole.encode(t, add_special_tokens=False).ids if t else []) + [0]
        want = ids * (2 if i == 2 else 1)
        assert np.frombuffer(b"".join(r.ids for r in mine), "<u4").tolist() == want


def test_quality_statistics(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([" ", "\n"]).join(rng.choice(["a", "b", "#x", "é"]) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "For " * 5000), (903, "x\nx\n\nx"), (903, "x\nx\n\nx")]
    got = quality_rules.text_stats(spark.createDataFrame(rows, TEXT)).select("doc_id", "_stats.*").collect()
    want = by_text((i, *brute.stats(t)) for i, t in rows)
    assert by_text((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want


def test_rules_are_learned_and_applied_in_order():
    rows = [{"a": float(i % 10), "b": float(i % 7)} for i in range(400)]
    bad = [r["a"] > 6 and r["b"] > 1 for r in rows]
    rules = quality_rules.grow_rules(rows, bad)
    hit = [any(all((r[c.feature] > c.cut) == c.above for c in rule.conditions) for rule in rules) for r in rows]
    assert hit == bad
    assert quality_rules.grow_rules([], []) == []


def test_toxicity_learns_on_held_out_rows(spark, sf_small):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    got = toxicity.op4_toxicity(spark, sf_small).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    right = sum(r.predicted == r.toxic for r in held) / len(held)
    assert right >= 0.93
    empty = toxicity.score(spark.createDataFrame([(1, None, "en"), (2, "", None)], TEXT + ", lang string"), None)
    assert [r.score for r in empty.collect()] == [0.5, 0.5]


def test_lm_scoring_base_and_normalisation(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["A", "b", "c", f"w{rng.randint(0, 99)}"]) for _ in range(rng.randint(0, 50)))) for i in range(200)] + [(500, None)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], TEXT + ", score double")
    got = {r.doc_id: r for r in lm_scoring.score_texts(df, lm_scoring.fold(lm_scoring.F.col("doc_id")) == 2).collect()}
    tokens = {i: [x.translate(brute.LOWER) for x in brute.WORD.findall(t or "")] + [None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = Counter(x for i, w in tokens.items() if not held[i] for x in w)
    n, v = sum(c.values()), len(c)
    for i, w in tokens.items():
        r = got[i]
        assert (r._held, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert r.score < 0
    model = lm_scoring.LogBilinear.start(np.full(20, 0.05))
    one, two, norm = model.normalised()
    total = np.exp(one[3] + two[7] - norm[3, 7]).sum()
    assert math.isclose(total, 1, rel_tol=1e-4)


def test_kneser_ney_sums_to_one():
    rng = np.random.default_rng(1)
    keys = np.unique(kneser_ney.key_of(rng.integers(0, 8, 200), rng.integers(0, 8, 200)))
    counts = rng.integers(1, 6, keys.size).astype("<u4")
    d = kneser_ney.discounts(*[int((counts == k).sum()) for k in (1, 2, 3, 4)])
    ends = np.bincount(kneser_ney.word_of(keys), minlength=8)
    lower = kneser_ney.Lower.of(kneser_ney.Vocabulary.of(np.arange(6, dtype=np.uint64), np.ones(6)), ends, d)
    model = kneser_ney.ShardModel(keys.size, kneser_ney.pack_arrays(kneser_ney.deltas(keys), counts), lower)
    for before in range(10):
        asked = kneser_ney.key_of(before, np.arange(8))
        assert math.isclose((10 ** model.log_probs(asked)).sum(), 1, rel_tol=1e-9)


def test_kneser_ney_keeps_good_text(spark, sf_small):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    got = kneser_ney.op5_quality_classifier(spark, sf_small)
    assert got.count() == spark.read.parquet(f"{sf_small}/documents.parquet").count()
    good = [r.kept for r in got.join(labels.filter("quality = 1"), "doc_id").collect()]
    bad = [r.kept for r in got.join(labels.filter("quality = 0"), "doc_id").collect()]
    assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.5


def test_top_k(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-3.0, 0.0, 1e-3, 2.5, 7.0]) for _ in range(rng.choice([3, 5, 8]))]) for i in range(900)]
    rows += [(1000, None), (1100, [float("nan")]), (1200, [None]), (1300, []), (1400, [0.0] * 8), (None, [1.0])]
    vectors = topk.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding", 1024)
    got = {}
    for r in topk.top_k(vectors, vectors.filter("id % 100 = 0"), 10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ok = [(i, [math.floor(1024 * c) for c in e]) for i, e in rows if i is not None and e is not None and all(c is not None and c == c for c in e)]
    for i, e in ok:
        if i % 100 == 0:
            s = sorted((-sum(a * b for a, b in zip(e, f)), j) for j, f in ok if j != i)[:10]
            assert sorted(got[i]) == [(n + 1, j, -c) for n, (c, j) in enumerate(s)]


def near_copies():
    rng = random.Random(5)
    voc, rows = [f"w{i}" for i in range(40)], []
    for _ in range(25):
        base = [rng.choice(voc) for _ in range(rng.choice([1, 2, 3, 11, 12, 13, 15, 20, 30, 60, 200]))]
        for _ in range(rng.choice([1, 2, 8, 20])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = rng.choice(voc)
            rows.append((rng.choice([None] + [len(rows)] * 9), " ".join(w)))
    return rows + [(9000, None), (9001, ""), (9002, "  "), (9003, "A b"), (9004, "a B")]


@pytest.mark.parametrize(("limit", "chunk"), [(jaccard_join.SHARD_LIMIT, jaccard_join.CHUNK), (0, 3)])
def test_jaccard_components(spark, monkeypatch, limit, chunk):
    monkeypatch.setattr(jaccard_join, "SHARD_LIMIT", limit)
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    rows = near_copies()
    df = spark.createDataFrame(rows, TEXT).repartition(4)
    got = jaccard_join.linked_components(df).select("doc_id", "n_shingles", "component_id")
    assert by_text(map(tuple, got.collect())) == by_text(brute.components(rows)[0])


def test_keep_one_of_each_group(spark):
    rows = near_copies()
    df = spark.createDataFrame([(*r, "x") for r in rows], TEXT + ", label string").repartition(3)
    kept = jaccard_join.keep_one(df, k=5, percent=80)
    assert kept.columns == df.columns and kept.count() == brute.components(rows, 5, 80)[1]
    assert jaccard_join.keep_one(df.limit(0)).count() == 0


def test_word_codes_are_exact():
    w = Words([b"a bb a", b"", b"bb\tccccccccccccccccccccc"])
    code, first = w.codes(np.zeros(len(w), dtype=np.uint64))  # every hash collides
    assert [w.word(first[c]) for c in code] == [b"a", b"bb", b"a", b"bb", b"c" * 21]
