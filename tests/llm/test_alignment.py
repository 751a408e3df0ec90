from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cliqueflow.llm import alignment
from cliqueflow.llm.packing import vocabulary_files
from cliqueflow.llm.pieces import model_path

TEXT = "doc_id long, text string"
FILES = (vocabulary_files()[0], model_path())


def byte_table():
    """The characters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=model_path()), byte_table()


def plain(texts):
    """Every text's tokens by the libraries, groups and links by nested loops."""
    a, b, table = libraries()
    found = []
    for t in texts:
        source = (" " + t).encode() if t else b""
        ids_a = a.encode(" " + t, add_special_tokens=False).ids if t else []
        ids_b = b.encode(t) if t else []
        bytes_a = [bytes(table[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        if not t or b"".join(bytes_a) != source or b"".join(bytes_b) != source:
            found.append(None)
            continue
        spans = []
        for tokens in (bytes_a, bytes_b):
            at, own = 0, []
            for x in tokens:
                own.append((at, at + len(x)))
                at += len(x)
            spans.append(own)
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            sides = [[str(i) for i, (_, e) in zip(ids, own) if low < e <= cut] for ids, own in zip((ids_a, ids_b), spans)]
            groups.append("|".join(",".join(x) for x in sides))
            low = cut
        links, j = Counter(), 0
        for i, (s, e) in zip(ids_a, spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(ids_b) and spans[1][k][0] < e:
                links[i, ids_b[k]] += 1
                k += 1
        found.append((len(ids_a), len(ids_b), ";".join(groups), len(groups), links))
    docs = Counter(pair for f in found if f for pair in f[4])
    highest = defaultdict(int)
    for (i, _), n in docs.items():
        highest[i] = max(highest[i], n)
    out = []
    for f in found:
        if f is None:
            out.append((0,) * 6 + ("",))
            continue
        n_a, n_b, groups, n_groups, links = f
        best = sum(n for p, n in links.items() if docs[p] == highest[p[0]])
        total = sum(n * docs[p] for p, n in links.items())
        out.append((n_a, n_b, n_groups, sum(links.values()), best, total, hashlib.sha256(groups.encode()).hexdigest()))
    return out


def texts():
    rng = random.Random(6)
    parts = [" ", " ", "  ", "the", " quick", "ing", "\n", "é", "😀", "слово", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "\t", "'s", "1234", "한국어", "!?", "ﬁ", "　", "\x00"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    made += [None, "", " ", "a", "a▁b", "▁", " " * 300, "x" * 700, "word " * 400, "слово " * 200, "a" * 300 + " b" * 300 + "😀" * 100]
    return made + ["the same text"] * 5 + ["é" * 50 + " ▁ " + "word " * 100]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize(("size", "fan", "unit"), [(alignment.RANGE, 8, alignment.UNIT), (37, 2, 100)])
def test_alignment_equals_plain_loops(spark, monkeypatch, size, fan, unit):
    monkeypatch.setattr(alignment, "UNIT", unit)
    made = texts()
    rows = [(None if i % 11 == 5 else i // 2, t, i, "x") for i, t in enumerate(made)]
    df = spark.createDataFrame(rows, TEXT + ", unit long, pairs string").repartition(4)
    got = alignment.align(df, *FILES, keep=("doc_id", "unit", "pairs"), size=size, fan=fan)
    got = sorted((r[1], r[0], *r[3:10]) for r in got.select("*").collect())
    want = [(i, rows[i][0], *w) for i, w in enumerate(plain(made))]
    assert got == want
    assert alignment.align(df.limit(0), *FILES).count() == 0


def test_ranges_of_one_long_text_compose_in_any_order():
    both = alignment.aligner(*FILES)
    rng = random.Random(9)
    text = " " + " ".join(rng.choice(["alpha", "été", "слово", "x" * 40, "😀", "1999", "don't", "\n"]) for _ in range(20_000))
    sound, a, b = both.read(text)
    whole = both.groups.finish(both.groups.fragment(sound, a, b, 0, int(a.ends[-1])))
    parts, opened = [], 0
    for low, high, start, region in alignment.ranges(text, 500):
        sound, a, b = both.read(region)
        parts.append(both.groups.fragment(sound, *(alignment.Tokens(t.ids, t.ends + start) for t in (a, b)), low, high))
        opened += bool(parts[-1]["before_a"].size or parts[-1]["after_a"].size)
    assert len(parts) > 100 and opened > 50

    def tree(f):
        if len(f) == 1:
            return f[0]
        at = rng.randint(1, len(f) - 1)
        return both.groups.compose(tree(f[:at]), tree(f[at:]))

    for f in (reduce(both.groups.compose, parts), tree(parts), tree(parts)):
        got = both.groups.finish(f)
        assert all(np.array_equal(got[k], whole[k]) for k in whole)
    unsound = both.groups.compose(both.groups.compose(parts[0], alignment.UNSOUND), parts[2])
    assert both.groups.finish(unsound)["n_a"] == 0


def test_ranges_without_safe_places():
    text = " " + "x" * 5000
    assert [(low, high) for low, high, _, _ in alignment.ranges(text, 100)] == [(0, 5001)]
    text = " a b" + "é" * 5000 + " c d"
    found = list(alignment.ranges(text, 100))
    assert found[0][0] == 0 and found[-1][1] == len(text.encode()) and sum(len(r) for *_, r in found) <= 3 * len(text)
