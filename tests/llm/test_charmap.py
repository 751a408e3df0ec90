"""Encoding through a compiled character map: the public model with a map of a few rules, against the library."""

from __future__ import annotations

import random

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from cliqueflow.llm import pieces

RULES = {"A": "a", "ab": "y", "abc": "zz", "ﬁ": "fi", "é": "e", "　": " ", "😀": "", "½": "1⁄2", "\t": " "}


def compiled(rules: dict[str, str]) -> bytes:
    """The rules as a double array: the children of a node lie in a block of their own, its value at the block's start."""
    trie: dict = {}
    for key, text in rules.items():
        node = trie
        for b in key.encode():
            node = node.setdefault(b, {})
        node["text"] = text
    units, texts = [0] * 256, b""
    queue = [(0, trie)]
    while queue:
        at, node = queue.pop()
        base = len(units)
        units += [0] * 256
        units[at] |= (at ^ base) << 10
        if "text" in node:
            units[at] |= 1 << 8
            units[base] = 1 << 31 | len(texts)
            texts += node["text"].encode() + b"\0"
        for b, child in node.items():
            if b != "text":
                units[base ^ b] = b
                queue.append((base ^ b, child))
    blob = np.array(units, dtype="<u4").tobytes()
    return len(blob).to_bytes(4, "little") + blob + texts


def model(squeeze: bool) -> bytes:
    proto = sentencepiece_model_pb2.ModelProto()
    with open(pieces.model_path(), "rb") as f:
        proto.ParseFromString(f.read())
    proto.normalizer_spec.name = "user_defined"
    proto.normalizer_spec.precompiled_charsmap = compiled(RULES)
    proto.normalizer_spec.remove_extra_whitespaces = squeeze
    return proto.SerializeToString()


@pytest.mark.parametrize("squeeze", [False, True])
def test_ids_and_spans_equal_the_library(squeeze):
    blob = model(squeeze)
    own = pieces.Encoder(None, blob)
    library = sentencepiece.SentencePieceProcessor(model_proto=blob)
    assert own.normalize.map.units and own.plain is not own.model
    rng = random.Random(1)
    parts = [*RULES, "a", "b", "c", "the ", " ", "  ", "ing", "\n", "x", "▁", "е", "Ab"]
    for _ in range(600):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        ids, starts, ends = own.encode(text)
        got = library.encode(text, return_type="proto")
        assert ids[1:-1].tolist() == [p.id for p in got.pieces], text
        spans = [(p.begin, p.end) for p in got.pieces]
        assert list(zip(starts[1:-1].tolist(), ends[1:-1].tolist())) == spans, text
