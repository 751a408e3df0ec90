"""Alignment of two tokenizers by an associative monoid of document fragments.

A text is read as a space and the text, once by a byte-level vocabulary (A)
and once by a piece model (B, which adds the space itself). Where a token of
A and a token of B end at the same byte, a group ends. A long text is cut
into ranges of bytes; the tokens that end in a range are a fragment: an open
prefix up to the range's first common end, closed groups, and an open suffix
after its last common end. Fragments of neighbouring ranges compose: the
suffix of one and the prefix of the next close a group. Composition is
associative, so ranges of one long document are read by many tasks and meet in
a tree. A range is read from the last safe place before it to the first one
after it, a space between two other characters, where neither tokenizer can
join what lies on both sides; so its tokens are those of the whole text.

Every document, short or long, ends as one row with its linked id pairs; units
of documents count how many documents hold a pair, the counts are summed over
the corpus and met by each unit again.

Defined cases: a text that is null or empty, or that the tokens of A or B do
not spell byte for byte, has no tokens and counts for no pair; every row is a
document of its own, also where ids repeat or are null; carried columns pass
through unchanged whatever their names; an empty table gives no row.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import cut_lineage, ship_package
from .packing import vocabulary_files
from .pieces import MARK, encoder, model_path

#: Characters of a range, linked pairs of a unit, and fragments that one step of the tree composes.
RANGE = 32_768
UNIT = 400_000
FAN = 8

SAFE = re.compile(rf"(?<=[^\s{MARK}]) (?=[^\s{MARK}])")
OPEN = ("before_a", "before_a_ends", "before_b", "before_b_ends", "after_a", "after_a_ends", "after_b", "after_b_ends")
FRAGMENT = (
    "row long, part long, sound boolean, cut boolean, n_a long, n_b long, n_groups long, groups binary, "
    "pairs array<long>, times array<long>, " + ", ".join(f"{c} array<long>" for c in OPEN)
)
RESULT = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


class Tokens:
    """Ids of consecutive tokens and the byte at which each ends."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray):
        self.ids, self.ends = ids, ends

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(np.concatenate((self.ids, other.ids)), np.concatenate((self.ends, other.ends)))

    def between(self, low: int, high: int) -> Tokens:
        """Those that end after ``low`` and not after ``high``."""
        at = slice(*np.searchsorted(self.ends, (low, high), side="right"))
        return Tokens(self.ids[at], self.ends[at])


MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
NONE = Tokens(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))


class Spelling:
    """The bytes of a vocabulary's tokens, as rows of eight-byte words."""

    def __init__(self, tokens: list[bytes]):
        self.widths = np.array(list(map(len, tokens)), dtype=np.int64)
        self.size = 8 * max(1, -(-int(self.widths.max(initial=0)) // 8))
        self.words = np.frombuffer(b"".join(t.ljust(self.size, b"\0") for t in tokens), dtype="<u8").reshape(-1, self.size // 8)

    def read(self, ids: np.ndarray, source: bytes) -> tuple[bool, Tokens]:
        """Tokens of ids, and whether they spell ``source`` byte for byte."""
        widths = self.widths[ids]
        ends = np.cumsum(widths)
        if (int(ends[-1]) if ids.size else 0) != len(source):
            return False, NONE
        padded = np.frombuffer(source + bytes(8), dtype=np.uint8)
        loads = np.ndarray((len(source) + 1,), dtype="<u8", buffer=padded, strides=(1,))
        at, live, starts = 0, slice(None), ends - widths
        while widths[live].size:
            masks = MASKS[np.minimum(widths[live] - at, 8)]
            if ((loads[starts[live] + at] ^ self.words[ids[live], at // 8]) & masks).any():
                return False, NONE
            at += 8
            live = np.flatnonzero(widths > at)
        return True, Tokens(ids, ends)


class Groups:
    """Fragments of texts, given the sizes of both vocabularies."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a, self.n_b = n_a, n_b
        # decimal ids with what follows them: a token of the same side and group, or the end of its side
        self.words = [f"{i}{end}" for n, ends in ((n_a, ",|"), (n_b, ",;")) for end in ends for i in range(n)]

    def close(self, a: Tokens, b: Tokens) -> dict:
        """What the groups of some tokens add up to; the first tokens of both sides begin, and the last ones end, together."""
        low = int(min(a.ends[0], b.ends[0]))
        marks = np.zeros(int(a.ends[-1]) - low + 1, dtype=np.int8)
        marks[a.ends - low] = 1
        marks[b.ends - low] += 2
        marks = marks[marks > 0]  # one for each stretch between two ends, which lies in one token of either side
        in_a, in_b = marks & 1, marks >> 1
        of_a, of_b = np.cumsum(in_a, dtype=np.int64) - in_a, np.cumsum(in_b, dtype=np.int64) - in_b
        pairs, times = np.unique(a.ids[of_a] * self.n_b + b.ids[of_b], return_counts=True)
        common = marks == 3
        at_a, at_b = of_a[common], of_b[common]  # the last token of each group
        last_a, last_b = np.zeros(a.ids.size, dtype=np.int64), np.zeros(b.ids.size, dtype=np.int64)
        last_a[at_a] = last_b[at_b] = 1
        # a group's tokens of A, then those of B: each moves behind what the other side has before it
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        words = np.zeros(a.ids.size + b.ids.size, dtype=np.int64)
        words[np.arange(a.ids.size) + np.concatenate(([0], at_b + 1))[group_a]] = a.ids + last_a * self.n_a
        words[np.arange(b.ids.size) + (at_a + 1)[group_b]] = 2 * self.n_a + b.ids + last_b * self.n_b
        groups = "".join(map(self.words.__getitem__, words.tolist())).encode()
        return {"n_groups": at_a.size, "groups": groups, "pairs": pairs, "times": times}

    def fragment(self, sound: bool, a: Tokens, b: Tokens, low: int, high: int) -> dict:
        """The fragment of the tokens that end after byte ``low`` (0: the text's start) and not after ``high``."""
        if not sound:
            return UNSOUND
        a, b = a.between(low, high), b.between(low, high)
        out = {"sound": True, "n_a": a.ids.size, "n_b": b.ids.size}
        cuts = np.intersect1d(a.ends, b.ends, assume_unique=True)
        if not low:
            cuts = np.concatenate(([0], cuts))
        if not cuts.size:
            return out | {"cut": False} | _closed() | _ends((a, b), (NONE, NONE))
        first, last = int(cuts[0]), int(cuts[-1])
        inner = a.between(first, last), b.between(first, last)
        closed = self.close(*inner) if inner[0].ids.size else _closed()
        return out | {"cut": True} | closed | _ends((a.between(-1, first), b.between(-1, first)), (a.between(last, high), b.between(last, high)))

    def compose(self, f: dict, g: dict) -> dict:
        """The fragment of two neighbouring ranges."""
        if not (f["sound"] and g["sound"]):
            return UNSOUND
        out = {"sound": True, "cut": f["cut"] or g["cut"]} | {k: f[k] + g[k] for k in ("n_a", "n_b")}
        before, after = [_tokens(x, "before") for x in (f, g)], [_tokens(x, "after") for x in (f, g)]
        closed, middle = [f, g], tuple(x + y for x, y in zip(after[0] if f["cut"] else before[0], before[1]))
        if f["cut"] and g["cut"]:
            if middle[0].ids.size:
                closed = [f, self.close(*middle), g]
            edges = before[0], after[1]
        elif g["cut"]:
            edges = middle, after[1]
        elif f["cut"]:
            edges = before[0], middle
        else:
            edges = middle, (NONE, NONE)
        return out | _sum(closed) | _ends(*edges)

    def finish(self, f: dict) -> dict:
        """The result of a whole text's fragment."""
        if not f["sound"] or not f["n_a"]:
            empty = np.zeros(0, dtype=np.int64)
            return {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "pairs": empty, "times": empty}
        sha = hashlib.sha256(f["groups"][:-1]).hexdigest()
        return {k: f[k] for k in ("n_a", "n_b", "n_groups", "pairs", "times")} | {"n_links": int(f["times"].sum()), "groups_sha256": sha}


def _closed() -> dict:
    return {"n_groups": 0, "groups": b"", "pairs": NONE.ids, "times": NONE.ids}


def _sum(parts: list[dict]) -> dict:
    pairs, at = np.unique(np.concatenate([p["pairs"] for p in parts]), return_inverse=True)
    times = np.bincount(at, weights=np.concatenate([p["times"] for p in parts]), minlength=pairs.size).astype(np.int64)
    return {"n_groups": sum(p["n_groups"] for p in parts), "groups": b"".join(p["groups"] for p in parts), "pairs": pairs, "times": times}


def _ends(before: tuple[Tokens, Tokens], after: tuple[Tokens, Tokens]) -> dict:
    return dict(zip(OPEN, (x for t in (*before, *after) for x in (t.ids, t.ends))))


def _tokens(f: dict, side: str) -> tuple[Tokens, Tokens]:
    return tuple(Tokens(f[f"{side}_{t}"], f[f"{side}_{t}_ends"]) for t in "ab")


#: A range that its tokens do not spell; what it composes with is unsound as well.
UNSOUND = {"sound": False, "cut": False, "n_a": 0, "n_b": 0} | _closed() | _ends((NONE, NONE), (NONE, NONE))


class Aligner:
    """Both vocabularies in one process."""

    def __init__(self, ranks_file: str, model_file: str):
        import public_tokenizers
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.a = tiktoken.Encoding("alignment", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = encoder(model_file)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        model = self.b.model
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        pieces = [
            bytes([int(p[3:-1], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(names)
        ]
        self.spelling = Spelling(tokens), Spelling(pieces)
        self.sizes = len(tokens), len(pieces)
        self.groups = grouping(*self.sizes)
        # ranges need a model that spells its text, puts one space before it and joins nothing over a space
        normal = self.b.normalize
        self.ranged = self.b.cuts and not normal.map.units and not normal.squeeze_spaces

    def read(self, text: str) -> tuple[bool, Tokens, Tokens]:
        """Tokens of a text that begins with a space, and whether both sides spell it."""
        source = text.encode()
        ids = self.a.encode_to_numpy(text, disallowed_special=()), self.b.ids(self.b.normalize(text[1:])[0])
        (one, a), (two, b) = (s.read(i.astype(np.int64), source) for s, i in zip(self.spelling, ids))
        return one and two, a, b


@lru_cache(maxsize=2)
def grouping(n_a: int, n_b: int) -> Groups:
    return Groups(n_a, n_b)


@lru_cache(maxsize=2)
def aligner(ranks_file: str, model_file: str) -> Aligner:
    return Aligner(ranks_file, model_file)


def ranges(text: str, size: int) -> Iterator[tuple[int, int, int, str]]:
    """(low, high, start, region) of every range of a text that begins with a space.

    ``low`` and ``high`` bound the bytes in which the range's tokens end,
    ``start`` is the first byte of the text read for it. A bound that has no
    safe place since the bound before it is left out, so a text is read at
    most twice, however rare safe places are.
    """
    bounds, held, safe = [0], 0, [0]
    for p in (m.start() for m in SAFE.finditer(text)):
        safe.append(p)
    places = np.array(safe)
    for bound in range(size, len(text), size):
        last = int(places[np.searchsorted(places, bound, side="right") - 1])
        if last > held:
            bounds.append(bound)
            held = bound
    bounds.append(len(text))
    byte = np.concatenate(([0], np.cumsum([len(text[a:b].encode()) for a, b in zip(bounds, bounds[1:])])))
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        start = int(places[np.searchsorted(places, low, side="right") - 1])
        nxt = int(np.searchsorted(places, high))
        stop = int(places[nxt]) if nxt < places.size else len(text)
        yield int(byte[i]), int(byte[i + 1]), int(byte[i]) - len(text[start:low].encode()), text[start:stop]


def _rows(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)


def _structure(*parts: str | StructType) -> tuple[StructType, pa.Schema]:
    """The fields of all parts, for Spark and for Arrow; made on the driver."""
    fields = [f for p in parts for f in (StructType.fromDDL(p) if isinstance(p, str) else p).fields]
    return StructType(fields), to_arrow_schema(StructType(fields))


def _arrays(f: dict) -> dict:
    return f | {k: np.array(f[k], dtype=np.int64) for k in ("pairs", "times", *OPEN)}


class Units:
    """Numbers of units: rows in a task's order, until they hold UNIT linked pairs."""

    def __init__(self, lead: int):
        self.unit, self.held = ((TaskContext.get().partitionId() << 1) + lead) << 31, 0

    def of(self, size: int) -> int:
        if self.held and self.held + size > UNIT:
            self.unit, self.held = self.unit + 1, 0
        self.held += size + 1
        return self.unit


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def _short(rows: DataFrame, keys: StructType, files: tuple[str, str]) -> DataFrame:
    """Result rows of texts that are one range each."""
    schema, _ = _structure("unit long", keys, RESULT)
    _, numbers = _structure("unit long", RESULT)
    names, own = schema.names, keys.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, units = aligner(*files), Units(0)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                for text in _texts(part.column("_text")):
                    sound, a, b = both.read(" " + text) if text else (False, NONE, NONE)
                    high = int(a.ends[-1]) if a.ends.size else 0
                    found = both.groups.finish(both.groups.fragment(sound, a, b, 0, high))
                    out.append(found | {"unit": units.of(found["pairs"].size)})
                made = _rows(numbers, out)
                yield pa.RecordBatch.from_arrays([part.column(n) if n in own else made.column(n) for n in names], names=names)

    return rows.mapInArrow(run, schema)


def _long(rows: DataFrame, keys: StructType, files: tuple[str, str], size: int, fan: int) -> DataFrame:
    """Result rows of texts of several ranges, each read on its own and composed in a tree."""
    whole, sizes = aligner(*files).ranged, aligner(*files).sizes
    cut, cut_arrow = _structure("row long, part long, low long, high long, start long, region string")
    fragment, fragment_arrow = _structure(FRAGMENT)
    result, result_arrow = _structure("row long, unit long", RESULT)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), _texts(batch.column("_text"))):
                for part, (low, high, start, region) in enumerate(ranges(" " + text, size if whole else len(text) + 1)):
                    yield _rows(cut_arrow, [{"row": row, "part": part, "low": low, "high": high, "start": start, "region": region}])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(*files)
        for batch in batches:
            for r in batch.to_pylist():
                sound, a, b = both.read(r["region"])
                a, b = (Tokens(t.ids, t.ends + r["start"]) for t in (a, b))
                yield _rows(fragment_arrow, [both.groups.fragment(sound, a, b, r["low"], r["high"]) | {"row": r["row"], "part": r["part"]}])

    def compose(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda f: f["part"])
        place = {"row": parts[0]["row"], "part": parts[0]["part"] // fan}
        return pa.Table.from_batches([_rows(fragment_arrow, [reduce(grouping(*sizes).compose, map(_arrays, parts)) | place])])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, units = grouping(*sizes), Units(1)
        for batch in batches:
            for f in batch.to_pylist():
                found = groups.finish(_arrays(f))
                yield _rows(result_arrow, [found | {"row": f["row"], "unit": units.of(found["pairs"].size)}])

    # stored, so that row numbers stay the same when a task is run again
    named = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()), "long-texts")
    parts = named.select("row", "_text").mapInArrow(split, cut).repartition("row", "part")
    fragments = cut_lineage(parts.mapInArrow(read, fragment), "fragments")
    most = (fragments.agg(F.max("part")).first()[0] or 0) + 1
    while most > 1:
        steps = fragments.groupBy("row", F.expr(f"part div {fan}").alias("_step"))
        fragments = cut_lineage(steps.applyInArrow(compose, fragment), "fragments")  # one Python worker a task
        most = -(-most // fan)
    found = fragments.mapInArrow(finish, result)
    return found.join(named.drop("_text"), "row").select(*_structure("unit long", keys, RESULT)[0].names)


def align(
    docs: DataFrame,
    ranks_file: str,
    model_file: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    size: int = RANGE,
    fan: int = FAN,
) -> DataFrame:
    """``keep`` columns plus n_a, n_b, n_groups, n_links, n_best, count_sum (long) and groups_sha256 of every row.

    ``pairs`` and ``times`` follow: the linked id pairs (A id times the size of
    B's vocabulary plus B id) and how often the row has each.
    """
    ship_package(docs.sparkSession)
    files = (ranks_file, model_file)
    n_b = aligner(*files).sizes[1]
    source = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    keys = StructType(source.schema.fields[:-1])
    long = F.coalesce(F.char_length("_text") >= size, F.lit(False))
    short = _short(source.filter(~long), keys, files)
    aligned = cut_lineage(short.unionByName(_long(source.filter(long), keys, files, size, fan)), "aligned")
    held = cut_lineage(aligned.select("unit", F.explode("pairs").alias("pair")).groupBy("unit", "pair").agg(F.count(F.lit(1)).alias("docs")), "held")
    counts = held.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.expr(f"pair div {n_b}"))
    counts = cut_lineage(counts, "counts")
    # one row for each id of A at most, so its size is bounded by the vocabulary
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    known = counts.join(F.broadcast(highest), "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    answers = held.select("unit", "pair").join(known, "pair")
    schema, arrow = _structure(keys, RESULT, "n_best long, count_sum long")

    def meet(rows: pa.Table, told: pa.Table) -> pa.Table:
        order = np.argsort(pairs := told.column("pair").to_numpy())
        pairs = pairs[order]
        count, best = (told.column(c).to_numpy()[order] for c in ("count", "best"))
        lists = rows.column("pairs").combine_chunks()
        flat, times = (rows.column(c).combine_chunks().flatten().to_numpy() for c in ("pairs", "times"))
        row = np.repeat(np.arange(rows.num_rows), lists.value_lengths().fill_null(0).to_numpy())
        at = np.searchsorted(pairs, flat)
        sums = []
        for weight in (times * best[at], times * count[at]) if pairs.size else (times, times):
            upto = np.concatenate(([0], np.cumsum(weight)))
            stops = np.searchsorted(row, np.arange(rows.num_rows + 1))
            sums.append(pa.array(upto[stops[1:]] - upto[stops[:-1]], pa.int64()))
        out = rows.drop_columns(["unit"]).append_column("n_best", sums[0]).append_column("count_sum", sums[1])
        return out.select(arrow.names).cast(arrow)

    met = aligned.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(meet, schema)
    return met.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        *["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "pairs", "times"],
    )


def op11_alignment(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return align(docs, vocabulary_files()[0], model_path()).drop("pairs", "times")
