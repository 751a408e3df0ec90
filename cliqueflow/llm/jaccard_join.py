"""N-gram Jaccard self-join by universe partitioning, and its connected components.

A document's set is its distinct word shingles (64-bit hashes). Two sets of at
most L elements whose Jaccard similarity reaches the threshold differ in at
most H(L) elements. Sets are banded by size; a band hashes the universe into
segments and a set sends one signature for each of its non-empty segment
subsets. With more such segments than H one of them is equal in both sets.
Where a set has too few non-empty segments it sends the one-deletion
neighbourhoods of its segments as well (each then bears two differences). How
many segments a band has, and how many bear one-deletion neighbourhoods from
the start, is the cheapest plan of ``plan_band``.

Blocks send signatures packed, to shards that answer which of them two sets or
more have. A band has half as many segments again as it needs, so a set that
links to another one shares at least its segments less H; sets that share
fewer are done. Of the others' shared signatures the first go on, in one order
of all signatures: what remains behind them is too little to hold all that a
linked pair shares, so the pair's first common signature is among them.
Equal sets are one class from here on. First every class is verified (exact
intersection of the sets) against the least class that it shares a signature
with, and linked classes form components; most groups of near copies end in
this star. Where a signature still holds several components, its classes are
compared across components in chunks by a parity bitmap of their sets: bitmaps
differ in at most as many bits as the sets do in elements, so what differs in
more bits than the threshold allows is no link. Of the others each class's
nearest is verified first. Classes that then still have a possible partner in
another component are compared again by wider bitmaps, and all pairs that
these allow are verified. No link between different components is lost.

Defined cases: A-Z are lowered; a text with fewer words than a shingle is one
shingle; without words or null it is empty and alone; repeated rows fall in
one class; a null id can be linked but is never a component's name; an empty
table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, distilled
from .blocks import arrow_of, discard, each_answered, each_block, expand, grouped, shards, squeeze, text_bytes, with_answers, write_blocks
from .components import components
from .words import Words, grams, mix

SHINGLE = 3
PERCENT = 90
#: Growth of a band's largest set over that of the band below.
BAND = 1.5
SHARD_BYTES = 1 << 20
#: Sets sharing half of a set's elements, times the cost of a verification per element, in signatures.
PARTNERS = 0.025
#: Bytes of signatures that one task gathers for a shard; beyond, all of them count as shared.
SHARD_LIMIT = 96 << 20
#: Classes of one signature that are compared in one piece.
CHUNK = 1024
#: Bits of a set's bitmap: the power of two from its size, within these bounds; of a wide one so many times that.
BITS = (64, 1 << 16)
WIDER = 8
#: Bytes of bitmaps that are compared at once.
COMPARED = 16 << 20


# --- bands and their plans -----------------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    largest: int  # set size at most
    differences: int  # H
    segments: int
    doubled: int  # segments that bear one-deletion neighbourhoods in every set


def max_differences(total: int, percent: int) -> int:
    """Most elements in one of two sets only, at the threshold, for sizes that sum to ``total``."""
    return total * (100 - percent) // (100 + percent)


def plan_band(smallest: int, largest: int, percent: int) -> Plan:
    """The cheapest number of segments and of one-deletion segments for a band.

    Cost: signatures that a set sends, plus the expected cost of verifying
    against sets that share half of it (``PARTNERS`` of them, each agreeing on
    a subset by chance), plus that of the fallback where segments stay empty.
    """
    h = max_differences(2 * largest, percent)
    size = (smallest + largest) / 2
    need = h + 1 + h // 2
    best, plan = math.inf, None
    for segments in range(1, need + max(3, h // 8)):
        per = size / segments
        empty = segments * math.exp(-per)
        for doubled in {0, max(0, need - segments), segments // 2}:
            slack = segments + doubled - need
            if slack < 0:
                continue
            # chance of more empty segments than the plan has to spare (Poisson)
            missing = math.exp(min(0.0, (slack + 1) * math.log(empty) - empty - math.lgamma(slack + 2))) if empty else 0.0
            cost = segments + doubled * per + PARTNERS * segments * 0.5**per * largest + missing * size
            if cost < best:
                best, plan = cost, Plan(largest, h, segments, doubled)
    return plan


@lru_cache(maxsize=8)
def bands(percent: int) -> tuple[Plan, ...]:
    """Plans from the smallest sets that can link to an unequal one up to 2 ** 40 elements."""
    first = -(-percent // max(1, 100 - percent))
    out, low = [], first
    while low < 1 << 40:
        high = max(low + 1, int(low * BAND))
        # the many segments of huge sets need no search: their subsets are large enough with few to spare
        h = max_differences(2 * high, percent)
        out.append(plan_band(low, high, percent) if h <= 512 else Plan(high, h, h + 1 + h // 2, 0))
        low = high + 1
    return tuple(out)


# --- sets and signatures of a block --------------------------------------------------------------


@dataclass
class Sets:
    """Distinct shingle hashes of the texts of a block, text by text, each sorted."""

    values: np.ndarray
    bounds: np.ndarray  # text i: values[bounds[i]:bounds[i + 1]]

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def sums(self, salt: int) -> np.ndarray:
        """An order-free hash of every set."""
        return mix(segment_sums(mix(self.values + np.uint64(salt)), self.bounds) + self.sizes.astype(np.uint64))


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def shingle_sets(texts: list[bytes], k: int) -> Sets:
    w = Words(texts, lower=True)
    h = w.hashes()
    whole = grams(h, k)
    text = w.text[: whole.size]
    inside = text == w.text[k - 1 :] if whole.size else np.zeros(0, dtype=bool)
    values, owner = whole[inside], text[inside]
    for n in range(1, k):  # texts of fewer words are one shingle
        short = np.flatnonzero(w.counts == n)
        if short.size:
            at = w.first[short]
            one = np.zeros(short.size, dtype=np.uint64)
            for j in range(n):
                one = mix(one * np.uint64(31) + h[at + j] + np.uint64(n))
            values, owner = np.concatenate((values, one)), np.concatenate((owner, short))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(values.size, dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return Sets(values, np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=w.n_texts)))))


def distinct_rows(sets: Sets) -> np.ndarray:
    """The first text of each different set that can link to another one."""
    _, first = np.unique(np.stack((sets.sums(1), sets.sums(2)), axis=1), axis=0, return_index=True)
    return np.sort(first)


def signatures(sets: Sets, rows: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All subsets and neighbourhoods that the plans give the sets of ``rows``: signature, row, and the number of its
    (set, band); and for each (set, band) how many of its signatures a set that it links to must share."""
    plans = bands(percent)
    tops = np.array([p.largest for p in plans])
    sizes = sets.sizes[rows]
    first = -(-percent // max(1, 100 - percent))
    band = np.searchsorted(tops, sizes)
    parts, needs, at = [], [], 0
    for b in np.unique(band[sizes >= first]).tolist():
        mine = rows[(band == b) & (sizes >= first)]
        own = sets.sizes[mine]
        for config in range(b, len(plans)):
            # those that can meet a set of that band: at the lowest thresholds several bands above their own
            chosen = mine[own * 100 >= percent * (plans[config - 1].largest + 1)] if config > b else mine
            if not chosen.size:
                break
            sig, local, need = band_signatures(sets, chosen, config, plans[config], percent)
            parts.append((sig, chosen[local], local + at))
            needs.append(need)
            at += chosen.size
    if not parts:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    return *(np.concatenate(c) for c in zip(*parts)), np.concatenate(needs)


def band_signatures(
    sets: Sets, rows: np.ndarray, config: int, plan: Plan, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = sets.sizes[rows]
    local = np.repeat(np.arange(rows.size), sizes)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(sets.bounds[rows], sizes)
    values = sets.values[at]
    segment = (mix(values + np.uint64(config + 17)) % np.uint64(plan.segments)).astype(np.int64)
    key = local * plan.segments + segment
    order = np.argsort(key, kind="stable")
    key, hashed = key[order], mix(values[order] ^ np.uint64(0x5BD1E995))
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if key.size else np.zeros(0, np.int64)
    bounds = np.concatenate((begin, [key.size]))
    sums, counts = segment_sums(hashed, bounds), np.diff(bounds)
    owner, place = key[begin] // plan.segments, key[begin] % plan.segments

    def sign(total: np.ndarray, count: np.ndarray, where: np.ndarray) -> np.ndarray:
        return mix(total + mix(count.astype(np.uint64) * np.uint64(1 << 20) + where.astype(np.uint64) + np.uint64(config << 44)))

    doubled = place < plan.doubled
    weight = np.bincount(owner, weights=np.where(doubled & (counts >= 2), 2, 1), minlength=rows.size)
    weak = weight < plan.differences + 1  # too many empty segments: all neighbourhoods are sent
    spread = (doubled | weak[owner]) & (counts >= 2)
    full = np.bincount(owner, weights=np.where(counts >= 2, 2, 1), minlength=rows.size)
    lost = np.flatnonzero(weak & (full < plan.differences + 1))  # not even those suffice: these few all meet
    element = np.repeat(spread, counts)
    of = np.repeat(np.arange(begin.size), counts)[element]
    sig = [sign(sums, counts, place), sign(sums[of] - hashed[element], counts[of] - 1, place[of])]
    row = [owner, owner[of]]
    if lost.size:
        sig.append(mix(np.full(lost.size, config + 1, dtype=np.uint64)))
        row.append(lost)
    # every difference spoils one subset at most, so the others are shared; a set's own size bounds its differences too
    subsets = np.bincount(owner, minlength=rows.size)
    own = (sizes + sizes * 100 // percent) * (100 - percent) // (100 + percent)
    need = np.where(weak | (plan.doubled > 0), 1, np.maximum(1, subsets - np.minimum(own, plan.differences)))
    return np.concatenate(sig), np.concatenate(row), need


# --- Spark stages --------------------------------------------------------------------------------


def node_of(block, row):
    """One long for a row of a block (block numbers are task << 32 + n)."""
    return ((block >> 32) << 40) + ((block & 0xFFFFFFFF) << 20) + row


ROWS = "node long, doc_id long, n_shingles long, f1 long, f2 long"


def rows_of(text: str, key: str, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = arrow_of(ROWS)

    def work(block: int, rows: pa.Table) -> pa.RecordBatch:
        sets = shingle_sets(text_bytes(rows.column(text)), k)
        n = sets.sizes.size
        return pa.RecordBatch.from_arrays(
            [
                pa.array(node_of(block, np.arange(n))),
                rows.column(key).combine_chunks().cast(pa.int64()),
                pa.array(sets.sizes, pa.int64()),
                pa.array(sets.sums(1).view(np.int64)),
                pa.array(sets.sums(2).view(np.int64)),
            ],
            schema=schema,
        )

    return work


def in_order(sets: Sets, percent: int, n_shards: int) -> tuple[np.ndarray, ...]:
    """Signatures of a block in the order of sending: sig, row, group, shard; and the groups' needs."""
    sig, row, group, need = signatures(sets, distinct_rows(sets), percent)
    shard = (sig % np.uint64(n_shards)).astype(np.int64)
    order = np.lexsort((group, sig, shard))
    return sig[order], row[order], group[order], shard[order], need


def place_in_group(group: np.ndarray) -> np.ndarray:
    """How many earlier entries of ``group`` hold the same number, entry by entry."""
    order = np.argsort(group, kind="stable")
    ordered = group[order]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    out = np.empty(group.size, dtype=np.int64)
    out[order] = np.arange(group.size) - np.repeat(first, np.diff(first, append=group.size))
    return out


def ask(text: str, k: int, percent: int, n_shards: int) -> Callable[[int, pa.Table], Iterator[dict]]:
    def run(block: int, rows: pa.Table) -> Iterator[dict]:
        sig, _, _, shard, _ = in_order(shingle_sets(text_bytes(rows.column(text)), k), percent, n_shards)
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [shard.size]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a < b:
                steps = np.diff(sig[a:b], prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
                yield {"shard": int(shard[a]), "block": block, "n": int(b - a), "blob": squeeze(steps.tobytes())}

    return run


def which_shared(limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For every question one bit per signature: whether another set has it too. Beyond ``limit`` bytes of a shard all count as shared."""

    def rows_out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["block", "shard", "reply"])

    def bits(flags: np.ndarray) -> bytes:
        return squeeze(np.packbits(flags).tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in grouped(batches, "shard"):
            held, size = [], 0
            for row in rows:
                size += 8 * row["n"]
                held.append(row)
                if size > limit:
                    yield rows_out([(r["block"], shard, bits(np.ones(r["n"], dtype=bool))) for r in held])
                    held = []
            if held:
                steps = [np.frombuffer(expand(r["blob"]), np.uint8).reshape(8, -1).T.copy().view("<u8").ravel() for r in held]
                sig = np.concatenate([np.cumsum(x, dtype=np.uint64) for x in steps])
                order = np.argsort(sig, kind="stable")
                twin = np.zeros(sig.size, dtype=bool)
                twin[1:] = sig[order[1:]] == sig[order[:-1]]
                twin[:-1] |= twin[1:]
                flags = np.empty(sig.size, dtype=bool)
                flags[order] = twin
                at = np.concatenate(([0], np.cumsum([r["n"] for r in held])))
                yield rows_out([(r["block"], shard, bits(flags[a:b])) for r, a, b in zip(held, at[:-1], at[1:])])

    return run


def shared_signatures(blocks: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """(sig, node) of the sets that share enough signatures: of each as many of the shared ones, in one order of all
    signatures, that two sets that link have one of them in common."""
    n_shards = shards(blocks, SHARD_BYTES)
    asked = each_block(blocks, ask(text, k, percent, n_shards), "shard long, block long, n long, blob binary")
    # a shard is a task of its own here: with many of them in a task, executors of 3 GB ran out in ``keep_one``
    dealt = asked.repartition(n_shards, "shard").sortWithinPartitions("shard")
    replies = cut_lineage(dealt.mapInArrow(which_shared(SHARD_LIMIT), "block long, shard long, reply binary"), "shared")

    def pick(block: int, rows: pa.Table, got: dict[int, bytes]) -> pa.Table:
        sig, row, group, shard, need = in_order(shingle_sets(text_bytes(rows.column(text)), k), percent, n_shards)
        sizes = np.bincount(shard, minlength=n_shards)
        flags = [np.unpackbits(np.frombuffer(expand(got[s]), np.uint8), count=sizes[s]) for s in sorted(got)]
        shared = np.concatenate(flags).astype(bool) if flags else np.zeros(0, dtype=bool)
        found = np.bincount(group[shared], minlength=need.size)
        kept = np.flatnonzero(shared & (found >= need)[group])
        # of two sets' common signatures the first in sending order is among the first found - need + 1 of both
        kept = kept[place_in_group(group[kept]) <= (found - need)[group[kept]]]
        return pa.table({"sig": pa.array(sig[kept].view(np.int64)), "node": pa.array(node_of(block, row[kept]), pa.int64())})

    return each_answered(with_answers(blocks, replies), pick, "sig long, node long")


def packed_rows(nodes: DataFrame) -> DataFrame:
    """Nodes as one answer per block: the sorted row numbers."""
    block = F.shiftright("node", 40) * (1 << 32) + F.shiftright("node", 20).bitwiseAND(0xFFFFF)
    wanted = nodes.select(block.alias("block"), F.col("node").bitwiseAND(0xFFFFF).alias("row"))
    asked = wanted.groupBy("block").agg(F.collect_list("row").alias("rows"))  # rows of one block: bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.sort(np.array(r, dtype="<u4")).tobytes() for r in batch.column("rows").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), pa.array([0] * batch.num_rows, pa.int64()), pa.array(packed, pa.binary())],
                names=["block", "shard", "reply"],
            )

    return asked.mapInArrow(run, "block long, shard long, reply binary")


def sets_of(blocks: DataFrame, nodes: DataFrame, text: str, k: int) -> DataFrame:
    """(node, members): the sorted set of every node, as packed longs."""

    def pick(block: int, rows: pa.Table, replies: dict[int, bytes]) -> pa.Table:
        want = np.frombuffer(replies[0], dtype="<u4").astype(np.int64)
        sets = shingle_sets(text_bytes(rows.column(text).take(pa.array(want))), k)
        members = [sets.values[a:b] for a, b in zip(sets.bounds[:-1], sets.bounds[1:])]
        return pa.table(
            {
                "node": pa.array(node_of(block, want), pa.int64()),
                "members": pa.array([m.tobytes() for m in members], pa.binary()),
                "bitmap": pa.array([parity_bitmap(m).tobytes() for m in members], pa.binary()),
            }
        )

    joined = with_answers(blocks, packed_rows(nodes)).filter(F.col("answers").isNotNull())
    return each_answered(joined, pick, "node long, members binary, bitmap binary")


def parity_bitmap(values: np.ndarray, wider: int = 1) -> np.ndarray:
    """Bit i is the parity of the elements that hash to i; equal elements of two sets cancel out."""
    bits = min(BITS[1], max(BITS[0], wider << (values.size - 1).bit_length()))
    at = (mix(values + np.uint64(0xA5A5)) & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<u8")


def folded(bitmaps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of one width: wider ones are halved by xor, which keeps what they mean."""
    width = min(map(len, bitmaps))
    out = []
    for b in bitmaps:
        row = np.frombuffer(b, dtype="<u8")
        while row.nbytes > width:
            row = row[: row.size // 2] ^ row[row.size // 2 :]
        out.append(row)
    return np.stack(out)


def close_pairs(percent: int, emit: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs of one group (sig, lo, hi) in different components that their bitmaps and sizes allow to link.

    ``emit`` is "nearest" (a, b: for every class the pair of fewest differing
    bits among the groups compared together), "some" (the rows that are in any
    pair) or "all" (a, b). Rows come sorted by group; whole groups are
    compared together, the rows at every distance at once.
    """
    group = ["sig", "lo", "hi"]

    def compare(table: pa.Table) -> list[pa.RecordBatch]:
        key = np.stack([table.column(c).to_numpy() for c in group], axis=1)
        node, n, label, chunk = (table.column(c).to_numpy() for c in ("node", "n", "label", "chunk"))
        new = np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1)))
        last = np.concatenate((np.flatnonzero(new)[1:], [new.size]))[np.cumsum(new) - 1]  # end of each row's group
        split = key[:, 1] != key[:, 2]
        widths = pc.binary_length(table.column("bitmap")).to_numpy()
        maps = table.column("bitmap").to_pylist()
        least = np.minimum.reduceat(widths, np.flatnonzero(new))[np.cumsum(new) - 1]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        none = np.iinfo(np.int64).max
        best = np.full(new.size, none)  # of every row the least (differing bits << 32) + other row
        for width in np.unique(least).tolist():
            rows = np.flatnonzero(least == width)
            bits = folded([maps[i] for i in rows] + [bytes(width)])[:-1]
            place = np.full(new.size, -1)
            place[rows] = np.arange(rows.size)
            live, step = rows, 1
            while live.size:
                live = live[live + step < last[live]]
                other = live + step
                small, large = np.minimum(n[live], n[other]), np.maximum(n[live], n[other])
                ok = (label[live] != label[other]) & (small * 100 >= large * percent)
                ok &= ~split[live] | (chunk[live] != chunk[other])
                a, b = live[ok], other[ok]
                at_once = max(1, COMPARED // width)
                for at in range(0, a.size, at_once):
                    x, y = a[at : at + at_once], b[at : at + at_once]
                    far = np.bitwise_count(bits[place[x]] ^ bits[place[y]]).sum(axis=1, dtype=np.int64)
                    good = far <= (n[x] + n[y]) * (100 - percent) // (100 + percent)
                    x, y, far = x[good], y[good], far[good]
                    if emit == "all":
                        found.append((node[x], node[y]))
                    else:
                        np.minimum.at(best, x, (far << 32) + y)
                        np.minimum.at(best, y, (far << 32) + x)
                step += 1
        x = np.flatnonzero(best < none)
        if emit == "some":
            return table.drop_columns("bitmap").take(pa.array(x)).to_batches()
        if emit == "nearest":
            x = x[np.lexsort((best[x], node[x]))]
            x = x[np.flatnonzero(np.diff(node[x], prepend=none))]
            found.append((node[x], node[best[x] & 0xFFFFFFFF]))
        a, b = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        pairs = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0)
        return [pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], names=["a", "b"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < 20_000:
                continue
            key = np.stack([held.column(c).to_numpy() for c in group], axis=1)
            edges = np.flatnonzero((key[1:] != key[:-1]).any(axis=1))
            if edges.size:
                cut = int(edges[-1]) + 1
                yield from compare(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from compare(held)

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column("x")[i].as_py(), dtype="<u8")
                y = np.frombuffer(batch.column("y")[i].as_py(), dtype="<u8")
                if x.size > y.size:
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), y.size - 1)
                both = int((y[at] == x).sum())
                if 100 * both >= percent * (x.size + y.size - both):
                    good.append(i)
            taken = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(taken), batch.column("b").take(taken)], names=["a", "b"])

    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


PIECES = "sig long, lo long, hi long, node long, n long, label long, chunk long"


def in_pieces(members: DataFrame) -> DataFrame:
    """The rows (``PIECES``) to compare for the signatures of several components: a class meets every chunk of its signature."""
    state = members.groupBy("sig").agg(F.min("label").alias("first"), F.max("label").alias("last"), F.count(F.lit(1)).alias("size"))
    open_sigs = state.filter("first < last").select("sig", F.ceil(F.col("size") / CHUNK).cast("long").alias("chunks"))
    # one piece for each pair of chunks
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    return (
        members.join(open_sigs, "sig")
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
        .withColumn("other", other)
        .select("sig", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "node", "n", "label", "chunk")
    )


def compared(pieces: DataFrame, bitmaps: DataFrame, percent: int, emit: str) -> DataFrame:
    """``close_pairs`` over ``pieces`` with the bitmaps (node, bitmap) of their classes."""
    group = ["sig", "lo", "hi"]
    dealt = pieces.join(bitmaps, "node").select(*pieces.columns, "bitmap").repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(close_pairs(percent, emit), PIECES if emit == "some" else "a long, b long")


def wide_bitmaps(sets: DataFrame) -> DataFrame:
    """(node, bitmap): with more bits, so that few elements of two sets fall on one bit unseen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = [parity_bitmap(np.frombuffer(m, dtype="<u8"), WIDER).tobytes() for m in batch.column("members").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(wide, pa.binary())], names=["node", "bitmap"])

    return sets.select("node", "members").mapInArrow(run, "node long, bitmap binary")


def across_components(members: DataFrame, sets: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Distinct pairs (a, b) of one signature and different components that may link; ``members`` has sig, node, n, label."""
    narrow = sets.select("node", "bitmap")
    if nearest:
        return compared(in_pieces(members), narrow, percent, "nearest").distinct()
    # only the classes of some pair are compared again, by wide bitmaps, before all pairs come out
    some = cut_lineage(compared(in_pieces(members), narrow, percent, "some"), "some")
    wide = wide_bitmaps(sets.join(some.select("node").distinct(), "node", "left_semi"))
    return compared(some, wide, percent, "all").distinct()


def near(n: str, m: str, percent: int) -> F.Column:
    """Sizes that the threshold allows."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def pair(one: str, other: str) -> list[F.Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def link_classes(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, label) of all classes that link to another one; ``members`` has sig, node, n, distinct."""
    least = members.groupBy("sig").agg(F.min(F.struct("node", "n")).alias("p"))
    met = members.join(least, "sig").filter((F.col("p.node") < F.col("node")) & near("p.n", "n", percent))
    pairs = met.groupBy("node").agg(F.min("p.node").alias("pivot")).select(*pair("node", "pivot"))
    links = cut_lineage(verified(pairs, sets, percent), "links")
    labels = components(links)
    for nearest in (True, False):
        # then each class against its nearest one of another component, then against all that are left
        named = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        named = cut_lineage(named, "members")
        rest = across_components(named, sets, percent, nearest)
        more = cut_lineage(verified(rest, sets, percent), "links")
        discard(named)
        if not more.isEmpty():
            links = cut_lineage(links.unionByName(more), "links")
            labels = components(links)
    return labels


def components_of(blocks: DataFrame, text: str, key: str, k: int, percent: int) -> DataFrame:
    """(node, doc_id, n_shingles, class_id, label, component_id) of every row of ``blocks``; a label is a component."""

    def one_table(block: int, rows: pa.Table, _: dict) -> pa.Table:
        return pa.Table.from_batches([rows_of(text, key, k)(block, rows)])

    plain = blocks.select("block", "payload").withColumn("answers", F.lit(None).cast("array<struct<shard:long,reply:binary>>"))
    rows = cut_lineage(each_answered(plain, one_table, ROWS), "rows")
    sums = ["f1", "f2", "n_shingles"]
    same = rows.filter("n_shingles > 0").groupBy(*sums).agg(F.min("node").alias("class_id"))
    joined = rows.join(same, sums, "left").select("node", "doc_id", "n_shingles", F.coalesce("class_id", "node").alias("class_id"))
    classes = cut_lineage(joined, "classes")
    shared = shared_signatures(blocks, text, k, percent)
    class_of = classes.select("node", "class_id", F.col("n_shingles").alias("n"))
    members = shared.join(class_of, "node").groupBy("sig", F.col("class_id").alias("node")).agg(F.first("n").alias("n"))
    counted = cut_lineage(members, "members")
    several = counted.groupBy("sig").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("sig")
    members = cut_lineage(counted.join(several, "sig"), "members")
    discard(rows, counted)
    sets = cut_lineage(sets_of(blocks, members.select("node").distinct(), text, k), "sets")
    labels = link_classes(members, sets, percent).withColumnRenamed("node", "class_id")
    per_class = classes.groupBy("class_id").agg(F.min("doc_id").alias("least_id"))
    named = per_class.join(labels, "class_id", "left").withColumn("label", F.coalesce("label", "class_id"))
    tops = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    of_class = named.select("class_id", "label").join(tops, "label")
    return classes.join(of_class, "class_id").select("node", "doc_id", "n_shingles", "class_id", "label", "component_id")


def linked_components(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``key``, n_shingles, component_id, and class_id (equal sets share it)."""
    blocks = write_blocks(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), "text")
    found = components_of(blocks, "text", "doc_id", k, percent)
    return found.select(F.col("doc_id").alias(key), "n_shingles", "component_id", "class_id")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row of the smallest id stays, and every empty text."""
    blocks = write_blocks(docs, text)

    def staying() -> DataFrame:
        found = components_of(blocks, text, key, k, percent)
        group = F.when(F.col("n_shingles") > 0, F.col("label")).otherwise(F.col("node"))
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node"))
        return packed_rows(found.groupBy(group.alias("group")).agg(first.alias("first")).select("first.node"))

    stay = distilled(docs.sparkSession, staying, "stay")

    def pick(block: int, rows: pa.Table, replies: dict[int, bytes]) -> pa.Table:
        return rows.take(pa.array(np.frombuffer(replies[0], dtype="<u4").astype(np.int64)))

    joined = with_answers(blocks, stay).filter(F.col("answers").isNotNull())
    return each_answered(joined, pick, docs.schema)


def op10_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return linked_components(docs).select("doc_id", "n_shingles", "component_id")
