"""Offset-preserving SentencePiece encoding and decoding.

``Normalizer`` applies a model's compiled character map by longest prefix and
records, for every byte of the normalised text, the source byte it came from.
``Encoder`` cuts the normalised text where no piece can cross (before a space
mark that follows another character), encodes each distinct segment once
through the model, and projects every piece back to source bytes.

Defined cases: a null or empty text has only the begin and end ids; repeated
rows are each encoded; carried columns pass through unchanged; an empty table
gives no row. One scan, no shuffle; the segment memory is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ..session import ship_package

MARK = "▁"
MARK_BYTES = MARK.encode()
#: Segments remembered at most by one worker process.
SEGMENTS = 500_000


class CharMap:
    """Compiled character map: a double-array trie of source prefixes and the texts that replace them."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist() if blob else []
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest prefix of ``data[at:]`` in the map, and its replacement."""
        if not self.units:
            return None
        unit, found = self.units[0], None
        node = _offset(unit)
        for i in range(at, len(data)):
            node ^= data[i]
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, self.units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        end = self.texts.index(b"\0", found[1])
        return found[0], self.texts[found[1] : end]


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & 0x200) >> 6)


class Normalizer:
    def __init__(self, charsmap: bytes, dummy_prefix: bool, squeeze_spaces: bool):
        self.map = CharMap(charsmap)
        self.dummy_prefix = dummy_prefix
        self.squeeze_spaces = squeeze_spaces

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text with space marks, and the source byte of each of its bytes (one more for the end)."""
        source = text.encode()
        if self.map.units or self.squeeze_spaces:
            data, origin, begin, end = self._mapped(source)
        else:
            data, origin, begin, end = source, None, 0, len(source)
        if not data:
            return "", np.array([len(source)], dtype=np.int64)
        raw = np.frombuffer(data, dtype=np.uint8)
        widths = np.where(raw == 32, 3, 1)
        at = np.arange(raw.size) if origin is None else np.asarray(origin, dtype=np.int64)
        spread = np.repeat(at, widths)
        lead = np.full(3 if self.dummy_prefix else 0, begin)
        marked = data.decode(errors="replace").replace(" ", MARK)
        return (MARK if self.dummy_prefix else "") + marked, np.concatenate((lead, spread, [end]))

    def _mapped(self, source: bytes) -> tuple[bytes, list[int], int, int]:
        """Normalised bytes, the source byte of each, and where the text begins and ends between spaces that are dropped."""
        out, origin, at, begin = bytearray(), [], 0, 0
        while at < len(source):
            hit = self.map.longest(source, at)
            if hit is None:
                n = 1
                while at + n < len(source) and source[at + n] & 0xC0 == 0x80:
                    n += 1
                piece = source[at : at + n]
                places = list(range(at, at + n))
            else:
                n, piece = hit
                places = [at] * len(piece)
            for b, p in zip(piece, places):
                if not (self.squeeze_spaces and b == 32 and (not out or out[-1] == 32)):
                    out.append(b)
                    origin.append(p)
            if self.squeeze_spaces and begin == at and piece == b" ":
                begin += n
            at += n
        end = len(source)
        # a space mark of the source's own counts as a space at the end
        while self.squeeze_spaces and (n := 1 if out.endswith(b" ") else 3 if out.endswith(MARK_BYTES) else 0):
            end = origin[-n]
            del out[-n:], origin[-n:]
        return bytes(out), origin, begin, end


class Encoder:
    """One model in one process."""

    def __init__(self, model_file: str | None, model_proto: bytes | None = None):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file, model_proto=model_proto)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.model.serialized_model_proto())
        spec = proto.normalizer_spec
        self.normalize = Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces)
        # what is normalised here must not be normalised again
        self.plain = self.model
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            spec.name, spec.precompiled_charsmap, spec.remove_extra_whitespaces = "identity", b"", False
            self.plain = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        # segments are cut before a mark that follows another character, so no piece may hold such a place
        self.cuts = spec.add_dummy_prefix and not any(MARK in p.lstrip(MARK) for p in names)
        self.widths = np.array(
            [1 if self.model.is_byte(i) else 0 if self.model.is_control(i) else len(p.encode()) for i, p in enumerate(names)]
        )
        self.mark = np.array([self.model.piece_to_id(MARK)], dtype="<u4").tobytes()
        self.seen: dict[str, bytes] = {}

    def ids(self, normal: str) -> np.ndarray:
        """Ids of a normalised text, without begin and end."""
        if not normal:
            return np.zeros(0, dtype="<u4")
        if not self.cuts:
            return np.array(self.plain.encode(normal[self.normalize.dummy_prefix :].replace(MARK, " ")), dtype="<u4")
        segments = self._segments(normal)
        seen = self.seen
        fresh = [s for s in dict.fromkeys(segments) if s not in seen]
        own = seen
        if fresh:
            if len(seen) + len(fresh) > SEGMENTS:
                own = {s: seen[s] for s in dict.fromkeys(segments) if s in seen}
                self.seen = own
            own.update(self._encoded(fresh))
        return np.frombuffer(b"".join(map(own.__getitem__, segments)), dtype="<u4")

    def _encoded(self, fresh: list[str]) -> Iterator[tuple[str, bytes]]:
        """Segments with their ids; all that end in another character than a mark go through the model as one text."""
        solid = [s for s in fresh if s and s[-1] != MARK]
        for s in fresh:
            if not s:
                yield s, self.mark
            elif s[-1] == MARK:
                yield s, np.array(self.plain.encode(s.replace(MARK, " ")), dtype="<u4").tobytes()
        if solid:
            got = np.array(self.plain.encode(MARK.join(solid).replace(MARK, " ")), dtype="<u4")
            stops = np.cumsum([len(s.encode()) + len(MARK_BYTES) for s in solid])
            bounds = np.searchsorted(np.cumsum(self.widths[got]), stops) + 1
            data, at = got.tobytes(), 0
            for s, stop in zip(solid, bounds.tolist()):
                yield s, data[4 * at : 4 * stop]
                at = stop

    @staticmethod
    def _segments(normal: str) -> list[str]:
        """Segments without their leading mark: each is marks, then other characters."""
        parts = normal[1:].split(MARK)
        if "" not in parts:
            return parts
        out, lead = [], 0
        for i, p in enumerate(parts):
            if p or i == len(parts) - 1:
                out.append(MARK * lead + p)
                lead = 0
            else:
                lead += 1
        return out

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids with begin and end, and the source byte bounds of every id (begin and end are empty)."""
        text = text or ""
        normal, origin = self.normalize(text)
        body = self.ids(normal)
        at = np.concatenate(([0], np.cumsum(self.widths[body])))
        starts, ends = origin[at[:-1]], origin[at[1:]]
        n = len(text.encode())
        ids = np.concatenate(([self.model.bos_id()], body, [self.model.eos_id()])).astype("<u4")
        return ids, np.concatenate(([0], starts, [n])), np.concatenate(([0], ends, [n]))

    def decode(self, ids: np.ndarray) -> str:
        return self.model.decode(ids.tolist())


@lru_cache(maxsize=2)
def encoder(model_file: str) -> Encoder:
    return Encoder(model_file)


def encode_texts(docs: DataFrame, model_file: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus n_tokens, ids, starts, ends (little-endian unsigned 32-bit each) and decoded."""
    ship_package(docs.sparkSession)
    source = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    keys = [f.name for f in source.schema.fields[:-1]]
    schema = StructType(
        source.schema.fields[:-1]
        + [StructField("n_tokens", LongType())]
        + [StructField(c, BinaryType()) for c in ("ids", "starts", "ends")]
        + [StructField("decoded", StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model_file)
        for batch in batches:
            texts = batch.column("_text")
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                columns: list[list] = [[], [], [], [], []]
                for t in texts.slice(at, 256):
                    ids, starts, ends = own.encode(t.as_py())
                    row = (ids.size, ids.tobytes(), starts.astype("<u4").tobytes(), ends.astype("<u4").tobytes(), own.decode(ids))
                    for c, v in zip(columns, row):
                        c.append(v)
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in keys]
                    + [pa.array(columns[0], pa.int64())]
                    + [pa.array(c, pa.binary()) for c in columns[1:4]]
                    + [pa.array(columns[4], pa.string())],
                    names=[*keys, "n_tokens", "ids", "starts", "ends", "decoded"],
                )

    return source.mapInArrow(run, schema).select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "n_tokens", "ids", "starts", "ends", "decoded"
    )


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op3_pieces(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_texts(docs, model_path()).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2(F.concat("starts", "ends"), 256).alias("spans_sha256"),
    )
