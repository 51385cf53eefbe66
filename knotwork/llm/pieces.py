"""SentencePiece encoding and decoding that keeps source offsets.

One pass makes ids and offsets. The text is normalised by longest-prefix lookups in the model's compiled
character map, noting the source byte of every normalised byte; a model without a map and without
squeezing leaves all bytes but spaces as they are, so there the same alignment is had by counting. The
normalised text is then split where no vocabulary piece can cross (before runs of the space symbol,
and around line ends if no piece holds one); merges never leave such a segment, so each distinct
segment is encoded once, and its ids and the bytes that each piece covers are kept. The running sum of
those bytes, looked up in the alignment, gives every piece's begin and end in the source.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Kept, alone, documents, texts_of

SPACE = "▁"


class CharsMap:
    """The compiled character map: a double-array trie over UTF-8 bytes, then zero-ended replacements."""

    def __init__(self, blob: bytes) -> None:
        n = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{n // 4}I", blob, 4) if blob else ()
        self.texts = blob[4 + n :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """How many bytes from at on are replaced, and by what; None if no prefix is in the map."""
        if not self.units:
            return None
        step = lambda unit: (unit >> 10) << ((unit & 0x200) >> 6)  # noqa: E731  the offset field and its scale bit
        node, found = step(self.units[0]), None
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= step(unit)
            if unit & 0x100:
                value = self.units[node] & 0x7FFFFFFF
                found = (k + 1 - at, self.texts[value : self.texts.index(b"\0", value)])
        return found


@dataclass
class Normal:
    text: str
    #: For each byte of the text in UTF-8, the source byte it came from; one more for the end.
    source: np.ndarray


@dataclass
class Coded:
    #: In decimal, comma-joined.
    ids: str
    plain: str
    #: Bytes of the source, a begin and an end for each id.
    begins: np.ndarray
    ends: np.ndarray


class PieceCoder:
    #: Texts whose new segments are encoded in one call.
    AT_ONCE = 200

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        self.map = CharsMap(rules.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = rules.add_dummy_prefix, rules.remove_extra_whitespaces, rules.escape_whitespaces
        if model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models that put the space symbol behind words aren't supported")
        names = [p.piece for p in model.pieces if p.type in (1, 4)]
        fallback = model.trainer_spec.byte_fallback
        self.whole = SentencePieceProcessor(model_file=path)
        # adjacent unknown pieces are joined to one, so without byte fallback segments aren't independent
        self.splits = fallback and self.escape and model.trainer_spec.model_type == 2 and not any(SPACE in x.lstrip(SPACE) for x in names) and not any(p.type == 4 for p in model.pieces)
        lines = not any("\n" in x for x in names)
        self.segments = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+" if lines else f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        #: Bytes that each piece covers; 0 for the unknown one, whose text varies.
        self.special = np.asarray([p.type != 1 for p in model.pieces])
        self.sizes = np.asarray([1 if p.type == 6 else 0 if p.type == 2 else len(p.piece.encode()) for p in model.pieces], "<u4")
        rules.add_dummy_prefix, rules.remove_extra_whitespaces, rules.precompiled_charsmap = False, False, b""
        self.bare = SentencePieceProcessor(model_proto=model.SerializeToString())
        self.identity = not self.map.units and not self.squeeze
        #: Segment -> its ids in decimal, and the bytes of each.
        self.known = Kept(lambda segment: self.cut(segment, self.bare.encode(segment)))
        #: Segments that don't decode to themselves.
        self.odd: dict[str, str] = {}

    def cut(self, segment: str, ids: list[int]) -> tuple[str, bytes]:
        size = self.sizes[ids]
        if not size.all():
            size = np.asarray([x.end - x.begin for x in self.bare.encode(segment, return_type="proto").pieces], "<u4")
        return ",".join(map(str, ids)), size.tobytes()

    def normalise(self, text: str) -> Normal:
        data = text.encode()
        if self.identity and self.escape:
            wide = len(SPACE.encode())
            dummy = SPACE if self.dummy and data else ""
            source = np.repeat(np.arange(len(data)), np.where(np.frombuffer(data, np.uint8) == 0x20, wide, 1))
            return Normal(dummy + text.replace(" ", SPACE), np.concatenate((np.zeros(len(dummy) * wide, np.int64), source, [len(data)])))
        parts: list[tuple[bytes, int]] = []
        at = 0
        while at < len(data):
            size = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
            n, new = self.map.longest(data, at) or (size, data[at : at + size])
            parts.append((new, at))
            at += n
        end = len(data)
        if self.squeeze:
            while parts and parts[0][0] in (b" ", b""):
                parts.pop(0)
            while parts and parts[-1][0] in (b" ", b""):
                end = parts.pop()[1]
        space = SPACE.encode() if self.escape else b" "
        out, source = bytearray(), []
        if self.dummy and parts:
            out += space
            source += [parts[0][1]] * len(space)
        blank = self.squeeze and bool(parts)
        for new, start in parts:
            if self.squeeze and blank:
                new = new.lstrip(b" ")
            if not new:
                continue
            blank = self.squeeze and new.endswith(b" ")
            new = new.replace(b" ", space)
            out += new
            source += [start] * len(new)
        if self.squeeze:
            while out.endswith(space):
                del out[-len(space) :]
                end = source[-len(space)]
                del source[-len(space) :]
        return Normal(out.decode(), np.asarray([*source, end]))

    def learn(self, segments: set[str]) -> None:
        """Encode those segments that aren't known yet, all in one call. Only segments with other than plain pieces can decode to something else."""
        new = [x for x in segments if x not in self.known and not self._again(x)]
        if not new:
            return
        coded = self.bare.encode(new, num_threads=1)
        ends = np.cumsum(list(map(len, coded)))
        ids = np.fromiter(chain.from_iterable(coded), np.int64, ends[-1])
        sizes, names = self.sizes[ids].tobytes(), list(map(str, ids.tolist()))
        at = 0
        for segment, end in zip(new, ends.tolist(), strict=True):
            self.known.keep(segment, (",".join(names[at:end]), sizes[4 * at : 4 * end]))
            at = end
        special = np.unique(np.searchsorted(ends, np.flatnonzero(self.special[ids]), "right")).tolist()
        for i, plain in zip(special, self.bare.decode([coded[i] for i in special], num_threads=1) if special else (), strict=True):
            self.known.keep(new[i], self.cut(new[i], coded[i]))
            if plain != new[i].replace(SPACE, " "):
                self.odd[new[i]] = plain

    def _again(self, segment: str) -> bool:
        value = self.known.older.get(segment)
        if value is not None:
            self.known.keep(segment, value)
        return value is not None

    def _coded(self, normal: Normal, ids: str, sizes: bytes, plain: str) -> Coded:
        """With offsets: each piece's bytes of the normalised text, looked up in the alignment."""
        ends = np.cumsum(np.frombuffer(sizes, "<u4"), dtype=np.int64)
        return Coded(ids, plain, normal.source[np.concatenate(([0], ends[:-1]))] if len(ends) else ends, normal.source[ends])

    def code(self, texts: list[str]) -> Iterator[Coded]:
        """Ids, decoded text and offsets of each text."""
        for at in range(0, len(texts), self.AT_ONCE):
            normal = [self.normalise(x) for x in texts[at : at + self.AT_ONCE]]
            if not self.splits:
                for x in normal:
                    own = self.bare.encode(x.text)
                    yield self._coded(x, *self.cut(x.text, own), self.whole.decode(own))
                continue
            split = [self.segments(x.text) for x in normal]
            self.learn(set().union(*split))
            for x, segments in zip(normal, split, strict=True):
                found = [self.known[y] for y in segments]
                plain = x.text.replace(SPACE, " ") if not self.odd else "".join([self.odd.get(y) or y.replace(SPACE, " ") for y in segments])
                yield self._coded(x, ",".join([ids for ids, _ in found]), b"".join([size for _, size in found]), plain[1:] if self.dummy and plain.startswith(" ") else plain)

    def spans(self, text: str) -> list[tuple[int, str, int, int]]:
        """(id, piece, begin, end) of every piece, as bytes of the text as given."""
        (x,) = self.code([text])
        ids = list(map(int, x.ids.split(","))) if x.ids else []
        return list(zip(ids, map(self.bare.id_to_piece, ids), x.begins.tolist(), x.ends.tolist(), strict=True))


def piece_coder(path: str) -> PieceCoder:
    return alone(f"pieces {path}", lambda: PieceCoder(path))


SPANS = pa.list_(pa.struct([("id", pa.int32()), ("piece", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))


def encode(docs: DataFrame, model: str, with_spans: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_tokens, digests of the ids, of the decoded text and of the spans; with with_spans also ids, pieces and byte spans.

    spans_crc32 is over the begins and then the ends, as little-endian 32-bit numbers. Null and empty texts
    have no tokens and decode to an empty text. Repeated rows, and rows without an id, each give a row. Other
    columns of docs are left out; an empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(model)
        for batch in batches:
            counts, ids_sha, text_sha, crc, spans = [], [], [], [], []
            for x in coder.code(batch.column(1).to_pylist()):
                counts.append(len(x.ends))
                ids_sha.append(hashlib.sha256(x.ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(x.plain.encode()).hexdigest())
                crc.append(zlib.crc32(x.ends.astype("<u4"), zlib.crc32(x.begins.astype("<u4"))))
                if with_spans:
                    ids = list(map(int, x.ids.split(","))) if x.ids else []
                    spans.append([dict(zip(("id", "piece", "begin", "end"), y, strict=True)) for y in zip(ids, map(coder.bare.id_to_piece, ids), x.begins.tolist(), x.ends.tolist(), strict=True)])
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string()), pa.array(crc, pa.int64())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"]
            if with_spans:
                columns.append(pa.array(spans, SPANS))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long" + ", spans array<struct<id:int,piece:string,begin:int,end:int>>" * with_spans
    return texts_of(docs, id_col, text_col).mapInArrow(run, schema)


def op4_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Every row of documents, encoded and decoded; see `encode`."""
    import public_tokenizers

    return encode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
