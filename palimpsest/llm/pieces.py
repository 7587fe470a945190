"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is read field by field, and its normaliser, white-space marker, scores (unigram) or merges (BPE) and
byte fallback are rebuilt as a tokenizers pipeline. Where no piece continues over a marker, a normalised text is cut before
each marker and every distinct word is encoded once for as long as a worker keeps it (for BPE, ROW_WORDS new words at a time);
else texts are encoded whole.
Batches run on several threads. Each document's ids are held against the sentencepiece library's; should they differ, the
library's are given and `parity` is false.

Nulls and empty texts have no ids and decode to an empty text. Other columns of the input do not reach the output.
Work is a map over partitions without a shuffle; memory is bounded by the batch and by KEPT_WORDS.
"""

from __future__ import annotations

import array
import os
import re
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Kept, pieces, small_batches

# Fixed values of the model file's schema: kinds of piece and of model.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"

THREADS = 2
KEPT_WORDS, KEPT_CHARS = 300_000, 32
SLICE_BYTES = 1 << 20
ROW_WORDS = 64


def fields(data: bytes):
    """The (number, value) pairs of a protobuf message; values are ints or bytes."""

    def varint(i: int) -> tuple[int, int]:
        n = shift = 0
        while True:
            b = data[i]
            n, shift, i = n | (b & 0x7F) << shift, shift + 7, i + 1
            if b < 0x80:
                return n, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            value, i = varint(i)
        else:
            if kind == 2:
                size, i = varint(i)
            elif kind in (1, 5):
                size = 8 if kind == 1 else 4
            else:
                raise ValueError(f"wire type {kind}")
            value, i = data[i : i + size], i + size
        yield key >> 3, value


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True


def parse(data: bytes) -> Model:
    m = Model()
    for number, value in fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for k, v in fields(value):
                if k == 1:
                    piece = v.decode()
                elif k == 2:
                    score = struct.unpack("<f", v)[0]
                elif k == 3:
                    kind = v
            m.pieces.append((piece, score, kind))
        elif number == 2:
            got = dict(fields(value))
            m.kind, m.byte_fallback, m.suffix = got.get(3, UNIGRAM), bool(got.get(35, 0)), bool(got.get(24, 0))
        elif number == 3:
            got = dict(fields(value))
            m.charsmap, m.dummy_prefix, m.squeeze, m.escape = got.get(2, b""), bool(got.get(3, 1)), bool(got.get(4, 1)), bool(got.get(5, 1))
    return m


def build(m: Model):
    """(tokenizer with a decoder and without a normaliser, normaliser, whether texts can be cut before a marker)."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if m.suffix or not m.escape:
        raise ValueError("models with the marker behind words, or without one, aren't supported")
    unknown = next((i for i, (_, _, kind) in enumerate(m.pieces) if kind == UNKNOWN), None)
    plain = [(p, s, i) for i, (p, s, kind) in enumerate(m.pieces) if kind in (NORMAL, USER_DEFINED)]
    if m.kind == UNIGRAM:
        lowest = min((s for _, s, _ in plain), default=0.0)
        # Control pieces must never come out of a text, so they get a score that no path takes.
        model = models.Unigram([(p, s if kind in (NORMAL, USER_DEFINED, UNKNOWN, BYTE) else lowest - 1e4) for p, s, kind in m.pieces], unk_id=unknown, byte_fallback=m.byte_fallback)
    elif m.kind == BPE:
        ids = {p: i for p, _, i in plain}
        # A merge for each way to put a piece together; of better score first.
        merges = [(-s, i, ids[p[:k]], ids[p[k:]], p[:k], p[k:]) for p, s, i in plain for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        model = models.BPE({p: i for i, (p, _, _) in enumerate(m.pieces)}, [(a, b) for *_, a, b in sorted(merges)], unk_token=None if unknown is None else m.pieces[unknown][0], fuse_unk=True, byte_fallback=m.byte_fallback)
    else:
        raise ValueError(f"models of kind {m.kind} aren't supported")
    steps = []
    if m.charsmap:
        steps.append(normalizers.Precompiled(m.charsmap))
    if m.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if m.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    tokenizer = Tokenizer(model)
    tokenizer.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse(), decoders.Replace(MARK, " "), *[decoders.Strip(" ", 1, 0)] * m.dummy_prefix])
    cuts = m.dummy_prefix and not any(re.search(f"[^{MARK}]{MARK}", p) for p, _, _ in plain)
    return tokenizer, normalizers.Sequence(steps), cuts


class Codec:
    """Encodes and decodes lists of texts."""

    def __init__(self, model: str, threads: int = THREADS):
        # Read by the library's thread pool when it starts.
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        with open(model, "rb") as f:
            m = parse(f.read())
        self.tokenizer, self.normalizer, self.cuts = build(m)
        # Without a character map or squeezing, normalising is these two string operations.
        self.lead = None if m.charsmap or m.squeeze else MARK * m.dummy_prefix
        self.kept = Kept(self._new, KEPT_WORDS, KEPT_CHARS)
        self.kind, self.marked = m.kind, np.array([kind in (NORMAL, USER_DEFINED) and p.startswith(MARK) for p, _, kind in m.pieces])
        # An ASCII byte is a character; other bytes, and control pieces, are left to the library's decoder.
        byte = [int(p[3:5], 16) if kind == BYTE else None for p, _, kind in m.pieces]
        self.table = [p.replace(MARK, " ") if b is None else chr(b) for (p, _, _), b in zip(m.pieces, byte, strict=True)]
        self.special = np.array([kind in (CONTROL, UNKNOWN) or b is not None and b > 0x7F for (*_, kind), b in zip(m.pieces, byte, strict=True)])
        self.dummy_prefix = m.dummy_prefix

    def normalize(self, text: str) -> str:
        if self.lead is not None:
            return self.lead + text.replace(" ", MARK) if text else ""
        return self.normalizer.normalize_str(text)

    def encode(self, texts: list[str]) -> list[array.array]:
        """Ids as array('I'). `kept` has the ids of words that recur, by the word without its first marker."""
        return [array.array("I", i) for i in self.kept.ids([self._words(t) for t in texts])[0]]

    def _new(self, words: list[str]) -> list[bytes]:
        """The ids of words. A BPE merge never goes over a marker, so words are encoded many in a row: of its tokens those that
        begin with a marker begin a word."""
        rowed = [w for w in words if w and MARK not in w] if self.cuts and self.kind == BPE else []
        rows = [rowed[a : a + ROW_WORDS] for a in range(0, len(rowed), ROW_WORDS)]
        found: dict[str, bytes] = {}
        for row, ids in zip(rows, self._batch([MARK + MARK.join(r) for r in rows]), strict=True):
            begins = np.flatnonzero(self.marked[ids])
            if len(begins) == len(row):
                raw, cuts = ids.tobytes(), [*(4 * begins).tolist(), 4 * len(ids)]
                found.update(zip(row, [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))
        rest, lead = [w for w in words if w not in found], MARK if self.cuts else ""
        found.update(zip(rest, [ids.tobytes() for ids in self._batch([lead + w for w in rest])], strict=True))
        return [found[w] for w in words]

    def _batch(self, texts: list[str]):
        for a in range(0, len(texts), 4096):
            for e in self.tokenizer.encode_batch_fast(texts[a : a + 4096], add_special_tokens=False):
                yield np.array(e.ids, np.uint32)

    def _words(self, text: str) -> str | None:
        """What stands behind each run's first marker, with a space between; the whole normalised text if it can't be cut.

        A normalised text has no spaces. Without any word there is nothing."""
        if not text:
            return None
        if self.cuts and self.lead == MARK and MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return text
        text = self.normalize(text)
        if not self.cuts or not text.startswith(MARK):
            if self.cuts and text:
                raise ValueError("a normalised text begins without a marker")
            return text or None
        words, lead = [], ""
        # A run of markers stays together with the word behind it.
        for w in text.split(MARK)[1:]:
            if w:
                words.append(lead + w)
                lead = ""
            else:
                lead += MARK
        return " ".join([*words, lead[1:]] if lead else words)

    def decode(self, ids: list[array.array]) -> list[str]:
        """Pieces put together by the model's table; where several bytes make a character, by the library's decoder."""
        table, out = self.table, []
        for i in ids:
            if self.special[np.frombuffer(i, np.uint32)].any():
                out.append(self.tokenizer.decode(i.tolist(), skip_special_tokens=False))
            else:
                text = "".join([table[k] for k in i])
                out.append(text[1:] if self.dummy_prefix and text.startswith(" ") else text)
        return out


_codecs: dict = {}


def codec(model: str, threads: int = THREADS) -> tuple[Codec, object]:
    """A worker's codec and the sentencepiece library's processor for the same model."""
    if (model, threads) not in _codecs:
        import sentencepiece

        _codecs[model, threads] = Codec(model, threads), sentencepiece.SentencePieceProcessor(model_file=model)
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    return _codecs[model, threads]


def encode_pieces(docs: DataFrame, model: str, threads: int = THREADS, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, decoded_crc32, round_trip, parity, and the ids (array of int) themselves if asked for.

    ids_crc32 is over the ids as little-endian unsigned 32-bit integers, decoded_crc32 over the UTF-8 of the text that they
    give back; round_trip says that this is the document's text.
    """

    def run(batches):
        import pyarrow as pa

        ours, library = codec(model, threads)
        names = ["doc_id", "n_tokens", "ids_crc32", "decoded_crc32", "round_trip", "parity", "ids"]
        for part in pieces(batches, "text", SLICE_BYTES):
            texts = [t or "" for t in part.column(1).to_pylist()]
            ids, checked = ours.encode(texts), library.encode(texts, num_threads=threads)
            same = [a.tolist() == b for a, b in zip(ids, checked, strict=True)]
            ids = [a if ok else array.array("I", b) for a, b, ok in zip(ids, checked, same, strict=True)]
            back = ours.decode(ids)
            columns = [part.column(0), pa.array(map(len, ids), pa.int64()), pa.array([zlib.crc32(i) for i in ids], pa.int64()), pa.array([zlib.crc32(t.encode()) for t in back], pa.int64()), pa.array([a == b for a, b in zip(back, texts, strict=True)], pa.bool_()), pa.array(same, pa.bool_())]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
                columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    small_batches(docs.sparkSession)
    rows = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, decoded_crc32 long, round_trip boolean, parity boolean" + ", ids array<int>" * with_ids)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)
