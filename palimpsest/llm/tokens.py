"""Token-ID output: documents as independent zstandard frames with a trailing seek table.

A file is a sequence of zstandard frames, so any zstandard tool decompresses it to the ids of all its documents
(little-endian unsigned 32-bit) one after the other:

    data frame *          one document's ids, at most FRAME_IDS of them; a longer document has several frames
    skippable frame       the directory: zstandard-compressed arrays of document ids and numbers of ids
    skippable frame       the public seekable format's seek table: for each data frame its compressed size,
                          its decompressed size and the low 32 bits of the XXH64 of its decompressed bytes

A reader fetches the tail, finds the frames of the documents it wants, and reads and decompresses only these.

Files are written in ascending order of doc_id: one range-partitioning shuffle of the texts, one file for each partition.
A task writes under a name of its own attempt and renames, so a retried or speculative task leaves one whole file.

Nulls: a null text has no ids but the end id; null ids sort first. Rows of the same doc_id follow each other in order of text.
"""

from __future__ import annotations

import array
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Kept, fs_of, scratch

# Fixed values of the zstandard seekable format.
SKIPPABLE_DIRECTORY = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_IDS = 1 << 18
#: Little-endian machines are assumed. Pieces kept by a worker, about 150 MB, and the longest of them.
CACHED_PIECES, CACHED_CHARS = 700_000, 32
SLICE_BYTES = 8 << 20
#: Marks that stand for ".\n", "." and "," after a letter, and for the lack of a space before a piece.
DOT_LINE, DOT, COMMA, GLUED = "\ue000", "\ue001", "\ue002", "\ue003"
MARKS = {DOT_LINE: ".\n", DOT: ".", COMMA: ",", GLUED: ""}
MARKED = re.compile("[\ue000-\ue003]")
#: Full stops and commas that don't follow a letter.
WIDE = re.compile(r"\s\s")
NOT_CUT = re.compile(r"[.,](?<![^\W\d_][.,])")


class Encoder:
    """Whole texts to bytes of ids, through the tokenizers library; pieces between words are encoded once and kept.

    Byte-level BPE begins a word at a space between two characters that aren't white space, at "." or "," after a letter,
    and after a line's end. A text is cut there by string operations alone, or at spaces only where such punctuation follows
    other characters. Texts with other white space are encoded whole.
    """

    def __init__(self, path: str):
        # Tasks share out the cores; threads of the library's own would only add memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A token of byte-level BPE has a character for each byte.
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)
        self.kept = Kept(self._pieces, CACHED_PIECES, CACHED_CHARS)

    def __call__(self, texts: list[str]) -> list[bytes]:
        rows = [self._cut(t) if t else None for t in texts]
        out, wrong = self.kept.ids(rows)
        # No cut was made, or a piece says that there should have been none.
        whole = sorted({*wrong.tolist(), *(i for i, r in enumerate(rows) if r is None and texts[i])})
        for i, e in zip(whole, self.tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False), strict=True):
            out[i] = array.array("I", e.ids).tobytes()
        return out

    @staticmethod
    def _cut(text: str) -> str | None:
        """The text with a space at each cut; nothing if it has to be encoded whole."""
        if not text.isascii() and MARKED.search(text):
            return None
        if not NOT_CUT.search(text):
            text = text.replace(".\n", f" {DOT_LINE} {GLUED}").replace(". ", f" {DOT} ").replace(",", f" {COMMA}")
        return GLUED + text

    def _pieces(self, new: list[str]) -> list[bytes | None]:
        """The ids of each piece; None for one that shows that its text can't be cut."""
        found: dict[str, bytes | None] = {}
        glued = [p for p in new if not p or p[0] in MARKS]
        spaced = [p for p in new if p and p[0] not in MARKS]
        for a in range(0, len(glued), 4096):
            part = []
            for p in glued[a : a + 4096]:
                if not p or p == GLUED or p[-1].isspace() or p[0] == GLUED and p[1].isspace():
                    found[p] = None
                else:
                    part.append(p)
            for p, e in zip(part, self.tokenizer.encode_batch_fast([self._text(p) for p in part], add_special_tokens=False), strict=True):
                found[p] = array.array("I", e.ids).tobytes()
        for a in range(0, len(spaced), 4096):
            part = spaced[a : a + 4096]
            row = " " + " ".join(part)
            if WIDE.search(row + "x"):
                found.update((p, None) for p in part if p[0].isspace() or p[-1].isspace())
                part = [p for p in part if p not in found]
                row = " " + " ".join(part)
            if not part:
                continue
            # Pieces that begin with a space keep their tokens in a row of pieces: the tokens' sizes tell which are whose.
            ids = np.array(self.tokenizer.encode_batch_fast([row], add_special_tokens=False)[0].ids, "<u4")
            ends = np.concatenate([[0], np.cumsum(self.sizes[ids])])
            data = np.frombuffer(row.encode(), np.uint8)
            begins = np.append(np.flatnonzero(data == 32), len(data))
            cuts = np.searchsorted(ends, begins)
            if not np.array_equal(ends[cuts], begins):
                raise ValueError("the tokens of the pieces don't add up")
            raw, cuts = ids.tobytes(), (4 * cuts).tolist()
            found.update(zip(part, [raw[i:j] for i, j in zip(cuts, cuts[1:], strict=False)], strict=True))
        return [found[p] for p in new]

    @staticmethod
    def _text(piece: str) -> str:
        for mark, text in MARKS.items():
            if mark in piece:
                piece = piece.replace(mark, text)
        return piece


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process, so that pieces are kept from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class FileWriter:
    """Writes one file of frames; add() in order, then close()."""

    def __init__(self, out, level: int = 3):
        import zstandard

        self.out, self.pack = out, zstandard.ZstdCompressor(level=level)
        self.table: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        import xxhash

        for a in range(0, len(ids), 4 * FRAME_IDS):
            raw = ids[a : a + 4 * FRAME_IDS]
            frame = self.pack.compress(raw)
            self.out.write(frame)
            self.table.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)

    def close(self) -> None:
        known = np.array([x is not None for x in self.ids], "u1")
        ids = np.array([x or 0 for x in self.ids], "<i8")
        directory = self.pack.compress(known.tobytes() + ids.tobytes() + np.array(self.counts, "<u8").tobytes())
        self.out.write(struct.pack("<II", SKIPPABLE_DIRECTORY, len(directory)) + directory)
        entries = np.array(self.table, "<u4").reshape(-1, 3).tobytes()
        footer = struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(entries) + len(footer)) + entries + footer)


class FileReader:
    """Random access to the documents of one file; source: a seekable binary file."""

    def __init__(self, source):
        import zstandard

        self.source, self.unpack = source, zstandard.ZstdDecompressor()
        size = source.seek(0, 2)
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("not a seekable token file")
        table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.sizes, self.raw, self.sums = table[:, 0], table[:, 1], table[:, 2]
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)])
        at = int(self.begins[-1])
        kind, length = struct.unpack("<II", self._at(at, 8))
        if kind != SKIPPABLE_DIRECTORY:
            raise ValueError("the directory is missing")
        d = self.unpack.decompress(self._at(at + 8, length))
        docs = len(d) // 17
        known = np.frombuffer(d, "u1", docs)
        ids = np.frombuffer(d, "<i8", docs, docs)
        self.doc_ids = [int(x) if k else None for x, k in zip(ids, known, strict=True)]
        self.counts = np.frombuffer(d, "<u8", docs, 9 * docs).astype(np.int64)
        self.frames = np.concatenate([[0], np.cumsum(-(-self.counts // FRAME_IDS))])
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    def _at(self, begin: int, n: int) -> bytes:
        self.source.seek(begin)
        return self.source.read(n)

    def ids(self, k: int) -> Iterator[bytes]:
        """The ids of the k-th document, a verified frame at a time; no other document's frame is read."""
        import xxhash

        for f in range(int(self.frames[k]), int(self.frames[k + 1])):
            raw = self.unpack.decompress(self._at(int(self.begins[f]), int(self.sizes[f])), max_output_size=int(self.raw[f]))
            if len(raw) != self.raw[f] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[f]:
                raise ValueError(f"frame {f} is damaged")
            yield raw

    def find(self, doc_id: int | None) -> list[int]:
        return [k for k, x in enumerate(self.doc_ids) if x == doc_id]


def write_tokens(docs: DataFrame, tokenizer: str, out: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes all texts into files under `out` in ascending order of id; returns one row per file: path, n_docs, n_ids, start.

    `start` counts the ids in all files before. Only these rows, one per file, come to the driver.
    An empty table gives no file and no row.
    """
    spark = docs.sparkSession

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encode, context, end = encoder(tokenizer), TaskContext.get(), np.array([end_id], "<u4").tobytes()
        fs, folder = fs_of(out)
        fs.create_dir(folder, recursive=True)
        name = f"{folder}/part-{context.partitionId():06d}.ids.zst"
        attempt, writer, n = f"{folder}/.{context.taskAttemptId()}.tmp", None, 0
        from .common import pieces

        with fs.open_output_stream(attempt) as stream:
            writer = FileWriter(stream)
            for part in pieces(batches, "text", SLICE_BYTES):
                texts = [t or "" for t in part.column(1).to_pylist()]
                for i, ids in zip(part.column(0).to_pylist(), encode(texts), strict=True):
                    writer.add(i, ids + end)
                    n += len(ids) // 4 + 1
            writer.close()
        if writer.counts:
            try:
                fs.move(attempt, name)
            except OSError:
                # Another attempt was faster, and its file holds the same.
                if fs.get_file_info(name).type.name != "File":
                    raise
                fs.delete_file(attempt)
            yield pa.RecordBatch.from_pydict({"part": [context.partitionId()], "path": [f"{out}/{name.rpartition('/')[2]}"], "n_docs": [len(writer.counts)], "n_ids": [n]})
        else:
            fs.delete_file(attempt)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).repartitionByRange("id").sortWithinPartitions("id", "text")
    files = sorted(rows.mapInArrow(write, "part long, path string, n_docs long, n_ids long").collect())
    start, listed = 0, []
    for f in files:
        listed.append((f.path, f.n_docs, f.n_ids, start))
        start += f.n_ids
    return spark.createDataFrame(listed, "path string, n_docs long, n_ids long, start long")


def read_tokens(files: DataFrame) -> DataFrame:
    """All documents of the files that write_tokens() returned: doc_id, start, n_tokens, ids_crc32."""

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                fs, name = fs_of(path)
                with fs.open_input_file(name) as source:
                    r = FileReader(source)
                    sums = []
                    for k in range(len(r.doc_ids)):
                        crc = 0
                        for raw in r.ids(k):
                            crc = zlib.crc32(raw, crc)
                        sums.append(crc)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(r.doc_ids, pa.int64()), pa.array(r.starts[:-1] + start, pa.int64()), pa.array(r.counts, pa.int64()), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return files.repartition(max(1, files.count()), "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(path: str, doc_ids: list[int]) -> dict[int, list[np.ndarray]]:
    """The ids of the named documents in one file, decompressing only their frames."""
    fs, name = fs_of(path)
    with fs.open_input_file(name) as source:
        r = FileReader(source)
        return {d: [np.frombuffer(b"".join(r.ids(k)), "<u4") for k in r.find(d)] for d in doc_ids}


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_tokens(write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), scratch(spark, "tokens")))
