"""What the training-data operators share: the shared scratch folder, row keys and vectorised hashing."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The same characters, as a string.
SPACES = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset: one in the warehouse, or in
    local mode, as in tests, a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        local = re.match(r"local(\[[^,]*\])?$", spark.sparkContext.master)
        base = "file://" + tempfile.mkdtemp(prefix="palimpsest-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the application's part of the shared folder, which goes when the driver's JVM ends."""
    small_batches(spark)
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/palimpsest-{spark.sparkContext.applicationId}")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.mkdirs(root):
        fs.deleteOnExit(root)
    # With its scheme, so that executors' own file access goes to the same store as Spark's.
    return f"{fs.makeQualified(root).toString()}/{name}-{uuid.uuid4().hex}"


#: Rows of an Arrow batch of texts; with Spark's default of 10000, a batch of long texts takes up much of a worker's memory.
BATCH_ROWS = 2500


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's limit of rows in an Arrow batch to BATCH_ROWS."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def delete(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


#: On local disks Hadoop starts a process (chmod) for each folder, file and checksum file that a task makes. Until it runs a
#: program of its own, it shares the memory of the executor, and may be counted beside it. So there are no checksum files:
#: the pages of a table have checksums of their own, which are held against them in every read.
BARE = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: the lineage ends there, so a lost executor costs only reads."""
    path = scratch(df.sparkSession, name)
    df.write.options(compression="zstd", **(BARE if path.startswith("file:") else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).option("parquet.page.verify-checksum.enabled", "true").parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that written() returned and that nothing reads any more."""
    for t in tables:
        for path in {f.rpartition("/")[0] for f in t.inputFiles()}:
            delete(t.sparkSession, path)


def crc32_text(c: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; of no bytes for null."""
    return F.crc32(F.coalesce(c, F.lit("")).cast("binary"))


def fs_of(path: str):
    """pyarrow's file system and the path in it; usable on executors."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("file://" + path.removeprefix("file:") if "://" not in path else path)


# ---- hashing in numpy ----

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x + U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: A random 64-bit value for each byte, and an odd base with its inverse modulo 2**64.
BYTE_VALUES = mix(np.arange(256, dtype=U64))
BASE = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64, kept between calls of a task."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16, 0 if have is None else min(2 * len(have), 1 << 20))
        with np.errstate(over="ignore"):
            have = np.cumprod(np.concatenate([np.ones(1, U64), np.full(size - 1, base, U64)]))
        _powers[base] = have
    return have[:n]


SPACE_BYTES = np.zeros(256, bool)
SPACE_BYTES[[0x20, *range(0x09, 0x0E)]] = True


#: Bytes that are hashed at once; longer texts are taken in pieces that end at white space.
HASH_BYTES = 8 << 20


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of the bytes, and where each begins."""
    if not len(data):
        return np.empty(0, U64), np.empty(0, np.int64)
    if len(data) > 2 * HASH_BYTES:
        parts, a = [], 0
        while a < len(data):
            b = min(a + HASH_BYTES, len(data))
            while b < len(data) and not (space := SPACE_BYTES[data[b : b + 4096]]).any():
                b += 4096
            b = min(b + (int(space.argmax()) if b < len(data) else 0), len(data))
            hashes, begin = _word_hashes(data[a:b])
            parts.append((hashes, begin + a))
            a = b
        return np.concatenate([h for h, _ in parts]), np.concatenate([b for _, b in parts])
    return _word_hashes(data)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = SPACE_BYTES[data]
    edge = np.flatnonzero(np.diff(space.astype(np.int8), prepend=1, append=1))
    begin, end = edge[::2], edge[1::2]
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data)))])
        h = (sums[end] - sums[begin]) * powers(INVERSE, len(data) + 1)[begin]
        return mix(h + (end - begin).astype(U64)), begin


def bytes_of(column) -> list[bytes]:
    """The values of a text column of Arrow, without decoding them; none for null."""
    import pyarrow as pa

    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def pieces(batches: Iterable, text: str, most: int = 1 << 20, inside: str | None = None):
    """Slices of Arrow batches whose texts have about `most` bytes together, one row at least.

    text: the texts' column; inside: the struct column that holds it, if it isn't one of its own.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(inside or text))
        lengths = pc.binary_length(column.field(text) if inside else column)
        ends = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False), dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)
    give_back()


#: Words whose ids are put together at once.
JOIN_WORDS = 1 << 18


def _lists(flat: np.ndarray, sizes: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Of lists of `sizes` that follow each other in `flat`, the k-th ones one after the other."""
    first, out = np.cumsum(sizes) - sizes, [flat[:0]]
    for a in range(0, len(k), JOIN_WORDS):
        part = k[a : a + JOIN_WORDS]
        end = np.cumsum(sizes[part])
        out.append(flat[np.repeat(first[part] - end + sizes[part], sizes[part]) + np.arange(end[-1])])
    return np.concatenate(out)


class Kept:
    """Ids (32 bits) of words, each encoded once for as long as it is kept. Words are looked up and their ids put together by
    Arrow and numpy; only words that aren't kept become Python objects.

    encode: lists of words to the bytes of their ids, or None for a word that can't be had. Beyond `most` words only those
    stay that come up again in the call; words of more than `longest` characters aren't kept.
    """

    def __init__(self, encode, most: int, longest: int):
        import pyarrow as pa

        self.encode, self.most, self.longest = encode, most, longest
        self.words, self.flat = pa.array([], pa.large_string()), np.empty(0, np.uint32)
        self.sizes, self.lacks = np.empty(0, np.int64), np.empty(0, bool)

    def ids(self, rows: list[str | None]) -> tuple[list[bytes], np.ndarray]:
        """(The ids of the words of each row, which is cut at every space; the rows with a word that can't be had).

        A null row has no word, an empty one an empty word."""
        import pyarrow as pa
        import pyarrow.compute as pc

        lists = pc.split_pattern(pa.array(rows, pa.large_string()), " ")
        words, begins = lists.flatten(), lists.offsets.to_numpy()
        at = pc.fill_null(pc.index_in(words, self.words), -1).to_numpy()
        unknown = np.flatnonzero(at < 0)
        new = words.take(pa.array(unknown)).dictionary_encode()
        new, number = new.dictionary, new.indices.to_numpy()
        if len(self.words) > self.most:
            # Words that have come up before, and do again, are the common ones.
            stay, number_of = np.unique(at, return_inverse=True)
            gone = int(len(stay) > 0 and stay[0] < 0)
            self._only(stay[gone:])
            at = number_of.reshape(-1) - gone
        at = at.astype(np.int64)
        at[unknown] = len(self.words) + number
        found = self.encode(new.to_numpy(zero_copy_only=False).tolist()) if len(new) else []
        self.words = pa.concat_arrays([self.words, new])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join([f or b"" for f in found]), np.uint32)])
        self.sizes = np.concatenate([self.sizes, np.array([len(f or b"") // 4 for f in found], np.int64)])
        self.lacks = np.concatenate([self.lacks, np.array([f is None for f in found], bool)])
        ends = np.concatenate([[0], np.cumsum(self.sizes[at])])[begins]
        raw, cuts = _lists(self.flat, self.sizes, at).tobytes(), (4 * ends).tolist()
        lacking = np.unique(np.searchsorted(begins, np.flatnonzero(self.lacks[at]), "right") - 1)
        if len(new) and pc.max(pc.utf8_length(new)).as_py() > self.longest:
            self._only(np.flatnonzero(pc.less_equal(pc.utf8_length(self.words), self.longest).to_numpy(zero_copy_only=False)))
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], lacking

    def _only(self, k: np.ndarray) -> None:
        import pyarrow as pa

        self.words, self.flat = self.words.take(pa.array(k, pa.int64())), _lists(self.flat, self.sizes, k)
        self.sizes, self.lacks = self.sizes[k], self.lacks[k]


def give_back() -> None:
    """Returns freed memory to the system, as an idle worker would keep it beside the next one's."""
    import ctypes

    import pyarrow as pa

    _powers.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def freed(spark: SparkSession) -> None:
    """Asks the driver's JVM to collect garbage, so that Spark's cleaner deletes shuffle files of steps that are over."""
    import gc

    gc.collect()
    spark._jvm.System.gc()
