"""Exact top-k search by inner product with vector-approximation files.

1. Each component is quantised into one of CELLS cells of its dimension, within a block of BLOCK_ROWS vectors. A map over the
   table writes files of blocks into the shared folder: first the cells of a block, two to a byte, with its ids, and behind
   them its exact vectors. A listing with a row for each block is a table beside them. Nothing is shuffled for that.
2. The queries are dealt to tasks, QUERY_ROWS at most to a search. A search scans the cells of one block after the other. They
   bound each candidate's score from both sides. Only candidates whose upper bound reaches a query's k-th best score so far
   have their exact vectors read, in the order of these bounds, until the k-th result is certain.

A task holds its queries, their k best so far and one block, whatever the size of the table; queries are the one thing
shuffled, and no block is ever paired with another in an exchange. Files go under a name of the task's attempt, and the
listing names those of attempts that were finished, so retried tasks and lost executors leave one whole set.

Vectors that are null, or hold a null or a non-finite component, take no part; neither do rows without an id, or vectors
of another length than the query's. Ties go to the smaller id. Rows are told apart by their number: a query's own row is
never a candidate, but rows that repeat its id or vector are, and repeated query rows have k results each. Fewer than k
candidates give fewer results; an empty table gives none. There are no texts. Other columns may have any name.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fs_of, scratch, written

BLOCK_ROWS, QUERY_ROWS, CELLS, STEP = 4096, 2048, 16, 64
#: Bytes between two wanted vectors that are read rather than skipped.
GAP = 1 << 13
LISTING = "path string, at long, n long, d long"


def approximate(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cells, least value of cell 0, cells' width) of integer vectors, by dimension. Cells are equal parts of its range."""
    low, high = x.min(0), x.max(0)
    width = np.maximum(1, -(-(high - low + 1) // CELLS))
    return ((x - low) // width).astype(np.uint8), low, width


class Block:
    """A block in its file: low, width, ids, rows, cells (two to a byte), exact vectors; all but cells of 8 bytes."""

    @staticmethod
    def packed(ids: np.ndarray, rows: np.ndarray, x: np.ndarray) -> bytes:
        cells, low, width = approximate(x)
        if cells.shape[1] % 2:
            cells = np.pad(cells, ((0, 0), (0, 1)))
        return b"".join(a.tobytes() for a in (low.astype("<i8"), width.astype("<i8"), ids.astype("<i8"), rows.astype("<i8"), cells[:, ::2] | cells[:, 1::2] << 4, x.astype("<i8")))

    def __init__(self, source, at: int, n: int, d: int):
        """Reads the cells; source: pyarrow's random-access file."""
        self.source, self.n, self.d = source, n, d
        half = (d + 1) // 2
        head = 16 * (d + n)
        data = source.read_at(head + n * half, at)
        self.exact = at + head + n * half
        self.low, self.width, self.ids, self.rows = (np.frombuffer(data, "<i8", size, 8 * a) for size, a in ((d, 0), (d, d), (n, 2 * d), (n, 2 * d + n)))
        both = np.frombuffer(data, np.uint8, n * half, head).reshape(n, half)
        self.cells = np.stack([both & 15, both >> 4], 2).reshape(n, 2 * half)[:, :d]

    def vectors(self, which: np.ndarray) -> np.ndarray:
        """Exact vectors of some candidates, in ascending order: neighbours in one read."""
        size = 8 * self.d
        if not self.d:
            return np.zeros((len(which), 0), np.int64)
        cuts = np.flatnonzero(np.diff(which) * size > GAP + size) + 1
        out = []
        for part in np.split(which, cuts):
            first, last = int(part[0]), int(part[-1])
            data = self.source.read_at((last - first + 1) * size, self.exact + first * size)
            out.append(np.frombuffer(data, "<i8").reshape(-1, self.d)[part - first])
        return np.concatenate(out)


class Search:
    """The k best candidates of some queries of one length, block by block."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.rows, self.q, self.k = ids, rows, q, k
        #: Results so far, best first; unused places have the lowest score.
        self.score = np.full((len(q), k), np.iinfo(np.int64).min)
        self.found = np.full((len(q), k), np.iinfo(np.int64).max)
        self.number = np.zeros(len(q), np.int64)
        self.up, self.down = np.maximum(q, 0), np.minimum(q, 0)
        self.read = 0

    def scan(self, b: Block) -> None:
        q, n = self.q, b.n
        # q . low(cell): a product with the cells alone. Exact in float32 or float64 while the sums stay in their integers.
        scaled = q * b.width
        most = int(np.abs(scaled).sum(1).max(initial=0)) * (CELLS - 1)
        kind = np.float32 if most < 1 << 24 else np.float64
        product = scaled.astype(kind) @ b.cells.T.astype(kind)
        slack = 0.0 if most < 1 << 53 else most * 2.0**-40
        # What a whole cell adds at most, and takes away at most, is the same for all candidates.
        base = (q @ b.low).astype(np.float64)
        above, below = base + self.up @ (b.width - 1) + slack, base + self.down @ (b.width - 1) - slack
        own = np.isin(b.rows, self.rows)
        if own.any():
            for c in np.flatnonzero(own):
                product[self.rows == b.rows[c], c] = -np.inf
        worst = self.score[:, -1].astype(np.float64)
        new = np.flatnonzero(self.number < self.k)
        if len(new) and n > self.k:
            # No k results yet: the block's own k-th best lower bound is a bound too.
            worst[new] = np.maximum(worst[new], np.partition(product[new], n - self.k, 1)[:, n - self.k] + below[new])
        # Rounded down where the product's kind is the coarser one.
        of, c = np.nonzero(product >= np.nextafter((worst - above).astype(kind), -np.inf)[:, None])
        bound = product[of, c] + above[of]
        fine = np.isfinite(bound)
        of, c, bound = of[fine], c[fine], bound[fine]
        order = np.lexsort((-bound, of))
        of, c, bound = of[order], c[order], bound[order]
        place = np.arange(len(of)) - np.searchsorted(of, of)
        for a in range(0, int(place.max(initial=-1)) + 1, STEP):
            near = (place >= a) & (place < a + STEP) & ((self.number[of] < self.k) | (bound >= self.score[of, -1]))
            if not near.any():
                break
            self._exact(b, of[near], c[near])

    def _exact(self, b: Block, of: np.ndarray, c: np.ndarray) -> None:
        """Reads the vectors of some pairs and keeps the best."""
        which, at = np.unique(c, return_inverse=True)
        x = b.vectors(which)
        self.read += len(which)
        score = np.empty(len(of), np.int64)
        for i in range(0, len(of), 1 << 16):
            score[i : i + (1 << 16)] = np.einsum("ij,ij->i", self.q[of[i : i + (1 << 16)]], x[at[i : i + (1 << 16)]])
        touched = np.unique(of)
        k = self.k
        all_of = np.concatenate([np.repeat(touched, k), of])
        all_score, all_found = np.concatenate([self.score[touched].reshape(-1), score]), np.concatenate([self.found[touched].reshape(-1), b.ids[c]])
        unused = np.concatenate([(np.arange(k) >= self.number[touched][:, None]).reshape(-1), np.zeros(len(of), bool)])
        order = np.lexsort((all_found, ~all_score, unused, all_of))
        all_of, all_score, all_found = all_of[order], all_score[order], all_found[order]
        first = np.searchsorted(all_of, touched)
        pick = first[:, None] + np.arange(k)
        self.score[touched], self.found[touched] = all_score[pick], all_found[pick]
        self.number[touched] = np.minimum(k, self.number[touched] + np.bincount(of, minlength=len(self.q))[touched])

    def results(self):
        """(query, rank, candidate, score) by number and id."""
        of, rank = np.nonzero(np.arange(self.k) < self.number[:, None])
        return self.ids[of], rank + 1, self.found[of, rank], self.score[of, rank]


def _arrays(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """id, row, length and the joined components of an Arrow batch of vectors."""
    v = batch.column(2)
    return batch.column(0).to_numpy(), batch.column(1).to_numpy(), np.diff(v.offsets.to_numpy()), v.flatten().to_numpy()


def _groups(batches, most: int):
    """(ids, rows, matrix) of up to `most` vectors of one length, as they come."""
    held: dict[int, list] = {}
    for batch in batches:
        ids, rows, length, values = _arrays(batch)
        begin = np.cumsum(length) - length
        for d in np.unique(length).tolist():
            at = np.flatnonzero(length == d)
            part = (ids[at], rows[at], values[begin[at][:, None] + np.arange(d)])
            have = held.get(d)
            part = tuple(np.concatenate(x) for x in zip(have, part, strict=True)) if have else part
            while len(part[0]) >= most:
                yield tuple(x[:most] for x in part)
                part = tuple(x[most:] for x in part)
            held[d] = part
    yield from (x for x in held.values() if len(x[0]))


def approximation_file(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vectors: id, row, v array<long>. Writes the file of blocks and returns its listing, a written table."""
    out = scratch(vectors.sparkSession, "cells")

    def write(batches):
        import pyarrow as pa

        fs, folder = fs_of(out)
        fs.create_dir(folder, recursive=True)
        name, at, listed, stream = uuid.uuid4().hex, 0, [], None
        for ids, rows, x in _groups(batches, block_rows):
            stream = stream or fs.open_output_stream(f"{folder}/{name}")
            data = Block.packed(ids, rows, x)
            stream.write(data)
            listed.append((f"{out}/{name}", at, *x.shape))
            at += len(data)
        if listed:
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*listed, strict=True)], ["path", "at", "n", "d"])

    return written(vectors.select("id", "row", "v").mapInArrow(write, LISTING), "blocks")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """vectors, queries: id, row (a number of its own, equal where a query is a candidate's row), v array<long>, in which
    nothing is null. Returns query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    blocks = approximation_file(vectors, block_rows)
    listing = blocks.inputFiles()
    folder = listing[0].rpartition("/")[0] if listing else None
    # Enough tasks for all cores, and no more queries in one than a few searches take.
    asked = queries.count()
    parts = max(1, min(-(-asked // 16), 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-asked // (4 * query_rows)))

    def run(batches):
        import pyarrow as pa
        import pyarrow.dataset as ds

        if folder is None:
            return
        fs, name = fs_of(folder)
        for ids, rows, q in _groups(batches, query_rows):
            search, path, source = Search(ids, rows, q, k), None, None
            # The listing too is read as a stream.
            for part in ds.dataset(name, format="parquet", filesystem=fs).to_batches():
                for p, at, n, d in zip(*[part.column(c).to_pylist() for c in ("path", "at", "n", "d")], strict=True):
                    if d != q.shape[1]:
                        continue
                    if p != path:
                        if source:
                            source.close()
                        path, source = p, fs_of(p)[0].open_input_file(fs_of(p)[1])
                    search.scan(Block(source, at, n, d))
            if source:
                source.close()
            query, rank, found, score = search.results()
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(rank, pa.int32()), pa.array(found, pa.int64()), pa.array(score, pa.int64())], ["query_id", "rank", "vec_id", "score"])

    return queries.select("id", "row", "v").repartition(parts, "row").mapInArrow(run, "query_id long, rank int, vec_id long, score long")


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """id, row, v: floor(scale * x) of each component, as a written table; rows that can't take part are left out."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(table[f"`{id_col}`"].cast("long").alias("id"), table[f"`{vector_col}`"].cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & fine)
    return written(rows.select("id", F.monotonically_increasing_id().alias("row"), F.transform(v, lambda x: F.floor(x * F.lit(float(scale)))).alias("v")), "vectors")


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, vectors.where("id % 20 = 0"))


OP6_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.r <> c.r
  WHERE q.vec_id % 20 = 0),
t AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM t WHERE rank <= 20
"""
