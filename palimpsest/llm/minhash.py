"""Near-duplicate documents by ProbMinHash, banding and verification.

A document is its set of shingles of SHINGLE words. All have the same weight however often they occur, so the probability
Jaccard that the signatures estimate is the plain one, by which links are asked for. Each shingle is a Poisson process of its
weight's rate, whose arrivals fall on random registers; a register keeps the shingle of its first arrival. A shingle ends as soon as it
comes later than the latest register, so after the first few hundred shingles most need a single arrival. All documents of
a slice run together, arrival by arrival.

Documents of equal text are one node. Nodes that agree in all registers of a band share a bucket. A bucket's members are
first compared to its head, the member that shares its buckets with the most others; in a group of copies that is the text
they stem from. Counts and heads are aggregations, and a bucket of any size is joined to its head by a join that Spark can
split. The links are joined to components. All nodes that were compared to one head make a cluster; where a cluster still
has several components, members of different ones are compared, in blocks of at most BLOCK by BLOCK, by a product of
incidence matrices, and only links that join components leave a block. The members of a cluster's largest component aren't
compared with each other, so a large group with a few strays costs a copy of each member for BLOCK strays, not for BLOCK
members. So no link is lost between nodes that share a bucket, but for those that wouldn't change a component, and pairs are
never rows.

Pairs are dropped early if their signatures agree in less than SIGNATURE_SHARE of the registers (for similar pairs that is
over 7 standard deviations off), and verified by the exact Jaccard similarity of their shingles' 64-bit hashes.
With 40 bands of 6 registers, a pair of similarity 0.8 shares no bucket with a probability of 5e-6, one of 0.9 with 1e-13, at whatever
counts of the shingles in both.

A document of fewer words than SHINGLE has one shingle of them all. Documents without words (null, empty) are alone in
their classes. Rows that agree in id and text are one document; of rows of one id and different texts, the one of the smaller
hash counts as the earlier. The class is named by its smallest id; null ids come first. Heads of equal company tie by a hash.
A text's shingles are taken whole, whatever its length: a task holds about fifteen bytes for each of the longest one's, and
the set of its shingles for a comparison. An empty table has no classes. Other columns may have any name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, bytes_of, dropped, freed, mix, pieces, written
from .components import components
from .lines import Lines

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 40, 6
SIGNATURE_SHARE = 0.55
SLICE_BYTES = 1 << 20
#: Arrivals that are drawn at once, at most, once fewer shingles than that are left.
ARRIVALS = 1 << 18
#: Shingles that arrive together.
MOST_SHINGLES = 1 << 20
#: Nodes of a block, and shingles of a matrix product, when a cluster's components are compared.
BLOCK, COLUMNS = 512, 2048


def shingles(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, count) of each text's different shingles, in order of text and hash."""
    x = Lines(texts)
    at = np.searchsorted(x.text, np.arange(len(texts) + 1))
    begin, end = x.begin[at[:-1]], x.end[at[1:] - 1]
    n = end - begin
    number = np.where(n > 0, np.maximum(n - k + 1, 1), 0)
    text = np.repeat(np.arange(len(texts)), number)
    a = begin[text] + np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    size = np.minimum(n, k)[text]
    h = x.keyed(x.run(a, a + size), size, 3).view(U64)
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (h[1:] != h[:-1])])) if len(h) else np.empty(0, np.int64)
    return text[first], h[first], np.diff(np.concatenate([first, [len(h)]]))


def prob_min_hash(text: np.ndarray, h: np.ndarray, w: np.ndarray, texts: int, m: int) -> np.ndarray:
    """For each text, m registers with the hash of the shingle that came first; 0 for a text without shingles."""
    first = np.full(texts * m, np.inf)
    registers = np.zeros(texts * m, U64)
    # A long text's shingles go by turns: later ones meet registers that are taken, and mostly end at once.
    for begin in range(0, len(h), MOST_SHINGLES):
        _arrive(first, registers, text[begin : begin + MOST_SHINGLES], h[begin : begin + MOST_SHINGLES], w[begin : begin + MOST_SHINGLES], texts, m)
    return registers.reshape(texts, m)


def _arrive(first: np.ndarray, registers: np.ndarray, text: np.ndarray, h: np.ndarray, w: np.ndarray, texts: int, m: int) -> None:
    left, when, done = np.arange(len(h)), np.zeros(len(h)), 0
    with np.errstate(over="ignore"):
        seed = mix(h)
        while len(left):
            # Many shingles: an arrival of each. Few: several arrivals at once, as short texts need many to fill all registers.
            steps = max(1, min(64, ARRIVALS // len(left)))
            key = mix(seed[left][:, None] + np.arange(done + 1, done + steps + 1, dtype=U64) * U64(0xA0761D6478BD642F))
            waits = -np.log(((key >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) / w[left][:, None]
            times = when[:, None] + (np.cumsum(waits, 1) if steps > 1 else waits)
            at = (text[left][:, None] * m + (mix(key) % U64(m)).astype(np.int64)).reshape(-1)
            flat = times.reshape(-1)
            sooner = np.flatnonzero(flat < first[at])
            # Later arrivals first: of those on one register the earliest is written last.
            sooner = sooner[np.argsort(-flat[sooner], kind="stable")]
            first[at[sooner]] = flat[sooner]
            registers[at[sooner]] = h[left[sooner // steps]]
            done += steps
            go_on = np.flatnonzero(times[:, -1] < first.reshape(texts, m).max(1)[text[left]])
            left, when = left[go_on], times[go_on, -1]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    i, t = docs[f"`{id_col}`"].cast("long"), docs[f"`{text_col}`"]
    return docs.select(i.alias("id"), F.xxhash64(i, t).alias("row"), F.xxhash64(t).alias("t1"), F.xxhash64(F.lit(1), t).alias("t2"), t.alias("text"))


def _signed(rows: DataFrame, bands: int, size: int) -> DataFrame:
    """id, row, t1, t2, bands (their keys), signature (a byte for each register); bands are null without words."""

    def run(batches):
        import pyarrow as pa

        for part in pieces(batches, "text", SLICE_BYTES):
            texts = bytes_of(part.column(4))
            text, h, _ = shingles(texts)
            registers = prob_min_hash(text, h, np.ones(len(h)), len(texts), bands * size)
            empty = np.bincount(text, minlength=len(texts)) == 0
            key = np.zeros((len(texts), bands), U64) + np.arange(bands, dtype=U64)
            with np.errstate(over="ignore"):
                for k in range(size):
                    key = mix(key + registers[:, k::size])
            keys = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * bands, pa.int32()), pa.array(key.reshape(-1).view(np.int64)), mask=pa.array(empty))
            signature = [x.tobytes() for x in (mix(registers) & U64(255)).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([*part.columns[:4], keys, pa.array(signature, pa.binary())], ["id", "row", "t1", "t2", "bands", "signature"])

    return rows.mapInArrow(run, "id long, row long, t1 long, t2 long, bands array<long>, signature binary")


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of the pairs a < b, those whose signatures agree in SIGNATURE_SHARE of their registers."""
    side = lambda name, s: nodes.select(F.col("node").alias(name), F.col("signature").alias(s))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8) for c in ("sa", "sb"))
            if batch.num_rows:
                share = (x == y).reshape(batch.num_rows, -1).mean(1)
                yield batch.filter(pa.array(share >= SIGNATURE_SHARE)).select(["a", "b"])

    joined = pairs.join(side("a", "sa"), "a").join(side("b", "sb"), "b")
    return joined.select("sa", "sb", "a", "b").mapInArrow(run, "a long, b long")


def _similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Of the pairs, those of exact Jaccard similarity `least` or more."""
    side = lambda name, s: sets.select(F.col("node").alias(name), F.col("set").alias(s))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            fine = []
            for r in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[r].as_py(), np.int64) for c in ("xa", "xb"))
                n = len(np.intersect1d(x, y, assume_unique=True))
                fine.append(n >= least * (len(x) + len(y) - n) * (1 - 1e-12))
            yield batch.filter(pa.array(fine, pa.bool_())).select(["a", "b"])

    joined = pairs.join(side("a", "xa"), "a").join(side("b", "xb"), "b")
    return joined.select("xa", "xb", "a", "b").mapInArrow(run, "a long, b long")


def _sets(texts: DataFrame) -> DataFrame:
    """node, text: node, set (the sorted 64-bit hashes of the shingles, in bytes)."""

    def run(batches):
        import pyarrow as pa

        for part in pieces(batches, "text", SLICE_BYTES):
            text, h, _ = shingles(bytes_of(part.column(1)))
            cuts = np.searchsorted(text, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([h[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())], ["node", "set"])

    return texts.mapInArrow(run, "node long, set binary")


def _forest(nodes: list[int], component: list[int], sets: list[np.ndarray], least: float, split: int) -> list[tuple[int, int]]:
    """Links between members of different components, as few as join them; members before `split` with those from it on
    (all with all if it is 0)."""
    n = len(nodes)
    sizes = np.array([len(x) for x in sets])
    where = np.repeat(np.arange(n), sizes)
    values, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = df[column] > 1
    where, column = where[common], np.unique(column[common], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    where, column = where[order], column[order]
    width = int(column[-1]) + 1 if len(column) else 0
    overlap = np.zeros((n, n), np.float32)
    for low in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((n, COLUMNS), np.float32)
        part[where[a:b], column[a:b] - low] = 1
        overlap += part @ part.T
    similar = overlap >= least * (sizes[:, None] + sizes[None, :] - overlap) * (1 - 1e-7)
    root = {c: c for c in component}

    def top(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    links = []
    for x, y in zip(*np.nonzero(np.triu(similar, 1)), strict=True):
        if (not split or x < split <= y) and (p := top(component[x])) != (q := top(component[y])):
            # The matrix is of single precision; sizes below 2**24 are exact, and this decides.
            if (k := len(np.intersect1d(sets[x], sets[y], assume_unique=True))) >= least * (len(sets[x]) + len(sets[y]) - k) * (1 - 1e-12):
                root[p] = q
                links.append((min(nodes[x], nodes[y]), max(nodes[x], nodes[y])))
    return links


def _within(clusters: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """clusters: head, node, component, large (whether that is the cluster's largest), n_large and n_rest (nodes in it, and in
    the others). Links between the components of each cluster."""
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    block = lambda n: F.pmod(F.xxhash64("node"), blocks(n)).cast("int")
    # Blocks of the largest component have negative numbers; these meet the others' blocks only.
    mine = F.when(F.col("large"), -1 - block("n_large")).otherwise(block("n_rest"))
    pair = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    rest = F.sequence(F.lit(0), blocks("n_rest") - 1)
    with_rest = F.transform(rest, lambda x: pair(F.least(F.col("mine"), x), F.greatest(F.col("mine"), x)))
    with_large = F.transform(F.sequence(F.lit(1), blocks("n_large")), lambda x: pair(-x, F.col("mine")))
    # A copy of each member for each block that its own meets.
    rows = clusters.withColumn("mine", mine).withColumn("meet", F.explode(F.when(F.col("large"), with_rest).otherwise(F.concat(with_rest, with_large))))
    rows = rows.select("head", "meet.i", "meet.j", "mine", "node", "component").join(sets, "node")
    parts = int(clusters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "head", "i", "j").sortWithinPartitions("head", "i", "j", "mine", "node").select("head", "i", "j", "mine", "node", "component", "set")

    def run(batches):
        import pyarrow as pa

        held: list = []

        def solve():
            sides = [x[0] for x in held]
            split = next((k for k, m in enumerate(sides) if m != sides[0]), 0)
            return _forest([x[1] for x in held], [x[2] for x in held], [np.frombuffer(x[3], np.int64) for x in held], least, split)

        last, links = None, []
        for batch in batches:
            for head, i, j, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if last != (head, i, j):
                    # Two blocks of which one is empty have been compared within themselves.
                    if last and (last[1] == last[2] or held[0][0] != held[-1][0]) and len({x[2] for x in held}) > 1:
                        links += solve()
                    last, held = (head, i, j), []
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])
            links = []
        if last and (last[1] == last[2] or held[0][0] != held[-1][0]) and len({x[2] for x in held}) > 1:
            links = solve()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def near_classes(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, row, class_id (the least id of its class), first (whether the row is the one that stays of its class).

    `row` is the hash of id and text; rows that agree in both come once.
    """
    spark = docs.sparkSession
    base = _rows(docs, id_col, text_col)
    signed = written(_signed(base, bands, rows), "signed")
    nodes = signed.where("bands IS NOT NULL").groupBy("t1", "t2").agg(F.min(F.struct("id", "row")).alias("head"), F.first("bands").alias("bands"), F.first("signature").alias("signature"))
    nodes = written(nodes.select(F.monotonically_increasing_id().alias("node"), "head.id", "head.row", "t1", "t2", "bands", "signature"), "nodes")
    freed(spark)

    # Buckets of two nodes or more; each one's head is the member with the most company over all of its buckets.
    every = nodes.select("node", F.explode("bands").alias("key"))
    shared = every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = written(every.join(shared, "key"), "members")
    freed(spark)
    company = members.groupBy("node").agg(F.sum("n").alias("company"))
    heads = members.select("key", "node").join(company, "node").groupBy("key").agg(F.max(F.struct("company", F.xxhash64("node").alias("h"), "node")).alias("head")).select("key", F.col("head.node").alias("head"))
    clusters = written(members.join(heads, "key").select("head", "node").distinct(), "clusters")
    dropped(members)
    freed(spark)
    pairs = clusters.where("node <> head").select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()
    pairs = written(_likely(pairs, nodes), "pairs")

    wanted = clusters.select("node").distinct()
    owners = nodes.join(wanted, "node", "left_semi").select("node", F.col("id").alias("i"), F.col("row").alias("r"))
    texts = base.where("text IS NOT NULL").join(owners, (F.col("row") == F.col("r")) & F.col("id").eqNullSafe(F.col("i"))).select("node", "text").dropDuplicates(["node"])
    sets = written(_sets(texts), "sets")
    freed(spark)
    links = written(_similar(pairs, sets, least), "links")
    found = components(links)

    # Clusters of three nodes or more that still hold several components.
    placed = clusters.join(found, "node", "left").select("head", "node", F.coalesce("component", "node").alias("component"))
    parts = placed.groupBy("head", "component").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("head").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("all"), F.count("*").alias("parts")).where("parts > 1 AND all > 2")
    # A table of its own, so that Spark can split the join of a large cluster's nodes: beside an aggregation it can't.
    mixed = written(mixed.select("head", F.col("most.component").alias("largest"), F.col("most.n").alias("n_large"), (F.col("all") - F.col("most.n")).alias("n_rest")), "mixed")
    more = written(_within(placed.join(mixed, "head").withColumn("large", F.col("component") == F.col("largest")), sets, least), "links")
    dropped(sets)
    freed(spark)
    if not more.isEmpty():
        found = components(links.unionByName(more))

    classes = nodes.join(found, "node", "left").select("node", "id", "row", "t1", "t2", F.coalesce("component", "node").alias("component"))
    head = classes.groupBy("component").agg(F.min(F.struct("id", "row")).alias("head"))
    named = classes.join(head, "component").select("t1", "t2", "head")
    texts = signed.select("id", "row", F.when(F.col("bands").isNotNull(), F.col("t1")).alias("t1"), "t2").distinct()
    joined = texts.join(named, ["t1", "t2"], "left")
    return joined.select("id", "row", F.when(F.col("head").isNull(), F.col("id")).otherwise(F.col("head.id")).alias("class_id"), F.coalesce(F.col("head") == F.struct("id", "row"), F.lit(True)).alias("first"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of `docs` of each class: the one of the least id."""
    stay = near_classes(docs, id_col=id_col, text_col=text_col).where("first").select(F.col("id").alias("__i"), F.col("row").alias("__r"))
    i, t = docs[f"`{id_col}`"].cast("long"), docs[f"`{text_col}`"]
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("__record"), i.alias("__id"), F.xxhash64(i, t).alias("__row")).dropDuplicates(["__id", "__row"])
    kept = rows.join(stay, (F.col("__row") == F.col("__r")) & F.col("__id").eqNullSafe(F.col("__i")), "left_semi")
    return kept.select(*[F.col("__record").getField(c).alias(c) for c in docs.columns])


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return classes.select(F.col("id").alias("doc_id"), "class_id", "first")
