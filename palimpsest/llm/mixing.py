"""Mixing sources to target weights by a min-cost flow.

Documents may belong to several sources. All documents of one set of sources form a membership pattern, and only the
patterns' word counts come to the driver: a row for each of the MAX_PATTERNS largest, and for each source. Documents of a set that is none of these
count for the first of their sources alone, so that no document is left out, however many sets there are; the flow is then
the cheapest of those in which they do. Words flow from patterns to the sources' quotas; each further repetition of a pattern
costs more than the one before, so documents are repeated only where a quota can't be met otherwise.

Then each pattern's flow is dealt to its documents: whole repetitions go to all of them, and the rest to those that come first
by a seeded hash. Where that order is cut is found by aggregation: words are summed by LEVEL_BITS bits of the hash, the part
in which the rest ends is summed by its next bits, and so on, so no group is ever collected or sorted, however large a source
is. At the cut a pattern leaves less than one document's words open; up to EXTRAS of the next documents in that order that
still fit are taken too, and one taken there may be exchanged for a larger one. The driver gets a row for each pattern.

The hash takes id, size and text, so reruns agree, whatever the partitioning. Rows that agree in all of these are told apart
by their place in the input, so that a cut may fall among them.

Nulls: a null source is a source of its own, after all others; a null or empty text has no words and is not taken; null ids
are ids. An array of sources that is empty or null belongs to the null source. Ties in the order are equal rows alone. A text
of any length counts whole; one that is longer than what is left to take is passed over. An empty table gives an empty
result. The input's columns may have any name.
"""

from __future__ import annotations

import bisect
import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, written

WEIGHTS = (5, 2, 1)
SHARE, MAX_COPIES = 1.5, 2
#: A row for each pattern is broadcast; MAX_PATTERNS and EXTRAS bound these to some MB.
MAX_PATTERNS, EXTRAS = 20_000, 8
#: Hash bits that are summed at a level (a divisor of 64; a task that finds a pattern's cut reads a row for each of their
#: values), and documents behind a cut that are looked at for the extras.
LEVEL_BITS, LAST_DOCS = 8, 256


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MAX_COPIES, total: int | None = None) -> dict:
    """share * total dealt by the weights, in the order of `sizes`; none above `most` times its size, the excess dealt again."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    left = share * (sum(sizes.values()) if total is None else total)
    out, open_ = {}, list(sizes)
    while open_:
        whole = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / whole > most * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / whole for s in open_}
        for s in full:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in out]
    return out


def min_cost_flow(supplies: dict, quotas: dict, copies: int = MAX_COPIES) -> dict:
    """Words from patterns (tuples of sources) to sources, by successive shortest paths: {(pattern, source): words}.

    The first copy of a pattern's words costs 1 a word, the second 3, and so on (convex); no quota is exceeded, and the
    flow is the largest of those of least cost.
    """
    names = ["from", *[("p", p) for p in supplies], *[("s", s) for s in quotas], "to"]
    at = {x: i for i, x in enumerate(names)}
    arcs: list[list] = []  # to, left, cost; an arc's reverse is its number ^ 1
    out: list[list[int]] = [[] for _ in names]

    def arc(a, b, most: int, cost: int) -> int:
        for x, y, c, w in ((a, b, most, cost), (b, a, 0, -cost)):
            out[at[x]].append(len(arcs))
            arcs.append([at[y], c, w])
        return len(arcs) - 2

    links = {}
    for p, words in supplies.items():
        for k in range(copies):
            arc("from", ("p", p), words, 2 * k + 1)
        for s in p:
            links[p, s] = arc(("p", p), ("s", s), copies * words, 0)
    for s, q in quotas.items():
        arc(("s", s), "to", int(q), 0)
    height = [0] * len(names)
    while True:
        dist, via = [float("inf")] * len(names), [-1] * len(names)
        dist[0], heap = 0, [(0, 0)]
        while heap:
            d, x = heapq.heappop(heap)
            if d > dist[x]:
                continue
            for k in out[x]:
                y, left, cost = arcs[k]
                if left > 0 and (new := d + cost + height[x] - height[y]) < dist[y]:
                    dist[y], via[y] = new, k
                    heapq.heappush(heap, (new, y))
        end = len(names) - 1
        if via[end] < 0:
            return {key: arcs[k ^ 1][1] for key, k in links.items() if arcs[k ^ 1][1]}
        height = [h + d if d < float("inf") else h for h, d in zip(height, dist, strict=True)]
        path, x = [], end
        while x:
            path.append(via[x])
            x = arcs[via[x] ^ 1][0]
        push = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= push
            arcs[k ^ 1][1] += push


@dataclass
class Mix:
    """What copies() needs: a row for each pattern, and the patterns by their names."""

    patterns: DataFrame
    sources: dict

    def copies(self, rows: DataFrame) -> DataFrame:
        """rows with __members, __pattern, __size, __hash and __tie: adds __copies and the pattern's columns. Rows without
        words aren't taken."""
        joined = _assigned(rows, self.patterns)
        key = F.struct(F.col("__hash").alias("hash"), F.col("__tie").alias("tie"))
        more = ((key < F.col("__cut")) & ~F.array_contains("__without", key)) | F.array_contains("__extras", key)
        copies = F.coalesce("__epochs", F.lit(0)) + F.coalesce(more, F.lit(False)).cast("int")
        return joined.withColumn("__copies", F.when(F.col("__size") > 0, copies).otherwise(0).cast("int"))


def _name(members: Column) -> Column:
    return F.to_json(F.struct(members.alias("m")), {"ignoreNullFields": "false"})


def _assigned(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """rows with their pattern's columns; those of a set that is no pattern, by their first source."""
    names = F.broadcast(patterns.select(F.col("__pattern").alias("__known"), F.struct(*patterns.columns).alias("__own")))
    single = F.broadcast(patterns.select(F.col("__pattern").alias("__alone"), F.struct(*patterns.columns).alias("__first")))
    joined = rows.join(names, F.col("__pattern") == F.col("__known"), "left").join(single, _name(F.slice("__members", 1, 1)) == F.col("__alone"), "left")
    return joined.withColumn("__of", F.coalesce("__own", "__first")).select(*[rows[f"`{c}`"] for c in rows.columns if c != "__pattern"], "__of.*")


def _keyed(docs: DataFrame, seed: int, source_col: str, id_col: str, text_col: str) -> list[Column]:
    """__members, __pattern, __size, __hash, __tie."""
    source, text = docs[f"`{source_col}`"], docs[f"`{text_col}`"]
    if isinstance(docs.schema[source_col].dataType, T.ArrayType):
        members = F.array_distinct(F.when(F.size(source) > 0, source.cast("array<string>")).otherwise(F.array(F.lit(None).cast("string"))))
        # By code point, null last.
        members = F.concat(F.sort_array(F.filter(members, lambda x: x.isNotNull())), F.filter(members, lambda x: x.isNull()))
    else:
        members = F.array(source.cast("string"))
    size = words_in(text)
    hashed = F.xxhash64(F.lit(seed), docs[f"`{id_col}`"], size, text)
    tie = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
    return [members.alias("__members"), _name(members).alias("__pattern"), size.alias("__size"), hashed.alias("__hash"), tie.alias("__tie")]


LOWEST = -(1 << 63)
_CUT = "struct<hash: bigint, tie: bigint>"


def _cuts(sized: DataFrame, rest: dict, count: dict) -> DataFrame:
    """sized: __pattern, __size, __hash, __tie; rest: words to take by pattern, more than 0 and less than all; count: documents.

    __pattern, __cut (what comes before is taken), __extras (what is taken besides) and __without (what is left out of it).
    The cut is found bits by bits, of the hash first and then of the tie; a level's sums are one row for each pattern and
    value of LEVEL_BITS bits.
    """
    spark = sized.sparkSession
    found = spark.createDataFrame([(p, n, 0, 0) for p, n in rest.items()], "__pattern string, rest long, high long, low long")
    rows = sized.where("__size > 0")
    # As unsigned numbers, so that their order is that of their bits from the left.
    unsigned = lambda c: F.col(c).bitwiseXOR(F.lit(LOWEST))
    bits = lambda c, shift: F.shiftrightunsigned(unsigned(c), shift).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1))
    for column, name, shift in [(c, n, s) for c, n in (("__hash", "high"), ("__tie", "low")) for s in range(64 - LEVEL_BITS, -1, -LEVEL_BITS)]:
        upper = shift + LEVEL_BITS
        # The same bits as the cut so far.
        inside = F.lit(True) if upper == 64 else F.shiftrightunsigned(unsigned(column), upper) == F.shiftrightunsigned(name, upper)
        if name == "low":
            inside = inside & (unsigned("__hash") == F.col("high"))
        sums = rows.join(F.broadcast(found), "__pattern").where(inside).groupBy("__pattern", "rest", "high", "low", bits(column, shift).alias("bin")).agg(F.sum("__size").alias("size"), F.count("*").alias("n"))
        before = F.sum("size").over(W.partitionBy("__pattern").orderBy("bin")) - F.col("size")
        # The part in which the rest ends: the last that begins within it.
        ends = sums.withColumn("before", before).where("before <= rest").groupBy("__pattern", "high", "low").agg(F.max_by(F.struct("bin", "n", (F.col("rest") - F.col("before")).alias("rest")), "bin").alias("end"))
        new = F.col(name).bitwiseOR(F.shiftleft(F.col("end.bin"), shift))
        # A row for each pattern.
        cut = ends.select("__pattern", F.col("end.rest").alias("rest"), *[new.alias(c) if c == name else F.col(c) for c in ("high", "low")], "end.n").collect()
        found = spark.createDataFrame([tuple(r)[:4] for r in cut], found.schema)
        # That part doesn't fit as a whole, so a single document in it doesn't.
        if all(r.n == 1 for r in cut):
            break
    return _filled(rows, {r["__pattern"]: (r.high ^ LOWEST, r.low ^ LOWEST, r.rest, count[r["__pattern"]]) for r in cut})


def _fill(rest: int, taken: list, left: list) -> tuple[list, list]:
    """(keys to add, keys to leave out): of what is left the largest that fit, EXTRAS at most, and then the exchange of one
    document for a larger one that uses the most of the rest. taken, left: (size, key)."""
    add, out = [], []
    for size, key in sorted(left, key=lambda x: (-x[0], x[1])):
        if size <= rest and len(add) < EXTRAS:
            add.append(key)
            rest -= size
    best = 0
    have = sorted(taken)
    for size, key in sorted(x for x in left if x[1] not in add):
        # The smallest that may go for it.
        k = bisect.bisect_left(have, (size - rest,))
        if k < len(have) and size - have[k][0] > best:
            best, swap = size - have[k][0], (key, have[k][1])
    if best:
        add.append(swap[0])
        out.append(swap[1])
    return add, out


def _filled(rows: DataFrame, cuts: dict) -> DataFrame:
    """cuts: hash, tie, words left and documents by pattern. __pattern, __cut, __extras and __without."""
    spark = rows.sparkSession
    # About LAST_DOCS documents on either side, as hashes are spread evenly; more where rows are equal.
    far = {p: (LAST_DOCS << 64) // n for p, (_, _, _, n) in cuts.items()}
    near = [(p, h, t, rest, max(LOWEST, h - far[p]), min(-LOWEST - 1, h + far[p])) for p, (h, t, rest, _) in cuts.items()]
    cut = spark.createDataFrame(near, "__pattern string, cut_hash long, cut_tie long, rest long, least long, most long")
    key = F.struct(F.col("__hash").alias("hash"), F.col("__tie").alias("tie"))
    around = rows.join(F.broadcast(cut), "__pattern").where(F.col("__hash").between(F.col("least"), F.col("most"))).withColumn("key", key).withColumn("taken", key < F.struct(F.col("cut_hash").alias("hash"), F.col("cut_tie").alias("tie")))
    # Of each pattern a task sends on its LAST_DOCS first on either side only, by the window's limit of groups.
    kept = [around.where(F.col("taken") if side else ~F.col("taken")).withColumn("n", F.row_number().over(W.partitionBy("__pattern").orderBy(F.desc("key") if side else F.asc("key")))).where(F.col("n") <= LAST_DOCS) for side in (True, False)]
    listed = kept[0].unionByName(kept[1]).groupBy("__pattern", "cut_hash", "cut_tie", "rest").agg(F.collect_list(F.struct("taken", "__size", "__hash", "__tie")).alias("docs"))

    def fill(batches):
        import pyarrow as pa

        kind = pa.struct([("hash", pa.int64()), ("tie", pa.int64())])
        for batch in batches:
            out = []
            for p, h, t, rest, docs in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                sides = [[(d["__size"], (d["__hash"], d["__tie"])) for d in docs if d["taken"] == side] for side in (True, False)]
                pair = lambda keys: [{"hash": a, "tie": b} for a, b in keys]
                add, without = _fill(rest, *sides)
                out.append((p, {"hash": h, "tie": t}, pair(add), pair(without)))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], kind), pa.array(columns[2], pa.list_(kind)), pa.array(columns[3], pa.list_(kind))], ["__pattern", "__cut", "__extras", "__without"])

    return listed.mapInArrow(fill, f"__pattern string, __cut {_CUT}, __extras array<{_CUT}>, __without array<{_CUT}>")


def plan_mix(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MAX_COPIES) -> Mix:
    """sized: __members, __pattern, __size, __hash, __tie; read a few times, so a written table."""
    spark = sized.sparkSession
    sums = [F.sum("__size").alias("size"), F.first("__members").alias("members"), F.count("*").alias("n")]
    patterns = sized.groupBy("__pattern").agg(*sums)
    found = patterns.orderBy(F.desc("size"), "__pattern").limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        # The largest, and each source by itself for all others.
        known = spark.createDataFrame([(r["__pattern"],) for r in found[:MAX_PATTERNS]], "__pattern string")
        other = patterns.join(F.broadcast(known), "__pattern", "left_anti").withColumn("__members", F.slice("members", 1, 1))
        others = other.withColumn("__pattern", _name(F.col("__members"))).groupBy("__pattern").agg(F.sum("size").alias("size"), F.first("__members").alias("members"), F.sum("n").alias("n")).collect()
        joined = {r["__pattern"]: r.asDict() for r in found[:MAX_PATTERNS]}
        for r in others:
            have = joined.setdefault(r["__pattern"], r.asDict() | {"size": 0, "n": 0})
            have["size"], have["n"] = have["size"] + r["size"], have["n"] + r["n"]
        found = [joined[p] for p in sorted(joined)]
    else:
        found = [r.asDict() for r in sorted(found, key=lambda r: r["__pattern"])]
    sizes: dict = {}
    for r in found:
        for s in r["members"]:
            sizes[s] = sizes.get(s, 0) + r["size"]
    sizes = {s: sizes[s] for s in sorted(sizes, key=lambda s: (s is None, s or ""))}
    target = targets(sizes, weights, share, most, total=sum(r["size"] for r in found))
    flow = min_cost_flow({tuple(r["members"]): r["size"] for r in found if r["size"]}, {s: round(t) for s, t in target.items()}, most)
    taken: dict = {}
    for (p, _), words in flow.items():
        taken[p] = taken.get(p, 0) + words

    plan, rest = [], {}
    for r in found:
        epochs, left = divmod(taken.get(tuple(r["members"]), 0), r["size"]) if r["size"] else (0, 0)
        if left:
            rest[r["__pattern"]] = left
        one = r["members"][0] if len(r["members"]) == 1 else ...
        plan.append((r["__pattern"], int(epochs), sizes.get(one) if one is not ... else None, float(target[one]) if one is not ... else None))
    rows = spark.createDataFrame(plan, "__pattern string, __epochs int, __source_size long, __target double")
    if rest:
        cuts = _cuts(_assigned(sized, rows).select("__pattern", "__size", "__hash", "__tie"), rest, {r["__pattern"]: r["n"] for r in found})
        rows = rows.join(F.broadcast(cuts), "__pattern", "left")
    else:
        rows = rows.select("*", F.lit(None).cast(_CUT).alias("__cut"), *[F.lit(None).cast(f"array<{_CUT}>").alias(c) for c in ("__extras", "__without")])
    return Mix(written(rows, "plan"), {s: (sizes[s], target[s]) for s in sizes})


def sized_table(docs: DataFrame, seed: int, source_col: str, id_col: str, text_col: str) -> DataFrame:
    return written(docs.select(docs[f"`{id_col}`"].alias("doc_id"), *_keyed(docs, seed, source_col, id_col, text_col)), "mix")


def mix(docs: DataFrame, seed: int = 7, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MAX_COPIES, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, with the columns of `docs`.

    docs is read twice, in the same order: a scan of files. Should the order of equal rows differ, the cut among them takes
    about as many of them, instead of exactly as many.
    """
    plan = plan_mix(sized_table(docs, seed, source_col, id_col, text_col), weights, share, most)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("__record"), *_keyed(docs, seed, source_col, id_col, text_col))
    taken = plan.copies(rows).where(F.col("__copies") > 0)
    return taken.select("__record", F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__copy")).select(*[F.col("__record").getField(c).alias(c) for c in docs.columns])


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = sized_table(spark.read.parquet(f"{sf_dir}/documents.parquet"), 7, "source", "doc_id", "text")
    return plan_mix(sized).copies(sized).select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__size") * F.col("__copies")).alias("taken"),
        F.col("__copies").alias("copies"),
    )
