"""Line dedup by a join of deletion neighbourhoods.

A line is a sequence of words, and the edit distance counts words. A line goes if a line that comes earlier, in order of
document id and line number, is within EDITS = 1 of it; so of equal or nearly equal lines the earliest stays. Lines of
fewer than `min_words` words always stay; those of fewer than `near_words` words go for an equal line only. In op10 and the
pipeline (WHOLE) every line with a word takes part, and one of 5 words or more, of which an edit is a fifth at most, goes for
a near one too.

1. One map over the texts hashes all lines. Equal lines are reduced to the earliest by an aggregation with map-side combine.
2. Two lines at distance 1 share their first or last half of words. Four keys for each distinct line say that (halves of
   its own length, and of a line shorter by one); only lines that share a key go on, and only with edits in the other half.
3. These emit all variants within the bound as hashed keys: the line itself, and the line without one word, with the word's
   place. Lines with an equal variant at one place differ in that word alone; a line that equals another's variant is
   shorter by that word. So every group needs only its earliest member to decide all its lines, and pairs within a group
   are never formed: of a group a map task sends on only its earliest line, which bounds the rows of the hottest variant by
   the number of tasks.
4. Each decision's pair of lines is verified by its words.

Rows that agree in id and text count as one document and get the same result; rows of one id and different texts come in the
order of a hash of them. So no two lines tie. Null ids come first. A null text has no lines and stays null; an empty one has
one, which stays. A text is hashed whole, whatever its length: a task holds about fifteen bytes for each of the longest one's.
An empty table gives an empty result. Columns of the input that are named like the operator's own don't clash, as they stay in
one struct.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BASE, INVERSE, U64, WORD, bytes_of, crc32_text, dropped, freed, mix, pieces, powers, word_hashes, written

MIN_WORDS, NEAR_WORDS = 5, 8
#: What op10 and the pipeline take.
WHOLE = {"min_words": 1, "near_words": 5}
#: The share of its words that a document must keep: with less, it agrees with earlier ones as near-duplicates do.
LEAST_LEFT = 0.2
BASE_2 = 0x9FB21C651E98DF25
INVERSE_2 = pow(BASE_2, -1, 1 << 64)
LENGTH = U64(0xA24BAED4963EE407)


class Lines:
    """The lines of some texts with hashes of any of their runs of words."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        ends = np.flatnonzero(data == 10)
        counts = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
        self.text = np.repeat(np.arange(len(texts)), counts)
        self.number = np.arange(len(ends)) - np.repeat(np.cumsum(counts) - counts, counts)
        hashes, begin = word_hashes(data)
        self.begin = np.searchsorted(begin, np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends)
        self.end = np.searchsorted(begin, ends)
        self.words = hashes
        self.sums = self._sums(hashes, BASE)
        self.data, self.first, self.last = data, np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends, ends

    def _sums(self, w: np.ndarray, base: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.concatenate([np.zeros(1, U64), np.cumsum(w * powers(base, len(w)))])

    def run(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The hash of words a to b, wherever they stand."""
        with np.errstate(over="ignore"):
            return (self.sums[b] - self.sums[a]) * powers(INVERSE, len(self.words) + 1)[a]

    def second(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Another hash, independent of run()."""
        sums = self._sums(mix(self.words), BASE_2)
        with np.errstate(over="ignore"):
            return mix((sums[b] - sums[a]) * powers(INVERSE_2, len(self.words) + 1)[a] + (b - a).astype(U64))

    def keyed(self, h: np.ndarray, n: np.ndarray, kind: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(h + n.astype(U64) * LENGTH + U64(kind)).view(np.int64)


def _all_lines(rows: DataFrame, min_words: int, near_words: int) -> DataFrame:
    """rows: id, row, text. The lines of min_words words or more: id, row, line, h1, h2, and the keys of their halves."""

    def run(batches):
        import pyarrow as pa

        for part in pieces(batches, "text"):
            x = Lines(bytes_of(part.column(2)))
            n = x.end - x.begin
            k = np.flatnonzero(n >= min_words)
            a, b, n = x.begin[k], x.end[k], n[k]
            near = n < near_words
            half = lambda m, kind: pa.array(x.keyed(x.run(a, a + m // 2) if kind else x.run(b - (m + 1) // 2, b), m, kind), mask=near)
            of = pa.array(x.text[k])
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(of), part.column(1).take(of), pa.array(x.number[k], pa.int64()), pa.array(x.keyed(x.run(a, b), n, 2)), pa.array(x.second(a, b).view(np.int64)), half(n, 1), half(n, 0), half(n - 1, 1), half(n - 1, 0)],
                ["id", "row", "line", "h1", "h2", "p0", "s0", "p1", "s1"],
            )

    return rows.where("text IS NOT NULL").mapInArrow(run, "id long, row long, line long, h1 long, h2 long, p0 long, s0 long, p1 long, s1 long")


def _variants(rows: DataFrame) -> DataFrame:
    """rows: id, row, text, near (array of line, front, back). The variants of these lines, and the lines' texts.

    place: the deleted word's, or -1 for the line itself. Of a task's lines with an equal variant only the earliest is sent;
    the others are decided here: `early` is then the earlier line.
    """

    def run(batches):
        import pyarrow as pa

        for part in pieces(batches, "text"):
            x = Lines(bytes_of(part.column(2)))
            lists = part.column(3)
            near = lists.flatten()
            doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            begins = np.concatenate([[0], np.cumsum(np.bincount(x.text, minlength=len(lists)))])
            line = near.field("line").to_numpy()
            at = begins[doc] + line
            a, b = x.begin[at], x.end[at]
            n = b - a
            low = np.where(near.field("front").to_numpy(zero_copy_only=False), 0, (n - 1) // 2)
            high = np.where(near.field("back").to_numpy(zero_copy_only=False), n, n - n // 2)
            size = high - low
            of = np.repeat(np.arange(len(at)), size)
            place = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + low[of]
            i = a[of] + place
            with np.errstate(over="ignore"):
                less = x.run(a[of], i) + powers(BASE, int(n.max(initial=0)) + 1)[place] * x.run(i + 1, b[of])
            key = np.concatenate([x.keyed(x.run(a, b), n, 2), x.keyed(less, n[of] - 1, 2)])
            place = np.concatenate([np.full(len(at), -1), place])
            of = np.concatenate([np.arange(len(at)), of])
            ids, rows_ = part.column(0), part.column(1)
            order = np.lexsort((of, place, key))  # lines of a batch aren't in order of id: the earliest is found below
            key, place, of = key[order], place[order], of[order]
            group = np.concatenate([[True], (key[1:] != key[:-1]) | (place[1:] != place[:-1])]) if len(key) else np.empty(0, bool)
            if not group.all():
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                when = np.empty(len(at), np.int64)
                rank = np.lexsort((line, rows_.to_numpy()[doc], ids.fill_null(0).to_numpy()[doc], known[doc]))
                when[rank] = np.arange(len(at))
                order = np.lexsort((when[of], np.cumsum(group)))
                key, place, of = key[order], place[order], of[order]
            first = np.flatnonzero(group)[np.cumsum(group) - 1] if len(group) else np.empty(0, np.int64)
            later = np.flatnonzero(~group)
            d, e = doc[of], doc[of[first]]
            send = np.flatnonzero(group)
            # One decision for each line is enough.
            _, one = np.unique(of[later], return_index=True)
            for k, decided in ((send, False), (later[one], True)):
                if len(k):
                    t = pa.array(d[k])
                    early = pa.StructArray.from_arrays([ids.take(pa.array(e[k])), rows_.take(pa.array(e[k])), pa.array(line[of[first[k]]])], ["id", "row", "line"], mask=pa.array(np.full(len(k), not decided)))
                    yield pa.RecordBatch.from_arrays([pa.array(key[k]), pa.array(place[k], pa.int64()), ids.take(t), rows_.take(t), pa.array(line[of[k]]), early], ["key", "place", "id", "row", "line", "early"])

    return rows.mapInArrow(run, "key long, place long, id long, row long, line long, early struct<id: long, row: long, line: long>")


def _within_one(a: str, b: str) -> bool:
    """Whether two lines are within one edit of a word."""
    x, y = sorted((a.encode("utf-8", "surrogatepass").split(), b.encode("utf-8", "surrogatepass").split()), key=len)
    if len(y) - len(x) > 1:
        return False
    p = 0
    while p < len(x) and x[p] == y[p]:
        p += 1
    return x[p + (len(x) == len(y)) :] == y[p + 1 :]


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs: late, early (id, row, line each); texts: at (the same), line_text. Those pairs that are within one edit."""
    t = lambda name, text: texts.select(F.col("at").alias(name), F.col("line_text").alias(text))
    joined = pairs.join(t("early", "b"), "early").join(t("late", "a"), "late")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            fine = [_within_one(a, b) for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)]
            yield batch.filter(pa.array(fine, pa.bool_())).select(["late"])

    return joined.select("a", "b", "late").mapInArrow(run, "late struct<id: long, row: long, line: long>")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """record (the row of `docs`), text (without the lines that go), n_lines, n_removed."""
    spark = docs.sparkSession
    i, t = docs[f"`{id_col}`"].cast("long"), docs[f"`{text_col}`"]
    rows = docs.select(i.alias("id"), F.xxhash64(i, t).alias("row"), t.alias("text"))
    same_row = lambda x, y: (x["row"] == y["row"]) & x["id"].eqNullSafe(y["id"])
    lines = written(_all_lines(rows, min_words, near_words), "lines")

    halves = ["p0", "s0", "p1", "s1"]
    firsts = lines.groupBy("h1", "h2").agg(F.min(F.struct("id", "row", "line", *halves)).alias("first"))
    firsts = written(firsts.select(F.monotonically_increasing_id().alias("number"), "first.*"), "firsts")
    every = written(_lists(lines, "every"), "every")
    dropped(lines)
    freed(spark)

    # Lines that share a half with another line; front: with edits in the front half.
    keys = firsts.where("p0 IS NOT NULL").select("number", F.explode(F.array(*[F.struct(F.col(c).alias("key"), F.lit(c[0] == "s").alias("front")) for c in halves])).alias("k")).select("number", "k.*")
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    # Lists and keys grow with the corpus, so these joins are merges at every size.
    sides = keys.hint("merge").join(shared, "key", "left_semi").groupBy("number").agg(F.max("front").alias("front"), F.max(~F.col("front")).alias("back"))
    near = firsts.select("number", "id", "row", "line").join(sides, "number")
    near = written(near.groupBy("row", "id").agg(F.collect_list(F.struct("line", "front", "back")).alias("near")), "near")
    freed(spark)

    # Rows that agree in id and text are one here.
    chosen = rows.where("text IS NOT NULL").join(near.hint("merge"), same_row(rows, near)).select(rows["id"], rows["row"], rows["text"], near["near"])
    chosen = written(chosen, "chosen")
    dropped(near)
    freed(spark)
    at = F.struct("id", "row", "line")
    kind, key = W.partitionBy("key", "place").orderBy("id", "row", "line"), W.partitionBy("key")
    itself = F.col("place") == -1
    sent = written(_variants(chosen), "variants")
    grouped = sent.where("early IS NULL").select("key", "place", "id", "row", "line").withColumn("at", at).withColumn("same", F.first("at").over(kind)).withColumn("short", F.min(F.when(itself, F.col("at"))).over(key)).withColumn("long", F.min(F.when(~itself, F.col("at"))).over(key))
    other = F.when(F.col("same") < F.col("at"), F.col("same")).when(~itself & (F.col("short") < F.col("at")), F.col("short")).when(itself & (F.col("long") < F.col("at")), F.col("long"))
    decided = grouped.select(F.col("at").alias("late"), other.alias("early")).where("early IS NOT NULL").unionByName(sent.where("early IS NOT NULL").select(at.alias("late"), "early"))
    pairs = written(decided.groupBy("late").agg(F.min("early").alias("early")), "pairs")
    dropped(sent)
    freed(spark)
    # Only the texts of lines in a pair move.
    asked = pairs.select(F.col("late").alias("at")).unionByName(pairs.select(F.col("early").alias("at"))).distinct()
    texts = chosen.select("id", "row", F.split("text", "\n").alias("all"), "near").select("id", "row", F.explode(F.transform("near", lambda x: F.struct(x["line"].alias("line"), F.get("all", x["line"].cast("int")).alias("line_text")))).alias("x"))
    texts = texts.select(F.struct("id", "row", "x.line").alias("at"), "x.line_text").hint("merge").join(asked, "at", "left_semi").dropDuplicates(["at"])
    gone = written(_verified(pairs, texts).select("late.*"), "gone")
    dropped(chosen, pairs)
    freed(spark)

    kept = firsts.select("id", "row", "line").join(gone, (firsts["row"] == gone["row"]) & firsts["id"].eqNullSafe(gone["id"]) & (firsts["line"] == gone["line"]), "left_anti")
    stay = _lists(kept, "stay")
    lists = every.join(stay, same_row(every, stay), "left").select(every["id"], every["row"], F.array_except("every", F.coalesce("stay", F.array().cast("array<int>"))).alias("drop")).where(F.size("drop") > 0)
    lists = written(lists, "lists")
    dropped(firsts, gone, every)
    freed(spark)
    records = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record"), i.alias("id"), F.xxhash64(i, t).alias("row"))
    text = F.col("record").getField(text_col)
    joined = records.join(lists.hint("merge"), same_row(records, lists), "left").select("record", "drop", F.split(text, "\n").alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    return joined.select(
        "record",
        F.when(F.col("drop").isNull(), text).otherwise(F.array_join(F.transform(left, lambda i: F.get(F.col("lines"), i)), "\n")).alias("text"),
        F.when(text.isNull(), F.lit(0)).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_removed"),
    )


def alone(text: bytes, min_words: int, near_words: int) -> int:
    """The words that a text keeps if it is the only document, by hashes of its lines and their variants."""
    x = Lines([text])
    n = x.end - x.begin
    k = np.flatnonzero(n >= min_words)
    a, b, n = x.begin[k], x.end[k], n[k]
    line = np.arange(len(k))
    near = np.flatnonzero(n >= near_words)
    of = np.repeat(near, n[near])
    place = np.arange(len(of)) - np.repeat(np.cumsum(n[near]) - n[near], n[near])
    i = a[of] + place
    with np.errstate(over="ignore"):
        less = x.run(a[of], i) + powers(BASE, int(n.max(initial=0)) + 1)[place] * x.run(i + 1, b[of])
    whole, less = x.keyed(x.run(a, b), n, 2), x.keyed(less, n[of] - 1, 2)
    place, at = np.concatenate([np.full(len(k), -1), place]), np.concatenate([line, of])
    value, key = np.unique(np.concatenate([whole, less]), return_inverse=True)
    gone = np.zeros(len(k), bool)
    # Equal lines, and lines that differ in the word at one place: all but the first of each group.
    order = np.lexsort((at, place, key))
    later = (key[order][1:] == key[order][:-1]) & (place[order][1:] == place[order][:-1])
    gone[at[order][1:][later]] = True
    # Lines that another's variant equals, of lines that take part in both.
    first = np.full((2, len(value)), len(k))
    longs, shorts = np.arange(len(k), len(key)), near
    np.minimum.at(first[0], key[shorts], shorts)
    np.minimum.at(first[1], key[longs], at[longs])
    gone[at[longs][first[0][key[longs]] < at[longs]]] = True
    gone[shorts[first[1][key[shorts]] < shorts]] = True
    return int((x.end - x.begin)[np.setdiff1d(np.arange(len(x.end)), k)].sum() + n[~gone].sum())


def drop_repeats(docs: DataFrame, least_left: float = LEAST_LEFT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` with the repeated lines gone from their texts (WHOLE), in the same columns.

    A document that keeps less than least_left of the words that it would keep alone goes altogether: it is a copy of what
    came earlier, and its remains would no longer be known as one. Lines that repeat within it alone don't count for that.
    Documents without a word stay.
    """
    rows = dedup_lines(docs, id_col, text_col, **WHOLE)
    words = lambda t: F.coalesce(F.regexp_count(t, F.lit(WORD)), F.lit(0))
    old = F.col("record").getField(text_col)
    rows = rows.select("record", "text", words(F.col("text")).cast("long").alias("left"), F.when((F.col("n_removed") > 0) & (words(F.col("text")) < least_left * words(old)), old).alias("old"))

    def judge(batches):
        import pyarrow as pa

        for part in pieces(batches, "old"):
            texts, left = part.column(3), part.column(2).to_pylist()
            stay = [not known or n >= least_left * alone(t, **WHOLE) for known, t, n in zip(texts.is_valid().to_pylist(), bytes_of(texts), left, strict=True)]
            yield part.filter(pa.array(stay, pa.bool_())).select(["record", "text"])

    kept = rows.mapInArrow(judge, f"record {docs.schema.simpleString()}, text string")
    return kept.select(*[(F.col("text") if c == text_col else F.col("record").getField(c)).alias(c) for c in docs.columns])


def _lists(df: DataFrame, name: str) -> DataFrame:
    """The line numbers of each row."""
    return df.groupBy("row", "id").agg(F.collect_set(F.col("line").cast("int")).alias(name))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"), **WHOLE)
    return rows.select("record.doc_id", "n_lines", "n_removed", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes_kept"), crc32_text(F.col("text")).alias("kept_crc32"))
