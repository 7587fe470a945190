"""Removal of long repeated passages by blockwise suffix sorting with a difference cover.

A byte goes if a string of LENGTH bytes that covers it starts at another place too, in any document or its own.

The corpus's suffixes are dealt to buckets by content: of the hashes of all GRAM bytes in a LENGTH-byte window the least,
its anchor, is the same wherever that window's string stands, and so are the bytes around the anchor that all windows on
one side of it have in common; their hash is the bucket. Neighbouring windows mostly have one anchor, so a run of them is
one entry. Only buckets with two entries or more are sorted, and only their bytes are moved; strings that are equal over a
whole run are found by their hashes, so a passage that thousands of documents share costs a task one copy of it.

A bucket of more than HOT entries is dealt anew: its runs are cut into pieces of FINE windows, by their distance to the
anchor, and what a piece's windows have in common, all but FINE - 1 of their LENGTH bytes, names its bucket. So strings
that many documents share, but too short to go, don't bring their surroundings together in one task. Where even such a bucket
has more than HOT entries, as many documents share nearly LENGTH bytes, its windows are counted by two hashes instead, an
aggregation with map-side combine, so that no task holds the bucket.

Buckets are sorted a bounded number of bytes at a time (UNIT_BYTES), depth-limited to LENGTH: suffixes are split by their
first COVER bytes, and longer ties are resolved by the ranks of the suffixes at a difference cover modulo COVER, which are
computed ahead by doubling: for any two suffixes there is a distance below COVER at which both are in the cover. Equal
neighbours in that order are repeats; no pair of copies is ever formed.

Beside the bytes that go, `n_passage_words` counts, if asked for, the words in passages of PASSAGE_WORDS words or more that
start at another place too, whatever their length in bytes (see passages.py). They are a measure: only strings of LENGTH bytes
go.

Documents of equal text are sorted once; they go altogether if they have LENGTH bytes. That texts, whole runs or windows of
crowded buckets are equal is told by two independent 64-bit hashes, without comparing their bytes.

Texts are bytes as they are. A text beyond SEGMENT_BYTES is worked on in segments that overlap by LENGTH - 1 bytes, so a task
holds its bytes once, and arrays for a segment only. Rows that agree in id and text count as several, and each gets the same
result; so do rows of equal ids and different texts, each its own. Null texts are empty, with nothing removed; null ids are
ids. There are no ties: every copy of a string goes, the first too. An empty table gives an empty result. What is left after a
cut may be invalid UTF-8 and is kept as bytes only. Other columns of the input don't take part, and may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BASE, INVERSE, U64, bytes_of, dropped, freed, mix, pieces, written
from .lines import BASE_2, INVERSE_2
from .passages import PASSAGE_WORDS, word_runs, word_windows
from .windows import Seen, hash_of, joined, sums_of, window_runs

LENGTH, GRAM, COVER = 400, 48, 40
UNIT_BYTES, SLICE_BYTES = 1 << 20, 1 << 20
SEGMENT_BYTES = 4 << 20
HOT, FINE = 2000, 22


def cover(v: int) -> np.ndarray:
    """A difference cover modulo v: 0 to r - 1 and the multiples of r, for r about the root of v."""
    r = int(np.ceil(np.sqrt(v)))
    return np.unique(np.concatenate([np.arange(r), np.arange(0, v, r)]))


def distances(v: int) -> np.ndarray:
    """By two residues modulo v, a distance at which both are in the cover."""
    inside = np.zeros(v, bool)
    inside[cover(v)] = True
    out = np.full((v, v), -1, np.int64)
    r = np.arange(v)
    for d in range(v):
        both = inside[(r + d) % v][:, None] & inside[(r + d) % v][None, :]
        out[both & (out < 0)] = d
    return out


DISTANCES = distances(COVER)
IN_COVER = np.isin(np.arange(COVER), cover(COVER))


class Runs:
    """The runs of windows of some texts: text, first window's place in it, number of windows, bucket key."""

    def __init__(self, texts: list[bytes]):
        self.data = data = np.frombuffer(b"".join(texts), np.uint8)
        base = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        empty = np.empty(0, np.int64)
        self.text, self.place, self.number, self.key, self.at, self.anchor = [empty] * 6
        self.sums = None
        if len(data) < LENGTH:
            return
        self.sums = sums_of(data, BASE)
        self.text, self.at, self.number, self.key, self.anchor = window_runs(self.sums, base, LENGTH, GRAM)
        self.place = self.at - base[self.text]

    def fine(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs k in pieces of FINE windows at most: (run, distance of the first window, number of windows, bucket key)."""
        near, far = self.anchor[k] - self.at[k] - self.number[k] + 1, self.anchor[k] - self.at[k]
        count = far // FINE - near // FINE + 1
        run = np.repeat(np.arange(len(k)), count)
        piece = near[run] // FINE + np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
        high, low = np.minimum(far[run], piece * FINE + FINE - 1), np.maximum(near[run], piece * FINE)
        begin = self.anchor[k][run] - piece * FINE
        with np.errstate(over="ignore"):
            key = mix(hash_of(self.sums, INVERSE, begin, begin + LENGTH - FINE + 1) + (piece + 2).astype(U64)).view(np.int64)
        return k[run], far[run] - high, high - low + 1, key


def sorted_classes(order_keys: list[np.ndarray], groups: np.ndarray) -> np.ndarray:
    """Ranks of items by group and then by the keys in a row; equal items have equal ranks."""
    order = np.lexsort([*order_keys[::-1], groups])
    change = np.zeros(len(order), bool)
    for k in [groups, *order_keys]:
        change[1:] |= k[order][1:] != k[order][:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(change)
    return rank


def repeated(blocks: list[bytes], groups: np.ndarray) -> list[np.ndarray]:
    """For each block, whether each of its LENGTH-byte windows is also elsewhere in the blocks of its group."""
    sizes = np.array([len(b) for b in blocks], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(blocks) + bytes(8), np.uint8)
    n = int(begin[-1])
    words = np.zeros(n, U64)
    for k in range(8):
        words |= data[k : n + k].astype(U64) << U64(56 - 8 * k)
    end = np.repeat(begin[1:], sizes)
    block = np.repeat(np.arange(len(blocks)), sizes)

    # Ranks at the cover, to a depth of LENGTH - COVER bytes: COVER bytes by their words, then doubled.
    sample = np.flatnonzero(IN_COVER[np.arange(n) % COVER])
    rank = np.full(n + LENGTH, -1, np.int64)
    at = sample[sample + COVER <= end[sample]]
    rank[at] = sorted_classes([words[at + k] for k in range(0, COVER, 8)], np.zeros(len(at), np.int64))
    depth = COVER
    while depth < LENGTH - COVER:
        step = min(depth, LENGTH - COVER - depth)
        at = at[at + depth + step <= end[at]]
        new = sorted_classes([rank[at], rank[at + step]], np.zeros(len(at), np.int64))
        rank[at] = new
        depth += step

    # Windows by their group and first COVER bytes, dropping those that are alone, eight bytes at a time.
    window = np.concatenate([np.arange(a, b - LENGTH + 1) for a, b in zip(begin, begin[1:], strict=False)])
    out = np.zeros(n, bool)
    cls = groups[block[window]]
    for k in range(0, COVER, 8):
        cls = sorted_classes([words[window + k]], cls)
        many = np.bincount(cls)[cls] > 1
        window, cls = window[many], cls[many]

    # Ties of that depth: three-way splits of all classes at once around a pivot of each.
    while len(window):
        order = np.argsort(cls, kind="stable")
        window, cls = window[order], cls[order]
        first = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]]))
        count = np.diff(np.concatenate([first, [len(cls)]]))
        pivot = np.repeat(window[first + count // 2], count)
        d = DISTANCES[window % COVER, pivot % COVER]
        compared = np.sign(rank[window + d] - rank[pivot + d])
        for k in range(LENGTH - COVER, LENGTH, 8):
            x, y = words[window + k], words[pivot + k]
            compared = np.where(compared == 0, (x > y).astype(np.int64) - (x < y), compared)
        same = compared == 0
        number = np.repeat(np.add.reduceat(same, first), count)
        out[window[same & (number > 1)]] = True
        left = ~same
        cls = (np.repeat(np.arange(len(first)), count) * 3 + compared + 1)[left]
        window = window[left]
        if len(window):
            _, cls = np.unique(cls, return_inverse=True)
            many = np.bincount(cls)[cls] > 1
            window, cls = window[many], cls[many]
    return [out[a : max(a, b - LENGTH + 1)] for a, b in zip(begin, begin[1:], strict=False)]


def _segments(texts: list[bytes], overlap: int = LENGTH - 1):
    """(texts' numbers, places, bytes) in lots: all texts of up to SEGMENT_BYTES in one, longer ones segment by segment."""
    short = [i for i, t in enumerate(texts) if len(t) <= SEGMENT_BYTES]
    if short:
        yield np.array(short), np.zeros(len(short), np.int64), [texts[i] for i in short]
    for i, t in enumerate(texts):
        if len(t) > SEGMENT_BYTES:
            for a in range(0, len(t) - overlap, SEGMENT_BYTES):
                yield np.array([i]), np.array([a]), [t[a : a + SEGMENT_BYTES + overlap]]


def _runs(rows: DataFrame, passages: bool) -> DataFrame:
    """rows: id, row, text. The runs of all texts, of bytes and, for passages, of words; one row for each text and bucket."""

    def lots(texts):
        for number, begin, some in _segments(texts):
            x = Runs(some)
            yield number[x.text], x.key, x.place + begin[x.text], False
        for x in word_runs(texts) if passages else ():
            yield x.text, x.key, x.place, True

    def run(batches):
        import pyarrow as pa

        for part in pieces(batches, "text", SLICE_BYTES):
            for text, key, place, words in lots(bytes_of(part.column(2))):
                order = np.lexsort((place, key, text))
                text, key, place = text[order], key[order], place[order]
                first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (key[1:] != key[:-1])])) if len(key) else np.empty(0, np.int64)
                t = pa.array(text[first])
                places = pa.ListArray.from_arrays(pa.array(np.append(first, len(key)), pa.int32()), pa.array(place, pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0).take(t), part.column(1).take(t), pa.array(key[first]), pa.array(np.full(len(first), words)), places], ["id", "row", "key", "words", "places"])

    return rows.mapInArrow(run, "id long, row long, key long, words boolean, places array<long>")


_BLOCK = "key long, hash long, id long, row long, place long, many boolean, bytes binary"


def _blocks(rows: DataFrame) -> DataFrame:
    """rows: id, row, text, places. The bytes of the runs that begin there; equal ones of a slice once, with `many`.

    The others of those come without bytes: they are repeats altogether, and `hash` is their number of bytes.
    """

    def run(batches):
        import pyarrow as pa

        for part, (text_of, begin, texts) in ((part, lot) for part in pieces(batches, "text", SLICE_BYTES) for lot in _segments(bytes_of(part.column(2)))):
            x = Runs(texts)
            if not len(x.key):
                continue
            of_text, in_text = text_of[x.text], x.place + begin[x.text]
            # Runs of a text in order of place: those asked for.
            lists = part.column(3)
            wanted = lists.flatten()
            asked = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())) << 32 | wanted.field("place").to_numpy()
            bytes_ = ~wanted.field("words").to_numpy(zero_copy_only=False)
            wanted, asked = wanted.filter(pa.array(bytes_)), asked[bytes_]
            hot = asked[wanted.field("hot").to_numpy(zero_copy_only=False)]
            k = np.flatnonzero(np.isin(of_text << 32 | in_text, asked))
            split = np.isin(of_text[k] << 32 | in_text[k], hot)
            whole_runs = k[~split]
            k, skip, number, fine_key = x.fine(k[split])
            skip, number = np.concatenate([np.zeros(len(whole_runs), np.int64), skip]), np.concatenate([x.number[whole_runs], number])
            keys = np.concatenate([x.key[whole_runs], fine_key])
            k = np.concatenate([whole_runs, k])
            a, size, place = x.at[k] + skip, number + LENGTH - 1, in_text[k] + skip
            first_hash = hash_of(x.sums, INVERSE, a, a + size)
            other = hash_of(sums_of(x.data, BASE_2), INVERSE_2, a, a + size)
            order = np.lexsort((other, first_hash, keys))
            k, a, size, place, key, first_hash, other = k[order], a[order], size[order], place[order], keys[order], first_hash[order], other[order]
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (first_hash[1:] != first_hash[:-1]) | (other[1:] != other[:-1])]) if len(k) else np.empty(0, bool)
            many = np.zeros(len(k), bool)
            many[np.flatnonzero(new)[np.cumsum(new)[~new] - 1]] = True
            data = x.data.tobytes()
            for pick, whole in ((np.flatnonzero(new), True), (np.flatnonzero(~new), False)):
                for c in range(0, len(pick), 4096):
                    i = pick[c : c + 4096]
                    t = pa.array(of_text[k[i]])
                    content = pa.array([data[p:q] for p, q in zip(a[i].tolist(), (a[i] + size[i]).tolist(), strict=True)] if whole else [None] * len(i), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[i]), pa.array(first_hash[i].view(np.int64) if whole else size[i]), part.column(0).take(t), part.column(1).take(t), pa.array(place[i], pa.int64()), pa.array(many[i]), content],
                        ["key", "hash", "id", "row", "place", "many", "bytes"],
                    )

    return rows.mapInArrow(run, _BLOCK)


#: Of a window: its hashes and place. kind 0: it may be there once; 1: it is there twice, for other tasks to know; 2: not a
#: window but a run of them that are there twice, from place to stop.
_WINDOW = "h1 long, h2 long, id long, row long, place long, stop long, kind int"


def _told(part, seen: Seen, length: int, text: np.ndarray, place: np.ndarray, h1: np.ndarray, h2: np.ndarray, twice: np.ndarray | None = None):
    """The rows of _WINDOW for some windows; text: the number in `part`."""
    import pyarrow as pa

    decided, told = seen.decide(h1, h2, twice)
    single = np.flatnonzero(~decided)
    run, begin, end = joined(text[decided], place[decided], length)
    pick = np.concatenate([single, told])
    t = pa.array(np.concatenate([text[pick], run]))
    none = np.zeros(len(run), np.int64)
    kind = np.repeat(np.array([0, 1, 2], np.int32), [len(single), len(told), len(run)])
    column = lambda c: part.column(part.schema.get_field_index(c)).take(t)
    stop = np.concatenate([place[pick] + length, end])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([h1[pick], none])), pa.array(np.concatenate([h2[pick], none])), column("id"), column("row"), pa.array(np.concatenate([place[pick], begin])), pa.array(stop), pa.array(kind)], ["h1", "h2", "id", "row", "place", "stop", "kind"])


def _there_twice(windows: DataFrame) -> DataFrame:
    """windows: _WINDOW, a written table. id, row, begin, end of what is there twice."""
    # Windows move once, as they are most of what the disk holds then; none has more rows than there are tasks.
    n = F.sum(F.col("kind") + 1).over(Window.partitionBy("h1", "h2"))
    found = windows.where("kind < 2").withColumn("n", n).where("kind = 0 AND n > 1").drop("n").unionByName(windows.where("kind = 2"))
    return found.select("id", "row", F.col("place").alias("begin"), F.col("stop").alias("end"))


def _windows(blocks: DataFrame) -> DataFrame:
    """All windows of the blocks' bytes, as _WINDOW; a block with `many` is there more than once."""

    def run(batches):
        seen = Seen()
        for part in pieces(batches, "bytes", SLICE_BYTES):
            column = lambda c: part.column(part.schema.get_field_index(c))  # noqa: B023, E731
            blocks = column("bytes").to_pylist()
            size = np.array([len(b) for b in blocks], np.int64)
            data = np.frombuffer(b"".join(blocks), np.uint8)
            of = np.repeat(np.arange(len(blocks)), size - LENGTH + 1)
            inside = np.arange(len(of)) - np.repeat(np.cumsum(size - LENGTH + 1) - (size - LENGTH + 1), size - LENGTH + 1)
            at = (np.cumsum(size) - size)[of] + inside
            hashes = [hash_of(sums_of(data, base), inverse, at, at + LENGTH).view(np.int64) for base, inverse in ((BASE, INVERSE), (BASE_2, INVERSE_2))]
            yield _told(part, seen, LENGTH, of, column("place").to_numpy()[of] + inside, *hashes, column("many").to_numpy(zero_copy_only=False)[of])

    return blocks.select("id", "row", "place", "many", "bytes").mapInArrow(run, _WINDOW)


def _intervals(blocks: DataFrame) -> DataFrame:
    """blocks in order of key and hash: the repeated bytes, as id, row, begin, end."""

    def run(batches):
        import pyarrow as pa

        held: list = []  # key, id, row, place, many, bytes
        size = 0

        def interval(rows: list):
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "row", "begin", "end"])

        def solve(items: list):
            rows, sort = [], []
            keys = [x[0] for x in items]
            alone = {}
            for key in keys:
                alone[key] = alone.get(key, 0) + 1
            for x in items:
                if x[4]:
                    rows.append((x[1], x[2], x[3], x[3] + len(x[5])))
                # Windows of one run are never equal, as their distances to the anchor differ.
                if alone[x[0]] > 1:
                    sort.append(x)
            if sort:
                _, groups = np.unique(np.array([x[0] for x in sort]), return_inverse=True)
                for x, flags in zip(sort, repeated([x[5] for x in sort], groups), strict=True):
                    if not x[4] and flags.any():
                        edge = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
                        rows += [(x[1], x[2], x[3] + b, x[3] + e - 1 + LENGTH) for b, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
            return interval(rows)

        for batch in batches:
            found = []
            for key, i, row, place, many, content in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("key", "id", "row", "place", "many", "bytes")], strict=True):
                last = held[-1] if held else None
                if last and last[0] == key and last[5] == content:
                    last[4] = True
                    found.append((i, row, place, place + len(content)))
                    continue
                if size >= UNIT_BYTES and last[0] != key:
                    yield solve(held)
                    held, size = [], 0
                held.append([key, i, row, place, many, content])
                size += len(content)
            yield interval(found)
        if held:
            yield solve(held)

    return blocks.mapInArrow(run, "id long, row long, begin long, end long")


def _repeated_words(rows: DataFrame) -> DataFrame:
    """rows: id, row, text, places. The windows of words in the runs that begin there, as _WINDOW."""

    def run(batches):
        seen = Seen()
        for part in pieces(batches, "text", SLICE_BYTES):
            lists = part.column(3)
            wanted = lists.flatten()
            asked = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())) << 32 | wanted.field("place").to_numpy()
            asked = asked[wanted.field("words").to_numpy(zero_copy_only=False)]
            if len(asked):
                for lot in word_windows(bytes_of(part.column(2)), asked):
                    yield _told(part, seen, PASSAGE_WORDS, *lot)

    return rows.mapInArrow(run, _WINDOW)


def _merged(spans) -> list[list[int]]:
    out: list[list[int]] = []
    for s in sorted((s["begin"], s["end"]) for s in spans or ()):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return out


def _cut(rows: DataFrame) -> DataFrame:
    """rows: id, text, many, spans, passages (arrays of begin, end; bytes and words). The digest of what is left, and the
    spans that go."""

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for part in pieces(batches, "text"):
            out = []
            for text, many, spans, passages in zip(bytes_of(part.column(1)), *[part.column(k).to_pylist() for k in (2, 3, 4)], strict=True):
                merged = [[0, len(text)]] if many and len(text) >= LENGTH else _merged(spans)
                left, at = hashlib.sha256(), 0
                for b, e in merged:
                    left.update(text[at:b])
                    at = e
                left.update(text[at:])
                words = len(text.split()) if many else sum(e - b for b, e in _merged(passages))
                out.append((len(text), sum(e - b for b, e in merged), len(merged), left.hexdigest(), [{"begin": b, "end": e} for b, e in merged], words if words >= PASSAGE_WORDS else 0))
            n, removed, spans, digest, gone, words = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest), pa.array(words, pa.int64()), pa.array(gone, kind)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words", "spans"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_words long, spans array<struct<begin: bigint, end: bigint>>")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passages: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (byte ranges that go) for each row of `docs`; with `passages`
    n_passage_words too."""
    i, t = docs[f"`{id_col}`"].cast("long"), docs[f"`{text_col}`"]
    spark = docs.sparkSession
    base = docs.select(i.alias("id"), F.xxhash64(i, t).alias("row"), F.xxhash64(t).alias("t1"), F.xxhash64(F.lit(1), t).alias("t2"), t.alias("text"))
    same = lambda x, y: (x["row"] == y["row"]) & x["id"].eqNullSafe(y["id"])
    # A passage of words has a byte and a space for each at least.
    long = base.where(f"octet_length(text) >= {min(LENGTH, 2 * PASSAGE_WORDS - 1) if passages else LENGTH}")
    # One row of each text takes part; equal texts go altogether.
    names = written(long.groupBy("t1", "t2").agg(F.min(F.struct("id", "row")).alias("head"), F.count("*").alias("n")), "texts")
    heads = names.select("head.id", "head.row")
    runs = written(_runs(long.select("id", "row", "text"), passages), "runs")
    freed(docs.sparkSession)
    twice = runs.groupBy("key").agg(F.sum(F.size("places")).alias("n")).where("n > 1").select("key", (F.col("n") > HOT).alias("hot"))
    wanted = runs.join(twice, "key").select("row", "id", F.transform("places", lambda p: F.struct(p.alias("place"), F.col("hot").alias("hot"), F.col("words").alias("words"))).alias("places"))
    # Rows that agree in id and text have the same lists, and as a set they count once.
    asked = wanted.groupBy("row", "id").agg(F.flatten(F.collect_set("places")).alias("places"))
    asked = asked.join(heads, same(asked, heads), "left_semi")
    asked = written(asked, "asked")
    dropped(runs)
    freed(docs.sparkSession)
    one = long.select("id", "row", "text")
    chosen = one.join(asked, same(one, asked)).groupBy(one["row"], one["id"]).agg(F.first("text").alias("text"), F.first("places").alias("places")).select("id", "row", "text", "places")
    words = spark.createDataFrame([], "id long, row long, begin long, end long")
    if passages:
        # Read twice. Each table goes before the next large one is made, as together they are what the disk has to hold.
        chosen = written(chosen, "chosen")
        dropped(asked)
        freed(docs.sparkSession)
        counted = written(_repeated_words(chosen), "words")
        words = written(_there_twice(counted), "passages")
        dropped(counted)
        freed(docs.sparkSession)
    blocks = written(_blocks(chosen), "blocks")
    dropped(chosen if passages else asked)
    freed(docs.sparkSession)
    known = blocks.where("bytes IS NULL").select("id", "row", F.col("place").alias("begin"), (F.col("place") + F.col("hash")).alias("end"))
    sent = blocks.where("bytes IS NOT NULL")
    crowded = written(sent.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("key"), "crowded")
    if not crowded.isEmpty():
        known = known.unionByName(_there_twice(written(_windows(sent.join(crowded, "key", "left_semi")), "windows")))
        sent = sent.join(crowded, "key", "left_anti")
    found = _intervals(sent.repartition("key").sortWithinPartitions("key", "hash", "bytes")).unionByName(known)
    both = found.withColumn("words", F.lit(False)).unionByName(words.withColumn("words", F.lit(True)))
    pair = F.struct("begin", "end")
    spans = both.groupBy("row", "id").agg(F.collect_list(F.when(~F.col("words"), pair)).alias("spans"), F.collect_list(F.when(F.col("words"), pair)).alias("passages"))
    spans = written(spans, "spans")
    dropped(blocks)
    freed(docs.sparkSession)
    # Copies are known by their text, the others' spans by their row; both are narrow, so the texts move once.
    copies = names.where("n > 1").select(F.col("t1").alias("x1"), F.col("t2").alias("x2"))
    rows = base.select("id", "row", "t1", "t2", "text")
    verdict = long.select("id", "row", "t1", "t2").join(copies, (F.col("t1") == F.col("x1")) & (F.col("t2") == F.col("x2")), "left_semi").select("id", "row").distinct().withColumn("many", F.lit(True))
    both = spans.join(verdict, same(spans, verdict), "full").select(F.coalesce(spans["row"], verdict["row"]).alias("row"), F.coalesce(spans["id"], verdict["id"]).alias("id"), F.coalesce("many", F.lit(False)).alias("many"), "spans", "passages")
    return _cut(rows.join(both, same(rows, both), "left").select(rows["id"], "text", F.coalesce("many", F.lit(False)).alias("many"), "spans", "passages")).drop(*[] if passages else ["n_passage_words"])


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), passages=True)
