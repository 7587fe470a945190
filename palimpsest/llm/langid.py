"""Language identification of whole texts, with spans for mixed ones.

Each word's script narrows the languages that it may be in. A word's score for a language is the log-likelihood of its
character n-grams, and Viterbi's algorithm with a penalty for each switch labels the words, so that neighbouring words
make spans. The document's language is the one with the most letters.

Viterbi runs for all documents of a batch in lockstep. Most documents are in one language; for these a proof is cheaper:
let no run of words favour another language than the document's by more than the penalty. Then m runs in others beside one
in the document's, which cost m switches or more, can't pay for them. A path that is nowhere in the document's language has
m - 1 switches only: it can beat the path without if some run favours another language by more than half the penalty and
the words' best other languages together by more than one. All other documents need no Viterbi.

The model is fitted on a bounded sample: at most about TRAIN_ROWS documents of each language, chosen by a hash. Its counts
are summed by Spark, and only MAX_LANGUAGES * (ORDERS * BUCKETS + scripts) numbers at most come to the driver.
Prediction is a map over partitions with the model as a broadcast of that bounded size.

Nulls, empty texts and texts without letters are `und` with score 0 and no span. Null languages and texts don't train.
With no labelled row at all, every document is `und`. Ties go to the language that comes first by code point.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, pieces, small_batches

UNDEFINED = "und"
TRAIN_ROWS, MAX_LANGUAGES = 4000, 256
ORDERS, BUCKETS = (2, 3), 1 << 15
SWITCH = 8.0
SLICE_BYTES = 1 << 19
#: A language uses a script if at least this share of its letters is in it.
SCRIPT_SHARE = 0.01

# First and last code points of scripts' main blocks. Letters elsewhere count as one more script.
SCRIPTS = (
    (0x0041, 0x024F), (0x0370, 0x03FF), (0x0400, 0x052F), (0x0530, 0x058F), (0x0590, 0x05FF), (0x0600, 0x06FF), (0x0900, 0x097F), (0x0980, 0x09FF),
    (0x0B80, 0x0BFF), (0x0E00, 0x0E7F), (0x10A0, 0x10FF), (0x1100, 0x11FF), (0x1E00, 0x1EFF), (0x3040, 0x309F), (0x30A0, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7AF),
)
#: Blocks of one script: extended Latin with Latin, both kana with the ideographs, jamo with syllables.
SAME = {12: 0, 13: 15, 14: 15, 11: 16}

_tables: list[np.ndarray] = []


def tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the lower-case letter or 0, and the script."""
    if not _tables:
        letter = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                letter[i] = ord(low) if len(low) == 1 else i
        script = np.full(0x110000, len(SCRIPTS), np.uint8)
        for k, (a, b) in enumerate(SCRIPTS):
            script[a : b + 1] = SAME.get(k, k)
        _tables.extend((letter, script))
    return _tables[0], _tables[1]


@dataclass
class Words:
    """The words of some texts: bounds in the joined code points, the text of each, its letters, script and n-grams."""

    base: np.ndarray  # where each text begins
    begin: np.ndarray
    end: np.ndarray
    text: np.ndarray
    script: np.ndarray
    grams: list[np.ndarray]  # by order: the bucket of each n-gram
    bounds: list[np.ndarray]  # by order: where each word's n-grams begin


def words_of(texts: list[str]) -> Words:
    letter, script = tables()
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    base = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    low = letter[points]
    edge = np.flatnonzero(np.diff((low > 0).astype(np.int8), prepend=0, append=0))
    begin, end = edge[::2], edge[1::2]
    # With an end mark after each word, its n-grams end at its letters and at that mark; none reaches into the word before.
    inside = low.astype(np.uint64)
    used = low > 0
    used[np.minimum(end, len(low) - 1)] = True
    at = np.flatnonzero(used)
    first = np.concatenate([[0], np.cumsum(end - begin + 1)])[:-1]
    grams = []
    with np.errstate(over="ignore"):
        before = np.concatenate([np.zeros(2, np.uint64), inside])
        # before[i + 1] is the character ahead of i, before[i] the one ahead of that.
        one, two = before[at + 1], before[at]
        two = np.where(one > 0, two, U64(0))
        for n in ORDERS:
            key = inside[at] + (one << U64(21)) + ((two << U64(42)) if n == 3 else U64(0))
            grams.append(((key * U64(0x9E3779B97F4A7C15)) >> U64(64 - BUCKETS.bit_length() + 1)).astype(np.int32))
    return Words(base, begin, end, np.searchsorted(base, begin, "right") - 1, script[points[begin]], grams, [first] * len(ORDERS))


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # order, bucket, language: log-likelihood
    scripts: np.ndarray  # script, language: whether the language uses it


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id", train_rows: int = TRAIN_ROWS) -> Model:
    """labelled: the rows that may train."""
    small_batches(labelled.sparkSession)
    rows = labelled.select(labelled[f"`{key_col}`"].alias("key"), labelled[f"`{text_col}`"].alias("text"), labelled[f"`{lang_col}`"].cast("string").alias("lang")).where("lang IS NOT NULL")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(counts)
    number = {x: i for i, x in enumerate(languages)}
    kinds = len(ORDERS) * BUCKETS + len(SCRIPTS) + 1
    sums = np.zeros((len(languages), kinds))
    if languages:
        share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1 << 20, -(-(train_rows << 20) // n)))])
        sample = rows.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < share[F.col("lang")]).where("text IS NOT NULL").select("text", "lang")

        def count(batches):
            import pyarrow as pa

            total = np.zeros((len(languages), kinds), np.int64)
            for part in pieces(batches, "text", SLICE_BYTES):
                langs = np.array([number[x] for x in part.column(1).to_pylist()])
                w = words_of(part.column(0).to_pylist())
                of = langs[w.text]
                lengths = w.end - w.begin
                for k, grams in enumerate(w.grams):
                    np.add.at(total.reshape(-1), np.repeat(of, lengths + 1) * kinds + k * BUCKETS + grams, 1)
                np.add.at(total.reshape(-1), of * kinds + len(ORDERS) * BUCKETS + w.script, lengths)
            lang, kind = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int64()), pa.array(kind, pa.int64()), pa.array(total[lang, kind], pa.int64())], ["lang", "kind", "n"])

        got = sample.mapInArrow(count, "lang long, kind long, n long").groupBy("lang", "kind").agg(F.sum("n").alias("n")).toArrow()
        sums[got["lang"].to_numpy(), got["kind"].to_numpy()] = got["n"].to_numpy()
    grams = sums[:, : len(ORDERS) * BUCKETS].reshape(len(languages), len(ORDERS), BUCKETS)
    scores = np.log((grams + 0.1) / (grams.sum(2, keepdims=True) + 0.1 * BUCKETS)).transpose(1, 2, 0).astype(np.float32)
    scripts = sums[:, len(ORDERS) * BUCKETS :]
    return Model(languages, np.ascontiguousarray(scores), (scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(1, keepdims=True))).T.copy())


def viterbi(scores: np.ndarray, begins: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The best path of each sequence: rows begins[i] to begins[i + 1] of scores; a change of state costs `penalty`.

    All sequences advance together, the longest first, so that those still running are a prefix.
    """
    lengths = np.diff(begins)
    order = np.argsort(-lengths, kind="stable")
    start, lengths = begins[:-1][order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    running = len(lengths) - np.searchsorted(lengths[::-1], np.arange(steps), "right")
    path = np.zeros(len(scores), np.int16)
    best = np.zeros(len(scores), np.int16)
    switch = np.zeros(scores.shape, bool)
    v = scores[start].astype(np.float64) if steps else np.zeros((0, scores.shape[1]))
    v[lengths == 0] = 0
    for t in range(1, steps):
        k = running[t]
        now, at = v[:k], start[:k] + t
        top = now.argmax(1)
        other = np.take_along_axis(now, top[:, None], 1) - penalty
        change = other > now
        switch[at], best[at] = change, top
        v[:k] = np.where(change, other, now) + scores[at]
    state = v.argmax(1)
    for t in range(steps - 1, -1, -1):
        k = running[t]
        at, s = start[:k] + t, state[:k]
        path[at] = s
        if t:
            state[:k] = np.where(switch[at, s], best[at], s)
    return path


def label(model: Model, texts: list[str]) -> tuple[list[str], list[float], list[list[tuple[int, int, int]]]]:
    """For each text: its language, score, and spans as (first character, character behind the last, language's number)."""
    n, size = len(texts), len(model.languages)
    w = words_of(texts)
    if not len(w.begin) or not size:
        return [UNDEFINED] * n, [0.0] * n, [[] for _ in texts]
    scores = sum(np.add.reduceat(model.scores[k][g], w.bounds[k], axis=0) for k, g in enumerate(w.grams)).astype(np.float64)
    allowed = model.scripts[w.script]
    known = allowed.any(1)
    scores = np.where(allowed, scores, scores.min(1, keepdims=True) - 2 * SWITCH)
    # Words of a script that no language uses say nothing.
    scores[~known] = 0
    begins = np.searchsorted(w.text, np.arange(n + 1))
    whole = np.zeros((n, size))
    np.add.at(whole, w.text, scores)
    top = whole.argmax(1)
    path = top[w.text].astype(np.int16)

    # How far any run of words favours another language than the document's: sums less the lowest sum before, by document.
    ahead = scores - scores[np.arange(len(scores)), top[w.text]][:, None]
    sums = np.cumsum(ahead, 0)
    zero = np.concatenate([np.zeros((1, size)), sums])[begins[:-1]]
    sums -= zero[w.text]
    # Documents are set apart by an offset, so that a running minimum starts anew in each.
    apart = (np.abs(sums).max() + 1) * 4
    offset = (w.text * apart)[:, None]
    lowest = np.minimum.accumulate(np.minimum(np.concatenate([np.zeros((1, size)), sums[:-1]]) * (w.text == np.concatenate([[-1], w.text[:-1]]))[:, None], 0) - offset, 0) + offset
    gain = np.zeros(n)
    np.maximum.at(gain, w.text, (sums - lowest).max(1))
    # How far a path that is nowhere in the document's language could be ahead without its switches.
    ahead[np.arange(len(ahead)), top[w.text]] = -np.inf
    elsewhere = np.bincount(w.text, ahead.max(1), n)
    least = SWITCH * (1 - 1e-9)
    mixed = np.flatnonzero((gain > least) | ((gain > least / 2) & (elsewhere > least)))
    if len(mixed):
        rows = np.concatenate([np.arange(begins[i], begins[i + 1]) for i in mixed])
        cuts = np.concatenate([[0], np.cumsum(np.diff(begins)[mixed])])
        path[rows] = viterbi(scores[rows], cuts)

    letters = np.zeros((n, size))
    lengths = (w.end - w.begin) * known
    np.add.at(letters, (w.text, path), lengths)
    every = np.bincount(w.text, w.end - w.begin, n)
    pick = letters.argmax(1)
    second = np.where(np.arange(size) == pick[:, None], -np.inf, whole).max(1) if size > 1 else np.full(n, -np.inf)
    margin = np.clip(whole[np.arange(n), pick] - second, -50, 50)
    share = letters[np.arange(n), pick] / np.maximum(every, 1)
    # The share of letters in the language, and the odds against the next one for a text that is too short to tell.
    score = share / (1 + np.exp(-np.abs(margin)))
    turn = np.flatnonzero((np.diff(path, prepend=-1) != 0) | (np.diff(w.text, prepend=-1) != 0))
    last = np.concatenate([turn[1:], [len(path)]]) - 1
    spans: list[list] = [[] for _ in texts]
    for i, a, b, p in zip(w.text[turn].tolist(), (w.begin[turn] - w.base[w.text[turn]]).tolist(), (w.end[last] - w.base[w.text[turn]]).tolist(), path[turn].tolist(), strict=True):
        spans[i].append((a, b, p))
    return [model.languages[p] if e else UNDEFINED for p, e in zip(pick, every, strict=True)], score.tolist(), spans


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, spans (array of begin, end, lang); one row for each of `docs`."""
    rows = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].alias("text"))
    return _map(rows, model, "text", None, "doc_id long")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose language is known with a score of `least` or more; all columns as they were."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record"))
    judged = _map(rows, model, text_col, "record", f"record {docs.schema.simpleString()}", lambda lang, score: lang != UNDEFINED and score >= least)
    return judged.select(*[F.col("record").getField(c).alias(c) for c in docs.columns])


def _map(rows: DataFrame, model: Model, text: str, inside: str | None, first: str, wanted=None) -> DataFrame:
    """rows: the column to carry, and the text unless it is inside that one. With `wanted`, only rows for which it holds."""
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        m = shared.value
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
        for part in pieces(batches, text, SLICE_BYTES, inside):
            texts = [t or "" for t in (part.column(0).field(text) if inside else part.column(1)).to_pylist()]
            langs, scores, spans = label(m, texts)
            if wanted:
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array([wanted(x, s) for x, s in zip(langs, scores, strict=True)], pa.bool_()))], [inside])
                continue
            spans = [[{"begin": a, "end": b, "lang": m.languages[p]} for a, b, p in s] for s in spans]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["doc_id", "lang_pred", "score", "spans"])

    return rows.mapInArrow(run, first if wanted else f"{first}, lang_pred string, score double, spans array<struct<begin: int, end: int, lang: string>>")


def held_out(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))
