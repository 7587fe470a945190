import hashlib
import random
from collections import Counter

import numpy as np

from palimpsest.llm import passages, suffixes, windows
from palimpsest.llm.suffixes import LENGTH, op3_suffix_dedup, remove_repeats


def brute(rows):
    data = [(t or "").encode() for _, t in rows]
    count = Counter(b[p : p + LENGTH] for b in data for p in range(len(b) - LENGTH + 1))
    out = []
    for (i, _), b in zip(rows, data):
        gone = np.zeros(len(b) + 1, np.int64)
        for p in range(len(b) - LENGTH + 1):
            if count[b[p : p + LENGTH]] > 1:
                gone[p] += 1
                gone[p + LENGTH] -= 1
        g = np.cumsum(gone)[: len(b)] > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~g])
        out.append((i, len(b), int(g.sum()), int((np.diff(g.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def brute_words(rows, k=51):
    words = [(t or "").encode().split() for _, t in rows]
    count = Counter(tuple(w[p : p + k]) for w in words for p in range(len(w) - k + 1))
    return sorted((i, len({p + j for p in range(len(w) - k + 1) if count[tuple(w[p : p + k])] > 1 for j in range(k)})) for (i, _), w in zip(rows, words))


def ours(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    rnd = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passages, rows = [rnd(rng.randint(300, 900)) for _ in range(6)], []
    for i in range(50):
        t = ""
        for _ in range(rng.randint(0, 4)):
            k = rng.randint(0, 5)
            if k < 3:
                p = rng.choice(passages)
                t += p[rng.randint(0, 200) : len(p) - rng.randint(0, 100)]
            elif k == 3:
                t += rnd(rng.randint(0, 700))
            elif k == 4:
                t += "x" * rng.randint(0, 1200)
            else:
                t += rng.choice(["ab", "xyz, ", "Is onhe. "]) * rng.randint(0, 200)
        rows.append((i, t))
    return rows + [(100, None), (101, ""), (102, rows[3][1]), (103, rows[3][1]), (104, "q" * 400), (105, "z" * 401), (106, rnd(3000) * 2), (106, "same id")]


def test_against_brute_force(spark, monkeypatch):
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows)
    assert ours(remove_repeats(df)) == want and sum(w[2] for w in want) > 10_000
    # All buckets are dealt anew, and all of these are counted by their windows.
    monkeypatch.setattr(suffixes, "HOT", 0)
    assert ours(remove_repeats(df)) == want


def test_segments_give_the_same_runs(monkeypatch):
    """Long texts are taken in segments: the same windows with the same keys, though a run may be cut."""
    texts = [(t or "").encode() for _, t in corpus(4)]

    def windows_of(segment):
        monkeypatch.setattr(suffixes, "SEGMENT_BYTES", segment)
        out = set()
        for number, begin, some in suffixes._segments(texts):
            x = suffixes.Runs(some)
            for t, p, n, key in zip(x.text.tolist(), x.place.tolist(), x.number.tolist(), x.key.tolist()):
                out |= {(int(number[t]), int(begin[t]) + p + k, key) for k in range(n)}
        return out

    def words_of(segment, words):
        monkeypatch.setattr(passages, "SEGMENT_BYTES", segment)
        monkeypatch.setattr(passages, "SEGMENT_WORDS", words)
        return {(t, p + k, key) for x in passages.word_runs(texts) for t, p, n, key in zip(x.text.tolist(), x.place.tolist(), x.number.tolist(), x.key.tolist()) for k in range(n)}

    whole = windows_of(1 << 20)
    assert whole == windows_of(700) and len(whole) > 10_000
    whole = words_of(1 << 20, 1 << 19)
    assert whole == words_of(60, 70) and len(whole) > 1000


def test_many_documents_share_almost_a_passage(spark, monkeypatch):
    """390 shared bytes amid other ones are no repeat, whatever way their bucket is taken; one more document with 400 is."""
    monkeypatch.setattr(suffixes, "HOT", 20)
    rng = random.Random(5)
    rnd = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = rnd(390)
    rows = [(i, rnd(200) + shared + rnd(200)) for i in range(120)]
    rows += [(900, rows[7][1][190:610]), (901, rows[7][1][190:610] + "x"), (902, rows[8][1][150:595])]
    want = brute(rows)
    assert ours(remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == want
    assert sum(w[2] > 0 for w in want) == 5


def test_minima_of_arrays_longer_than_their_position_bits(monkeypatch):
    key = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2)
    key[1000:1200] = key[1000]
    want = [int(np.argmin(key[p : p + 353])) + p for p in range(5000 - 352)]
    assert windows.sliding_argmin(key, 353).tolist() == want
    monkeypatch.setattr(windows, "POSITION_BITS", 10)
    assert windows.sliding_argmin(key, 353).tolist() == want


def test_documents_against_brute_force(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert ours(op3_suffix_dedup(spark, small)) == brute(rows)


def test_passages_of_words_against_brute_force(spark, medium):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 3)))
    shared = [[word() for _ in range(n)] for n in (49, 50, 51, 52, 60, 140)]
    rows = []
    for i in range(60):
        w = [word() for _ in range(rng.randint(0, 200))]
        if rng.random() < 0.7:
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice(shared)
        rows.append((i, "".join(x + rng.choice([" ", "\n", "  "]) for x in w)))
    rows += [(100, None), (101, ""), (102, rows[3][1]), (103, " ".join(shared[2])), (104, "x " * 55), (105, "one two"), (106, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_words(rows)
    found = lambda df: sorted((r.doc_id, r.n_passage_words) for r in df.collect())
    assert found(remove_repeats(df, passages=True)) == want and sum(n > 0 for _, n in want) > 20
    docs = [tuple(r) for r in spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text").collect()]
    df = spark.read.parquet(f"{medium}/documents.parquet")
    assert found(remove_repeats(df, passages=True)) == brute_words(docs)


def test_query_tells_planted_passages_shorter_than_a_cut(spark, tmp_path):
    """Passages of 51 to 60 words in two documents each have less than LENGTH bytes: nothing goes, but all are counted."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 6)))
    rows = [[word() for _ in range(rng.randint(80, 200))] for _ in range(120)]
    planted = {}
    for k, n in enumerate(range(51, 61)):
        passage = [word() for _ in range(n)]
        assert len(" ".join(passage)) < LENGTH
        for i in (k, 60 + k):
            at = rng.randint(0, len(rows[i]))
            rows[i][at:at] = passage
            planted[i] = n
    spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op3_suffix_dedup(spark, str(tmp_path)).collect()}
    assert all(r.n_removed == 0 and r.n_bytes == len(" ".join(rows[i])) for i, r in got.items())
    assert {i: r.n_passage_words for i, r in got.items()} == {i: planted.get(i, 0) for i in range(120)}


def test_difference_cover_covers():
    for v in (5, 16, 40, 50):
        d = set(suffixes.cover(v).tolist())
        table = suffixes.distances(v)
        assert all((i + table[i, j]) % v in d and (j + table[i, j]) % v in d and 0 <= table[i, j] < v for i in range(v) for j in range(v))


def test_suffix_sort_of_one_bucket():
    rng = random.Random(1)
    base = bytes(rng.randrange(256) for _ in range(900))
    blocks = [base[:600], base[100:700], base[150:560], bytes(rng.randrange(256) for _ in range(500)), base[:600]]
    groups = np.array([0, 0, 0, 0, 1])
    got = suffixes.repeated(blocks, groups)
    for k, b in enumerate(blocks):
        for p in range(len(b) - LENGTH + 1):
            w = b[p : p + LENGTH]
            elsewhere = sum(x[q : q + LENGTH] == w for m, x in enumerate(blocks) if groups[m] == groups[k] for q in range(len(x) - LENGTH + 1))
            assert got[k][p] == (elsewhere > 1)


def test_odd_rows(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.where("length(text) < 5000 OR text IS NULL").collect()]
    assert ours(remove_repeats(odd.where("length(text) < 5000 OR text IS NULL"))) == brute(rows)
    whole = {r.doc_id: r for r in remove_repeats(odd).collect() if r.doc_id in (8, 9, 10)}
    assert whole[8].n_removed == whole[8].n_bytes > 10**6 and whole[10].n_removed == 50_000
    assert remove_repeats(nothing).count() == 0


def test_windows_that_a_task_meets_twice(monkeypatch):
    """Each window is told as single, or once as repeated; what is known stays known within the bound."""
    monkeypatch.setattr(windows.Seen, "KEPT", 30)
    rng, seen, told_of, single_of = np.random.default_rng(6), windows.Seen(), Counter(), Counter()
    every = Counter()
    for _ in range(20):
        h1 = rng.integers(0, 60, 40)
        h2 = h1 % 7
        decided, told = seen.decide(h1, h2)
        here = Counter(h1.tolist())
        every += here
        assert all(decided[k] for k in range(40) if here[h1[k]] > 1) and decided[told].all()
        told_of += Counter(h1[told].tolist())
        single_of += Counter(h1[~decided].tolist())
    # Whoever sums kind + 1 finds all that are there twice.
    assert all((2 * told_of[h] + single_of[h] > 1) == (n > 1) for h, n in every.items())
    assert [x.tolist() for x in windows.joined(np.array([1, 0, 1, 1, 0]), np.array([5, 2, 6, 9, 3]), 10)] == [[0, 1, 1], [2, 5, 9], [13, 16, 19]]
