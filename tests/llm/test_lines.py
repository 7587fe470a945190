import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from palimpsest.llm import common, lines
from palimpsest.llm.lines import _within_one, dedup_lines, drop_repeats, op10_line_dedup


def near(x, y):
    if x == y:
        return True
    if len(x) < 8 or len(y) < 8 or abs(len(x) - len(y)) > 1:
        return False
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) <= 1
    return any(y[:j] + y[j + 1 :] == x for j in range(len(y)))


def brute(rows):
    """rows of different ids: the kept texts."""
    seen, out = [], {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        if t is None:
            out[i] = None
            continue
        left = []
        for line in t.split("\n"):
            w = line.encode().split()
            if len(w) < 5 or not any(near(w, y) for y in seen):
                left.append(line)
            if len(w) >= 5:
                seen.append(w)
        out[i] = "\n".join(left)
    return out


def test_against_brute_force(spark):
    rng = random.Random(1)
    words = ["aa", "bb", "cc", "dd", "é", "x1"]
    base = [[rng.choice(words) for _ in range(rng.randint(3, 12))] for _ in range(30)]
    rows = [(900, None), (901, ""), (902, "\n\n"), (None, "aa bb cc dd é x1 aa bb")]
    for i in range(140):
        lines = []
        for _ in range(rng.randint(0, 6)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                j = rng.randrange(len(w)) if w else 0
                kind = rng.randint(0, 2)
                if kind == 0 and w:
                    w[j] = rng.choice(words)
                elif kind == 1:
                    w.insert(j, rng.choice(words))
                elif w:
                    del w[j]
            lines.append(rng.choice([" ", "  ", "\t"]).join(w))
        rows.append((i, "\n".join(lines)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.record.doc_id: (r.text, r.n_lines, r.n_removed) for r in dedup_lines(df).collect()}
    want = brute(rows)
    assert {i: t for i, (t, _, _) in got.items()} == want
    texts = dict(rows)
    for i, (t, n, removed) in got.items():
        assert n == (0 if texts[i] is None else texts[i].count("\n") + 1)
        if removed < n:
            assert t is None or t.count("\n") + 1 == n - removed
    assert sum(r for _, _, r in got.values()) > 100


def test_documents_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    assert {r.record.doc_id: r.text for r in dedup_lines(docs).collect()} == brute([tuple(r) for r in docs.collect()])
    assert op10_line_dedup(spark, small).count() == docs.count()


def test_edit_distance():
    line = "one two three four five six seven eight"
    assert _within_one(line, line) and _within_one(line, line.replace("four", "4")) and _within_one(line, line + " nine") and _within_one(line.replace("one ", ""), line)
    assert not _within_one(line, line.replace("four", "4").replace("six", "6")) and not _within_one(line, line + " nine ten") and not _within_one(line, line.replace("one two", "two one"))


def test_odd_rows(spark, odd, nothing):
    rows = dedup_lines(odd).collect()
    assert len(rows) == odd.count() and set(rows[0].record.asDict()) == set(odd.columns)
    by = {}
    for r in rows:
        assert (r.text is None) == (r.record.text is None)
        by.setdefault((r.record.doc_id, r.record.text), set()).add(r.text)
    assert all(len(x) == 1 for x in by.values()), "rows that agree have one result"
    assert dedup_lines(nothing).count() == 0


def test_short_lines_of_the_queries(spark, tmp_path):
    five = "one two three four five"
    rows = [
        (1, f"All rights reserved.\n日本語のテキスト。\nHome\n\n{five}\na b c d"),
        (2, f"Home\nAll  rights reserved.\nkept\n日本語のテキスト。\n\n{five} six\na b c e"),
        (3, f"Home page\n{five.replace('two', '2')}\nHome"),
    ]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = {1: rows[0][1], 2: "kept\n\na b c e", 3: "Home page"}
    assert {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, str(tmp_path)).collect()} == want
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_bytes_kept) for r in op10_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {i: (t.count("\n") + 1, {1: 0, 2: 4, 3: 2}[i], len(want[i].encode())) for i, t in rows}


def left_alone(text):
    """Words of the lines that no earlier line of the same text is near to."""
    lines = [x.split() for x in text.encode().split(b"\n")]

    def close(x, y):
        x, y = sorted((x, y), key=len)
        if x == y:
            return True
        if len(x) < 5 or len(y) - len(x) > 1:
            return False
        return sum(p != q for p, q in zip(x, y)) <= 1 if len(x) == len(y) else any(y[:j] + y[j + 1 :] == x for j in range(len(y)))

    return sum(len(x) for k, x in enumerate(lines) if x and not any(close(x, y) for y in lines[:k] if y))


def test_lines_of_one_document_alone():
    rng = random.Random(3)
    for _ in range(200):
        text = "\n".join(" ".join(rng.choice("abc") for _ in range(rng.choice([0, 1, 4, 5, 6, 7]))) for _ in range(rng.randint(0, 12)))
        assert lines.alone(text.encode(), 1, 5) == left_alone(text)


def test_short_lines_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    words, near_words, want = {}, {}, {}
    for i, t in sorted((tuple(r) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0)):
        left = []
        for line in (t or "").split("\n"):
            w = tuple(line.encode().split())
            n = len(w)
            forms = [("same", j, w[:j] + w[j + 1 :]) for j in range(n)] + [("whole", w)] + [("less", w[:j] + w[j + 1 :]) for j in range(n)] if n >= 5 else []
            seen = [("same", j, w[:j] + w[j + 1 :]) for j in range(n)] + [("less", w)] + [("whole", w[:j] + w[j + 1 :]) for j in range(n)]
            if not n or not (w in words or n >= 5 and any(x in near_words for x in seen)):
                left.append(line)
            words[w] = 1
            near_words.update(dict.fromkeys(forms, 1))
        new = None if t is None else "\n".join(left)
        # The stage leaves out documents that keep less than a fifth of what they would keep alone.
        if new == t or len(new.encode().split()) >= 0.2 * left_alone(t):
            want[i] = new
    assert {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, small).collect()} == want


def test_words_of_long_texts_are_hashed_in_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.choice(np.frombuffer(b"abc \n", np.uint8), 60_000)
    data[20_000:31_000] = 97
    whole = common.word_hashes(data)
    monkeypatch.setattr(common, "HASH_BYTES", 500)
    assert all((a == b).all() for a, b in zip(common.word_hashes(data), whole))


def test_documents_that_lose_most_words_go(spark):
    rng = random.Random(9)
    some = [" ".join(rng.choices([f"w{i}" for i in range(900)], k=9)) for _ in range(30)]
    table = "\n".join(f"row {i} of a long table with the same words in it" for i in range(20))
    rows = [(1, "\n".join(some[:10])), (2, "\n".join(some[:9] + some[20:21])), (3, "\n".join(some[:5] + some[10:15])), (4, some[0]), (5, None), (6, ""), (7, " \n "), (8, table)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("record", F.lit("clash"))
    got = {r.doc_id: r.text for r in drop_repeats(docs).collect()}
    assert sorted(got) == [1, 3, 5, 6, 7, 8] and got[1] == rows[0][1] and got[3] == "\n".join(some[10:15])
    assert got[8] == table.split("\n")[0]
    assert drop_repeats(docs).columns == docs.columns
