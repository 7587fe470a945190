import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from palimpsest.llm import minhash
from palimpsest.llm.components import components
from palimpsest.llm.minhash import drop_near, near_classes, op5_minhash, prob_min_hash, shingles


def brute(rows):
    """Smallest id of each id's class."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    inverted, root = defaultdict(list), {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(sets):
        for j, n in Counter(j for q in sets[i] for j in inverted[q]).items():
            if n >= 0.8 * (len(sets[i]) + len(sets[j]) - n):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
        for q in sets[i]:
            inverted[q].append(i)
    return {i: top(i) for i in sets}


def copies(seed, n, words=120, edits=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [rng.choice(vocabulary) for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        out.append(" ".join(w))
    return out


def test_documents_against_brute_force(spark, medium):
    rows = [tuple(r) for r in spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(rows)
    got = {r.doc_id: (r.class_id, r.first) for r in op5_minhash(spark, medium).collect()}
    assert {i: c for i, (c, _) in got.items()} == want
    assert all(first == (want[i] == i) for i, (_, first) in got.items())
    assert len(set(want.values())) < len(want)


def test_a_cluster_copies_its_members_for_the_strays_only(spark, monkeypatch):
    """64 members in one component and 4 strays, in blocks of 8: the members meet the strays' block, not each other's."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    sets = {n: np.arange(100) + (n if n < 64 else 1000 * n) for n in range(68)}
    sets[67] = np.arange(100) + 63 + 6  # near to some members
    rows = spark.createDataFrame([(0, n, 0 if n < 64 else n, n < 64, 64, 4) for n in sets], "head long, node long, component long, large boolean, n_large long, n_rest long")
    binary = spark.createDataFrame([(n, bytearray(x.astype("<i8").tobytes())) for n, x in sets.items()], "node long, set binary")
    links = minhash._within(rows, binary, 0.8).collect()
    assert {r.b for r in links} == {67} and all(r.a < 64 for r in links) and 1 <= len(links) <= 8
    plan = minhash._within(rows, binary, 0.8)._jdf.queryExecution().analyzed().toString()
    assert "explode" in plan


def test_signatures_of_many_shingles_by_turns(monkeypatch):
    rng = np.random.default_rng(4)
    h = rng.integers(1, 1 << 62, 3000).astype(np.uint64)
    text = np.sort(rng.integers(0, 5, 3000))
    whole = prob_min_hash(text, h, np.ones(3000), 5, 64)
    monkeypatch.setattr(minhash, "MOST_SHINGLES", 100)
    assert (prob_min_hash(text, h, np.ones(3000), 5, 64) == whole).all()


@pytest.mark.parametrize("block", [512, 16])
def test_a_group_around_a_hub(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = list(enumerate(copies(1, 80, edits=5) + copies(2, 30, edits=2) + ["one two"] * 3 + ["one two three"]))
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.class_id for r in near_classes(df).collect()}
    assert got == brute(rows)


def test_forest_across_two_blocks():
    sets = [np.arange(100), np.arange(5, 105), np.arange(10, 110), np.arange(500, 600)]
    assert minhash._forest([1, 2, 3, 4], [1, 2, 3, 4], sets, 0.8, 0) == [(1, 2), (1, 3)]
    assert minhash._forest([1, 2, 3, 4], [1, 2, 3, 4], sets, 0.8, 1) == [(1, 2), (1, 3)]
    assert minhash._forest([1, 2, 3, 4], [1, 1, 1, 4], sets, 0.8, 0) == []


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(0)
    m, found, want = 256, [], []
    for _ in range(30):
        h = np.unique(rng.integers(1, 1 << 62, 300).astype(np.uint64))
        w = 1 + rng.integers(0, 3, (2, len(h))) * (rng.random((2, len(h))) < 0.4)
        in_a, in_b = rng.random(len(h)) < 0.9, rng.random(len(h)) < 0.9
        both = in_a & in_b
        wa, wb = np.where(in_a, w[0], 0).astype(float), np.where(in_b, w[1], 0).astype(float)
        want.append(sum(1 / np.maximum(wa / wa[k], wb / wb[k]).sum() for k in np.flatnonzero(both)))
        text = np.concatenate([np.zeros(in_a.sum(), int), np.ones(in_b.sum(), int)])
        r = prob_min_hash(text, np.concatenate([h[in_a], h[in_b]]), np.concatenate([wa[in_a], wb[in_b]]), 2, m)
        found.append((r[0] == r[1]).mean())
    assert abs(np.mean(found) - np.mean(want)) < 0.02 and np.abs(np.array(found) - want).max() < 0.15


def test_signatures_dont_depend_on_counts(spark):
    """Pairs of similarity 0.8, half of whose shared shingles are repeated in one text only, the other half in the other."""
    rows = []
    for k in range(20):
        p, q, x, y = ([f"{name}{k}.{i}" for i in range(n)] for name, n in (("p", 200), ("q", 200), ("x", 42), ("y", 42)))
        rows += [(2 * k, " ".join(p * 16 + q + x)), (2 * k + 1, " ".join(p + q * 16 + y))]
    (_, a), (_, b) = ((i, set(zip(*(t.split()[j:] for j in range(5))))) for i, t in rows[:2])
    assert 0.8 <= len(a & b) / len(a | b) < 0.82
    df = spark.createDataFrame(rows, "doc_id long, text string")
    signed = {r.id: np.frombuffer(r.signature, np.uint8) for r in minhash._signed(minhash._rows(df, "doc_id", "text"), minhash.BANDS, minhash.ROWS).collect()}
    share = [(signed[2 * k] == signed[2 * k + 1]).mean() for k in range(20)]
    assert abs(np.mean(share) - 0.8) < 0.03 and min(share) > 0.68
    assert {r.id: r.class_id for r in near_classes(df).collect()} == {i: i - i % 2 for i, _ in rows}


def test_shingles_count_and_stop_at_texts():
    text, h, n = shingles([b"a b c d e a b c d e", b"", b"a b c", b"a b c d e"])
    assert np.bincount(text, minlength=4).tolist() == [5, 0, 1, 1] and n.tolist().count(2) == 1
    assert h[text == 3][0] in h[text == 0]


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark, odd, nothing):
    rows = near_classes(odd).collect()
    assert len(rows) == len({(r.id, r.row) for r in rows}) == odd.select("doc_id", "text").distinct().count()
    kept = drop_near(odd)
    assert kept.columns == odd.columns
    texts = [r.text for r in kept.collect()]
    assert len([t for t in texts if t and t.startswith("The quick")]) == 1
    assert len([t for t in texts if t and t.startswith("lorem")]) == 1
    assert sum(not (t or "").split() for t in texts) == odd.where("text IS NULL OR trim(translate(text, '\t\n', '')) = ''").select("doc_id", "text").distinct().count()
    assert drop_near(nothing).count() == 0 and near_classes(nothing).count() == 0
