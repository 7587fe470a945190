import io
import random
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest

from palimpsest.llm import common, tokens
from palimpsest.llm.common import scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_cut_texts_have_the_ids_of_whole_texts(tokenizer):
    rng = random.Random(5)
    some = ["a", "B", "é", ".", " ", "\n", ",", "!", "  ", ". ", ".\n", "1", "'s", "\t", "日", " ", ", ", "", "", "word", " the", "<|endoftext|>", "\x1c", "\x85"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(0, 14))) for _ in range(20_000)]
    plain = ["ab", "cd", " the", ". ", ".\n", ",", " x", ", ", "é"]
    texts += ["".join(rng.choice(plain) for _ in range(rng.randint(0, 30))) for _ in range(10_000)]
    encode = tokens.Encoder(PATH)
    for a in range(0, len(texts), 700):
        part = texts[a : a + 700]
        for text, got, want in zip(part, encode(part), tokenizer.encode_batch(part, add_special_tokens=False)):
            assert np.frombuffer(got, "<u4").tolist() == want.ids, repr(text)


def test_pieces_are_dropped_without_harm(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_PIECES", 20)
    encode = tokens.Encoder(PATH)
    texts = [f"word{i} of the, day{i % 7}. And more{i}" for i in range(300)]
    for a in range(0, 300, 10):
        for text, got in zip(texts[a : a + 10], encode(texts[a : a + 10])):
            assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_that_recur_do_not_become_objects(monkeypatch):
    """A call makes Python objects of the pieces that are new, not of each place where a piece stands."""
    pieces, made = tokens.Encoder._pieces, []

    def counted(self, new):
        made.append((sys.getallocatedblocks() - before, len(new)))
        return pieces(self, new)

    monkeypatch.setattr(tokens.Encoder, "_pieces", counted)
    encode = tokens.Encoder(PATH)
    texts = [" ".join(f"word{(i * 7 + k) % 100}" for k in range(2000)) for i in range(50)]
    before = sys.getallocatedblocks()
    encode(texts)
    [(blocks, new)] = made
    assert 100 <= new <= 200 and blocks < 10_000


def test_kept_words_against_a_plain_encoding():
    rng, asked = random.Random(9), []

    def encode(words):
        asked.extend(words)
        return [None if "?" in w else np.arange(len(w), dtype=np.uint32).tobytes() for w in words]

    kept = common.Kept(encode, 30, 6)
    word = lambda: rng.choice(["", "é日", "?", "x" * rng.randint(1, 9), "y" * rng.randint(1, 9), str(rng.randint(0, 60))])
    for _ in range(60):
        rows = [rng.choice([None, " ".join(word() for _ in range(rng.randint(1, 12)))]) for _ in range(rng.randint(0, 9))]
        asked.clear()
        out, lacking = kept.ids(rows)
        words = [r.split(" ") if r is not None else [] for r in rows]
        assert out == [b"".join(np.arange(0 if "?" in w else len(w), dtype=np.uint32).tobytes() for w in ws) for ws in words]
        assert lacking.tolist() == [i for i, ws in enumerate(words) if "?" in "".join(ws)]
        assert len(asked) == len(set(asked)) and len(kept.words) <= 30 + 9 * 12 and all(len(w) <= 6 for w in kept.words.to_pylist())


def test_file_is_plain_zstandard_with_random_access(monkeypatch):
    import zstandard

    monkeypatch.setattr(tokens, "FRAME_IDS", 100)
    docs = [(i if i != 2 else None, np.arange(n, dtype="<u4").tobytes()) for i, n in enumerate([0, 1, 99, 100, 101, 1000])]
    out = io.BytesIO()
    writer = tokens.FileWriter(out)
    for i, ids in docs:
        writer.add(i, ids)
    writer.close()
    data = out.getvalue()
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert whole == b"".join(ids for _, ids in docs)
    reads = []

    class Watched(io.BytesIO):
        def read(self, n=-1):
            reads.append((self.tell(), n))
            return super().read(n)

    reader = tokens.FileReader(Watched(data))
    assert reader.doc_ids == [i for i, _ in docs] and reader.counts.tolist() == [0, 1, 99, 100, 101, 1000]
    for k, (i, ids) in enumerate(docs):
        reads.clear()
        assert b"".join(reader.ids(k)) == ids and reader.find(i) == [k]
        assert len(reads) == -(-len(ids) // 400), "only the document's own frames are read"
    damaged = bytearray(data)
    damaged[int(reader.begins[reader.frames[4]]) + 12] ^= 255
    with pytest.raises(Exception):
        list(tokens.FileReader(io.BytesIO(bytes(damaged))).ids(4))


def test_whole_corpus_against_the_library(spark, small, tokenizer):
    got = {r.doc_id: r for r in tokens.op1_token_ids(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    start = 0
    for d in docs:
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2]
        assert (got[d.doc_id].start, got[d.doc_id].n_tokens, got[d.doc_id].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_odd_rows_and_requested_documents(spark, odd, nothing, tokenizer):
    files = tokens.write_tokens(odd, PATH, scratch(spark, "t"))
    got = sorted(tokens.read_tokens(files).collect(), key=lambda r: r.start)
    assert len(got) == odd.count() and [r.doc_id for r in got[:4]] == [None] * 4
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids == sorted(ids)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:])) and got[0].start == 0
    found = [x for f in files.collect() for x in tokens.read_documents(f.path, [7])[7]]
    assert [x.tolist() for x in found] == [[*tokenizer.encode("123 !!! ???", add_special_tokens=False).ids, 2]]
    assert tokens.read_tokens(tokens.write_tokens(nothing, PATH, scratch(spark, "t"))).count() == 0


def test_zstd_tool_reads_a_file(spark, small, tmp_path):
    import shutil

    if not shutil.which("zstd"):
        pytest.skip("no zstd here")
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(5)
    path = tokens.write_tokens(docs, PATH, f"file://{tmp_path}/x").first().path.removeprefix("file://")
    assert len(subprocess.run(["zstd", "-dc", path], capture_output=True, check=True).stdout) % 4 == 0
