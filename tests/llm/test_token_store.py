import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from playtrail.llm import token_store as S

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, start long"
ODD = ["", None, " ", "  two  blanks ", "a\n\nb \n c\t d", "é è  ü x  y", "don't I'll 'tis", "<|endoftext|> and <|endoftext|>", "\x1c \x1d a\x85b", "emoji 😀 ok", "中文 字 x"]


def brute(rows):
    """Every text encoded whole by the library, in key order."""
    plain, at, out = Tokenizer.from_file(PATH), 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_same_as_brute_force(spark, frame):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10_000 + i, t) for i, t in enumerate(ODD)] + [(20_000, "w" * 300_000), (20_001, " " * 300_000), (20_002, "a b " * 100_000)]
    got = S.digests(frame([(*r, 7) for r in rows], SCHEMA).repartition(5), PATH)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and rows_of(got) == brute(rows)


def test_small_shards_copies_and_null_keys(spark, frame):
    rows = [(None, "none"), (None, "none"), (-5, "x")] + [(3, "the same")] * 400 + [(i, f"text {i}") for i in range(4, 40)]
    docs = frame([(*r, 7) for r in rows], SCHEMA)
    root = S.build(docs, PATH, shard_ids=50)
    assert S.files(spark, root).count() > 20
    got = S.read(spark, root, S.keys_of(docs))
    found = [(None if r.k is None else int(r.k), r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in got.collect()]
    assert sorted(found, key=str) == brute(rows)
    payload = b"".join(bytes(r.content)[:-14 - int.from_bytes(bytes(r.content)[-13:-5], "little")] for r in S.files(spark, root).orderBy("shard").collect())
    plain = Tokenizer.from_file(PATH)
    ids = [x for _, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])) for x in plain.encode(text).ids + [0]]
    assert np.frombuffer(payload, "<u2").tolist() == ids  # the files are the raw ids in key order
    wanted = frame([("3", 399), ("3", 400), ("39", 0), ("40", 0), (None, 1), ("none", 0), ("39", 0)], "k string, copy int")
    assert sorted(((r.k, r.copy) for r in S.lookup(spark, root, wanted).collect()), key=str) == [("3", 399), ("39", 0), (None, 1)]


def test_empty_table(spark, frame):
    docs = frame([], SCHEMA)
    assert S.digests(docs, PATH).count() == 0


def test_text_keys(spark, frame):
    rows = [("b", "one two"), ("a\n", "three"), ("", "four")]
    assert rows_of(S.digests(frame(rows, "doc_id string, text string"), PATH)) == brute(rows)


@pytest.fixture(scope="module")
def encoders():
    with open(PATH, "rb") as file:
        return S.Encoder(file.read()), Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab '.\n\t1_é  \x1c😀sl|<>"), max_size=30) | st.text(max_size=30), min_size=1, max_size=4))
def test_pieces_give_the_ids_of_the_whole(encoders, texts):
    own, plain = encoders
    assert [np.frombuffer(b, "<u2").tolist() for b in own.packed(pa.array(texts, pa.string()))] == [plain.encode(t, add_special_tokens=False).ids + [0] for t in texts]


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 2 ** 32))
def test_hash_function_is_minimal_and_perfect(n, seed):
    rng = np.random.default_rng(seed)
    h1, h2, other = (rng.integers(0, 2 ** 64, n, dtype=np.uint64) for _ in range(3))
    made = S.hash_function(h1, h2)
    assert sorted(S.slots(h1, h2, *made).tolist()) == list(range(n))
    assert all(-1 <= s < n for s in S.slots(other, h2, *made).tolist())


def test_rows_are_looked_up_in_bounded_handfuls(monkeypatch):
    """2,048 common texts in one look-up, very long ones in several; every row once, in order."""
    texts = ["x" * 100] * 2000 + ["y" * 5000, None, "z" * 30_000] * 20
    batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(len(texts))]), pa.array(texts, pa.string())], names=["k", "t"])
    halves = [batch.slice(0, 1000), batch.slice(1000, 0), batch.slice(1000, 1000), batch.slice(2000)]
    assert [f.num_rows for f in S.handfuls(halves[:3])] == [2000]  # batches are joined
    monkeypatch.setattr(S, "BYTES", 20_000)
    found = list(S.handfuls(halves))
    assert [k for f in found for k in f.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(f.num_rows == 1 or sum(len(t or "") for t in f.column(1).to_pylist()) <= 20_000 for f in found)
    monkeypatch.setattr(S, "ROWS", 7)
    found = list(S.handfuls(halves))
    assert [k for f in found for k in f.column(0).to_pylist()] == batch.column(0).to_pylist() and max(f.num_rows for f in found) == 7
    assert list(S.handfuls([])) == []


def test_a_word_of_other_letters_and_a_stop_take_the_ids_of_the_word(monkeypatch):
    """The library does not see a known word again because a stop follows; new pieces go to it in short texts."""
    encode = S.Encoder(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    words = [f"ción{a}ó{b}ÿ" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    whole, seen = encode.whole, []
    monkeypatch.setattr(encode, "whole", lambda texts: (seen.extend(texts), whole(texts))[1])
    encode.packed(pa.array(["x " + " ".join(words)]))
    assert max(t.count(" ") for t in seen) <= 512
    seen.clear()
    text = "x " + " ".join(w + s for w in words for s in S.STOPS)
    got = encode.packed(pa.array([text]))
    assert seen == ["x"] and got == [np.append(whole([text])[0], S.END_ID).astype(encode.kind).tobytes()]


def test_index_is_made_without_reading_shards(spark, frame):
    """The places of all documents lie in one file a writing task, and are those of the footers."""
    rows = [(None, "none"), (None, "none"), (3, "the \x00 same")] + [(3, "the same")] * 40 + [(i, f"text {i}") for i in range(4, 90)]
    root = S.build(frame([(*r, 7) for r in rows], SCHEMA), PATH, shard_ids=30)
    found = S.entries(spark, root)
    names = [r.name for r in found.select(F.input_file_name().alias("name")).distinct().collect()]
    assert S.files(spark, root).count() > 10 and len(names) == 1 and "kind=keys" in names[0]
    footers = []
    for shard, content in S.files(spark, root).orderBy("shard").collect():
        listed, at, copy = S.footer_of(bytes(content))[1], 0, 0
        for i, (k, n) in enumerate(listed):
            copy = copy + 1 if i and k == listed[i - 1][0] else 0
            footers.append((shard, k == listed[0][0], k, copy, at, n))
            at += n
    assert [tuple(r) for r in found.orderBy("shard", "at").collect()] == footers and len(footers) == len(rows)


def test_a_shard_of_another_store_is_told(spark, frame):
    docs = frame([(i, "a text", 7) for i in range(5)], SCHEMA)
    root, other = S.build(docs, PATH), S.build(frame([(i, "a text more", 7) for i in range(5)], SCHEMA), PATH)
    spark.read.parquet(f"{root}/index").write.parquet(f"{other}/index", mode="overwrite")
    with pytest.raises(Exception, match="not the one that the index was made of"):
        S.read(spark, other, S.keys_of(docs)).count()


def test_reading_tasks_grow_with_the_shards(spark, frame):
    rows = [(i, f"text {i} of many words") for i in range(200)]
    docs = frame([(*r, 7) for r in rows], SCHEMA)
    root = S.build(docs, PATH, shard_ids=30)
    got, shards = S.read(spark, root, S.keys_of(docs)), S.files(spark, root).count()
    assert shards > 30 and got.rdd.getNumPartitions() == -(-shards // S.SHARDS_A_TASK)
    assert sorted(((int(r.k), r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in got.collect()), key=str) == brute(rows)
