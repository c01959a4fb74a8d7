"""Token files: ids against the tokenizer on whole texts, round trips, single documents, damage."""

import os
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from skyledger.llm import token_files as T

WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, shard string, ids string"


def texts_of_all_sorts():
    rng = random.Random(9)
    odd = ["", " ", "\t\n\x0b\x0c\r", "Hello, World!!", "it's we're I'll 'S 'T", "a.b,c;d", "x y z\x1c\x85w", "é ́ Å Σ ΟΔΟΣ. Σας", "漢字カナ テスト。", "<|endoftext|> a<|startoftext|>b.", "🙂👩‍👩‍👧 ok",
           "1234 5.6%", "...", "\"quoted\" (x) [y]", "İstanbul ǅ ß ﬁ", "​zero​width", "a" * 3000, "Ⅷ ² ½ ١٢٣", "taiĺ.", "x'", "don't.", "'", "\x00\x01"]
    pieces = odd + ["the", "Of", "and.", "ering,", "été", "ÜBER", "naïve!", "\n", "  ", "̀", "ﬀ.", "'ve", "_", "—", "ä?"]
    return odd + ["".join(rng.choice(pieces) + rng.choice([" ", "", "\n"]) for _ in range(rng.randrange(1, 40))) for _ in range(300)]


def test_ids_are_those_of_whole_texts():
    texts, plain = texts_of_all_sorts(), Tokenizer.from_file(WORDS)
    encoder = T.Encoder.load(WORDS)
    assert encoder.wordwise
    for chunk in (texts, texts[::-1]):
        ids, sizes = encoder.encode(pa.array(chunk))
        got = np.split(ids, np.cumsum(sizes)[:-1])
        for text, own in zip(chunk, got):
            assert own.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_special_tokens_in_other_case_are_plain_text():
    """Special tokens are matched before letters are lower-cased."""
    texts, plain = ["<|ENDOFTEXT|>", "a<|EndOfText|>b. <|endoftext|>", "X<|STARTOFTEXT|>, A<B <B>"], Tokenizer.from_file(WORDS)
    ids, sizes = T.Encoder.load(WORDS).encode(pa.array(texts))
    assert [own.tolist() for own in np.split(ids, np.cumsum(sizes)[:-1])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_piece_is_encoded_once():
    """Words of one piece and different ends, and in later slices, cost the tokenizer nothing more, also after others have been forgotten."""
    encoder, learned = T.Encoder(WORDS), []
    learn = encoder._learn
    encoder._learn = lambda new: learned.extend(new.to_pylist()) or learn(new)
    texts = ["Alpha, alpha. (beta) ALPHA", "alpha! été, été", "", None, "beta; alpha"]
    for _ in range(3):
        encoder.encode(pa.array(texts).fill_null(""))
    assert sorted(learned) == sorted({"alpha", ",", ".", "(beta)", "!", "été", "beta", ";"} - {"(beta)"} | {"(beta"} | {")"})


def test_remembered_pieces_take_little_memory():
    """An encoder holds columns of bytes and numbers, no object for each piece: some 30 bytes, where a str, a tuple and their place in a dict took over 200."""
    encoder, before = T.Encoder(WORDS), pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        for k in range(10):
            encoder.encode(pa.array([" ".join(f"q{10_000 * k + i}" for i in range(10_000))]))
        held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    finally:
        tracemalloc.stop()
    assert held < 100_000 * 100


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts, plain, encoder = texts_of_all_sorts()[:60], Tokenizer.from_file(path), T.Encoder.load(path)
    assert not encoder.wordwise
    ids, sizes = encoder.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in plain.encode(t, add_special_tokens=False).ids] and sizes.sum() == len(ids)


@pytest.fixture
def written(spark, tmp_path):
    rows = [(i * 2, t, "s", "x") for i, t in enumerate(texts_of_all_sorts())] + [(None, "no id", "s", "x"), (4, "same id", "s", "x"), (6, None, "s", "x"), (6, None, "s", "x"), (900, "word " * 5000, "s", "x")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return rows, T.write_token_files(docs, f"file://{tmp_path}/tokens", WORDS, end_id=2, frame_ids=512), f"{tmp_path}/tokens"


def test_round_trip(spark, written):
    rows, manifest, folder = written
    plain = Tokenizer.from_file(WORDS)
    got = sorted(T.read_token_files(spark, manifest).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in got]
    assert ids == sorted([r[0] for r in rows], key=lambda i: (i is not None, i or 0))
    want = sorted((str(i), np.array(plain.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for i, t, *_ in rows)
    assert sorted((str(r["doc_id"]), bytes(r["ids"])) for r in got) == want
    at = 0
    for r in got:
        assert r["start"] == at
        at += len(r["ids"]) // 4
    digests = {(r["doc_id"], r["start"]): (r["n_tokens"], r["ids_crc32"]) for r in T.token_digests(T.read_token_files(spark, manifest)).collect()}
    assert digests == {(r["doc_id"], r["start"]): (len(r["ids"]) // 4, zlib.crc32(r["ids"])) for r in got}
    assert not [f for f in os.listdir(folder) if f.startswith(".writing")]


def test_only_wanted_frames_are_read(spark, written):
    rows, manifest, folder = written
    wanted = spark.createDataFrame([(900,), (10,), (10,), (123456,)], "doc_id bigint")
    assert sorted(r["doc_id"] for r in T.read_token_files(spark, manifest, wanted).collect()) == [10, 900]
    for file in manifest.collect():
        with pa.OSFile(file["path"].removeprefix("file://")) as source:
            reader = T.FileReader(source)
            assert len(reader.entries) > 3
            reader.ids(0)
            assert reader.frames_read <= 1 + reader.sizes[0] // 512


def test_any_zstandard_reader_and_damage(written):
    _, manifest, _ = written
    path = manifest.first()["path"].removeprefix("file://")
    data = open(path, "rb").read()
    with pa.OSFile(path) as source:
        reader = T.FileReader(source)
        whole = b"".join(reader.ids(k) for k in range(len(reader.docs)))
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain == whole
    broken = bytearray(data)
    broken[int(reader.at[1]) + int(reader.entries[1, 0]) // 2] ^= 255
    damaged = T.FileReader(pa.BufferReader(bytes(broken)))
    damaged.frame(0)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        damaged.frame(1)
    with pytest.raises(ValueError):
        T.FileReader(pa.BufferReader(data[:-1]))


def test_empty_table(spark, tmp_path):
    manifest = T.write_token_files(spark.createDataFrame([], SCHEMA), f"file://{tmp_path}/none", WORDS, end_id=2)
    assert T.read_token_files(spark, manifest).collect() == []
