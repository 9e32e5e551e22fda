import struct

import brute
import numpy as np
import pytest
import xxhash
import zstandard
from helpers import SF, documents, rows_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from arrears.llm import token_shards as T
from arrears.llm.common import scratch, table
from arrears.llm.queries import tokenizer_path

PATH = tokenizer_path()
ODD = ["", None, "It's 42 o'clock!!", "<|endoftext|> a<|endoftext|>b", "<|startoftext|>", "<|", "|>", "a | b < c", "É é ́x é", "x y z", "\x1c\x85 \x00 q",
       "日本語 テキスト 123٣٤", "😀👍🏽 ok", "DON'T we'LL", "a" * 5000, "\n\t \r", "ǅ İ ß ﬁ", "end\u0085line", "'s 't 're", "word. word, word!! (word). \"word\"). it's. dogs' dogs'. a.b.c. x... y,,; z-- <|endoftext|>. b|> c< d<. e|.",
       "é. ét. té, 1. 2, a1. 1a. w/ w_ w% ***w*** $$$ !!", "The. THE. the. İ. K. K"]


def test_driver_table(spark):
    docs = table(spark, SF, "documents")
    want = brute.tokens([(r.doc_id, r.text) for r in docs.collect()], Tokenizer.from_file(PATH))
    assert rows_of(T.token_report(docs, PATH)) == sorted(want, key=str)


def test_odd_texts_are_encoded_as_whole(spark):
    rows = list(enumerate(ODD)) + [(100 + i, f"{a} {b}") for i, (a, b) in enumerate(zip(ODD[2:], ODD[5:]))]
    want = brute.tokens(rows, Tokenizer.from_file(PATH))
    assert rows_of(T.token_report(documents(spark, rows, clash=True), PATH)) == sorted(want, key=str)


def test_repeats_nulls_and_empty_table(spark):
    rows = [(2, "b b"), (1, "a"), (2, "c"), (2, "b b"), (None, "n"), (3, None)]
    got = T.token_report(documents(spark, rows), PATH).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 2, 2, 3]
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    assert T.token_report(documents(spark, []), PATH).collect() == []


def _shards(spark, n=300, **kw):
    folder = scratch(spark, "tokens")
    docs = documents(spark, [(i, f"text number {i} " * (i % 50)) for i in range(n)])
    return T.with_start(T.write_shards(docs, PATH, folder, **kw).checkpoint()), folder


def test_frames_and_seek_table(spark):
    """Every frame stands alone and matches its checksum; the table at the end finds them."""
    index, folder = _shards(spark, frame_ids=500, shard_bytes=800)
    files = index.select("shard", "part").distinct().collect()
    assert len(files) > 3
    fs, path = T._open_fs(folder)
    for r in files:
        with fs.open_input_file(f"{path}/shard-{r['shard']:06d}-{r['part']:04d}.zst") as f:
            raw = f.read()
            frames = T.read_seek_table(f, f.size())
        back = [zstandard.ZstdDecompressor().decompress(raw[a : a + n]) for a, n, _, _, _ in frames.tolist()]
        assert [len(x) for x in back] == frames[:, 3].tolist()
        assert [xxhash.xxh64(x).intdigest() & 0xFFFFFFFF for x in back] == frames[:, 4].tolist()
        assert struct.unpack("<I", raw[-4:])[0] == 0x8F92EAB1
        whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()  # any reader sees one stream
        assert whole == b"".join(back)


def test_only_wanted_documents_are_read(spark):
    index, folder = _shards(spark, frame_ids=200)
    some = index.where(F.col("doc_id") % 37 == 0)
    got = {r["doc_id"]: bytes(r["ids"]) for r in T.read_shards(some, folder).collect()}
    tok = Tokenizer.from_file(PATH)
    for i in range(0, 300, 37):
        ids = [*tok.encode(f"text number {i} " * (i % 50), add_special_tokens=False).ids, 1]
        assert got[i] == struct.pack(f"<{len(ids)}I", *ids)
    assert len(got) == len(range(0, 300, 37))


def test_damage_is_noticed(spark, tmp_path):
    index, folder = _shards(spark, n=20)
    fs, path = T._open_fs(folder)
    r = index.first()
    name = f"{path}/shard-{r['shard']:06d}-{r['part']:04d}.zst"
    with fs.open_input_file(name) as f:
        raw = bytearray(f.read())
    table_at = len(raw) - 9 - 12
    raw[table_at + 8] ^= 1  # the checksum of the last frame
    T.put_file(folder, name.rsplit("/", 1)[1], [bytes(raw)])
    with pytest.raises(Exception, match="checksum"):
        T.read_shards(index, folder).collect()


def test_tokenizers_that_are_not_word_by_word(spark):
    """A byte-level vocabulary keeps white space: its texts are encoded whole."""
    path = tokenizer_path("byte_bpe_50k.json")
    rows = list(enumerate(ODD))
    want = brute.tokens(rows, Tokenizer.from_file(path))
    assert not T._tokenizer(path).by_word and T._tokenizer(PATH).by_word
    assert rows_of(T.token_report(documents(spark, rows), path)) == sorted(want, key=str)
