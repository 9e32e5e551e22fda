"""Token ids in shards of independent zstandard frames with a trailing seek table.

Documents are dealt to shards by range of doc_id, tokenised there (each distinct
word of a batch once) and written as frames of little-endian 32-bit ids.
The last frame of a shard is a skippable one that lists every frame's
compressed size, decompressed size and checksum, so a reader seeks to the
frames of the documents it wants and decompresses those only.

Layout of the trailing table (the public seekable format):
    0x184D2A5E, size of what follows, then for each frame (compressed size,
    decompressed size, low 32 bits of XXH64 of the content), then
    (number of frames, 0x80, 0x8F92EAB1); all little-endian 32-bit but the 0x80 byte.

Cases: a null or empty text is written as the end id alone; null ids come first;
rows with one doc_id stand in the order of a hash of their text, each with its own row; an empty table gives no shard and an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import json
import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import SLICE_BYTES, cut, scratch, text_slices, word_hashes, word_spans

END_ID = 1
FRAME_IDS = 1 << 16
#: Words that go through the tokenizer as one string.
WORDS_AT_ONCE = 1 << 14
#: Text whose distinct words are looked for together.
TEXT_BYTES = 24 << 20
SHARD_BYTES = 256 << 20

_tokenizers: dict = {}


#: The word put between words that go through the tokenizer together.
BETWEEN = "0"


@dataclass(frozen=True)
class Words:
    """A tokenizer file in use.

    ``by_word``: it drops white space and joins nothing across it, so a text's ids are its words' ids in turn;
    ``between``: the one id of the word ``BETWEEN``; ``folds``: it lower-cases; ``marks``: it joins no letter with
    the punctuation after it.
    """

    tok: object
    by_word: bool
    between: int
    folds: bool
    marks: bool


def _tokenizer(path: str) -> Words:
    """The tokenizer of a file, loaded once by each worker."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        ids = lambda x: tok.encode(x, add_special_tokens=False).ids
        pairs = (("a", "b"), ("it's", "'s"), ("1", "2."), (".", "the"), ("é!", "?"), (BETWEEN, BETWEEN), ("x", BETWEEN))
        by_word = len(ids(BETWEEN)) == 1 and all(ids(f"{a}{w}{b}") == ids(a) + ids(b) for a, b in pairs for w in (" ", "\n", " \t "))
        named = (json.loads(tok.to_str()).get("normalizer") or {}).get("normalizers", [])
        ends = (".", ",", ";", ":", "!", "?", ")", '"', "...", "!!", "***", "$$$", '").', "-", "/", "_", "%")
        marks = all(ids(w + m) == ids(w) + ids(m) for w in ("the", "of", "a", "word", "xqzv", "It", "www", "é" + "t") for m in ends)
        _tokenizers[path] = Words(tok, by_word, ids(BETWEEN)[0] if by_word else -1, any(n["type"] == "Lowercase" for n in named), marks)
    return _tokenizers[path]


def encode_words(words: list[bytes], use: Words) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words, number of ids of each).

    Many words go through the tokenizer as one string with a known word between them; none of them may hold that
    word's character, so its id marks where each ends.
    """
    ids, sizes = [], np.zeros(len(words), np.int64)
    sep = f" {BETWEEN} ".encode()
    for k in range(0, len(words), WORDS_AT_ONCE):
        part = words[k : k + WORDS_AT_ONCE]
        got = np.array(use.tok.encode_batch_fast([sep.join(part).decode("utf-8")], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(got == use.between)
        sizes[k : k + len(part)] = np.diff(np.concatenate([[-1], ends, [len(got)]])) - 1
        ids.append(np.delete(got, ends))
    return np.concatenate([*ids, np.zeros(0, np.uint32)]), sizes


_LETTER = np.array([chr(i).isalpha() and i < 128 for i in range(256)])
#: Punctuation that can be taken off a word's end: not the apostrophe, which begins contractions, nor parts of special tokens.
_MARK = np.array([32 < i < 127 and not chr(i).isalnum() and chr(i) not in "'<|" for i in range(256)])


def split_marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans with the punctuation at a word's end, after an ASCII letter, as a word of its own."""
    at = ends.copy()  # where the marks at the end of each word begin
    live = np.flatnonzero(_MARK[data[ends - 1]])
    while len(live):
        at[live] -= 1
        live = live[(at[live] > starts[live]) & _MARK[data[np.maximum(at[live] - 1, 0)]]]
    cut_here = (at > starts) & (at < ends)
    cut_here[cut_here] = _LETTER[data[at[cut_here] - 1]]
    i = np.flatnonzero(cut_here)
    more = np.concatenate([[0], np.cumsum(cut_here)])
    return np.insert(starts, i + 1, at[i]), np.insert(ends, i, at[i]), before + more[before]


def _words(data: np.ndarray, offs: np.ndarray, use: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the words to encode and the number of them before each text, found in parts that fit a cache."""
    starts, ends, before, n, lo = [], [], [np.zeros(1, np.int64)], 0, 0
    while lo < len(offs) - 1:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + SLICE_BYTES, "right")) - 1)
        part, at = data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        s, e, b = word_spans(part, at)
        if use.marks and len(s):
            s, e, b = split_marks(part, s, e, b)
        starts.append(s + offs[lo])
        ends.append(e + offs[lo])
        before.append(b[1:] + n)
        n, lo = n + len(s), hi
    none = [np.zeros(0, np.int64)]
    return np.concatenate(starts or none), np.concatenate(ends or none), np.concatenate(before)


_ODD = np.isin(np.arange(256), list(b"<|" + BETWEEN.encode()))


def encode_each(texts: list[bytes], use: Words) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, number of ids of each), each text on its own."""
    ids, sizes = [], []
    for k in range(0, len(texts), 1024):
        for e in use.tok.encode_batch_fast([x.decode("utf-8") for x in texts[k : k + 1024]], add_special_tokens=False):
            ids.append(np.array(e.ids, np.uint32))
            sizes.append(len(ids[-1]))
    return np.concatenate([*ids, np.zeros(0, np.uint32)]), np.array(sizes, np.int64)


def encode_slice(data: np.ndarray, offs: np.ndarray, use: Words, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offsets of each text's ids), the end id last in each.

    Where the tokenizer drops white space and joins nothing across it, every distinct word is encoded once.
    """
    raw = data.tobytes()
    if not use.by_word:
        ids, size = encode_each([raw[a:b] for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)], use)
        ends = np.cumsum(size)
        return np.insert(ids, ends, end_id), np.concatenate([[0], ends + np.arange(1, len(size) + 1)])
    starts, ends, before = _words(data, offs, use)
    # Words that hold the word between, or that may hold part of a special token, are taken as they stand, one by one.
    odd = np.zeros(len(starts), bool)
    odd[np.searchsorted(ends, np.flatnonzero(_ODD[data]), "right")] = True
    keys = word_hashes(data, starts, ends, lower=use.folds)
    for i, a, b in zip(np.flatnonzero(odd).tolist(), starts[odd].tolist(), ends[odd].tolist(), strict=True):
        keys[i] = xxhash.xxh64_intdigest(raw[a:b])
    keys, first, back = np.unique(keys, return_index=True, return_inverse=True)
    n_keys, lone_first = len(keys), odd[first]
    rank = np.argsort(lone_first, kind="stable")
    plain = n_keys - int(lone_first.sum())
    place = np.empty(n_keys, np.int32)
    place[rank] = np.arange(n_keys, dtype=np.int32)
    # The sequence of words with the end id after each text's last word.
    order = np.insert(place[back], before[1:], n_keys)
    a, b = starts[first[rank]].tolist(), ends[first[rank]].tolist()
    del keys, back, odd, starts, ends, place
    word = lambda lo, hi: [raw[x:y] for x, y in zip(a[lo:hi], b[lo:hi], strict=True)]
    ids, size = encode_words(word(0, plain), use)
    lone, lone_size = encode_each(word(plain, n_keys), use)
    flat = np.concatenate([ids, lone, np.array([end_id], np.uint32)])
    size = np.concatenate([size, lone_size, [1]])
    begin = np.cumsum(size) - size
    stops = np.flatnonzero(order == n_keys)
    out = np.empty(int(size[order].sum()), np.uint32)
    ends_at, done = np.zeros(len(stops) + 1, np.int64), 0
    for k in range(0, len(order), 1 << 18):
        part = order[k : k + (1 << 18)]
        m = size[part]
        at = np.cumsum(m) - m
        hi = int(m.sum())
        out[done : done + hi] = flat[np.repeat(begin[part] - at, m) + np.arange(hi)]
        x, y = np.searchsorted(stops, (k, k + len(part)))
        ends_at[x + 1 : y + 1] = done + at[stops[x:y] - k] + 1
        done += hi
    return out, ends_at


def _open_fs(folder: str):
    fs, path = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
    return fs, path.rstrip("/")


def put_file(folder: str, name: str, parts) -> None:
    """Write a file whole: under a name of its own first, then moved, so a repeated task replaces it."""
    import uuid

    fs, path = _open_fs(folder)
    fs.create_dir(path, recursive=True)
    own = f"{path}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as f:
        for p in parts:
            f.write(p)
    try:
        fs.move(own, f"{path}/{name}")
    except OSError:  # a store that does not replace: an earlier attempt of the same task left the same file
        if fs.get_file_info(f"{path}/{name}").type == pafs.FileType.NotFound:
            raise
        fs.delete_file(f"{path}/{name}")
        fs.move(own, f"{path}/{name}")


def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    body = b"".join(struct.pack("<III", *x) for x in frames) + struct.pack("<IBI", len(frames), 0x80, 0x8F92EAB1)
    return struct.pack("<II", 0x184D2A5E, len(body)) + body


def read_seek_table(f, size: int) -> np.ndarray:
    """Rows of (compressed offset, compressed size, decompressed offset, decompressed size, checksum)."""
    f.seek(size - 9)
    n, flag, magic = struct.unpack("<IBI", f.read(9))
    if magic != 0x8F92EAB1 or flag != 0x80:
        raise ValueError("no seek table at the end of the shard")
    f.seek(size - 9 - 12 * n - 8)
    if struct.unpack("<II", f.read(8)) != (0x184D2A5E, 12 * n + 9):
        raise ValueError("the seek table has another size")
    t = np.frombuffer(f.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
    return np.column_stack([np.cumsum(t[:, 0]) - t[:, 0], t[:, 0], np.cumsum(t[:, 1]) - t[:, 1], t[:, 1], t[:, 2]])


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES, frame_ids: int = FRAME_IDS) -> DataFrame:
    """Deal the documents to shards by range of doc_id, tokenise and write them.

    A row per document: doc_id, shard, part, at (first id in the file), n_tokens.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("part", pa.int32()), ("at", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        use = _tokenizer(tokenizer)
        shard = TaskContext.get().partitionId()
        z = zstandard.ZstdCompressor(level=3, write_content_size=True)
        part, frames, blobs, size, buf, held, at = 0, [], [], 0, [], 0, 0

        def frame():
            nonlocal buf, held, size
            if held:
                raw = b"".join(buf)
                blobs.append(z.compress(raw))
                size += len(blobs[-1])
                frames.append((len(blobs[-1]), len(raw), xxhash.xxh64(raw).intdigest() & 0xFFFFFFFF))
                buf, held = [], 0

        def close():
            nonlocal part, frames, blobs, size, at
            frame()
            if frames:
                put_file(folder, f"shard-{shard:06d}-{part:04d}.zst", [*blobs, seek_table(frames)])
                part, frames, blobs, size, at = part + 1, [], [], 0, 0

        for b in batches:
            for lo, hi, data, offs in text_slices(b, "text", TEXT_BYTES):
                ids, ends = encode_slice(data, offs, use, end_id)
                raw = ids.astype("<u4").tobytes()
                where = []
                for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    where.append((part, at, y - x))
                    at += y - x
                    buf.append(raw[4 * x : 4 * y])
                    held += y - x
                    if held >= frame_ids:
                        frame()
                    if size >= shard_bytes:
                        close()
                p, first, n = zip(*where, strict=True)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), pa.array([shard] * len(p), pa.int32()), pa.array(p, pa.int32()), pa.array(first, pa.int64()), pa.array(n, pa.int64())], schema=schema)
        close()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "doc_id long, shard int, part int, at long, n_tokens long")


def _read(index: DataFrame, folder: str, schema: pa.Schema, ddl: str, row) -> DataFrame:
    """``row(index row, ids bytes)`` of each index row, read from its shard.

    Only the frames that hold a wanted document are decompressed, and each is checked against its checksum.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open_fs(folder)
        z = zstandard.ZstdDecompressor()
        name, f, frames, last = None, None, None, (None, b"")
        for b in batches:
            out = []
            for r in b.to_pylist():
                want = f"{path}/shard-{r['shard']:06d}-{r['part']:04d}.zst"
                if want != name:
                    if f is not None:
                        f.close()
                    name, last = want, (None, b"")
                    f = fs.open_input_file(want)
                    frames = read_seek_table(f, f.size())
                    begins = frames[:, 2].tolist()
                lo, hi = 4 * r["at"], 4 * (r["at"] + r["n_tokens"])
                k = bisect.bisect_right(begins, lo) - 1
                got = []
                while k < len(begins) and begins[k] < hi:
                    if last[0] != k:
                        f.seek(int(frames[k, 0]))
                        raw = z.decompress(f.read(int(frames[k, 1])), max_output_size=int(frames[k, 3]))
                        if xxhash.xxh64(raw).intdigest() & 0xFFFFFFFF != frames[k, 4]:
                            raise ValueError(f"{want}: frame {k} does not match its checksum")
                        last = (k, raw)
                    got.append(last[1][max(0, lo - begins[k]) : hi - begins[k]])
                    k += 1
                out.append(row(r, got[0] if len(got) == 1 else b"".join(got)))
                if len(out) >= 512:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if f is not None:
            f.close()

    cols = ["doc_id", "shard", "part", "at", "n_tokens", "start"]
    near = index.select(*cols).repartition("shard", "part", F.floor(F.col("at") / (64 * FRAME_IDS))).sortWithinPartitions("shard", "part", "at")
    return near.mapInArrow(run, ddl)


def read_shards(index: DataFrame, folder: str) -> DataFrame:
    """Read documents back: doc_id, start, n_tokens and ``ids`` (little-endian 32-bit) of the index rows given."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    row = lambda r, ids: {"doc_id": r["doc_id"], "start": r["start"], "n_tokens": len(ids) // 4, "ids": ids}
    return _read(index, folder, schema, "doc_id long, start long, n_tokens long, ids binary", row)


def digest_shards(index: DataFrame, folder: str) -> DataFrame:
    """Read documents back and return their ids' CRC-32 in place of the ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    row = lambda r, ids: {"doc_id": r["doc_id"], "start": r["start"], "n_tokens": len(ids) // 4, "ids_crc32": zlib.crc32(ids)}
    return _read(index, folder, schema, "doc_id long, start long, n_tokens long, ids_crc32 long", row)


def with_start(index: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all documents before, by one sum per shard file."""
    files = index.groupBy("shard", "part").agg(F.sum("n_tokens").alias("_n"))
    before = files.select("shard", "part", (F.sum("_n").over(Window.orderBy("shard", "part")) - F.col("_n")).alias("_before"))  # a row for each file
    return index.join(before, ["shard", "part"]).withColumn("start", F.col("_before") + F.col("at")).drop("_before")


def shard_corpus(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID) -> tuple[DataFrame, str]:
    """Tokenise and write; (index with start, folder)."""
    folder = folder or scratch(docs.sparkSession, "tokens")
    index = cut(write_shards(docs, tokenizer, folder, end_id))
    return with_start(index), folder


def token_report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the shards read back."""
    index, folder = shard_corpus(docs, tokenizer)
    return digest_shards(index, folder)
