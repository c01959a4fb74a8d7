"""Documents as token ids in seekable Zstandard files (operator 9).

A file holds the ids of a range of documents as unsigned 32-bit little-endian integers:

    independent Zstandard frames | skippable frame with the documents' ids and sizes | skippable frame with the seek table

The seek table is that of Zstandard's public seekable format: compressed size, plain size and the low half of XXH64 of the plain bytes for
each frame, then a footer. A document of up to FRAME_IDS ids lies in one frame, a longer one has frames of its own, so a reader finds a document's
frames from the end of the file, decompresses only those, and checks each. The frame of the document index counts with a plain size of 0.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.words import ALNUM, slices, text_bytes
from skyledger.llm.workers import give_back, give_back_pages, keeps
from skyledger.workspace import Workspace

#: ids in a frame, 256 KB
FRAME_IDS = 1 << 16
#: pieces of words whose ids a worker remembers, and bytes of text that it encodes at a time
REMEMBERED, ENCODED = 300_000, 1 << 21
#: pieces whose encodings, objects of some hundred bytes, are held at once
LEARNED = 1 << 12
LEVEL = 3

# Fixed values of the file format.
INDEX_MAGIC, SEEK_MAGIC, FOOTER_MAGIC, HAS_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80

MANIFEST = "shard int, path string, n_docs bigint, n_ids bigint"
READ = "doc_id bigint, start bigint, ids binary"


# --- ids of words ----------------------------------------------------------------------------------------------------------


class Encoder:
    """Ids of texts. A tokenizer that drops white space and lower-cases gives a text's ids word by word, so each distinct piece of a word is encoded once.

    The ids are those of the tokenizer on the whole text: nothing in its normalizer or its splitting looks across white space, and letters
    are split from the punctuation after them. Any other tokenizer gets whole texts.
    """

    #: what the normalizer and the splitter must be for that
    WORDWISE = [["NFC", "Replace", "Lowercase"], "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"]
    #: punctuation that ends a word; no apostrophe, and nothing that special tokens consist of
    TAIL = ".,;:!?%$#&*\"()[]"
    #: what special tokens begin with; they are matched before the tokenizer lower-cases
    SPECIAL = "<"
    _loaded: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        normal, split = rules["normalizer"] or {}, (rules["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        form = [[x["type"] for x in normal.get("normalizers", [])], split[0].get("pattern", {}).get("Regex")]
        special = [x["content"] for x in rules["added_tokens"]]
        self.wordwise = form == self.WORDWISE and all(x.startswith(self.SPECIAL) and not set(x) & set(self.TAIL + " \t\n\v\f\r") for x in special)
        self._forget()

    @classmethod
    def load(cls, path: str) -> Encoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of each text."""
        if not self.wordwise:
            found = [x.ids for x in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(x) for x in found], np.int64)
        words = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        bounds, places = words.offsets.to_numpy() - words.offsets[0].as_py(), words.flatten().dictionary_encode()
        del words
        ids, sizes = self._words(places.dictionary)
        which = places.indices.to_numpy()
        taken = sizes[which]
        flat = _gather(ids, (np.cumsum(sizes) - sizes)[which], taken)
        return flat, np.diff(np.append(0, np.cumsum(taken))[bounds])

    def _forget(self) -> None:
        """Known pieces, the ids of all of them in order, and where those of each begin and how many they are."""
        self.pieces, self.ids = pa.array([""], pa.large_string()), np.zeros(0, np.uint32)
        self.starts, self.sizes = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pieces) > REMEMBERED:
            self._forget()
        parts = self._parts(words).dictionary_encode()
        at = pc.index_in(parts.dictionary, value_set=self.pieces)
        new, at = at.is_null(), at.fill_null(-1).to_numpy().copy()
        at[at < 0] = self._learn(parts.dictionary.filter(new))
        which = at[parts.indices.to_numpy()]
        sizes = self.sizes[which]
        return _gather(self.ids, self.starts[which], sizes), sizes.reshape(-1, 2).sum(axis=1)

    def _parts(self, words: pa.Array) -> pa.Array:
        """Head and tail of each word in turn; both are ranges of the words' own bytes, with A-Z as a-z where that comes to the same."""
        data, bounds = text_bytes(words)
        begins, ends = bounds[:-1], bounds[1:]
        heads = pc.ascii_rtrim(words, characters=self.TAIL)
        cuts = begins + pc.binary_length(heads).to_numpy()
        last = np.append(data, np.uint8(0))[cuts - 1]  # of an empty head some other byte, looked at by none
        apart = (begins < cuts) & (cuts < ends)
        far = np.flatnonzero(apart & (last > 127))
        apart &= ALNUM[last]
        apart[far] = [head[-1].isalnum() for head in heads.take(pa.array(far)).to_pylist()]
        odd = np.append(0, np.cumsum((data > 127) | (data == ord(self.SPECIAL))))[bounds]
        upper = (data >= 65) & (data <= 90) & np.repeat(np.diff(odd) == 0, np.diff(bounds))
        inner = np.empty(2 * len(words) + 1, np.int64)
        inner[::2], inner[1::2] = bounds, np.where(apart, cuts, ends)
        return pa.LargeStringArray.from_buffers(2 * len(words), pa.py_buffer(inner), pa.py_buffer(data + 32 * upper.astype(np.uint8)))

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Have the tokenizer encode pieces, and return their places among the known ones. Lower-case letters are one word to it, which its model splits."""
        letters = pc.and_(pc.string_is_ascii(new), pc.ascii_is_alpha(new))
        words, others = new.filter(letters), new.filter(pc.invert(letters))
        model, ids, sizes = self.tokenizer.model, [], []
        for word in words.to_numpy(zero_copy_only=False):
            own = [x.id for x in model.tokenize(word)]
            ids += own
            sizes.append(len(own))
        for at in range(0, len(others), LEARNED):
            for found in self.tokenizer.encode_batch_fast(others.slice(at, LEARNED).to_numpy(zero_copy_only=False).tolist(), add_special_tokens=False):
                own = found.ids
                ids += own
                sizes.append(len(own))
        sizes = np.array(sizes, np.int64)
        places = np.empty(len(new), np.int64)
        places[np.argsort(~letters.to_numpy(zero_copy_only=False), kind="stable")] = len(self.pieces) + np.arange(len(new))
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(sizes) - sizes)
        self.sizes = np.append(self.sizes, sizes)
        self.pieces, self.ids = pa.concat_arrays([self.pieces, words, others]), np.append(self.ids, np.array(ids, np.uint32))
        return places


def _gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranges of ``values`` one after the other."""
    ends = np.cumsum(sizes)
    places = np.repeat(starts - ends + sizes, sizes)
    places += np.arange(len(places))
    return values[places]


keeps(Encoder._loaded.clear)


# --- one file --------------------------------------------------------------------------------------------------------------


class FileWriter:
    """Writes one file: documents in order, each with its id (or None) and token ids."""

    def __init__(self, sink, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        self.sink, self.frame_ids, self.zstd = sink, frame_ids, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.entries, self.docs, self.sizes = [], [], []
        self.pending, self.n_pending = [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.sizes.append(len(ids))
        if self.n_pending + len(ids) > self.frame_ids:
            self._flush()
        for at in range(0, len(ids), self.frame_ids):
            self.pending.append(ids[at : at + self.frame_ids])
            self.n_pending += len(self.pending[-1])
            if len(ids) > self.frame_ids:
                self._flush()

    def _flush(self) -> None:
        if self.n_pending:
            self._frame(np.concatenate(self.pending))
        self.pending, self.n_pending = [], 0

    def _frame(self, ids: np.ndarray) -> None:
        plain = ids.astype("<u4").tobytes()
        packed = self.zstd.compress(plain)
        self.sink.write(packed)
        self.entries.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))

    def close(self) -> None:
        self._flush()
        known = np.array([d is not None for d in self.docs], np.uint8)
        index = struct.pack("<Q", len(self.docs)) + np.array([d or 0 for d in self.docs], "<i8").tobytes() + np.array(self.sizes, "<u8").tobytes() + known.tobytes()
        self.sink.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.entries.append((len(index) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        table = np.array(self.entries, "<u4").tobytes() + struct.pack("<IBI", len(self.entries), HAS_CHECKSUMS, FOOTER_MAGIC)
        self.sink.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)


class FileReader:
    """Reads the seek table and the document index of one file, then any documents."""

    def __init__(self, source):
        self.source, size = source, source.size()
        source.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != FOOTER_MAGIC or flags != HAS_CHECKSUMS:
            raise ValueError("not a token file: it does not end with a seek table")
        source.seek(size - 9 - 12 * n)
        self.entries = np.frombuffer(source.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.at = np.cumsum(self.entries[:, 0]) - self.entries[:, 0]
        source.seek(int(self.at[-1]) + 8)
        index = source.read(int(self.entries[-1, 0]) - 8)
        (m,) = struct.unpack_from("<Q", index)
        self.docs, self.sizes = np.frombuffer(index, "<i8", m, 8), np.frombuffer(index, "<u8", m, 8 + 8 * m).astype(np.int64)
        self.known = np.frombuffer(index, np.uint8, m, 8 + 16 * m).astype(bool)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.frame_ends = np.cumsum(self.entries[:-1, 1]) // 4
        self.frames_read, self._held = 0, (-1, b"")

    def frame(self, k: int) -> bytes:
        if self._held[0] != k:
            self.source.seek(int(self.at[k]))
            plain = zstandard.ZstdDecompressor().decompress(self.source.read(int(self.entries[k, 0])), max_output_size=int(self.entries[k, 1]))
            if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.entries[k, 2]:
                raise ValueError(f"frame {k} does not match its checksum")
            self._held, self.frames_read = (k, plain), self.frames_read + 1
        return self._held[1]

    def ids(self, row: int) -> bytes:
        """Token ids of the row-th document, as bytes."""
        start, end, out = int(self.starts[row]), int(self.starts[row] + self.sizes[row]), []
        while start < end:
            k = int(np.searchsorted(self.frame_ends, start, side="right"))
            begin, upto = int(self.frame_ends[k] - self.entries[k, 1] // 4), min(end, int(self.frame_ends[k]))
            out.append(self.frame(k)[4 * (start - begin) : 4 * (upto - begin)])
            start = upto
        return out[0] if len(out) == 1 else b"".join(out)


# --- on Spark --------------------------------------------------------------------------------------------------------------


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = None, id_column: str = "doc_id", text_column: str = "text", frame_ids: int = FRAME_IDS) -> DataFrame:
    """Write the documents as token files in ascending order of their id and return the manifest (shard, path, n_docs, n_ids).

    ``folder`` is an address that the executors can write, ``tokenizer`` the path of a tokenizer file. ``end_id`` ends each document.
    Null and empty texts have the end id only. A null id comes first. Documents that share an id are all written, in the order of a hash of
    their text; equal rows are written as often as they come. An empty table gives no file. Other columns are not read. A task writes a
    file under a name of its own and then moves it to its place, so a task that runs again or twice leaves one whole file.
    """
    order: list[str | Column] = ["doc_id", "_tie"]
    ranged = (
        docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
        .withColumn("_tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie").withColumn("shard", F.spark_partition_id())
    )
    end = np.array([] if end_id is None else [end_id], np.uint32)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        writer = sink = shard = None
        n_docs = n_ids = 0
        for batch in batches:
            for part in slices(batch, limit=ENCODED):
                if writer is None:
                    shard = part.column(2)[0].as_py()
                    store.create_dir(base)
                    own = f"{base}/.writing-{shard:06d}-{os.getpid()}-{os.urandom(6).hex()}"
                    sink = store.open_output_stream(own)
                    writer = FileWriter(sink, frame_ids)
                ids, sizes = Encoder.load(tokenizer).encode(part.column(1).fill_null(""))
                for doc, own_ids in zip(part.column(0).to_pylist(), np.split(ids, np.cumsum(sizes)[:-1])):
                    own_ids = np.concatenate([own_ids, end])
                    writer.add(doc, own_ids)
                    n_docs, n_ids = n_docs + 1, n_ids + len(own_ids)
                give_back_pages()
        if writer is not None:
            writer.close()
            sink.close()
            store.move(own, f"{base}/tokens-{shard:06d}.zst")
            give_back()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [f"{folder}/tokens-{shard:06d}.zst"], "n_docs": [n_docs], "n_ids": [n_ids]})

    return Workspace(docs.sparkSession).materialize(ranged.mapInArrow(write, MANIFEST), "manifest")[0]


def read_token_files(spark: SparkSession, manifest: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Documents of token files: doc_id, start (ids of all documents before it) and ids (little-endian unsigned 32-bit integers).

    With ``wanted`` (a DataFrame with a column doc_id) only its documents are read, and only the frames that hold them.
    """
    before = F.sum("n_ids").over(Window.orderBy("shard")) - F.col("n_ids")  # a row for each file
    files = manifest.select("shard", "path", before.alias("base"))
    n_files = max(1, manifest.count())
    if wanted is None:
        files = files.withColumn("pick", F.lit(None).cast("array<bigint>"))
    else:
        places = read_index(manifest).join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
        files = files.join(places.groupBy("shard").agg(F.array_sort(F.collect_list("row")).alias("pick")), "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(file["path"])
                with store.open_input_file(path) as source:
                    reader = FileReader(source)
                    out, held = [], 0
                    for row in range(len(reader.docs)) if file["pick"] is None else file["pick"]:
                        ids = reader.ids(row)
                        out.append((int(reader.docs[row]) if reader.known[row] else None, file["base"] + int(reader.starts[row]), ids))
                        held += len(ids)
                        if held > 1 << 22:
                            yield _rows(out)
                            out, held = [], 0
                    if out:
                        yield _rows(out)

    return files.repartitionByRange(n_files, "shard").mapInArrow(read, READ)


def read_index(manifest: DataFrame) -> DataFrame:
    """The documents of token files (shard, row, doc_id) from their indexes; no frame is read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(file["path"])
                with store.open_input_file(path) as source:
                    reader = FileReader(source)
                m = len(reader.docs)
                yield pa.RecordBatch.from_pydict({"shard": pa.array(np.full(m, file["shard"], np.int32)), "row": pa.array(np.arange(m)), "doc_id": pa.array(reader.docs, mask=~reader.known)})

    return manifest.repartitionByRange(max(1, manifest.count()), "shard").mapInArrow(read, "shard int, row bigint, doc_id bigint")


def _rows(out: list[tuple]) -> pa.RecordBatch:
    docs, starts, ids = zip(*out)
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "start", "ids"])


def token_digests(documents: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids of documents as ``read_token_files`` gives them."""
    n_tokens = (F.octet_length("ids") / 4).cast("bigint")
    return documents.select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through token files; the digests come from the files."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = Workspace(spark).root + "/tokens"
    manifest = write_token_files(docs, folder if "://" in folder else f"file://{folder}", public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_digests(read_token_files(spark, manifest))
