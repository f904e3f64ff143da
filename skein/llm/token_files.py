"""Token ids as Arrow files of equal-length sequences.

Documents are dealt by range of their id, sorted, encoded with the tokenizers
library and written one shard per task.  A shard is an Arrow IPC file with the
columns `tokens` (fixed_size_list of the smallest unsigned type that holds the
vocabulary) and `mask` (fixed_size_list of bool, false on the padding of the
shard's last sequence).  The documents of a shard follow each other without gaps,
each closed by the end id, so document `start .. start + n_tokens` is a slice of the
flat token buffer: a memory-mapped shard gives it without copying.

An index row (shard, document, place) is written per document as a Parquet table in
the same folder.  Both are written below the session's shared folder through
Arrow's file systems (local, HDFS or object stores).  A file name carries the
task's attempt, and the index names the files of the attempts that counted, so a
task that is repeated or lost leaves nothing that is read.

Reading back goes from the index: its rows come in shard order and are small; each
task opens the shards its rows name and reads the slices.

The library encodes the words of a text independently of each other.  A plain text
(characters below U+0250) is cut by the file's word pattern, and each distinct word is given to the library's model once per task and kept in a cache of
bounded size; other texts are given to the library whole.

Defined cases: a null or empty text has the end id only; repeated ids are ordered by
their texts' hash, then text, over all shards; documents without an id come first; an empty table gives no shard.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.files import file_system as _file_system
from . import bpe
from .common import Memo, scratch, text_chunks, text_table

END_ID = 2
SEQUENCE = 2048
#: Sequences per record batch of a shard.
BATCH_SEQUENCES = 256
#: Distinct words per cache generation of a task.
CACHE_WORDS = 250_000

INDEX = "shard int, file string, doc_id {id_type}, local_start long, n_tokens long"


class LibraryEncoder:
    """The tokenizers library behind a cache of encoded words (as packed ids)."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(tokenizer)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind = np.dtype(np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32)
        self.model = self.library.model
        self.symbols = {b: c for c, b in bpe.byte_symbols().items()}
        self.memo = Memo(CACHE_WORDS)

    def _packed(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words by the library's model, given their byte-level symbols."""
        tokenize, symbols, kind = self.model.tokenize, self.symbols, self.kind.char
        said = [w if w.isascii() and w.isprintable() else "".join(symbols[b] for b in w.encode()) for w in words]
        return [array(kind, [t.id for t in tokenize(w)]).tobytes() for w in said]

    def column(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of an Arrow column of texts, one text after the other, each closed by the end
        id, and the number of ids of each text."""
        n = len(column)
        plain = bpe.plain_rows(column)
        words, codes, offsets = bpe.word_table(column, plain)
        known = self.memo.all_of(words, self._words)
        entries = [known[w] for w in words]
        odd = [int(i) for i in np.flatnonzero(~plain) if column[int(i)].is_valid]
        whole = len(entries) + np.arange(len(odd))
        entries += self._packed([column[i].as_py() for i in odd])
        end = len(entries)
        entries.append(np.array([end_id], self.kind).tobytes())
        # behind each text's tokens: the whole of an odd text, then the end
        row = np.concatenate([np.array(odd, np.int64), np.arange(n)])
        by = np.argsort(row * 2 + (np.arange(len(row)) >= len(odd)), kind="stable")
        codes = np.insert(codes.astype(np.int64), offsets[1:][row][by], np.concatenate([whole, np.full(n, end)])[by])
        counts = np.diff(offsets) + 1
        counts[odd] += 1
        size = np.fromiter(map(len, entries), np.int64, len(entries)) // self.kind.itemsize
        values = pa.array(np.frombuffer(b"".join(entries), self.kind))
        lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size)))), values).take(pa.array(codes))
        bounds = np.concatenate(([0], np.cumsum(size[codes])))[np.concatenate(([0], np.cumsum(counts)))]
        return lists.flatten().to_numpy(zero_copy_only=False), np.diff(bounds)


class ShardWriter:
    """Packs ids into equal-length sequences, batch by batch."""

    def __init__(self, folder: str, name: str, kind: np.dtype, length: int):
        self.kind, self.length = kind, length
        system, path = _file_system(folder)
        self.path = f"{path}/{name}"
        self.file = system.open_output_stream(self.path)
        value = pa.from_numpy_dtype(kind)
        self.schema = pa.schema([("tokens", pa.list_(pa.field("item", value, nullable=False), length)),
                                 ("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length))])
        self.writer = pa.ipc.new_file(self.file, self.schema)
        self.rest = np.empty(0, kind)
        self.total = 0

    def _batch(self, flat: np.ndarray, real: int) -> None:
        tokens = pa.FixedSizeListArray.from_arrays(pa.array(flat), type=self.schema.field("tokens").type)
        mask = pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(flat)) < real), type=self.schema.field("mask").type)
        self.writer.write_batch(pa.RecordBatch.from_arrays([tokens, mask], schema=self.schema))

    def add(self, ids: np.ndarray) -> None:
        flat = np.concatenate([self.rest, ids])
        self.total += len(ids)
        step = self.length * BATCH_SEQUENCES
        whole = len(flat) // step * step
        for at in range(0, whole, step):
            self._batch(flat[at:at + step], step)
        self.rest = flat[whole:].copy()

    def close(self) -> None:
        n = len(self.rest)
        if n:
            padded = np.zeros(-(-n // self.length) * self.length, self.kind)
            padded[:n] = self.rest
            self._batch(padded, n)
        self.writer.close()
        self.file.close()


class ShardReader:
    """Random access to the ids of one shard; a local file is memory-mapped, so slices
    within a record batch are views of it."""

    def __init__(self, folder: str, name: str):
        from pyarrow import fs
        system, path = _file_system(folder)
        path = f"{path}/{name}"
        source = pa.memory_map(path) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(path)
        self.file = pa.ipc.open_file(source)
        self.length = self.file.schema.field("tokens").type.list_size
        self.step = self.length * BATCH_SEQUENCES
        self._at, self._flat = -1, None

    def _batch(self, k: int) -> np.ndarray:
        if k != self._at:
            self._flat = self.file.get_batch(k).column("tokens").flatten().to_numpy(zero_copy_only=True)
            self._at = k
        return self._flat

    def ids(self, start: int, n: int) -> np.ndarray:
        """The ids `start .. start + n` of the shard."""
        parts = []
        while n > 0:
            flat = self._batch(start // self.step)
            at = start % self.step
            part = flat[at:at + min(n, self.step - at)]
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint16)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequence `i` and its mask."""
        batch = self.file.get_batch(i // BATCH_SEQUENCES)
        row = i % BATCH_SEQUENCES
        cut = slice(row * self.length, (row + 1) * self.length)
        return (batch.column("tokens").flatten().to_numpy(zero_copy_only=True)[cut],
                batch.column("mask").flatten().to_numpy(zero_copy_only=False)[cut])


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = END_ID, length: int = SEQUENCE) -> DataFrame:
    """Write the shards below `folder` and return the index
    (`shard, file, doc_id, start, n_tokens`; `start`: ids of all documents before)."""
    rows = text_table(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    order = ["doc_id", F.xxhash64("text"), "text"]  # rows of one id may span shards: one order within and between them
    dealt = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(*order)
    shards = f"{folder}/shards"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get()
        shard, writer, encoder, name = task.partitionId(), None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encoder = LibraryEncoder(tokenizer)
                name = f"shard-{shard:06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.arrow"
                writer = ShardWriter(shards, name, encoder.kind, length)
            starts, sizes = [], []
            for _, texts in text_chunks(batch.column(1)):
                ids, size = encoder.column(texts, end_id)
                starts.append(writer.total + np.cumsum(size) - size)
                sizes.append(size)
                writer.add(ids)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * n, pa.int32()), pa.array([name] * n, pa.string()), batch.column(0),
                 pa.array(np.concatenate(starts), pa.int64()), pa.array(np.concatenate(sizes), pa.int64())],
                names=["shard", "file", "doc_id", "local_start", "n_tokens"])
        if writer is not None:
            writer.close()

    spark = docs.sparkSession
    schema = INDEX.format(id_type=id_type)
    _make_folder(spark, shards)
    index_path = f"{folder}/index"
    dealt.mapInArrow(write, schema).write.mode("overwrite").parquet(index_path)
    index = spark.read.schema(schema).parquet(index_path)
    # one row per shard: its ids, then the ids of all shards before it
    sizes = index.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return (index.join(F.broadcast(offsets), "shard")
            .select("shard", "file", "doc_id", (F.col("local_start") + F.col("offset")).alias("start"), "local_start", "n_tokens"))


def _make_folder(spark: SparkSession, folder: str) -> None:
    system, path = _file_system(folder)
    system.create_dir(path, recursive=True)


def read_token_files(index: DataFrame, folder: str) -> DataFrame:
    """The index with `ids_crc32`, the crc32 of each document's ids (as little-endian
    unsigned 32-bit integers) read from the shards."""
    shards = f"{folder}/shards"
    names = index.columns
    at = {c: names.index(c) for c in ("file", "local_start", "n_tokens")}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, opened = None, None
        for batch in batches:
            sums = []
            for name, start, n in zip(*(batch.column(at[c]).to_pylist() for c in ("file", "local_start", "n_tokens"))):
                if name != opened:
                    reader, opened = ShardReader(shards, name), name
                sums.append(zlib.crc32(reader.ids(start, n).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], names=[*names, "ids_crc32"])

    from pyspark.sql import types as T
    return index.mapInArrow(read, T.StructType([*index.schema.fields, T.StructField("ids_crc32", T.LongType())]))


def round_trip(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write the token files and return what is read back from them per document."""
    folder = folder or scratch(docs.sparkSession, "tokens")
    index = write_token_files(docs, tokenizer, folder)
    return read_token_files(index, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
