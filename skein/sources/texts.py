"""Texts kept once, in files of their own, and read by their places: rows move with a place in place of a text.

A place is `(file, start, length)`.  Every task appends the texts that it has to one file, named by the number of the
task's attempt, so that a repeated task leaves a file that no row refers to.  Texts are read where they are used, places
that lie beside each other at once, and handed on in batches of a bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .files import file_system

PLACE = "struct<file: bigint, start: bigint, length: int>"
#: Bytes of texts handed on at once, bytes read at once, and of a gap between two texts that is read too.
BATCH_BYTES = 32 << 20
READ_BYTES = 4 << 20
GAP_BYTES = 4096


def put_texts(rows: DataFrame, column: str, path: str, place: str = "place") -> DataFrame:
    """`rows` with the place of the text of `column` in its stead (null: no text).  To be stored or checkpointed once:
    every evaluation writes the files anew."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != column), f"`{place}` {PLACE}"])
    at, names = rows.columns.index(column), [c for c in rows.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        files, root = file_system(path)
        attempt, out, end = TaskContext.get().taskAttemptId(), None, 0
        try:
            for batch in batches:
                texts = batch.column(at).cast(pa.large_binary())
                if out is None and texts.null_count < len(texts):
                    files.create_dir(root, recursive=True)
                    out = files.open_output_stream(f"{root}/{attempt}")
                lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
                starts = end + np.cumsum(lengths) - lengths
                for text in texts:
                    if text.is_valid:
                        out.write(text.as_buffer())
                end += int(lengths.sum())
                held = pa.StructArray.from_arrays(
                    [pa.array(np.full(len(texts), attempt, np.int64)), pa.array(starts), pa.array(lengths.astype(np.int32))],
                    names=["file", "start", "length"], mask=texts.is_null())
                yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != at), held], names=[*names, place])
        finally:
            if out is not None:
                out.close()

    return rows.mapInArrow(run, schema)


class _Reader:
    """The files of a folder of texts, opened when they are first asked for."""

    def __init__(self, path: str):
        self.files, self.root = file_system(path)
        self.open: dict[int, pa.NativeFile] = {}

    def texts(self, places: pa.Array) -> pa.Array:
        """The texts at `places`; a place that comes several times is read once."""
        part = lambda c: pc.fill_null(pc.struct_field(places, c), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        file, start, length = part("file"), part("start"), part("length")
        # a text without letters takes no room: its start may be the next one's
        _, first, which = np.unique(np.stack((file, start, length), 1), axis=0, return_index=True, return_inverse=True)
        file, start, length = file[first], start[first], length[first]
        held: list[bytes] = []
        a = 0
        while a < len(file):
            b = a + 1
            while b < len(file) and file[b] == file[a] and start[b] - start[b - 1] - length[b - 1] <= GAP_BYTES and start[b] + length[b] - start[a] <= READ_BYTES:
                b += 1
            size = int((start[a:b] + length[a:b]).max() - start[a])
            whole = self.read(int(file[a]), int(start[a]), size) if size else b""
            held += [whole[s:s + n] for s, n in zip((start[a:b] - start[a]).tolist(), length[a:b].tolist())]
            a = b
        found = pa.array(held, pa.binary()).view(pa.string())
        return found.take(pa.array(which.reshape(-1), mask=places.is_null().to_numpy(zero_copy_only=False)))

    def read(self, file: int, start: int, size: int) -> bytes:
        if file not in self.open:
            self.open[file] = self.files.open_input_file(f"{self.root}/{file}")
        got = self.open[file].read_at(size, start)
        if len(got) != size:
            raise OSError(f"{self.root}/{file} ends before {start + size}")
        return got

    def close(self) -> None:
        for f in self.open.values():
            f.close()


def with_texts(rows: DataFrame, places: str, out: str, path: str) -> DataFrame:
    """`rows` with the texts at `places`, a place or an array of places, as `out` in their stead (null: null)."""
    many = rows.schema[places].dataType.typeName() == "array"
    kept = [f for f in rows.schema.fields if f.name != places]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{out}` {'array<string>' if many else 'string'}"])
    at, names = rows.columns.index(places), [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(path)
        try:
            for batch in batches:
                column = batch.column(at)
                items = column.flatten() if many else column
                each = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False) if many else np.ones(len(column), np.int64)
                ends = np.cumsum(each.astype(np.int64))
                size = np.concatenate(([0], np.cumsum(pc.fill_null(pc.struct_field(items, "length"), 0).to_numpy(zero_copy_only=False).astype(np.int64))))
                upto = size[ends]
                a = 0
                while a < len(column):
                    before, skipped = (int(upto[a - 1]), int(ends[a - 1])) if a else (0, 0)
                    b = max(a + 1, int(np.searchsorted(upto, before + BATCH_BYTES, "right")))
                    found = reader.texts(items.slice(skipped, int(ends[b - 1]) - skipped))
                    if many:
                        offsets = np.concatenate(([0], ends[a:b] - skipped)).astype(np.int32)
                        found = pa.ListArray.from_arrays(pa.array(offsets), found, mask=column.slice(a, b - a).is_null())
                    yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for i, c in enumerate(batch.columns) if i != at), found], names=[*names, out])
                    a = b
        finally:
            reader.close()

    return rows.mapInArrow(run, schema)
