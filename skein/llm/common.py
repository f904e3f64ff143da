"""Shared helpers of the text operators: Arrow batch mapping over a text column,
shared-folder files, and small numpy utilities used inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text handed to one call of a batch function: bounds a task's memory
#: independently of the number of rows in an Arrow batch.
CHUNK_BYTES = 4_000_000

ASCII_UPPER = bytes(range(65, 91))
ASCII_LOWER = bytes(range(97, 123))
LOWER_TABLE = bytes.maketrans(ASCII_UPPER, ASCII_LOWER)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words `[^\\x20\\x09-\\x0D]+` as UTF-8 bytes.

    `bytes.split()` splits on exactly these six ASCII white-space bytes and
    `bytes.lower()` folds exactly A-Z, so non-ASCII text is left alone."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """A text column of an Arrow batch in pieces of about `limit` bytes, with their first row.
    One longer text forms its own piece; texts are never cut.  Only one piece at a time is
    turned into Python strings."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False) if len(column) else np.empty(0, np.int64)
    start = total = 0
    for i, n in enumerate(size.tolist()):
        if i > start and total + n > limit:
            yield start, column.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(size):
        yield start, column.slice(start)


def arrow_type(dt: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(dt)


def batch_maker(ddl: str) -> Callable[[dict[str, Sequence]], pa.RecordBatch]:
    """Made on the driver: turns columns by name into a batch of the schema `ddl` (columns left out are null)."""
    fields = [(f.name, arrow_type(f.dataType)) for f in T._parse_datatype_string(ddl).fields]

    def make(columns: dict[str, Sequence]) -> pa.RecordBatch:
        rows = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[c], type=t) if c in columns else pa.nulls(rows, t) for c, t in fields],
                                          names=[c for c, _ in fields])

    return make


def map_texts(df: DataFrame, text_col: str, fn: Callable[[list[str | None]], dict[str, Sequence]],
              fields: str, drop_text: bool = False, keep: Callable[[dict[str, Sequence]], np.ndarray] | None = None,
              as_arrow: bool = False) -> DataFrame:
    """Append the columns `fields` (a DDL string) that `fn` derives from whole texts.

    Narrow and distributed: every Arrow batch is handled in pieces of about
    `CHUNK_BYTES`, all other columns pass through untouched.  An
    input column with the name of a derived one is replaced by it.  `keep`
    turns the derived columns into a row mask (a filter without a second
    pass); `drop_text` leaves the text out of the result; `as_arrow` hands `fn` the texts
    as an Arrow array instead of a list."""
    new = T._parse_datatype_string(fields)
    assert isinstance(new, T.StructType)
    names = {f.name for f in new.fields}
    stay = [c for c in df.columns if c not in names and not (drop_text and c == text_col)]
    schema = T.StructType([df.schema[c] for c in stay] + list(new.fields))
    need = stay + [text_col] if text_col not in stay else stay
    types = [arrow_type(f.dataType) for f in new.fields]
    out_names = [f.name for f in schema.fields]
    plain = isinstance(df.schema[text_col].dataType, T.StringType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(need.index(text_col))
            for a, texts in text_chunks(column) if plain else [(0, column)]:
                got = fn(texts if as_arrow else texts.to_pylist())
                cols = [batch.column(i).slice(a, len(texts)) for i in range(len(stay))]
                cols += [pa.array(got[f.name], type=t) for f, t in zip(new.fields, types)]
                out = pa.RecordBatch.from_arrays(cols, names=out_names)
                yield out.filter(pa.array(keep(got))) if keep else out

    return df.select(*need).mapInArrow(run, schema)


class Memo:
    """A bounded cache for values of words: two generations of at most `limit` entries.

    When the young generation is full it becomes the old one; what is asked for again
    moves back, so frequent words stay and rare ones go."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def all_of(self, keys: Collection, compute: Callable[[list], Sequence]) -> dict:
        """A dict that holds the values of all `keys` (distinct); `compute` gives those of unknown ones."""
        missing = [k for k in keys if k not in self.young]
        if missing and len(self.young) + len(missing) > self.limit:
            self.young, self.old = {}, self.young
            missing = list(keys)
        if missing:
            old = self.old
            unknown = [k for k in missing if k not in old]
            self.young.update((k, old[k]) for k in missing if k in old)
            self.young.update(zip(unknown, compute(unknown)))
        return self.young


def text_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and text columns, as `doc_id` and `text` (other columns, also
    of clashing names, are not read)."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def in_training(id_col: str, modulus: int):
    """crc32 of the id as text, modulo `modulus`, is not 0."""
    return F.crc32(F.col(id_col).cast("string")) % modulus != 0


def scratch(spark, name: str) -> str:
    """A fresh folder below the session's shared checkpoint folder."""
    from ..session import scratch_path
    return scratch_path(spark, "llm-" + name)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back:
    cuts lineage and survives executors that are lost later."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_lengths(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start positions and lengths of the runs of equal values in a sorted array."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return starts, np.diff(np.append(starts, len(keys)))
