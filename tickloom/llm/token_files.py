"""Token ids in Arrow files of equal-length sequences (operator 1).

A file is in Arrow's random-access file format. Its rows are sequences: `ids`, a fixed-size list
of unsigned integers, and `mask`, a fixed-size list of booleans that is false behind the last
token. The documents of a file follow each other without gaps, so only its last sequence is
padded. All record batches but the last have the same number of rows; the place of sequence i is
arithmetic, and a memory-mapped file gives it without a copy. Beside each data file lies one with
fixed-width columns for its documents: doc_id, first token in the file, number of tokens.

NULL and empty texts have the end id only. Rows with the same id are ordered by text and each has
its own entry; NULL ids come first. An empty table makes no file and reads back as no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import keyed_text
from tickloom.llm.word_tokens import word_encoder
from tickloom.session import store

SEQUENCE_TOKENS = 2048
SEQUENCES_PER_BATCH = 64
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all executors see, and the path in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


class _Writer:
    """Writes one data file and its documents, holding one record batch of tokens."""

    def __init__(self, fs: pafs.FileSystem, path: str, dtype: str, length: int, per_batch: int):
        self.dtype, self.length, self.block = dtype, length, length * per_batch
        self.schema = pa.schema(
            [
                ("ids", pa.list_(pa.from_numpy_dtype(np.dtype(dtype)), length)),
                ("mask", pa.list_(pa.bool_(), length)),
            ],
            metadata={"sequences_per_batch": str(per_batch)},
        )
        self.streams = [fs.open_output_stream(path), fs.open_output_stream(f"{path}.docs")]
        self.data = pa.ipc.new_file(self.streams[0], self.schema)
        self.docs = pa.ipc.new_file(self.streams[1], _DOCS)
        self.waiting: list[np.ndarray] = []
        self.held = self.tokens = self.count = 0
        self.rows: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.rows.append((doc_id, self.tokens, len(ids)))
        self.waiting.append(ids.astype(self.dtype))
        self.held += len(ids)
        self.tokens += len(ids)
        self.count += 1
        if self.held >= self.block:
            flat = np.concatenate(self.waiting)
            whole = len(flat) // self.block * self.block
            for at in range(0, whole, self.block):
                self._put(flat[at : at + self.block], self.block)
            self.waiting, self.held = [flat[whole:]], len(flat) - whole
        if len(self.rows) >= 16384:
            self._put_docs()

    def _put(self, flat: np.ndarray, real: int) -> None:
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.length)
            for values in (flat, np.arange(len(flat)) < real)
        ]
        self.data.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def _put_docs(self) -> None:
        columns = [pa.array(c, pa.int64()) for c in zip(*self.rows, strict=True)]
        self.docs.write_batch(pa.RecordBatch.from_arrays(columns, schema=_DOCS))
        self.rows = []

    def close(self) -> None:
        if self.held:
            flat = np.concatenate(self.waiting)
            full = np.zeros(-(-len(flat) // self.length) * self.length, self.dtype)
            full[: len(flat)] = flat
            self._put(full, len(flat))
        if self.rows:
            self._put_docs()
        for x in (self.data, self.docs, *self.streams):
            x.close()


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int,
    sequence_tokens: int = SEQUENCE_TOKENS,
    sequences_per_batch: int = SEQUENCES_PER_BATCH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the ids of all texts below `path`, in ascending order of id; returns the manifest.

    One file per range of ids (spark.sql.shuffle.partitions, coalesced by AQE); texts are
    shuffled, because they pack smaller than their ids. The manifest (first_id, file, n_docs,
    n_tokens, start) is stored and names only files of tasks that succeeded: a repeated task
    writes under another name. Its running sum over files is the only step in one task; it has
    a row per file.
    """

    def write(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        encoder = word_encoder(vocabulary)
        fs, folder = open_store(path)
        dtype = "<u2" if max(encoder.size - 1, end_id) < 1 << 16 else "<u4"
        writer, first, name = None, None, f"tokens-{uuid.uuid4().hex}.arrow"
        end = np.array([end_id], "<u4")
        for part in parts:
            for at in range(0, part.num_rows, 512):
                some = part.slice(at, 512)
                keys, texts = some.column(0).to_pylist(), some.column(1).to_pylist()
                if writer is None:
                    fs.create_dir(folder, recursive=True)
                    writer = _Writer(fs, f"{folder}/{name}", dtype, sequence_tokens, sequences_per_batch)
                    first = keys[0]
                for key, raw in zip(keys, encoder.encode(texts), strict=True):
                    writer.add(key, np.concatenate([np.frombuffer(raw, "<u4"), end]))
        if writer is not None:
            writer.close()
            row = [[first], [name], [writer.count], [writer.tokens]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=["first_id", "file", "n_docs", "n_tokens"],
            )

    rows = keyed_text(docs, id_col, text_col)
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = store(
        ordered.mapInArrow(write, "first_id long, file string, n_docs long, n_tokens long"),
        "token-manifest",
    )
    before = Window.orderBy(F.asc_nulls_first("first_id")).rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class TokenFile:
    """Random access to one data file; sequences of a local file are views into its pages."""

    def __init__(self, path: str):
        fs, place = open_store(path)
        local = isinstance(fs, pafs.LocalFileSystem)
        source = pa.memory_map(place) if local else fs.open_input_file(place)
        docs = pa.memory_map(f"{place}.docs") if local else fs.open_input_file(f"{place}.docs")
        self.data, self.docs = pa.ipc.open_file(source), pa.ipc.open_file(docs)
        self.per_batch = int(self.data.schema.metadata[b"sequences_per_batch"])
        self.length = self.data.schema.field("ids").type.list_size
        self.last: tuple[tuple[int, str] | None, np.ndarray | None] = (None, None)

    def _flat(self, batch: int, column: str = "ids") -> np.ndarray:
        if self.last[0] != (batch, column):
            values = self.data.get_batch(batch).column(column).flatten()
            self.last = (batch, column), values.to_numpy(zero_copy_only=column == "ids")
        return self.last[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence i."""
        batch, row = divmod(i, self.per_batch)
        at = slice(row * self.length, (row + 1) * self.length)
        return self._flat(batch)[at], self._flat(batch, "mask")[at]

    def tokens(self, start: int, count: int) -> np.ndarray:
        """`count` ids of the file's stream of tokens."""
        block, parts = self.length * self.per_batch, []
        while count > 0:
            batch, at = divmod(start, block)
            part = self._flat(batch)[at : at + count]
            parts.append(part)
            start, count = start + len(part), count - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint32), *parts])

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in the file, ids) of each document."""
        for i in range(self.docs.num_record_batches):
            rows = self.docs.get_batch(i).to_pydict()
            for key, start, count in zip(*rows.values(), strict=True):
                yield key, start, self.tokens(start, count)


def read_token_files(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """A row per document from the files: doc_id, start in the whole, n_tokens, crc32 of its ids."""

    def read(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for name, base in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                rows = [
                    (key, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for key, start, ids in TokenFile(f"{path}/{name}").documents()
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    # A task per file. The count is of files, and AQE would put all these small rows into one task.
    files = manifest.select("file", "start").repartition(max(1, manifest.count()))
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
