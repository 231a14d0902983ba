"""Equal-length token sequences in Arrow stream files.

A file is one Arrow stream. Its batches hold ``tokens`` and ``mask`` as
fixed-size lists, so any sequence is a view into the file's bytes: nothing is
parsed or copied. ``ends`` names the documents that end in a sequence, with the position after
their last id. Documents follow each other without gaps; what is left of a file's
last sequence is padding, where the mask is false. Documents never cross files.
"""

from __future__ import annotations

import array
import json
import os
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from firmweave.llm.bpe import BEYOND_LATIN, LONG_TEXT, latin_pattern
from firmweave.llm.common import arrow_rows, read_files, whole_text, write_files

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEQUENCE = 2048
# ids after which a file is closed at the next end of a document
FILE_IDS = 2_000_000
BATCH_SEQUENCES = 256
REMEMBERED = 400_000


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write each byte as: printable Latin-1 bytes as they are, others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class _Pieces(dict):
    """Piece -> its ids as bytes, asked of the library's BPE model at first sight."""

    def __init__(self, model, code: str):
        self.model, self.code = model, code
        self.letters = dict(enumerate(_byte_letters()))

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        letters = piece.encode().decode("latin-1").translate(self.letters)
        ids = self[piece] = array.array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()
        return ids


class Encoder:
    """Whole texts to ids by the ``tokenizers`` library; the strings of added tokens give those tokens, as its plain call does.

    A tokenizer that splits at the byte-level pattern encodes each piece by itself, so
    the library's model is asked once for each new piece and its answers are remembered
    (bounded). Other tokenizers, texts beyond Latin letters and those that hold an added token's string get the whole text.
    """

    def __init__(self, definition: str, pattern: str | None = None):
        self.definition, self.pattern = definition, pattern
        self.dtype = np.dtype("<u2" if self._load().get_vocab_size() <= 1 << 16 else "<u4")
        self._ready = None

    def _load(self) -> tokenizers.Tokenizer:
        return tokenizers.Tokenizer.from_str(self.definition)

    def __getstate__(self):
        return self.__dict__ | {"_ready": None}

    def splits_at(self, pattern: str) -> bool:
        """Whether ``pattern`` is what the definition splits at before merging, and it does nothing else."""
        d = json.loads(self.definition)
        step = d.get("pre_tokenizer") or {}
        plain = step.get("type") == "ByteLevel" and not step.get("add_prefix_space") and step.get("use_regex", True)
        return plain and not d.get("normalizer") and d["model"]["type"] == "BPE" and pattern == self.pattern

    def encode(self, text: str) -> bytes:
        """The text's ids as unsigned integers of ``dtype``."""
        code = "H" if self.dtype.itemsize == 2 else "I"
        if self._ready is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
            by_piece = self.pattern is not None and self.splits_at(self.pattern)
            tokenizer = self._load()
            added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
            self._ready = tokenizer, _Pieces(tokenizer.model, code), latin_pattern(self.pattern) if by_piece else None, added
        tokenizer, known, split, added = self._ready
        if split is None or BEYOND_LATIN.search(text) or any(t in text for t in added):
            return array.array(code, tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(text) <= LONG_TEXT:
            return b"".join(map(known.__getitem__, split.findall(text)))
        return b"".join(known[m.group()] for m in split.finditer(text))


class _Shard:
    """Gathers documents and lays them out as the bytes of one file."""

    def __init__(self, dtype: np.dtype, length: int):
        self.dtype, self.length = dtype, length
        self.ids, self.n, self.documents, self.stops = [], 0, [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(ids)
        self.n += len(ids) // self.dtype.itemsize
        self.documents.append(doc_id)
        self.stops.append(self.n)

    def to_bytes(self, task: int, before: int) -> bytes:
        """The file; ``before`` counts the ids that the same task has written to earlier files."""
        length, n = self.length, self.n
        sequences = -(-n // length)
        tokens = np.zeros(sequences * length, self.dtype)
        tokens[:n] = np.frombuffer(b"".join(self.ids), self.dtype)
        self.ids = []
        mask = np.arange(sequences * length) < n
        stops = np.array(self.stops)
        which = (stops - 1) // length
        offsets = np.searchsorted(which, np.arange(sequences + 1)).astype(np.int32)
        ends = pa.StructArray.from_arrays(
            [pa.array(self.documents, pa.int64()), pa.array(stops - which * length, pa.int32())], ["doc_id", "stop"]
        )
        kind = pa.from_numpy_dtype(self.dtype)
        table = pa.table(
            {
                "tokens": pa.FixedSizeListArray.from_arrays(pa.array(tokens, kind), length),
                "mask": pa.FixedSizeListArray.from_arrays(pa.array(mask), length),
                "ends": pa.ListArray.from_arrays(pa.array(offsets), ends),
            }
        ).replace_schema_metadata({"task": str(task), "before": str(before), "ids": str(n)})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table, max_chunksize=BATCH_SEQUENCES)
        return sink.getvalue().to_pybytes()


class TokenFile:
    """Random access to the sequences of one file, given as bytes or a memory map."""

    def __init__(self, content: bytes | pa.Buffer):
        reader = pa.ipc.open_stream(pa.py_buffer(content))
        self.batches = list(reader)
        self.schema = reader.schema
        self.info = {k.decode(): int(v) for k, v in reader.schema.metadata.items()}
        self.length = self.schema.field("tokens").type.list_size

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def _view(self, column: str, i: int) -> pa.Array:
        batch = self.batches[i // BATCH_SEQUENCES]
        row = i % BATCH_SEQUENCES
        values = batch.column(batch.schema.get_field_index(column))
        return values.values.slice((values.offset + row) * self.length, self.length)

    def tokens(self, i: int) -> np.ndarray:
        """Sequence ``i`` as a view of the file."""
        return self._view("tokens", i).to_numpy(zero_copy_only=True)

    def mask(self, i: int) -> pa.Array:
        """True where sequence ``i`` has an id; a view of the file's bits."""
        return self._view("mask", i)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, ids of its task before it, ids), ids as unsigned 32-bit."""
        start, open_part = self.info["before"], []
        for at, batch in enumerate(self.batches):
            ends = batch.column(batch.schema.get_field_index("ends"))
            offsets, items = ends.offsets.to_pylist(), ends.values
            ids, stops = items.field("doc_id").to_pylist(), items.field("stop").to_pylist()
            for row in range(batch.num_rows):
                line, cut = self.tokens(at * BATCH_SEQUENCES + row), 0
                for k in range(offsets[row], offsets[row + 1]):
                    parts = np.concatenate([*open_part, line[cut : stops[k]]]).astype("<u4")
                    yield ids[k], start, parts
                    start, open_part, cut = start + len(parts), [], stops[k]
                if cut < self.length:
                    open_part.append(line[cut:])


def write_sequences(
    docs: DataFrame, encoder, path: str, key: str = "doc_id", text: str = "text", end_id: int = 0,
    length: int = SEQUENCE, file_ids: int = FILE_IDS,
) -> None:
    """Write the ids of all texts in ascending ``key`` order, each followed by ``end_id``.

    ``encoder`` is a shared ``Encoder``. Bytes that are no UTF-8 are encoded as U+FFFD. Null and empty texts give the end
    id alone; null keys come first; rows equal in key are ordered by a hash of their text. Other
    columns are not read. No rows write no file with sequences.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder.value
        stop = np.array([end_id], coder.dtype).tobytes()
        task, before, shard = TaskContext.get().partitionId(), 0, _Shard(coder.dtype, length)
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard.add(doc_id, coder.encode(whole_text(value.as_py() or b"")) + stop)
                if shard.n >= file_ids:
                    yield pa.RecordBatch.from_arrays([pa.array([shard.to_bytes(task, before)], pa.binary())], ["content"])
                    before, shard = before + shard.n, _Shard(coder.dtype, length)
        if shard.n:
            yield pa.RecordBatch.from_arrays([pa.array([shard.to_bytes(task, before)], pa.binary())], ["content"])

    used = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("binary").alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = used.repartitionByRange(n, "key").sortWithinPartitions("key", F.xxhash64("text"))
    with arrow_rows(docs.sparkSession, 500):
        write_files(ordered.mapInArrow(pack, "content binary"), "content", path)


def read_documents(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids): every document of the files; ``start`` counts the ids of all before it."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(batch.schema.get_field_index("content")):
                file = TokenFile(content.as_buffer())
                rows, size = [], 0
                for doc_id, start, ids in file.documents():
                    rows.append((doc_id, start, len(ids), ids.tobytes()))
                    size += ids.nbytes
                    if size > 8_000_000:
                        yield as_batch(file.info, rows)
                        rows, size = [], 0
                if rows:
                    yield as_batch(file.info, rows)

    def as_batch(info, rows):
        doc_id, start, n, ids = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([info["task"]] * len(rows), pa.int32()), pa.array(doc_id, pa.int64()),
             pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
            ["task", "doc_id", "start", "n_tokens", "ids"],
        )

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(batch.schema.get_field_index("content")):
                info = pa.ipc.open_stream(content.as_buffer()).schema.metadata
                yield pa.RecordBatch.from_arrays([pa.array([int(info[k])]) for k in (b"task", b"ids")], ["task", "ids"])

    files = read_files(spark, path)
    # ids of each writing task: one row for each partition that wrote, so small enough to broadcast
    tasks = files.mapInArrow(head, "task bigint, ids bigint").groupBy("task").agg(F.sum("ids").alias("ids"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = tasks.select(F.col("task").cast("int").alias("task"), F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("first"))
    rows = files.mapInArrow(unpack, "task int, doc_id bigint, start bigint, n_tokens bigint, ids binary")
    return rows.join(F.broadcast(firsts), "task").select(
        F.col("doc_id").alias(key), (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids"
    )
