"""Byte-level BPE encoding and decoding from a rank file.

Every match of the split pattern is looked up in two tiers. A minimal perfect
hash over the vocabulary answers pieces that are tokens themselves; other
pieces are merged from their bytes, the pair with the lowest rank first, with a
heap over a linked list of parts (n log n for a piece of n bytes).
"""

from __future__ import annotations

import base64
import heapq
import itertools
import re
import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from firmweave.llm.common import Shared, whole_text

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# pieces remembered by a task's process, and as many older ones; about 250 bytes each
REMEMBERED = 250_000
# rows encoded between two output batches
ROWS_OUT = 256
# texts above this are split lazily, so that their pieces need not be held at once
LONG_TEXT = 1_000_000

# the classes of the split pattern for texts below U+0250, where the standard library's
# faster matcher can be used: letters, numbers and white space of Unicode
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t-\r \x85\xa0"
BEYOND_LATIN = re.compile("[^\x00-ɏ]")


def latin_pattern(pattern: str) -> re.Pattern:
    """``pattern`` for the standard library, right for texts below U+0250."""
    for name, chars in ((r"[^\s\p{L}\p{N}]", f"[^{_S}{_L}{_N}]"), (r"\p{L}", f"[{_L}]"), (r"\p{N}", f"[{_N}]"), (r"\S", f"[^{_S}]"), (r"\s", f"[{_S}]")):
        pattern = pattern.replace(name, chars)
    return re.compile(pattern)


class PerfectHash:
    """Minimal perfect hash by hash and displace: n keys, n slots.

    Keys are dealt to buckets; large buckets first, each searches a displacement that
    sends its keys to free slots. A bucket of one key names its slot directly.
    """

    def __init__(self, keys: list[bytes], per_bucket: int = 4):
        self.n, self.buckets = len(keys), max(1, len(keys) // per_bucket)
        dealt: dict[int, list[int]] = {}
        for i, key in enumerate(keys):
            dealt.setdefault(xxhash.xxh64_intdigest(key) % self.buckets, []).append(i)
        self.displacement = [0] * self.buckets
        self.order = [-1] * self.n  # slot -> index of its key
        free = 0
        for bucket, members in sorted(dealt.items(), key=lambda x: -len(x[1])):
            if len(members) > 1:
                for d in itertools.count(1):
                    slots = [xxhash.xxh64_intdigest(keys[i], d) % self.n for i in members]
                    if len(set(slots)) == len(slots) and all(self.order[s] < 0 for s in slots):
                        break
                self.displacement[bucket] = d
            else:
                while self.order[free] >= 0:
                    free += 1
                slots, self.displacement[bucket] = [free], -free - 1
            for s, i in zip(slots, members):
                self.order[s] = i

    def slot(self, key: bytes) -> int:
        """The key's slot; any slot for what is no key."""
        d = self.displacement[xxhash.xxh64_intdigest(key) % self.buckets]
        return -d - 1 if d < 0 else xxhash.xxh64_intdigest(key, d) % self.n


class _Pieces(dict):
    """Piece -> its ids as little-endian unsigned 32-bit integers, worked out at first sight.

    When full, its pieces become the older ones, and those that are seen again come back, so frequent pieces stay.
    """

    def __init__(self, tokenizer: BytePairTokenizer):
        self.tokenizer, self.older = tokenizer, {}

    def __missing__(self, piece: str) -> bytes:
        known = self.older.get(piece)
        if known is None:
            ids = self.tokenizer.piece_ids(piece.encode())
            known = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[piece] = known
        return known


class BytePairTokenizer:
    """Encodes and decodes with the ranks of one vocabulary; every single byte has a rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.tokens = {i: t for t, i in ranks.items()}
        self.hash = PerfectHash(list(ranks))
        keys = list(ranks)
        self.slots = [keys[i] for i in self.hash.order]
        self.bytes = [ranks[bytes([a])] for a in range(256)]  # ids of single bytes
        self.pairs = [[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)]  # and of two
        self._prepared = None

    @classmethod
    def from_file(cls, path: str, pattern: str) -> BytePairTokenizer:
        """From a file with a base64 token and its rank in each line, read on the driver."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def __getstate__(self):
        return self.__dict__ | {"_prepared": None}

    def piece_ids(self, piece: bytes) -> list[int]:
        token = self.slots[self.hash.slot(piece)]
        return [self.ranks[token]] if token == piece else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Ids after merging the pair of lowest rank, leftmost first, while any pair is a token."""
        n, rank_of, pairs = len(piece), self.ranks.get, self.pairs
        end = list(range(1, n + 1))  # of the part that starts here
        before = list(range(-1, n - 1))  # start of the part before
        ids = list(map(self.bytes.__getitem__, piece))  # of the part that starts here: the rank it was merged by
        pair = [pairs[a][b] for a, b in itertools.pairwise(piece)]  # rank of this part and the next
        pair.append(-1)
        heap = [r * n + i for i, r in enumerate(pair) if r >= 0]  # by rank, then place
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            r, i = divmod(pop(heap), n)
            if pair[i] != r:
                continue  # one of its parts has been merged since
            j, ids[i] = end[i], r
            e = end[i] = end[j]
            pair[j] = -1
            if e < n:
                before[e] = i
                r = pair[i] = rank_of(piece[i : end[e]], -1)
                if r >= 0:
                    push(heap, r * n + i)
            else:
                pair[i] = -1
            p = before[i]
            if p >= 0:
                r = pair[p] = rank_of(piece[p:e], -1)
                if r >= 0:
                    push(heap, r * n + p)
        merged, i = [], 0
        while i < n:
            merged.append(ids[i])
            i = end[i]
        return merged

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if self._prepared is None:
            self._prepared = latin_pattern(self.pattern), regex.compile(self.pattern), _Pieces(self)
        latin, full, known = self._prepared
        split = full if BEYOND_LATIN.search(text) else latin
        if len(text) < LONG_TEXT:
            return b"".join(map(known.__getitem__, split.findall(text)))
        return b"".join(known[m.group()] for m in split.finditer(text))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _mapped(df: DataFrame, source: str, out: list[str], keep: list[str], function) -> DataFrame:
    """(keep..., out...): binary columns, what ``function`` returns for each value of ``source``."""
    wanted = [f for f in df.schema.fields if f.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                made = [function(v.as_py()) for v in part.column(len(wanted))]
                columns = [part.column(i) for i in range(len(wanted))]
                results = [pa.array([m[k] for m in made], pa.binary()) for k in range(len(out))]
                yield pa.RecordBatch.from_arrays([*columns, *results], [*(f.name for f in wanted), *out])

    used = df.select(*(f.name for f in wanted), F.col(source).cast("binary").alias("__source"))
    return used.mapInArrow(run, T.StructType([*wanted, *[T.StructField(o, T.BinaryType()) for o in out]]))


def share(spark: SparkSession, tokenizer: BytePairTokenizer):
    """The tokenizer sent once to each executor; its size is that of the vocabulary."""
    return Shared(spark, tokenizer)


def encode_texts(df: DataFrame, shared, text: str = "text", out: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """(keep..., out): ids of each whole text, little-endian unsigned 32-bit; empty for null and empty texts.

    ``keep`` defaults to all columns but the text and one called ``out``. Rows are neither merged nor dropped; bytes that are
    no UTF-8 are encoded as U+FFFD.
    """
    keep = [c for c in df.columns if c not in (text, out)] if keep is None else keep
    return _mapped(df, text, [out], keep, lambda t: (shared.value.encode(whole_text(t or b"")),))


def decode_ids(df: DataFrame, shared, ids: str = "ids", out: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """(keep..., out): bytes of each id list; ``keep`` defaults to all columns. Null ids give no bytes."""
    return _mapped(df, ids, [out], [c for c in df.columns if c != out] if keep is None else keep, lambda i: (shared.value.decode(i or b""),))


def encode_and_decode(df: DataFrame, shared, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(keep..., ids, decoded): both of the above in one pass, so that a task needs one Python process and one tokenizer."""

    def both(value: bytes | None) -> tuple[bytes, bytes]:
        ids = shared.value.encode(whole_text(value or b""))
        return ids, shared.value.decode(ids)

    keep = [c for c in df.columns if c not in (text, "ids", "decoded")] if keep is None else keep
    return _mapped(df, text, ["ids", "decoded"], keep, both)
