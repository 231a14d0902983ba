"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance d <= r have a common point within r/2 of both. So
every distinct fingerprint emits all its variants within r/2 flipped bits, equal
variants meet, and fingerprints that share one are linked.

The variants are not shuffled one by one. A variant's leading bits (its cell)
are enough to bring equal variants together: a fingerprint is sent once to each
of the 137 cells that its variants lie in, and the task of a cell makes the
variants that fall into it. Cells with very many variants are cut again by the
next bits before the shuffle, so near copies of one text are spread over tasks.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from firmweave.operators.components import label_components
from firmweave.operators.relational import lookup
from firmweave.storage import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELL_BITS = 16
# variants in one cell beyond which the cell is cut by the next bits; a cell has a few
# thousand of them at most where fingerprints are spread evenly
CROWDED_VARIANTS = 4_000_000
# variants held at once by a task (8 bytes each, a few copies)
BLOCK_VARIANTS = 2_000_000
BLOCK_SHINGLES = 65_536


def shingle_spans(text: bytes, words: int) -> tuple[bytes, list[int], list[int]]:
    """(text, starts, ends) of the shingles, repeats included, in the text A-Z lower-cased and single-spaced."""
    # bytes.lower() changes A-Z only and bytes.split() splits at 09-0D and 20
    tokens = text.lower().split()
    if not tokens:
        return b"", [], []
    after = list(itertools.accumulate([len(t) + 1 for t in tokens]))
    starts = [0, *after[:-1]]
    n = max(1, len(tokens) - words + 1)
    return b" ".join(tokens), starts[:n], [e - 1 for e in after[min(words, len(tokens)) - 1 :]]


def fingerprint(text: bytes | None, words: int = 4) -> int:
    """Bit i is set if it is set in more than half of the shingles' XXH64 values; 0 without words."""
    set_in = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    joined, starts, ends = shingle_spans(text or b"", words)
    for at in range(0, len(starts), BLOCK_SHINGLES):
        spans = zip(starts[at : at + BLOCK_SHINGLES], ends[at : at + BLOCK_SHINGLES])
        digests = np.frombuffer(b"".join([digest(joined[s:e], 42) for s, e in spans]), np.uint8)
        set_in += np.unpackbits(digests).reshape(-1, 64).sum(axis=0, dtype=np.uint32)  # highest bit first
    return int.from_bytes(np.packbits(2 * set_in > len(starts)).tobytes(), "big")


def with_fingerprint(df: DataFrame, text: str = "text", words: int = 4, out: str = "fingerprint") -> DataFrame:
    """``df`` with its texts' 64-bit fingerprints as a signed long; a null text has fingerprint 0."""

    def add(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            prints = np.array([fingerprint(t.as_py(), words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints)], [*batch.schema.names, out])

    return df.mapInArrow(add, T.StructType([*df.schema.fields, T.StructField(out, T.LongType())]))


def flips(bits: int, most: int) -> list[int]:
    """All masks of ``bits`` bits with up to ``most`` set."""
    return [sum(1 << b for b in chosen) for k in range(most + 1) for chosen in itertools.combinations(range(bits), k)]


def _cells(prints: DataFrame, half: int, crowded: int) -> DataFrame:
    """(fingerprint, cell): the cells that hold variants of a fingerprint; see ``_unpack``."""
    cell_masks = F.explode(F.array(*[F.lit(m) for m in flips(CELL_BITS, half)]))
    home = F.shiftrightunsigned("fingerprint", 64 - CELL_BITS).cast("int")

    def within(bits: int, flipped: Column) -> Column:
        counts = [len(flips(bits, half - k)) for k in range(half + 1)]
        return F.element_at(F.array(*[F.lit(c).cast("bigint") for c in counts]), flipped.cast("int") + 1)

    # work in a cell, from the number of fingerprints at home in each: at most 2^CELL_BITS rows
    homes = prints.groupBy(home.alias("home")).agg(F.count(F.lit(1)).alias("n"))
    full = (
        homes.select("home", "n", cell_masks.alias("m"))
        .groupBy(F.col("home").bitwiseXOR(F.col("m")).alias("cell"))
        .agg(F.sum(F.col("n") * within(64 - CELL_BITS, F.bit_count("m"))).alias("variants"))
        .filter(F.col("variants") > crowded).select("cell", F.lit(True).alias("full"))
    )
    sent = prints.select("fingerprint", home.alias("home"), cell_masks.alias("m")).select(
        "fingerprint", F.col("home").bitwiseXOR(F.col("m")).alias("cell"), F.bit_count("m").alias("used")
    ).join(F.broadcast(full), "cell", "left")
    # masks of the next bits with up to ``half - used`` set come first in the list
    ordered = sorted(flips(CELL_BITS, half), key=lambda m: m.bit_count())
    next_masks = F.array(*[F.lit(m) for m in ordered])
    following = F.shiftrightunsigned("fingerprint", 64 - 2 * CELL_BITS).bitwiseAND(F.lit((1 << CELL_BITS) - 1))
    cell = F.col("cell").cast("bigint")
    finer = F.transform(
        F.slice(next_masks, F.lit(1), within(CELL_BITS, F.col("used")).cast("int")),
        lambda m: F.lit(1 << (2 * CELL_BITS)) + F.shiftleft(cell, CELL_BITS) + following.bitwiseXOR(m.cast("bigint")),
    )
    return sent.select("fingerprint", F.explode(F.when(F.col("full"), finer).otherwise(F.array(cell))).alias("cell"))


def _unpack(prints: np.ndarray, cells: np.ndarray, half: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(variant with no flip in the open bits, row, open bits, flips left) of the rows, by kind."""
    fine = cells >> np.uint64(2 * CELL_BITS) > 0
    for rows, fixed in ((np.flatnonzero(~fine), CELL_BITS), (np.flatnonzero(fine), 2 * CELL_BITS)):
        open_bits = 64 - fixed
        prefix = cells[rows] & np.uint64((1 << fixed) - 1)
        used = np.bitwise_count((prints[rows] >> np.uint64(open_bits)) ^ prefix)
        base = (prefix << np.uint64(open_bits)) | (prints[rows] & np.uint64((1 << open_bits) - 1))
        for k in range(half + 1):
            at = np.flatnonzero(used == k)
            if len(at):
                yield base[at], rows[at], open_bits, half - k


def _split(base: np.ndarray, owner: np.ndarray, left: np.ndarray, open_bits: int, half: int) -> Iterator:
    """(variants, owners) of one cell in blocks that hold equal variants together."""
    masks = [np.array(flips(open_bits, k), np.uint64) for k in range(half + 1)]
    if open_bits < 8 or sum(int((left == k).sum()) * len(masks[k]) for k in range(half + 1)) <= BLOCK_VARIANTS:
        made = [(base[left == k][:, None] ^ masks[k]).ravel() for k in range(half + 1)]
        yield np.concatenate(made), np.concatenate([np.repeat(owner[left == k], len(masks[k])) for k in range(half + 1)])
        return
    rest = open_bits - 8
    turned = [(np.uint64(m << rest), m.bit_count()) for m in flips(8, half)]
    b = np.concatenate([base[left >= n] ^ m for m, n in turned])
    o = np.concatenate([owner[left >= n] for _, n in turned])
    lf = np.concatenate([left[left >= n] - n for _, n in turned])
    key = b >> np.uint64(rest)
    order = np.argsort(key, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
        yield from _split(b[part], o[part], lf[part], rest, half)


def _meet(variants: np.ndarray, owners: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints linked by a shared variant: each with the smallest of its variant."""
    ordered = np.sort(variants)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    hit = np.flatnonzero(np.isin(variants, shared))
    v, p = variants[hit], prints[owners[hit]]
    order = np.lexsort((p, v))
    v, p = v[order], p[order]
    first = np.flatnonzero(np.r_[True, v[1:] != v[:-1]][: len(v)])
    least = np.repeat(p[first], np.diff(np.r_[first, len(v)]))
    ok = (p != least) & (np.bitwise_count(p ^ least) <= radius)  # by the triangle inequality always
    return p[ok], least[ok]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same groups with one link for each fingerprint."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before, least = root.copy(), np.minimum(root[x], root[y])
        np.minimum.at(root, before[x], least)
        np.minimum.at(root, before[y], least)
        root = root[root]
        if (root == before).all():
            break
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def ball_links(prints: DataFrame, radius: int = 4, crowded: int = CROWDED_VARIANTS) -> DataFrame:
    """(src, dst) links whose groups are those of all pairs of ``fingerprint`` at ``radius`` or fewer bits.

    ``prints`` has distinct fingerprints. Not every pair of a group is
    returned, but any two within the radius are connected. ``radius`` is even or rounded up in half.
    """
    half = (radius + 1) // 2

    def collide(batches):
        def links(p, c):
            found = []
            for base, rows, open_bits, left in joined(p, c):
                for variants, owners in _split(base, rows, left, open_bits, half):
                    found.append(_meet(variants, owners, p, radius))
            a, b = (np.concatenate(x) for x in zip(*found))
            src, dst = _forest(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(src.view(np.int64)), pa.array(dst.view(np.int64))], ["src", "dst"])

        def joined(p, c):
            by_bits = {}
            for base, rows, open_bits, left in _unpack(p, c, half):
                by_bits.setdefault(open_bits, []).append((base, rows, np.full(len(rows), left)))
            for open_bits, parts in by_bits.items():
                base, rows, left = (np.concatenate(x) for x in zip(*parts))
                yield base, rows, open_bits, left

        # rows come sorted by cell; whole cells are gathered until they make a block
        p, c = np.empty(0, np.uint64), np.empty(0, np.uint64)
        for batch in batches:
            p = np.concatenate([p, batch.column(0).to_numpy().view(np.uint64)])
            c = np.concatenate([c, batch.column(1).to_numpy().view(np.uint64)])
            last = int(np.searchsorted(c, c[-1])) if len(c) else 0
            if last >= 20_000:
                yield from links(p[:last], c[:last])
                p, c = p[last:], c[last:]
        if len(p):
            yield from links(p, c)

    cells = _cells(prints, half, crowded)
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.repartition(n, "cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(collide, "src bigint, dst bigint").distinct()


def fingerprint_groups(prints: DataFrame, radius: int = 4, crowded: int = CROWDED_VARIANTS) -> DataFrame:
    """(fingerprint, component) for every distinct fingerprint of ``prints``; component is its smallest."""
    distinct = cut_lineage(prints.select("fingerprint").distinct(), spread=True)
    return label_components(distinct, ball_links(distinct, radius, crowded), "fingerprint")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """(key, fingerprint, component_id) for every row of ``docs``.

    ``component_id`` is the smallest key of the documents reachable over links
    of ``radius`` or fewer differing bits. Null texts and texts without words have
    fingerprint zero and are linked like any other; rows with a null key get the
    smallest key of their group (null if there is none). Repeated rows are returned as often as they
    come. Other columns are not read. No rows give no rows.
    """
    prints = cut_lineage(with_fingerprint(docs.select(key, text), text, words).drop(text))
    groups = fingerprint_groups(prints, radius)
    least = prints.groupBy("fingerprint").agg(F.min(key).alias("least"))
    named = groups.join(least, "fingerprint")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = cut_lineage(lookup(cut_lineage(named), smallest, "component", "inner").select("fingerprint", "component_id"))
    return lookup(prints, labels, "fingerprint", "inner").select(
        key, F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one row for each group of near-duplicates: that with the smallest key (nulls last).

    Rows that are equal in key too count as copies, so one of them stays. Columns stay as they are,
    whatever their names.
    """
    columns = docs.columns
    own = [f"c{i}" for i in range(len(columns))]  # clashing names cannot meet the operator's own
    plain = docs.toDF(*own)
    text_at, key_at = own[columns.index(text)], own[columns.index(key)]
    table = cut_lineage(with_fingerprint(plain, text_at, words).withColumn("row", F.monotonically_increasing_id()))
    groups = fingerprint_groups(table, radius)
    order = F.struct(F.col(key_at).isNull().alias("none"), F.col(key_at).alias("key"), "row")
    least = table.groupBy("fingerprint").agg(F.min(order).alias("least"))
    stay = groups.join(least, "fingerprint").groupBy("component").agg(F.min("least").alias("least")).select("least.row")
    return table.join(stay, "row", "left_semi").select(*own).toDF(*columns)
