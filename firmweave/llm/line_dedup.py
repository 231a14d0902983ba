"""Fuzzy line dedup, with Spark expressions only.

Lines are normalised and counted by hash, so equal lines are one. A different line gets a 64-bit
SimHash of its pairs of neighbouring words. The SimHash's four blocks, two at a time, are six join keys, so
lines at RADIUS or fewer differing bits share one. Four more keys make one edited word sure to be found in a line of any
length: lines one edit apart share their first or their last half. Lines that share a key are verified by edit
similarity and linked; of each connected group the first occurrence stays.

Found for certain: lines at RADIUS bits or fewer, or at one edit, so all alike lines of up to nine words. Of longer
lines with more edits those are found that share two SimHash blocks (figures in the README); ``complete=True``
finds all of them, at several times the cost: an edit touches three triples of neighbouring words at most, so of the
first few triples in a fixed order one is common.

Small keys are met pair by pair: each line is compared with the first that it meets, then the pairs that these links leave apart are.
In crowded keys of halves, lines meet by what is left of them without one word,
and all that share it at one place are linked to the first. In other crowded keys every round compares the lines
with the smallest one (the pivot), and lines unlike it go to the next round. Lines that
went to different pivots are compared only where the triangle inequality leaves a
chance that they are alike, so no link between lines of a key is lost.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from firmweave.operators.components import label_components
from firmweave.operators.relational import HOT_KEY_ROWS, lookup, salted_join
from firmweave.storage import cut_lineage, release, tidy_shuffles

SIMILARITY = 0.8
BLOCKS = (0, 16, 32, 48)  # first bits of the SimHash's blocks of 16
RADIUS = 2  # differing bits that leave two of the blocks as they are
# anything but letters and digits; Latin-1 is written out, which Java answers from a table
_BETWEEN = r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf\xd7\xf7[\x{100}-\x{10ffff}&&[^\p{L}\p{N}]]]+"
MIN_WORDS = 5  # of a line that is compared by words
MIN_CHARS = 20  # of a line of fewer words, one without spaces too, that is compared by characters
BROADCAST_ROWS = 500_000  # of a written table with some 50 bytes a row
SMALL_KEY = 32  # lines of a key that are compared pair by pair
SHORT = 10  # words; pairs of lines that are both shorter are one edit apart
TRIPLES_FROM = 8  # words; shorter lines have no partner of more than nine
KEY_BITS = 44  # of a triple's hash that make a key
ROUNDS = 4  # in which triples are dealt, each a part of the keys, so that not all are on disk at once
SLOTS = 16_384  # that triples are counted in to find the common ones
SLOT_LINES = 20_000  # about so many lines are counted
_LANES = 0x0101010101010101  # one counter in each byte
_CHUNK = 127  # pairs after which the counters are read, so that the highest stays positive
_HALF = -(1 << 63)  # bit that tells keys of halves from those of blocks
WIDE_FROM = 96  # words; lines from here on would fill a sketch of 128 bits, so they have one of 512 too
POOR_PIVOT = 8  # a pivot unlike all but one in so many lines of its key ends the rounds there


def words_of(line: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.array_remove(F.split(F.lower(line), _BETWEEN), "")


def _word_string(codes: Column) -> Column:
    """One character for each word's code, so that an edit of the string is an edit of words."""
    letters = F.transform(codes, lambda c: F.hex(c.cast("int") + 0x8000))  # four digits, as codes end at 0x5000 on both sides
    return F.decode(F.unhex(F.concat_ws("", letters)), "UTF-16BE")


def _alike(a: Column, b: Column, share: float = 1 - SIMILARITY) -> Column:
    """Whether the edits between two word strings are within ``share`` of the longer one."""
    most = F.greatest(F.length(a), F.length(b))
    allowed = F.floor(most * share + 1e-9).cast("int")
    # -1 beyond the last argument
    return (F.abs(F.length(a) - F.length(b)) <= allowed) & (F.call_function("levenshtein", a, b, allowed) >= 0)


def _simhash(hashes: str) -> tuple[list[Column], Column]:
    """Counters of an array of hashes, and from them (as l0 .. l7, or m0 .. m7 for long arrays, with their number as ``pairs``)
    the bits set in over half."""
    one, many = F.size(hashes) <= _CHUNK, F.size(hashes) > _CHUNK
    at = F.sequence(F.lit(0), F.size(hashes) - 1, F.lit(_CHUNK))

    def add(k: int):
        return lambda total, h: total + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_LANES))

    def lanes(k: int, part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("bigint"), add(k))

    short = [F.when(one, lanes(k, F.col(hashes))).alias(f"l{k}") for k in range(8)]
    chunks = lambda k: F.transform(at, lambda s: lanes(k, F.slice(hashes, s + 1, _CHUNK)))
    long = [F.when(many, chunks(k)).alias(f"m{k}") for k in range(8)]
    # a counter above half reaches its byte's highest bit when what half lacks to 127 is added; the last byte, where that is the sign, apart
    half = F.floor(F.col("pairs") / 2)
    low = F.lit(_LANES >> 8)
    lacking = (F.lit(_CHUNK) - half) * low

    def quickly(k: int) -> Column:
        most = F.shiftrightunsigned(F.col(f"l{k}").bitwiseAND(F.lit((1 << 56) - 1)) + lacking, 7).bitwiseAND(low)
        last = F.when(F.shiftrightunsigned(f"l{k}", 56) > half, F.lit(1 << 56)).otherwise(F.lit(0).cast("bigint"))
        return F.shiftleft(most.bitwiseOR(last), k)

    quick = [quickly(k) for k in range(8)]

    def bit(b: int) -> Column:
        n = F.aggregate(f"m{b % 8}", F.lit(0).cast("bigint"), lambda total, x: total + F.shiftrightunsigned(x, b - b % 8).bitwiseAND(F.lit(255)))
        return F.when(2 * n > F.col("pairs"), F.lit(1 << b if b < 63 else -(1 << 63)).cast("bigint")).otherwise(F.lit(0).cast("bigint"))

    # bits are apart, so the sum is their union
    union = lambda parts: functools.reduce(lambda x, y: x.bitwiseOR(y), parts)
    return [*short, *long], F.when(F.col("pairs") <= _CHUNK, union(quick)).otherwise(union([bit(b) for b in range(64)]))


def _half_keys() -> list[Column]:
    """The first and the last half of a line, of its own length and, for partners one word shorter, of one less."""
    n = F.size("codes")
    keys = []
    for least in (n, n - 1):
        half = F.floor(least / 2).cast("int")
        keys.append(F.xxhash64(least, F.lit(0), F.slice("codes", F.lit(1), half)))
        keys.append(F.xxhash64(least, F.lit(1), F.slice("codes", n - (least - half) + 1, least - half)))
    return [k.bitwiseOR(F.lit(_HALF)).alias(f"half{i}") for i, k in enumerate(keys)]


def _surely_near(a: Column, b: Column) -> Column:
    """Whether any line one edit away from ``a`` is alike to ``b``; not for ``b`` itself."""
    allowed = F.floor(F.greatest(F.length(a) - 1, F.length(b)) * (1 - SIMILARITY) + 1e-9).cast("int") - 1
    return (allowed > 0) & (a != b) & (F.call_function("levenshtein", a, b, F.greatest(allowed, F.lit(0))) >= 0)


def _sketch() -> list[Column]:
    """128 bits in two numbers, one of which each word flips: an edit changes two at most."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def flips(half: int):
        at = lambda c: F.call_function("shiftleft", one, c.cast("int").bitwiseAND(F.lit(63)))
        return lambda seen, c: seen.bitwiseXOR(F.when(c.cast("int").bitwiseAND(F.lit(64)) == half, at(c)).otherwise(none))

    return [F.aggregate("codes", none, flips(half)).alias(f"sketch{i}") for i, half in enumerate((0, 64))]


def _wide_sketch() -> Column:
    """512 bits in eight numbers, flipped in the same way, of lines of WIDE_FROM words or more; null for others."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def part(k: int) -> Column:
        own = F.filter("codes", lambda c: F.shiftright(c.cast("int"), 6).bitwiseAND(F.lit(7)) == k)
        return F.aggregate(own, none, lambda seen, c: seen.bitwiseXOR(F.call_function("shiftleft", one, c.cast("int").bitwiseAND(F.lit(63)))))

    return F.when(F.size("codes") >= WIDE_FROM, F.array(*[part(k) for k in range(8)])).alias("wide")


def line_table(docs: DataFrame, key: str, text: str, complete: bool = False) -> DataFrame:
    """(row, h1, h2, at, n_words, codes, sim, half0 .. half3) of every line, written; ``at`` orders occurrences by key (nulls last), document and line.

    h1, h2 stand for the normalised line, a code for a word (one of 40,960). Lines of fewer than MIN_WORDS words have codes of their
    characters, or none if those are fewer than MIN_CHARS; without codes there are no SimHash and no halves. ``complete`` needs
    no SimHash, and halves only of lines that can have partners of up to nine words alone.
    """
    lines = docs.select(
        F.xxhash64(key, text).alias("r1"), F.xxhash64(F.lit(1), text, key).alias("r2"), F.col(key).alias("key"),
        F.posexplode_outer(F.split(text, "\n")).alias("line_no", "line"),
    ).filter("line IS NOT NULL")
    at = F.struct(F.col("key").isNull().alias("none"), "key", "r1", "r2", "line_no")
    split = lines.select(at.alias("at"), words_of(F.col("line")).alias("words"))
    # codes lie where UTF-16 has no surrogates once 0x8000 is added
    def coded(units: Column, seed: int) -> Column:
        return F.transform(units, lambda w: (F.pmod(F.xxhash64(w, F.lit(seed)), F.lit(0xA000)) - 0x5000).cast("smallint"))

    joined = F.array_join("words", " ")
    code = (
        F.when(F.size("words") >= MIN_WORDS, coded(F.col("words"), 7)).when(F.length(joined) >= MIN_CHARS, coded(F.split(joined, ""), 8))
        .otherwise(F.array().cast("array<smallint>"))
    )
    known = split.select(
        F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(1), "words").alias("h2"), "at", F.size("words").alias("n_words"), code.alias("codes")
    )
    n = F.size("codes")
    fuzzy = n >= MIN_WORDS
    if complete:
        short = fuzzy & (n < SHORT)
        halves = [F.when(short, h).alias(f"half{i}") for i, h in enumerate(_half_keys())]
        return cut_lineage(known.select(F.monotonically_increasing_id().alias("row"), "*", *halves))
    pairs = F.zip_with(F.slice("codes", F.lit(1), n - 1), F.slice("codes", F.lit(2), n - 1), lambda a, b: F.xxhash64(a, b))
    hashed = known.select("*", F.when(fuzzy, pairs).alias("hashes"))
    lanes, sim = _simhash("hashes")
    counted = hashed.select(*known.columns, F.size("hashes").alias("pairs"), *lanes)
    return cut_lineage(counted.select(
        F.monotonically_increasing_id().alias("row"), *known.columns, F.when(fuzzy, sim).alias("sim"), *[F.when(fuzzy, h).alias(f"half{i}") for i, h in enumerate(_half_keys())],
    ))


def different_lines(lines: DataFrame) -> DataFrame:
    """(id, h1, h2, n, words, sim if it is made, half0 .. half3): the different lines with words; ``id`` is the row of one occurrence.

    All but n is the same for equal lines, so numbers alone are shuffled and combined.
    """
    made = [c for c in lines.columns if c.startswith(("sim", "half"))]
    counted = lines.filter(F.col("n_words") > 0).groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.max("row").alias("id"), F.max(F.size("codes")).alias("words"), *[F.max(c).alias(c) for c in made]
    )
    return cut_lineage(counted)


def _if_small(table: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it has few rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def candidate_texts(lines: DataFrame, members: DataFrame) -> DataFrame:
    """(id, codes, ws): codes and word strings of the lines that share a key."""
    wanted = cut_lineage(members.select("id").distinct())
    found = lines.select(F.col("row").alias("id"), "codes").join(_if_small(wanted), "id")
    return cut_lineage(found.select("id", "codes", _word_string(F.col("codes")).alias("ws")))


def _triple(i: Column) -> Column:
    """Hash of the three neighbouring words from the ``i``-th (from 0) on."""
    return F.xxhash64(F.get("codes", i), F.get("codes", i + 1), F.get("codes", i + 2))


def _places(last: Column) -> Column:
    return F.sequence(F.lit(0), last)


def _commonness(long: DataFrame, lines: DataFrame) -> Column:
    """An array of SLOTS numbers: how far triples of a slot are above the average of all slots, in powers of two.

    Counted on a sample; it only orders triples, and any order finds all pairs.
    """
    step = max(1, long.count() // SLOT_LINES)
    some = F.broadcast(long.filter(F.pmod(F.col("h1"), F.lit(step)) == 0).select("id"))  # about SLOT_LINES
    sample = lines.select(F.col("row").alias("id"), "codes").join(some, "id")
    slots = sample.select(F.explode(F.transform(_places(F.size("codes") - 3), lambda i: F.pmod(_triple(i), F.lit(SLOTS)))).alias("slot"))
    counts = {r["slot"]: r["n"] for r in slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).collect()}
    usual = max(1, sum(counts.values()) // SLOTS)
    powers = [min(15, (counts.get(i, 0) // usual).bit_length()) for i in range(SLOTS)]
    return F.split(F.lit(",".join(map(str, powers))), ",").cast("array<int>")


def _block_keys() -> list[Column]:
    """The SimHash's blocks, two at a time."""
    part = lambda first: F.shiftrightunsigned("sim", first).bitwiseAND(F.lit(0xFFFF))
    return [F.lit(n << 32) + F.shiftleft(part(i), 16) + part(j) for n, (i, j) in enumerate(itertools.combinations(BLOCKS, 2))]


def _keyed(different: DataFrame) -> DataFrame:
    """(bucket, id, words, root): each line, its own root, under two blocks of its SimHash at a time and under its halves."""
    halves = [F.col(f"half{i}") for i in range(4)]
    return different.filter("sim IS NOT NULL").select(F.explode(F.array(*_block_keys(), *halves)).alias("bucket"), "id", "words", F.col("id").alias("root"))


def _halved(different: DataFrame) -> DataFrame:
    """(bucket, id, words, root): lines of fewer than SHORT words, each its own root, under their halves."""
    halves = [F.col(f"half{i}") for i in range(4)]
    return different.filter("half0 IS NOT NULL").select(F.explode(F.array(*halves)).alias("bucket"), "id", "words", F.col("id").alias("root"))


def _first_triples(different: DataFrame, lines: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``_coded`` and its keys by ``_dealt``."""
    coded, placed = _coded(different, lines)
    return coded, _dealt(coded, placed)


def _coded(different: DataFrame, lines: DataFrame) -> tuple[DataFrame, Callable[[Column], Column]]:
    """(id, root, words, codes, last, sketch0, sketch1, wide), written, of lines of MIN_WORDS words or more, each its own root; and the fixed order of triples, rare ones first.

    ``last`` is the last triple in order that is a key of a line of TRIPLES_FROM words or more.
    If t edits make the longer line of M words from one of n, at least M - 2 - 3 t triples are common, so up to
    n - M + 3 t of this line's are not; that is most for M = n or the next multiple of five. One more than that
    holds the first common one. Shorter lines have no partner of more than nine words, so they are one edit apart.
    """
    fuzzy = different.filter(F.col("words") >= MIN_WORDS).select("id", "h1", "words")
    n, long = F.col("words"), F.col("words") >= TRIPLES_FROM
    common = _commonness(fuzzy.filter(long), lines)

    def placed(h: Column) -> Column:
        return F.shiftleft(F.get(common, F.pmod(h, F.lit(SLOTS)).cast("int")).cast("bigint"), 58) + F.shiftrightunsigned(h, 6)

    coded = fuzzy.drop("h1").join(lines.select(F.col("row").alias("id"), "codes"), "id")
    lost = F.greatest(3 * F.floor(n / 5), n - 2 * F.ceil(n / 5)).cast("int")
    order = F.sort_array(F.transform(_triples(), placed))
    # found once for all rounds
    last = F.when(long, F.get(order, F.least(lost, F.size(order) - 1)))
    return cut_lineage(coded.select("id", F.col("id").alias("root"), "words", "codes", last.alias("last"), *_sketch(), _wide_sketch())), placed


def _triples() -> Column:
    return F.array_distinct(F.transform(_places(F.col("words") - 3), _triple))


def _dealt(coded: DataFrame, placed: Callable[[Column], Column]) -> list[DataFrame]:
    """(bucket, id, words, root) in ROUNDS parts with keys of their own: each line of TRIPLES_FROM words or more under its first triples."""
    first = coded.filter("last IS NOT NULL").select("id", "words", "root", "last", F.explode(_triples()).alias("triple"))
    first = first.withColumn("triple", placed(F.col("triple"))).filter("triple <= last")
    # lines that meet by a collision are compared for nothing, and narrow keys keep the shuffle small
    narrow = first.select(F.col("triple").bitwiseAND(F.lit((1 << KEY_BITS) - 1)).alias("bucket"), "id", "words", "root")
    return [narrow.filter(F.pmod("bucket", F.lit(ROUNDS)) == i) for i in range(ROUNDS)]


def _texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``texts`` of the lines in ``ids`` alone, written, so that several comparisons need not read all of them."""
    wanted = _if_small(cut_lineage(ids.select("id").distinct()))
    return cut_lineage(texts.join(wanted, "id", "left_semi"))


def _compared(pairs: DataFrame, texts: DataFrame, columns: tuple[str, str]) -> DataFrame:
    """``pairs`` with ``alike``, and the word strings of its two columns of ids as ``a`` and ``b``."""
    x, y = columns
    pairs = cut_lineage(pairs)

    def asked(column: str, name: str) -> DataFrame:
        # texts that no pair asks for stay out of the shuffle
        wanted = _if_small(cut_lineage(pairs.select(column).distinct()))
        found = texts.withColumnRenamed("id", column).join(wanted, column, "left_semi")
        # a word string that is not written is made behind the join, for the lines asked for alone
        return found.select(column, (F.col("ws") if "ws" in texts.columns else _word_string(F.col("codes"))).alias(name))

    first, second = asked(x, "a"), asked(y, "b")
    return pairs.join(first, x).join(second, y).withColumn("alike", _alike(F.col("a"), F.col("b")))


def _sharing(keyed: DataFrame) -> DataFrame:
    """(bucket, id, words, root, n): lines under the keys that lines of more than one root have, n in number."""
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # nulls are ruled out and the ends asked for so that both readers of ``dealt`` have the same filters and columns, and it is made once
    dealt = keyed.filter("bucket IS NOT NULL AND id IS NOT NULL AND words IS NOT NULL AND root IS NOT NULL").repartition(parts, "bucket")
    sizes = dealt.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"), F.max("words").alias("most"), F.max("id").alias("end")
    ).filter("low < high AND most > 0 AND end IS NOT NULL")
    return cut_lineage(dealt.join(sizes.select("bucket", "n").hint("shuffle_hash"), "bucket"))


def _room(x: str, y: str, sketched: bool) -> Column:
    """Whether the lengths of two aliased tables, and their sketches if there are, leave room for likeness."""
    allowed = F.floor(F.greatest(f"{x}.words", f"{y}.words") * (1 - SIMILARITY) + 1e-9)
    near = F.abs(F.col(f"{x}.words") - F.col(f"{y}.words")) <= allowed
    if not sketched:
        return near
    changed = [F.bit_count(F.col(f"{x}.sketch{i}").bitwiseXOR(F.col(f"{y}.sketch{i}"))) for i in range(2)]
    wide = [F.bit_count(F.get(f"{x}.wide", F.lit(i)).bitwiseXOR(F.get(f"{y}.wide", F.lit(i)))) for i in range(8)]
    few = functools.reduce(lambda a, b: a + b, wide) <= 2 * allowed  # null if one line is too short for it
    return near & (changed[0] + changed[1] <= 2 * allowed) & F.coalesce(few, F.lit(True))


def _one_edit_links(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """(src, dst): links that connect all lines of ``ids`` that are one word's edit apart, however many share their halves.

    Lines that leave the same rest without their word at one place differ in that word alone, and from the rest itself
    by one word more. So each is linked to the first of them, and that to the rest's own line.
    """
    lines = texts.join(ids.select("id").distinct(), "id", "left_semi")
    n = F.size("codes")
    rest = lambda i: F.concat(F.slice("codes", F.lit(1), i), F.slice("codes", i + 2, n))
    left = F.transform(_places(n - 1), lambda i: F.struct(i.alias("place"), F.xxhash64(rest(i)).alias("a"), F.xxhash64(F.lit(1), rest(i)).alias("b")))
    own = F.array(F.struct(F.lit(-1).alias("place"), F.xxhash64("codes").alias("a"), F.xxhash64(F.lit(1), F.col("codes")).alias("b")))
    rests = cut_lineage(lines.select("id", F.inline(F.concat(own, left))))
    holders = rests.filter("place >= 0").select("id", F.struct("place", "a", "b").alias("rest"))
    firsts = cut_lineage(holders.groupBy("rest").agg(F.min("id").alias("dst")))
    stars = lookup(holders, firsts, "rest", "inner").filter("id <> dst").select(F.col("id").alias("src"), "dst")
    whole = rests.filter("place < 0").select("a", "b", F.col("id").alias("src"))
    shorter = firsts.select("rest.a", "rest.b", "dst").join(whole, ["a", "b"]).select("src", "dst")
    return stars.unionByName(shorter).distinct()


def _meeting(one: DataFrame, other: DataFrame, sketched: bool) -> DataFrame:
    """(src, dst): rows of two tables that share a key, without a common root, and have room for likeness."""
    near = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.root") != F.col("y.root")) & _room("x", "y", sketched)
    return one.alias("x").join(other.alias("y"), near).select(F.col("x.id").alias("src"), F.col("y.id").alias("dst"))


def _met(shared: DataFrame, coded: DataFrame | None, small: int) -> tuple[DataFrame, DataFrame]:
    """Two written tables: (src, dst) that share a key of up to ``small`` lines, and the rows of larger keys, with sketches
    if ``coded`` gives them. ``shared`` is deleted."""
    members, sketched = shared, coded is not None
    if sketched:
        members = cut_lineage(shared.join(coded.select("id", "sketch0", "sketch1", "wide"), "id"))
        release(shared)
    few = members.filter(F.col("n") <= small)
    pairs = cut_lineage(_meeting(few, few, sketched).filter("src < dst").distinct())
    crowded = cut_lineage(members.filter(F.col("n") > small).drop("n"))
    release(members)
    return pairs, crowded


def _first_links(pairs: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(src, dst) of the pairs of each line with the first before it, if alike; and (id, first, root) of these lines.

    In a group of lines that are all alike, these links go to one root, so no other pair of the group needs its texts.
    """
    first = cut_lineage(pairs.groupBy("dst").agg(F.min("src").alias("src")))
    faced = cut_lineage(_compared(first, texts, ("src", "dst")).select("src", "dst", "alike"))
    links = faced.filter("alike").select("src", "dst")
    known = faced.select(F.col("dst").alias("id"), F.col("src").alias("first"), F.when(F.col("alike"), F.col("src")).otherwise(F.col("dst")).alias("root"))
    above = links.select(F.col("dst").alias("root"), F.col("src").alias("next"))
    for _ in range(2):  # up to four links; beyond, some pairs are compared for nothing
        further = known.join(above, "root", "left").select("id", "first", F.coalesce("next", "root").alias("root"))
        known = cut_lineage(further)
        above = known.filter("id <> root").select(F.col("id").alias("root"), F.col("root").alias("next"))
    return links, known


def _unsettled(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """``pairs`` that ``_first_links`` neither compared nor connected."""
    ends = [known.select(F.col("id").alias(x), F.col("root").alias(f"{x}_root"), *own) for x, own in (("src", []), ("dst", ["first"]))]
    root = lambda x: F.coalesce(F.col(f"{x}_root"), F.col(x))
    joined = pairs.join(ends[0], "src", "left").join(ends[1], "dst", "left")
    return joined.filter((root("src") != root("dst")) & F.coalesce(F.col("first") != F.col("src"), F.lit(True))).select("src", "dst")


def line_links(different: DataFrame, lines: DataFrame, small: int = SMALL_KEY, complete: bool = False) -> DataFrame:
    """(src, dst) that connect all alike lines among ``different`` that share a key.

    Keys of up to ``small`` lines are met pair by pair; pairs that are connected already are not compared, and keys whose lines all are
    hold none. In larger keys of blocks (or triples) each round compares all
    lines with the smallest, its pivot; lines alike form its family and the others go on, until ``small``
    are left or the pivot was like few of them. Those are loners, compared with all lines of the key;
    ``_between`` compares families of one key. Larger keys of halves are told apart by ``_one_edit_links``.
    """
    if complete:
        coded, placed = _coded(different, lines)
        keyed = [_halved(different), _dealt(coded, placed)[0]]
        shared, texts = [_sharing(k) for k in keyed], coded.select("id", "codes")
    else:
        shared = [_sharing(_keyed(different))]
        texts = candidate_texts(lines, shared[0])
    met = [_met(s, coded if complete else None, small) for s in shared]
    links, known = _first_links(functools.reduce(DataFrame.unionByName, [p for p, _ in met]), texts)
    if complete:
        # the other rounds leave out keys of one root
        joined = coded.withColumnRenamed("root", "own").join(known.select("id", "root"), "id", "left")
        rooted = cut_lineage(joined.withColumn("root", F.coalesce("root", "own")).select(coded.columns))
        release(coded)
        coded, texts = rooted, rooted.select("id", "codes")
        met += [_met(_sharing(k), coded, small) for k in _dealt(coded, placed)[1:]]
    pairs = cut_lineage(functools.reduce(DataFrame.unionByName, [p for p, _ in met]).distinct())
    many = cut_lineage(functools.reduce(DataFrame.unionByName, [c for _, c in met]))
    release(*[t for pair in met for t in pair])
    large, halves = many.filter("bucket >= 0"), many.filter("bucket < 0")
    # in a crowded key of halves, lines so near its first that any line one edit away is alike too leave with that link
    firsts = cut_lineage(halves.groupBy("bucket").agg(F.min("id").alias("pivot")))
    faced = cut_lineage(_compared(lookup(cut_lineage(halves.select("bucket", "id")), firsts, "bucket", "inner"), texts, ("id", "pivot")).withColumn("near", _surely_near(F.col("a"), F.col("b"))).select("bucket", "id", "pivot", "alike", "near"))
    starred = faced.filter("alike AND id <> pivot").select(F.col("pivot").alias("src"), F.col("id").alias("dst"))
    edited = _one_edit_links(faced.filter("NOT near"), texts).select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    pairs = pairs.unionByName(starred).unionByName(edited)
    left, families, loners, read = large, [], [], texts
    while not left.isEmpty():
        if families:
            read = _texts_of(read, left)
        least = left.groupBy("bucket").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("size"))
        pivots = cut_lineage(least.join(left, ["bucket", "id"]))
        loners.append(left.join(pivots.filter(F.col("size") <= small), "bucket", "left_semi"))
        near = (F.col("x.bucket") == F.col("y.bucket")) & _room("x", "y", complete)
        faced = left.alias("x").join(pivots.filter(F.col("size") > small).alias("y"), near)
        faced = faced.select("x.bucket", "x.id", F.col("y.id").alias("pivot"), "y.size")
        family = cut_lineage(_compared(faced, read, ("id", "pivot")).filter("alike").select("bucket", "id", "pivot", "size"))
        families.append(family.drop("size"))
        rich = family.groupBy("bucket").agg((F.count(F.lit(1)) * POOR_PIVOT >= F.first("size")).alias("rich"))
        rest = left.join(pivots.filter(F.col("size") > small).select("bucket"), "bucket").join(family.select("bucket", "id"), ["bucket", "id"], "left_anti")
        rest = cut_lineage(rest.join(rich, "bucket"))
        loners.append(rest.filter("NOT rich").drop("rich"))
        left = rest.filter("rich").drop("rich")
    if loners:
        alone = cut_lineage(functools.reduce(DataFrame.unionByName, loners))
        pairs = pairs.unionByName(_meeting(alone, large, complete).select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")))
    pairs = cut_lineage(_unsettled(pairs.distinct(), known))
    links = links.unionByName(_compared(pairs, texts, ("src", "dst")).filter("alike").select("src", "dst"))
    if families:
        family = functools.reduce(DataFrame.unionByName, families)
        links = links.unionByName(family.filter("id <> pivot").select(F.col("id").alias("src"), F.col("pivot").alias("dst")))
        links = links.unionByName(_between(family, _texts_of(texts, family)))
    links = cut_lineage(links.distinct())
    release(coded if complete else texts)
    return links


def _between(family: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between lines that went to different pivots of a key.

    If lines a and b are alike and went to pivots p and q, then p and q are within three times
    the edits that likeness allows, and a and b within two times of the other's pivot. Only
    lines that pass these tests meet.
    """
    share = 1 - SIMILARITY
    # allowed edits are a share of the longer line; lines in reach of n words have up to n / 0.8
    wide = share / SIMILARITY**2
    pivots = family.filter("id = pivot").select("bucket", "pivot")
    pairs = pivots.join(pivots.select("bucket", F.col("pivot").alias("other")), "bucket").filter("pivot <> other")
    apart = _compared(pairs.select("pivot", "other").distinct(), texts, ("pivot", "other"))
    near = apart.filter(_alike(F.col("a"), F.col("b"), 3 * wide)).select("pivot", "other")
    reach = _compared(family.join(near, "pivot").select("id", "pivot", "other").distinct(), texts, ("id", "other"))
    border = cut_lineage(reach.filter(_alike(F.col("a"), F.col("b"), 2 * wide)).select("id", "pivot", "other"))
    across = border.select(F.col("id").alias("dst"), F.col("pivot").alias("other"), F.col("other").alias("pivot"))
    meet = border.filter("pivot < other").join(across, ["pivot", "other"]).select(F.col("id").alias("src"), "dst").distinct()
    return _compared(meet, texts, ("src", "dst")).filter("alike").select("src", "dst")


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", complete: bool = False) -> DataFrame:
    """(r1, r2, drop): for each document (r1, r2) with repeated lines the line numbers to take out.

    The first occurrence of each group of alike lines stays, by key (nulls last), then document, then line.
    """
    lines = line_table(docs, key, text, complete)
    different = different_lines(lines)
    links = line_links(different, lines, complete=complete)
    ends = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    groups = label_components(ends, links, "id").withColumnRenamed("component", "line_group")
    repeated = cut_lineage(
        different.select("id", F.struct("h1", "h2").alias("line"), "n").join(groups, "id", "left").filter("n > 1 OR line_group IS NOT NULL")
        .select("line", "n", F.coalesce("line_group", "id").alias("line_group"))
    )
    seen = lines.select(F.struct("h1", "h2").alias("line"), "at")
    if repeated.count() <= BROADCAST_ROWS:
        held = seen.join(F.broadcast(repeated.drop("n")), "line")
    else:
        hot = repeated.filter(F.col("n") >= HOT_KEY_ROWS).select("line", F.ceil(F.col("n") / HOT_KEY_ROWS).alias("salts"))
        held = salted_join(seen, repeated.drop("n"), hot, "line", "inner")
    held = cut_lineage(held.select("line_group", "at"))
    release(lines, different)
    firsts = cut_lineage(held.groupBy("line_group").agg(F.min("at").alias("stays")))
    gone = lookup(held, firsts, "line_group", "inner").filter("at <> stays")
    return gone.select("at.r1", "at.r2", "at.line_no").groupBy("r1", "r2").agg(F.collect_set("line_no").alias("drop"))


def drop_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", complete: bool = False) -> DataFrame:
    """``docs`` without repeated lines; all rows and columns stay, only ``text`` changes.

    Lines end at line feeds. Equal lines of any length are repeats, but those without words (letters and digits), blank ones too, are never
    taken out; alike ones need MIN_WORDS words or MIN_CHARS characters. Repeated rows (equal in key and text) are one document and keep the same lines.
    Null texts stay null; a text that loses all its lines becomes empty. ``complete`` compares all lines that can be alike,
    not only those that share SimHash blocks or halves.
    """
    columns = docs.columns
    own = [f"c{i}" for i in range(len(columns))]
    plain = docs.toDF(*own)
    key_at, text_at = own[columns.index(key)], own[columns.index(text)]
    with tidy_shuffles(docs.sparkSession):
        gone = repeated_lines(plain, key_at, text_at, complete)
    joined = plain.withColumns(
        {"r1": F.xxhash64(key_at, text_at), "r2": F.xxhash64(F.lit(1), text_at, key_at)}
    ).join(gone, ["r1", "r2"], "left")
    stay = F.filter(F.split(text_at, "\n"), lambda _, i: ~F.array_contains("drop", i))
    changed = F.when(F.col("drop").isNull(), F.col(text_at)).otherwise(F.concat_ws("\n", stay))
    return joined.withColumn(text_at, changed).select(*own).toDF(*columns)
