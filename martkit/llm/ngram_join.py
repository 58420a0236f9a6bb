"""Join documents by the Jaccard similarity of their word shingles, through parity sketches.

Every shingle flips one bit of a document's sketch, so two sketches differ in no more bits than the sets differ in
shingles.  Similar sets of a size band differ in at most D shingles; of more than D parts of the sketch that are not
empty, one must then be equal.  Documents meet on equal parts (as hashes); how many parts and bits differ rules out most
pairs, and the rest are verified on the shingles themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martkit.llm.common import Words, byte_texts, columns_of, cut, mixed, own_name, small_enough, steps
from martkit.llm.links import BROADCAST_PAIRS, classes_by_keys
from martkit.operators.joins import spread_join
from martkit.sources.tables import StageArea

SHINGLE = 5
# Ids of distinct sets that may be broadcast while texts are read again; more are shuffled.
BROADCAST_IDS = 1_000_000
# Words of the sketch that a document keeps, at least; a larger set has two bits a shingle, to the next power of two.
SKETCH_WORDS = 16
# Bits of the map of frequent parts, and from how many documents on a part is frequent: in the stretch of documents
# that a task looks at together, and in all.
MAP_BITS = 1 << 26
STRETCH_KEYS, OFTEN_HERE, OFTEN = 2_000_000, 4, 32

# Fixed value: blank, tab to carriage return separate words.
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False

# Linked sets share 75 of 100: they differ in a seventh of the sum of their sizes at most, and neither is smaller
# than three quarters of the other.
SIMILAR = (75, 100)


def _band(n: int) -> int:
    """Sizes from a power of two to the next make up a band."""
    return n.bit_length() - 1


def _parts(band: int) -> int:
    """Parts of a sketch in a band: a quarter more than there can be differences."""
    most = 2 * (2 ** (band + 1) - 1) // 7
    return (5 * (most + 1) + 3) // 4 + 1


class Sets:
    """Shingle sets of several texts: sorted distinct 64-bit hashes of each."""

    def __init__(self, texts: list[bytes], size: int = SHINGLE):
        words = Words([t.lower() for t in texts], _IS_WORD)
        whole = words.windows(size)
        self.sets = []
        for a, b in zip(words.first, words.first[1:], strict=False):
            if b - a >= size:
                self.sets.append(np.unique(whole[a : b - size + 1]))
            elif b > a:
                own = words.hash[a:b]
                h = np.full(1, b - a, np.uint64)
                for x in own:
                    h = mixed(h * np.uint64(0xD6E8FEB86659FD93) + x)
                self.sets.append(h)
            else:
                self.sets.append(np.zeros(0, np.uint64))


def _part_hashes(shingles: np.ndarray, labels: np.ndarray, band: int) -> np.ndarray:
    """Hashes of the parts that are not empty.

    A shingle's high bits say which part it is in, so parts are stretches of the sorted set; its label stands for the bit that
    it flips in the part, and the labels of a part are joined by XOR, which is the parity of each bit.
    """
    part = ((shingles >> np.uint64(32)) * np.uint64(_parts(band))) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    parity = np.bitwise_xor.reduceat(labels, starts)
    return mixed(parity + (part[starts] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((band + 1) << 40))


def _bands(n: int) -> list[tuple[int, int]]:
    """The own band, and the next one if a similar set can be in it; with the most shingles that may then differ."""
    b = _band(n)
    largest = 4 * n // 3
    near = (b, (n + min(largest, 2 ** (b + 1) - 1)) // 7)
    return [near, (b + 1, (n + largest) // 7)] if largest >= 2 ** (b + 1) else [near]


def _labels(shingles: np.ndarray) -> np.ndarray:
    return mixed(shingles ^ np.uint64(0xA0761D6478BD642F))


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles at each bit.  A sketch of half the width is the XOR of this one's halves."""
    words = max(SKETCH_WORDS, 1 << (2 * len(shingles) // 64).bit_length())
    bits = np.bincount((shingles & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _bits_apart(a: Column, b: Column) -> Column:
    """Bits in which two sketches differ, once the wider one is folded to the width of the other."""
    narrow, wide = F.when(F.size(a) <= F.size(b), a).otherwise(b), F.when(F.size(a) <= F.size(b), b).otherwise(a)
    # Sizes differ by a third at most, so one width is at most twice the other.
    half = F.size(narrow)
    folded = F.zip_with(F.slice(wide, 1, half), F.slice(wide, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    same = F.when(F.size(wide) > half, folded).otherwise(wide)
    apart = F.zip_with(narrow, same, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(apart, F.lit(0), lambda n, x: n + x)


def _folded(sketch: Column) -> list[Column]:
    """A sketch as SKETCH_WORDS columns: the wider ones are folded, which never makes two sketches differ in more bits."""
    word = lambda i: F.aggregate(
        F.sequence(F.lit(0), (F.size(sketch) / SKETCH_WORDS).cast("int") - 1),
        F.lit(0).cast("long"),
        lambda x, k: x.bitwiseXOR(F.element_at(sketch, k * SKETCH_WORDS + i + 1)),
    )
    return [word(i).alias(f"w{i}") for i in range(SKETCH_WORDS)]


def _can_link(x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
    """Whether sizes and folded sketches are such as similar sets can have."""
    sizes = 4 * F.least(x("n"), y("n")) >= 3 * F.greatest(x("n"), y("n"))
    apart = reduce(Column.__add__, [F.bit_count(x(f"w{i}").bitwiseXOR(y(f"w{i}"))) for i in range(SKETCH_WORDS)])
    return sizes & (7 * apart <= x("n") + y("n"))


def _describe(sets: list[np.ndarray]) -> list[tuple]:
    """Size, two hashes of the whole set, and the small sketch."""
    out = []
    for s in sets:
        if len(s):
            first = np.bitwise_xor.reduce(_labels(s)).astype(np.int64)
            second = np.sum(mixed(s + np.uint64(0x2545F4914F6CDD1D))).astype(np.int64)
            out.append((len(s), int(first), int(second), _sketch(s)))
        else:
            out.append((0, 0, 0, np.zeros(SKETCH_WORDS, np.int64)))
    return out


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds, from one pass over the texts: a document's size, hashes and sketch; parts that occur often among the
    documents of a stretch, as ``key`` and ``times``."""
    held: list[np.ndarray] = []

    def counted() -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(held or [np.zeros(0, np.uint64)]), return_counts=True)
        often = n >= OFTEN_HERE
        none = [pa.nulls(int(often.sum()), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([*none, pa.array(keys[often].astype(np.int64)), pa.array(n[often])], names=_DESCRIBED)

    for part in steps(batches):
        sets = Sets(byte_texts(part.column(1))).sets
        n, a, b, sketch = zip(*_describe(sets), strict=True)
        longs = [pa.array(c, pa.int64()) for c in (n, a, b)]
        lists = pa.array([s.tolist() for s in sketch], pa.list_(pa.int64()))
        none = [pa.nulls(len(sets), pa.int64())] * 2
        yield pa.RecordBatch.from_arrays([part.column(0), *longs, lists, *none], names=_DESCRIBED)
        for s in sets:
            if len(s):
                labels = _labels(s)
                held += [_part_hashes(s, labels, band) for band, _ in _bands(len(s))]
        if sum(map(len, held)) > STRETCH_KEYS:
            yield counted()
            held = []
    yield counted()


_DESCRIBED = ["doc_id", "n", "h1", "h2", "sketch", "key", "times"]


def frequent_parts(described: DataFrame) -> np.ndarray:
    """A bit map of fixed size, one bit a frequent part: only an order of parts follows from it, so it may be rough."""
    counts = described.filter("key IS NOT NULL").groupBy("key").agg(F.sum("times").alias("n")).filter(F.col("n") >= OFTEN)
    places = counts.select(F.expr(f"CAST(pmod(key, {MAP_BITS}) DIV 64 AS INT)").alias("word"), F.expr("shiftleft(1L, CAST(pmod(key, 64) AS INT))").alias("bit"))
    found = places.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # MAP_BITS / 64 rows of 12 bytes at most
    words = np.zeros(MAP_BITS // 64, np.uint64)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint64)
    return words


def _rare_first(keys: np.ndarray, often: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(MAP_BITS - 1)
    flags = (often[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
    return keys[np.argsort(flags, kind="stable")]


def _keys(ids: pa.Array, texts: list[bytes], often: np.ndarray) -> pa.RecordBatch:
    """``(key, id, own)``: hashes of as many parts as may differ, and one more; frequent parts come last in their order.

    Sets that differ in d of their parts in use agree in one of the first d + 1, in any order that is the same for all sets.
    So a passage that many documents share makes no key where a document has other parts enough.  Where so few parts are in
    use that all may differ, the first shingles are keys besides, for two such sets.
    """
    keys, counts, own = [], [], []
    for s in Sets(texts).sets:
        before = len(keys)
        if len(s):
            labels = _labels(s)
            for i, (band, most) in enumerate(_bands(len(s))):
                parts = _rare_first(_part_hashes(s, labels, band), often)
                keys.append(parts[: most + 1])
                own.append(np.full(len(keys[-1]), i == 0))
                if len(parts) <= most:
                    keys.append(mixed(labels[: most + 1] + np.uint64(1)))
                    own.append(np.full(len(keys[-1]), True))
        counts.append(sum(map(len, keys[before:])))
    repeated = ids.take(pa.array(np.repeat(np.arange(len(ids)), counts)))
    flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    owned = np.concatenate(own) if own else np.zeros(0, bool)
    return pa.RecordBatch.from_arrays([pa.array(flat.astype(np.int64)), repeated, pa.array(owned)], names=["key", "id", "own"])


def _mapped(docs: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            yield make(part)

    return docs.mapInArrow(run, schema)


def _set_rows(part: pa.RecordBatch) -> pa.RecordBatch:
    sets = pa.array([s.astype(np.int64).tolist() for s in Sets(byte_texts(part.column(1))).sets], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([part.column(0), sets], names=["id", "shingles"])


def similar_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of each row: its set's size and the smallest id that links lead to.

    Words are stretches without white space, letter case of A-Z does not count.  A text of fewer than five words is one
    shingle; a null or empty text, or one without words, has an empty set and is alone.  Ids are integers; rows of the same
    id count as one document; rows without an id are linked to others by equal sets only, and have none as component if
    no row of their class has one.  Equal sets are joined before anything meets, so copies cost nothing.
    """
    frame = columns_of(docs, key, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    with StageArea(docs.sparkSession) as stage:
        return cut(_classes(frame, stage))


def _classes(frame: DataFrame, stage: StageArea) -> DataFrame:
    schema = "doc_id long, n long, h1 long, h2 long, sketch array<long>, key long, times long"
    read = stage(frame.mapInArrow(_described, schema), "read")
    described = read.filter("n IS NOT NULL").drop("key", "times")
    same = ["n", "h1", "h2"]
    groups = described.filter("n > 0").groupBy(*same).agg(F.min("doc_id").alias("first"))
    groups = stage(groups, "groups")
    firsts = groups.select(F.col("first").alias("doc_id")).dropna().distinct()
    chosen = frame.join(small_enough(firsts, BROADCAST_IDS), "doc_id").select("doc_id", "text")
    often = frame.sparkSession.sparkContext.broadcast(frequent_parts(read))
    members = _mapped(chosen, lambda part: _keys(part.column(0), byte_texts(part.column(1)), often.value), "key long, id long, own boolean")
    known = described.join(groups.select(*same, F.col("first").alias("doc_id")), [*same, "doc_id"]).dropDuplicates(["doc_id"])
    known = stage(known.select(F.col("doc_id").alias("id"), "n", "sketch"), "known")

    def likely(pairs: DataFrame) -> DataFrame:
        """Pairs of sizes and sketches that similar sets can have."""
        of = lambda s: known.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
        sizes = 4 * F.least("n_a", "n_b") >= 3 * F.greatest("n_a", "n_b")
        sized = known.select("id", "n")
        # Ids are known once, so that no join makes more rows than there are pairs.
        few = F.broadcast if pairs.limit(BROADCAST_PAIRS + 1).count() <= BROADCAST_PAIRS else lambda df: df
        near = few(few(pairs).join(sized.toDF("a", "n_a"), "a")).join(sized.toDF("b", "n_b"), "b").filter(sizes).select("a", "b")
        both = near.join(of("a"), "a").join(of("b"), "b")
        apart = _bits_apart(F.col("sketch_a"), F.col("sketch_b"))
        return both.filter(7 * apart <= F.col("n_a") + F.col("n_b")).select("a", "b")

    def confirm(pairs: DataFrame) -> DataFrame:
        pairs = stage(likely(pairs), "likely")
        wanted = stage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")
        texts = chosen.join(small_enough(wanted, BROADCAST_IDS), "doc_id").select("doc_id", "text")
        sets = stage(_mapped(texts, _set_rows, "id long, shingles array<long>"), "sets")
        first = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
        second = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
        both = F.size(F.array_intersect("sa", "sb"))
        joined = pairs.join(first, "a").join(second, "b").select("a", "b", both.alias("both"), (F.size("sa") + F.size("sb")).alias("sum"))
        least, of = SIMILAR
        return joined.filter(of * F.col("both") >= least * (F.col("sum") - F.col("both"))).select("a", "b")

    def marks_among(ids: DataFrame) -> DataFrame:
        return known.join(ids, "id").select("id", "n", *_folded(F.col("sketch")))

    labels = classes_by_keys(members, lambda _: confirm, stage, marks_among, _can_link, once=True)
    often.unpersist()
    named = groups.join(labels.withColumnRenamed("id", "first"), "first", "left")
    named = stage(named.select(*same, F.coalesce("label", "first").alias("label")), "named")
    out = spread_join(described.select("doc_id", *same), named, same, "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("label"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def drop_similar(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their class; of rows with the same id all or none.

    Rows without an id stay, as nothing names them.
    """
    classes = similar_classes(docs, key, text)
    name = own_name(docs, "gone")
    gone = cut(classes.filter("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct())
    return docs.join(small_enough(gone, BROADCAST_IDS), F.col(f"`{key}`").cast("long") == F.col(name), "left_anti")
