"""Find passages of a benchmark in training texts, and remove the passages or the texts.

The benchmark's word windows form a hash set that every task holds; the texts stream past it once, nothing is
shuffled.  A hash hit counts only after the words themselves are compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from martkit.llm.common import Words, byte_texts, columns_of, cut, own_name, steps

WINDOW = 13
# Benchmark text that one pass holds in memory; a larger benchmark is compared in several passes.
BLOCK_BYTES = 16 << 20

# Fixed value: digits, lower-case letters and all that is not ASCII make up words.
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_PAIRS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
# What a pass finds: words, hit words, items found, hit stretches as words and as code points.
_FOUND = {"n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(pa.string()), "ranges": _PAIRS, "spans": _PAIRS}


class WindowSet:
    """The windows of some items: hashes in order, by window length, and where their words stand."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.names = [name for name, _ in items]
        self.words = Words([t.lower() for _, t in items], _IS_WORD)
        first = self.words.first
        sizes = np.diff(first)
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted({min(int(n), window) for n in sizes if n}):
            hashes = self.words.windows(size)
            # Windows within one item; items of fewer words than a window are one whole window.
            starts = [np.arange(a, b - size + 1) for a, b, n in zip(first, first[1:], sizes, strict=False) if n == size or n > size == window]
            at = np.concatenate(starts)
            order = np.argsort(hashes[at], kind="stable")
            at = at[order]
            ordered = hashes[at]
            likely = np.zeros(1 << 20, bool)
            likely[ordered >> np.uint64(44)] = True
            self.by_size[size] = (ordered, at, likely)

    def matches(self, size: int, words: Words, i: int, hash_: np.uint64) -> set[str]:
        """Items that have just the words of the window at i."""
        ordered, at, _ = self.by_size[size]
        low, high = np.searchsorted(ordered, hash_, "left"), np.searchsorted(ordered, hash_, "right")
        own = words.word(i, i + size)
        return {self.names[np.searchsorted(self.words.first, k, "right") - 1] for k in at[low:high] if self.words.word(k, k + size) == own}

    def scan(self, texts: list[bytes], before: list[tuple[list[str], list[dict[str, int]]]] | None = None) -> list[tuple]:
        """The values of ``_FOUND`` per text; ``before`` has items and ranges that an earlier pass found."""
        words = Words([t.lower() for t in texts], _IS_WORD)
        covered = np.zeros(len(words.hash) + 1, np.int64)
        found: dict[int, set[str]] = {}
        for text, (items, ranges) in enumerate(before or []):
            if items:
                found[text] = set(items)
                for r in ranges:
                    covered[words.first[text] + r["start"]] += 1
                    covered[words.first[text] + r["end"]] -= 1
        for size, (ordered, _, likely) in self.by_size.items():
            hashes = words.windows(size)
            maybe = np.flatnonzero(likely[hashes >> np.uint64(44)])
            maybe = maybe[ordered[np.minimum(np.searchsorted(ordered, hashes[maybe]), len(ordered) - 1)] == hashes[maybe]]
            text_of = np.searchsorted(words.first, maybe, "right") - 1
            inside = maybe + size <= words.first[text_of + 1]
            for i, text in zip(maybe[inside], text_of[inside], strict=True):
                if items := self.matches(size, words, i, hashes[i]):
                    found.setdefault(int(text), set()).update(items)
                    covered[i] += 1
                    covered[i + size] -= 1
        hit = np.cumsum(covered[:-1]) > 0
        out = []
        for text in range(len(texts)):
            a, b = words.first[text], words.first[text + 1]
            if text in found:
                ranges = _runs(hit[a:b])
                spans = _spans(texts[text], words, text, ranges)
                out.append((int(b - a), int(hit[a:b].sum()), sorted(found[text]), ranges, spans))
            else:
                out.append((int(b - a), 0, [], [], []))
        return out


def _runs(flags: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"start": int(i), "end": int(j)} for i, j in zip(edges[::2], edges[1::2], strict=True)]


def _spans(raw: bytes, words: Words, text: int, ranges: list[dict[str, int]]) -> list[dict[str, int]]:
    """Word ranges of one text as code points."""
    first, offset = words.first[text], words.offset[text]
    spans, at, chars = [], 0, 0
    for r in ranges:
        start, end = int(words.start[first + r["start"]] - offset), int(words.end[first + r["end"] - 1] - offset)
        begin = chars + len(raw[at:start].decode())
        chars = begin + len(raw[start:end].decode())
        at = end
        spans.append({"start": begin, "end": chars})
    return spans


_sets: dict[object, WindowSet] = {}


def _set_of(shared, window: int, number: str) -> WindowSet:
    """One window set per worker process; ``number`` is the pass's own, as another pass's items may get the address of released ones."""
    key = (number, window)
    if key not in _sets:
        _sets.clear()
        _sets[key] = WindowSet(shared.value, window)
    return _sets[key]


def _items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """Items that have an id; texts of one id add up."""
    named = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))
    return named.dropna()


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, dict[str, str]]:
    """The rows of ``docs`` with ``n_words``, ``n_hit``, ``items`` (sorted ids), ``ranges`` and ``spans`` added.

    Also says under which names they were added, as ``docs`` may have such columns of its own.  Letter case of A-Z does
    not count.  A window is ``window`` consecutive words of an item; an item of fewer words is one window.  A null or
    empty text has no words and no hits.  Items without id or text, or without words, are never found; an empty
    benchmark finds nothing.  Repeated rows are each judged alike.
    """
    items = _items(benchmark, item, item_text)
    total = items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    blocks = 1 + int(total // block_bytes)
    names: dict[str, str] = {}
    for name in _FOUND:
        names[name] = own_name(docs, name)
    for block in range(blocks):
        of_block = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        held = [(r.item, r.text.encode()) for r in of_block.collect()]  # about block_bytes, or one long item
        docs = _one_pass(docs, held, window, text, names, block > 0)
        if block + 1 < blocks:
            docs = cut(docs)
    return docs, names


def _one_pass(
    docs: DataFrame, held: list[tuple[str, bytes]], window: int, text: str, names: dict[str, str], again: bool
) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(held)
    number = uuid.uuid4().hex
    fresh = list(names.values())
    at = docs.columns.index(text)
    kept = [i for i, c in enumerate(docs.columns) if c not in fresh]
    earlier = [docs.columns.index(names["items"]), docs.columns.index(names["ranges"])] if again else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _set_of(shared, window, number)
        for part in steps(batches, at):
            before = list(zip(*[part.column(i).to_pylist() for i in earlier], strict=True)) if earlier else None
            rows = windows.scan(byte_texts(part.column(at)), before)
            made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _FOUND.values(), strict=True)]
            columns = [*[part.column(i) for i in kept], *made]
            yield pa.RecordBatch.from_arrays(columns, names=[*[part.schema.names[i] for i in kept], *fresh])

    pairs = "array<struct<start:bigint,end:bigint>>"
    found = StructType.fromDDL(f"n_words long, n_hit long, items array<string>, ranges {pairs}, spans {pairs}")
    schema = StructType([docs.schema[i] for i in kept])
    for field in found:
        schema = schema.add(names[field.name], field.dataType)
    return docs.mapInArrow(run, schema)


def contaminated(names: dict[str, str]) -> Column:
    """Hits make up a twentieth of the words or more."""
    hit, words = F.col(names["n_hit"]), F.col(names["n_words"])
    return (hit > 0) & (20 * hit >= words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options: object) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    found, names = find_passages(docs, benchmark, text, **options)
    return found.filter(~contaminated(names)).select(*[F.col(f"`{c}`") for c in docs.columns])


def cut_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options: object) -> DataFrame:
    """All rows of ``docs``, their texts without the hit stretches."""
    found, names = find_passages(docs, benchmark, text, **options)
    spans, value = F.col(names["spans"]), F.col(f"`{text}`")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.char_length(value).cast("long")))
    kept = F.zip_with(starts, ends, lambda a, b: F.substring(value, (a + 1).cast("int"), (b - a).cast("int")))
    return found.withColumn(text, F.when(F.size(spans) > 0, F.array_join(kept, "")).otherwise(value)).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options: object) -> DataFrame:
    """Per row: key, words, hit words, number and digest of the items found, and the verdict."""
    found, names = find_passages(columns_of(docs, key, text), benchmark, **options)
    items = F.col(names["items"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(names).alias("contaminated"),
    )
