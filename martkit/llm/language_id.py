"""Tell the language of texts by rank-order profiles of their most frequent character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from martkit.llm.common import columns_of, steps

UNKNOWN = "und"
# n-grams kept of a profile, and the longest n-gram in characters.
PROFILE = 300
LONGEST = 3
# Counts that a training task holds before it hands them on.
HELD = 400_000

_SPACE = 32


@lru_cache(1)
def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or a space if it is no letter."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


class Grams:
    """The n-grams of several texts as numbers: words of letters between single spaces, letter case folded."""

    def __init__(self, texts: list[str | None]):
        # A space before and after each text; lone surrogates cannot occur in a text column.
        raw = "".join([f" {t} " if t else "  " for t in texts]).encode("utf-32-le")
        chars = _letters()[np.frombuffer(raw, "<u4")]
        sizes = np.fromiter((len(t or "") + 2 for t in texts), np.int64, len(texts))
        text_of = np.repeat(np.arange(len(texts)), sizes)
        space = chars == _SPACE
        repeated = space[1:] & space[:-1] & (text_of[1:] == text_of[:-1])
        kept = np.concatenate([[True], ~repeated])
        chars, text_of = chars[kept].astype(np.uint64), text_of[kept]
        codes, owners = [], []
        code = np.zeros(len(chars), np.uint64)
        for n in range(1, LONGEST + 1):
            code = (code[: len(chars) - n + 1] << np.uint64(21)) | chars[n - 1 :]
            whole = text_of[: len(code)] == text_of[n - 1 :]
            if n == 1:
                whole &= chars != _SPACE
            else:
                whole &= code != _SPACE << 21 | _SPACE
            codes.append(code[whole])
            owners.append(text_of[: len(code)][whole])
        self.codes = codes
        # Where each text's n-grams of each length begin.
        self.bounds = [np.searchsorted(o, np.arange(len(texts) + 1)) for o in owners]

    def counts(self, text: int) -> tuple[np.ndarray, np.ndarray]:
        parts = [c[b[text] : b[text + 1]] for c, b in zip(self.codes, self.bounds, strict=True)]
        return np.unique(np.concatenate(parts), return_counts=True)

    def empty(self, text: int) -> bool:
        return self.bounds[0][text] == self.bounds[0][text + 1]


def _most_frequent(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Codes by falling count, then code."""
    return codes[np.argsort(-counts, kind="stable")[:size]]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    sums = np.zeros(len(codes), np.int64)
    np.add.at(sums, where, np.concatenate([p[1] for p in parts]))
    return codes, sums


def count_grams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, gram, n)``: how often each n-gram occurs in the texts of a language, over all rows.

    Rows without language or text count for nothing.
    """
    frame = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        rows = 0
        for part in steps(batches):
            by_lang: dict[str, list[str]] = {}
            for name, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                by_lang.setdefault(name, []).append(t)
            for name, texts in by_lang.items():
                grams = Grams(texts)
                found = np.unique(np.concatenate(grams.codes), return_counts=True)
                held.setdefault(name, []).append(found)
                rows += len(found[0])
            if rows > HELD:
                held = {k: [_merged(v)] for k, v in held.items()}
                rows = sum(len(v[0][0]) for v in held.values())
                if rows > HELD // 2:
                    yield from _rows(held)
                    held, rows = {}, 0
        yield from _rows(held)

    counted = frame.dropna().mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _rows(held: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
    for name, parts in held.items():
        codes, sums = _merged(parts)
        if len(codes):
            names = pa.array([name] * len(codes), pa.string())
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(codes.astype(np.int64)), pa.array(sums)], names=["lang", "gram", "n"]
            )


@dataclass(frozen=True)
class Profiles:
    """Per language the ranks of its most frequent n-grams: ``PROFILE`` numbers for each language."""

    langs: tuple[str, ...]
    grams: np.ndarray  # sorted codes of all profiles
    ranks: np.ndarray  # languages by grams; PROFILE where a profile lacks the gram

    def judge(self, codes: np.ndarray) -> tuple[str, float]:
        """Nearest language of a text's ranked n-grams; the score is 1 less its share of the largest distance.

        Out-of-place distance: the difference of ranks, and ``PROFILE`` for an n-gram the profile lacks.  Of equal
        distances the first language by name wins.
        """
        if not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, codes), len(self.grams) - 1)
        known = self.grams[at] == codes
        ranks = np.where(known, self.ranks[:, at], PROFILE)
        distance = np.where(ranks == PROFILE, PROFILE, np.abs(ranks - np.arange(len(codes)))).sum(axis=1)
        best = int(np.argmin(distance))
        return self.langs[best], float(1 - distance[best] / (PROFILE * len(codes)))


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles of all languages that ``docs`` names.  At most ``PROFILE`` rows a language reach the driver."""
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), F.col("gram"))
    top = count_grams(docs, text, lang).withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < PROFILE)
    rows = top.select("lang", "gram", "rank").collect()
    langs = sorted({r.lang for r in rows})
    grams = np.unique(np.array([r.gram for r in rows], np.uint64))
    ranks = np.full((len(langs), len(grams)), PROFILE, np.int64)
    for r in rows:
        ranks[langs.index(r.lang), np.searchsorted(grams, np.uint64(r.gram))] = r["rank"]
    return Profiles(tuple(langs), grams, ranks)


def predict_language(docs: DataFrame, profiles: Profiles, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` of each row, from the whole text alone.

    A text that is null, empty or without letters is ``und`` with score 0; so is any text if nothing was learned.
    """
    frame = columns_of(docs, key, text)
    shared = frame.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part in steps(batches):
            texts = part.column(1).to_pylist()
            grams = Grams(texts)
            made = [
                (UNKNOWN, 0.0) if grams.empty(i) else known.judge(_most_frequent(*grams.counts(i), PROFILE))
                for i in range(len(texts))
            ]
            langs, scores = zip(*made, strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return frame.mapInArrow(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def language_report(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out and predict all rows."""
    profiles = learn_profiles(docs.filter(~held_out), text, lang)
    predicted = predict_language(docs, profiles, key, text)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
