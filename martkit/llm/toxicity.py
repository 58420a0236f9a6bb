"""Score the toxicity of texts by weak supervision.

Voters look for words and word beginnings of a lexicon, one voter an entry, and for patterns.  A generative label model learns from
the votes on labelled and unlabelled texts how often each voter is right and how voters depend on each other; voters that say nothing
are dropped, those that are right less often than chance are turned round.  Its posterior labels, of labelled and unlabelled texts
alike, train a linear classifier.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martkit.llm.common import byte_texts, columns_of, cut, forget, steps
from martkit.llm.quality import labelled_sample

# Rows that train the model, at most: labelled ones, from which the lexicon is learned too, and others.
TRAINING_ROWS, UNLABELLED_ROWS = 20_000, 10_000
# Entries of the lexicon, each of which is a voter.
ENTRIES = 48
# Bytes of word beginnings that may become entries.
BEGINNINGS = range(4, 11)
# Words that a task counts before it passes them on, and words whose beginnings it makes at a time.
COUNTED_WORDS, STEM_WORDS = 300_000, 10_000
# Toxic texts that an entry must be in, and how much likelier it must be in them.
LEAST_TEXTS, LEAST_RATIO = 3, 3.0
# How far a given label is trusted beside the votes.
LABEL_TRUST = 0.98
# Evidence (log odds) from which on a voter votes, and below which a pattern's votes say nothing.
VOTING, TELLING = 1.0, 0.3
TOXIC, CLEAN, ABSTAIN = 2, 1, 0

_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_APART = bytes(b if _IS_WORD[b] else 32 for b in range(256))

# What the pattern voters look for, in order.
PATTERNS = ("exclamations", "symbols", "capitals", "repetition", "brevity", "digits", "quiet")


def _stems(word: bytes) -> set[tuple[bytes, bool]]:
    """A word and its beginnings that do not end inside a character."""
    out = {(word, True)}
    for n in BEGINNINGS:
        if n < len(word) and word[n] & 0xC0 != 0x80:
            out.add((word[:n], False))
    return out


def count_stems(sample: DataFrame) -> DataFrame:
    """``(stem, whole, y, n)``: occurrences of words and word beginnings in the texts of each label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for part in steps(batches):
            for y, text in zip(part.column(2).to_pylist(), byte_texts(part.column(1)), strict=True):
                counts[y].update(text.lower().translate(_APART).split())
            if sum(map(len, counts.values())) > COUNTED_WORDS:
                yield from _stem_rows(counts)
                counts = {0: Counter(), 1: Counter()}
        yield from _stem_rows(counts)

    counted = sample.select("doc_id", "text", "y").mapInArrow(run, "stem binary, whole boolean, y int, n long")
    return counted.groupBy("stem", "whole", "y").agg(F.sum("n").alias("n"))


def _stem_rows(counts: dict[int, Counter]) -> Iterator[pa.RecordBatch]:
    """Counts of stems, a few words in order at a time, so that words of one beginning mostly come together."""
    for y, words in counts.items():
        ordered = sorted(words)
        for start in range(0, len(ordered), STEM_WORDS):
            stems: Counter = Counter()
            for word in ordered[start : start + STEM_WORDS]:
                for stem in _stems(word):
                    stems[stem] += words[word]
            names, whole = zip(*stems, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(whole), pa.array([y] * len(stems), pa.int32()), pa.array(stems.values(), pa.int64())],
                names=["stem", "whole", "y", "n"],
            )


def learn_lexicon(sample: DataFrame) -> list[tuple[bytes, bool]]:
    """Entries that tell toxic texts from others best, by log-likelihood ratio: words, or beginnings of words.

    ``4 * ENTRIES`` rows reach the driver.
    """
    counts = cut(count_stems(sample))
    totals = {r.y: r.n for r in counts.filter("whole").groupBy("y").agg(F.sum("n").alias("n")).collect()}
    t1, t0 = totals.get(1, 0), totals.get(0, 0)
    if not t1 or not t0:
        return []
    of = lambda y: F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0))
    both = counts.groupBy("stem", "whole").agg(of(1).alias("c1"), of(0).alias("c0"))
    share = F.lit(t1 / (t1 + t0))
    all_, c1, c0 = F.col("c1") + F.col("c0"), F.col("c1"), F.col("c0")
    ratio = 2 * (c1 * F.log(c1 / (all_ * share)) + F.when(c0 > 0, c0 * F.log(c0 / (all_ * (1 - share)))).otherwise(0.0))
    rows = (
        both.filter((c1 >= LEAST_TEXTS) & (c1 / t1 > 3 * c0 / t0))
        .withColumn("ratio", F.round(ratio, 6))
        .orderBy(F.col("ratio").desc(), F.length("stem").desc(), F.col("whole").desc(), "stem")
        .limit(4 * ENTRIES)
        .collect()
    )
    chosen: list[tuple[bytes, bool]] = []
    for r in rows:
        stem = bytes(r.stem)
        # One entry for a family of stems: the one that tells most.
        if not any(stem.startswith(o) or o.startswith(stem) for o, _ in chosen) and len(chosen) < ENTRIES:
            chosen.append((stem, r.whole))
    return chosen


class Matcher:
    """Counts of words, entries and patterns in texts."""

    def __init__(self, entries: list[tuple[bytes, bool]]):
        self.entries = entries
        self.whole = {e: i for i, (e, w) in enumerate(entries) if w}
        self.begin = {e: i for i, (e, w) in enumerate(entries) if not w}
        self.lengths = sorted({len(e) for e in self.begin})
        self.known: dict[bytes, int] = {}

    def entry(self, word: bytes) -> int:
        """The entry that a word belongs to, or -1."""
        i = self.whole.get(word, -1)
        for n in self.lengths:
            if i >= 0 or n >= len(word):
                break
            i = self.begin.get(word[:n], -1)
        return i

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text, occurrences of each entry, and which patterns fit (0 or 1)."""
        n = np.zeros(len(texts), np.float32)
        found = np.zeros((len(texts), len(self.entries)), np.float32)
        fits = np.zeros((len(texts), len(PATTERNS)), np.float32)
        known = self.known
        if len(known) > 200_000:
            known.clear()
        for row, text in enumerate(texts):
            words = Counter(text.lower().translate(_APART).split())
            n[row] = words.total()
            for word, k in words.items():
                i = known.get(word)
                if i is None:
                    i = known[word] = self.entry(word)
                if i >= 0:
                    found[row, i] += k
            size = len(text)
            marks = sum(map(text.count, (b"*", b"$", b"#", b"&", b"%")))
            digits = sum(map(text.count, (b"0", b"1", b"2", b"3", b"4", b"5", b"6", b"7", b"8", b"9")))
            fits[row, :-1] = (
                text.count(b"!") * 50 > size > 0, marks * 20 > size > 0, text.isupper(), n[row] >= 8 and max(words.values()) * 4 > n[row],
                n[row] < 8, digits * 10 > size > 0,
            )
            fits[row, -1] = not found[row].any() and not fits[row, :-1].any()
        return n, found, fits


@dataclass(frozen=True)
class Evidence:
    """What it says about a text that an entry is in it, and how often: rates in the texts that have it."""

    has: np.ndarray  # log odds of presence
    lacks: np.ndarray  # log odds of absence
    weight: np.ndarray  # log odds of an occurrence
    cost: np.ndarray  # difference of the rates per word

    @classmethod
    def of(cls, n: np.ndarray, found: np.ndarray, y: np.ndarray) -> Evidence:
        """From labelled texts; where few have an entry, the rates lean on those of all texts that have it."""
        texts, hits, words = [], [], []
        for label in (1, 0):
            rows = y == label
            there = found[rows] > 0
            texts.append((there.sum(axis=0) + 0.5) / (rows.sum() + 1))
            hits.append(found[rows].sum(axis=0))
            words.append((there * n[rows][:, None]).sum(axis=0))
        rate = (hits[0] + hits[1] + 0.01) / (words[0] + words[1] + 1)
        r1, r0 = ((h + 500 * rate) / (w + 500) for h, w in zip(hits, words, strict=True))
        return cls(np.log(texts[0] / texts[1]), np.log((1 - texts[0]) / (1 - texts[1])), np.log(r1 / r0), r1 - r0)

    def told(self, n: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Log odds from each entry, present ones alone."""
        return np.where(found > 0, self.has + found * self.weight - n[:, None] * self.cost, 0.0)

    def features(self, n: np.ndarray, found: np.ndarray, fits: np.ndarray) -> np.ndarray:
        told = self.told(n, found)
        total = told.sum(axis=1) + np.where(found > 0, 0.0, self.lacks).sum(axis=1)
        return np.hstack([np.clip(told, -6, 6) / 4, np.clip(total, -12, 12)[:, None] / 4, fits])

    def votes(self, n: np.ndarray, found: np.ndarray, fits: np.ndarray) -> np.ndarray:
        """One voter an entry and one a pattern; what the patterns mean the label model finds out."""
        told = self.told(n, found)
        by_entry = np.where(told > VOTING, TOXIC, np.where(told < -VOTING, CLEAN, ABSTAIN))
        return np.hstack([by_entry, np.where(fits > 0, TOXIC, ABSTAIN)]).astype(np.int8)


@dataclass(frozen=True)
class LabelModel:
    """Class shares, and for each voter the chance of its vote given the class and the vote of the voter it leans on."""

    prior: np.ndarray  # class
    lean: tuple[int, ...]  # voter it depends on, -1 for none
    table: np.ndarray  # voter, class, vote leaned on, vote
    turn: np.ndarray  # voter: 1 as it votes, -1 turned round, 0 dropped

    def turned(self, votes: np.ndarray) -> np.ndarray:
        other = np.where(votes == TOXIC, CLEAN, np.where(votes == CLEAN, TOXIC, ABSTAIN))
        return np.where(self.turn == 1, votes, np.where(self.turn == -1, other, ABSTAIN))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance of the toxic class for each row of votes, as the voters cast them."""
        return _posterior(self.prior, self.lean, self.table, self.turned(votes))

    def accuracy(self, votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Per voter, turned round or not, the expected share of right votes among its votes."""
        p, votes = self.posterior(votes)[:, None], self.turned(votes)
        right = np.where(votes == TOXIC, p, np.where(votes == CLEAN, 1 - p, 0.0)) * weight[:, None]
        cast = (votes != ABSTAIN) * weight[:, None]
        return right.sum(axis=0) / np.maximum(cast.sum(axis=0), 1e-9)


def _posterior(prior: np.ndarray, lean: tuple[int, ...], table: np.ndarray, votes: np.ndarray) -> np.ndarray:
    score = np.tile(np.log(prior), (len(votes), 1))
    for j, parent in enumerate(lean):
        on = votes[:, parent] if parent >= 0 else np.zeros(len(votes), np.int64)
        score += np.log(table[j][:, on, votes[:, j]]).T
    return 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -500, 500)))


def _orientation(votes: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """1 for voters that labelled texts bear out, -1 for those that are right less often than chance, 0 for those that say nothing."""
    base = np.log((toxic.sum() + 1) / (clean.sum() + 1))
    turn = np.ones(votes.shape[1], int)
    for j in range(votes.shape[1]):
        says = 0.0
        for vote, sign in ((TOXIC, 1), (CLEAN, -1)):
            rows = votes[:, j] == vote
            n1, n0 = toxic[rows].sum(), clean[rows].sum()
            if n1 + n0 > 0:
                says += sign * (np.log((n1 + np.exp(base)) / (n0 + 1)) - base) * (n1 + n0)
        cast = (toxic + clean)[votes[:, j] != ABSTAIN].sum()
        says /= max(cast, 1)
        # A voter that no labelled text bears out or refutes is left to the model.
        turn[j] = 1 if cast == 0 or says > TELLING else -1 if says < -TELLING else 0
    return turn


def _leaning(votes: np.ndarray, weight: np.ndarray, p: np.ndarray) -> tuple[int, ...]:
    """For each voter the earlier voter it depends on most, given the class, if at all."""
    m = votes.shape[1]
    lean = [-1] * m
    w1, w0 = weight * p, weight * (1 - p)
    marks = [(votes == v).astype(float) for v in range(3)]
    # For every pair of voters and votes, the weight of the rows that have both.
    joint = np.array([[[(a * w[:, None]).T @ b for b in marks] for a in marks] for w in (w1, w0)]) + 1e-9
    share = np.array([w1.sum(), w0.sum()]) / weight.sum()
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    free = joint.sum(axis=2, keepdims=True) * joint.sum(axis=1, keepdims=True)
    gain = np.tensordot(share, (joint * np.log(joint / free)).sum(axis=(1, 2)), 1)
    for j in range(1, m):
        k = int(np.argmax(gain[:j, j]))
        if gain[k, j] > 0.01:
            lean[j] = k
    return tuple(lean)


def fit_label_model(votes: np.ndarray, counts: np.ndarray, toxic: np.ndarray, clean: np.ndarray, rounds: int = 30) -> LabelModel:
    """Expectation maximisation over combinations of votes.

    Per combination: rows without label, with label 1, with label 0.  Labelled rows count with ``LABEL_TRUST``.
    """
    turn = _orientation(votes, toxic, clean)
    votes = LabelModel(np.ones(2), (), np.zeros(0), turn).turned(votes)
    base = (toxic.sum() + 1) / (toxic.sum() + clean.sum() + 2)
    p = (toxic + 4 * base) / (toxic + clean + 4)
    for _ in range(rounds):
        w1 = counts * p + toxic * LABEL_TRUST + clean * (1 - LABEL_TRUST)
        w0 = counts * (1 - p) + clean * LABEL_TRUST + toxic * (1 - LABEL_TRUST)
        weight = w1 + w0
        lean = _leaning(votes, weight, w1 / np.maximum(weight, 1e-9))
        table = np.full((votes.shape[1], 2, 3, 3), 1 / 3)
        for j, parent in enumerate(lean):
            on = votes[:, parent] if parent >= 0 else np.zeros(len(votes), np.int64)
            for c, w in enumerate((w0, w1)):
                joint = np.bincount(on * 3 + votes[:, j], w, 9).reshape(3, 3) + 0.1
                table[j, c] = joint / joint.sum(axis=1, keepdims=True)
        prior = np.array([w0.sum() + 1, w1.sum() + 1]) / (weight.sum() + 2)
        new = _posterior(prior, lean, table, votes)
        done, p = np.abs(new - p).max(initial=0) < 1e-4, new
        if done:
            break
    return LabelModel(prior, lean, table, turn)


def train_linear(x: np.ndarray, target: np.ndarray, rounds: int = 25, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the last weight is the intercept."""
    width = x.shape[1] + 1
    w = np.zeros(width)
    penalty = np.full(width, ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        gradient, curvature = penalty * w, np.diag(penalty)
        for start in range(0, len(x), 4_096):  # a few rows at a time, so that no second copy of all is made
            part = np.hstack([x[start : start + 4_096], np.ones((len(x[start : start + 4_096]), 1))])
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            gradient = gradient + part.T @ (p - target[start : start + 4_096])
            curvature = curvature + (part * (p * (1 - p))[:, None]).T @ part
        step = np.linalg.solve(curvature, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class ToxicityModel:
    entries: list[tuple[bytes, bool]]
    evidence: Evidence | None  # none without labels of both kinds
    labels: LabelModel | None
    weights: np.ndarray

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """A model at work in one task."""

    def __init__(self, model: ToxicityModel):
        self.model, self.matcher = model, Matcher(model.entries)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.model.evidence is None:
            return np.full(len(texts), 0.5)
        x = self.model.evidence.features(*self.matcher.counts(texts))
        return 1 / (1 + np.exp(-np.clip(x @ self.model.weights[:-1] + self.model.weights[-1], -30, 30)))

    def posteriors(self, texts: list[bytes]) -> np.ndarray:
        """What the label model alone says."""
        return self.model.labels.posterior(self.model.evidence.votes(*self.matcher.counts(texts)))


def _counted(texts: DataFrame, entries: list[tuple[bytes, bool]]) -> tuple[np.ndarray, ...]:
    """Labels (-1 for none), words, entries and patterns of the texts of a bounded sample, in the order of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        matcher = Matcher(entries)
        for part in steps(batches):
            n, found, fits = matcher.counts(byte_texts(part.column(1)))
            x = np.hstack([n[:, None], found, fits]).astype(np.float32)
            rows = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), rows], names=["doc_id", "y", "x"])

    of_key = texts.schema["doc_id"].dataType.simpleString()
    found = texts.select("doc_id", "text", "y").mapInArrow(run, f"doc_id {of_key}, y int, x array<float>").toArrow()
    found = found.combine_chunks().sort_by("doc_id")
    width = 1 + len(entries) + len(PATTERNS)
    x = found.column("x").combine_chunks()
    x = (x.flatten() if len(x) else pa.array([], pa.float32())).to_numpy(zero_copy_only=False).reshape(-1, width)
    y = np.array([-1 if v is None else v for v in found.column("y").to_pylist()], np.int64)
    return y, x[:, 0], x[:, 1 : 1 + len(entries)], x[:, 1 + len(entries) :]


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, held_out, key: str = "doc_id", text: str = "text", rows: int = TRAINING_ROWS, more: int = UNLABELLED_ROWS
) -> ToxicityModel:
    """Learn from labels that are not held out, and from texts without a label that are not held out either.

    At most ``rows`` labelled and ``more`` other texts train, chosen by a hash of their key; a null key is never chosen, rows of one key
    count each.  Without labels of both kinds (no table of labels, no texts) nothing tells toxic from other texts: every text has the
    score 0.5.
    """
    frame = columns_of(docs, key, text)
    sample = labelled_sample(labels, "toxic", held_out, rows)
    unknown = frame.filter(~held_out & F.col("doc_id").isNotNull()).select("doc_id")
    unknown = unknown.join(labels.select(F.col("doc_id").alias("known")), F.col("doc_id") == F.col("known"), "left_anti")
    unknown = unknown.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(more).withColumn("y", F.lit(None).cast("int"))
    sample = cut(sample.unionByName(unknown))
    texts = frame.join(F.broadcast(sample), "doc_id")  # ``rows + more`` rows at most
    entries = learn_lexicon(texts.filter("y IS NOT NULL"))
    if not entries:
        return ToxicityModel([], None, None, np.zeros(0))
    y, n, found, fits = _counted(texts, entries)
    in_toxic, in_clean = ((found[y == label] > 0).sum(axis=0) for label in (1, 0))
    tells = (in_toxic >= LEAST_TEXTS) & (in_toxic * ((y == 0).sum() + 1) > LEAST_RATIO * in_clean * ((y == 1).sum() + 1))
    entries, found = [e for e, told in zip(entries, tells, strict=True) if told], found[:, tells]
    fits = fits.copy()
    fits[:, -1] = ~found.any(axis=1) & ~fits[:, :-1].any(axis=1)
    evidence = Evidence.of(n[y >= 0], found[y >= 0], y[y >= 0])
    votes, at = np.unique(evidence.votes(n, found, fits), axis=0, return_inverse=True)
    at = at.ravel()
    share = [np.bincount(at[y == label], minlength=len(votes)).astype(float) for label in (-1, 1, 0)]
    model = fit_label_model(votes, *share)
    p = np.clip(model.posterior(votes)[at], 1e-6, 1 - 1e-6)
    # A label is one more voter of known accuracy.
    odds = np.log(p / (1 - p)) + np.where(y == 1, 1, np.where(y == 0, -1, 0)) * np.log(LABEL_TRUST / (1 - LABEL_TRUST))
    target = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return ToxicityModel(entries, evidence, model, train_linear(evidence.features(n, found, fits), target))


def score_toxicity(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score)`` of each row, from the whole text alone.

    A null text counts as empty and has a score too, as has a text without words; repeated rows have equal scores, an empty
    table none.  Other columns do not matter, whatever their names.
    """
    frame = columns_of(docs, key, text)
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        scorer = shared.value.scorer()
        for part in steps(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scorer.scores(byte_texts(part.column(1))))], names=["doc_id", "score"])

    return frame.mapInArrow(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, score double")


def drop_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, unchanged; null and empty texts are scored as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        scorer = shared.value.scorer()
        for part in steps(batches, at):
            yield part.filter(pa.array(scorer.scores(byte_texts(part.column(at))) < threshold))

    return docs.mapInArrow(run, docs.schema)


def toxicity_report(docs: DataFrame, labels: DataFrame, held_out, threshold: float = 0.7) -> DataFrame:
    """Learn from labels that are not held out and score all rows; 1 from the threshold on."""
    model = learn_toxicity(docs, labels, held_out)
    return score_toxicity(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
