from __future__ import annotations

import tracemalloc
import weakref
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from martkit.llm import common, language_id, quality, sentencepiece_bpe, toxicity
from martkit.llm.common import in_fold
from martkit.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.01"


def test_language_on_held_out_rows(spark, docs, odd_rows):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    profiles = language_id.learn_profiles(table.filter(~in_fold("doc_id", 4, 2)))
    rows = language_id.predict_language(table, profiles).join(table, "doc_id").filter(in_fold("doc_id", 4, 2)).collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    odd = language_id.predict_language(docs([*odd_rows, (7, "12 34!")], clash=True), profiles).collect()
    assert [r.doc_id for r in odd] == [k for k, _ in odd_rows] + [7]
    assert [r.lang_pred for r in odd[4:6]] == ["und", "und"] and odd[-1].lang_pred == "und" and odd[0] == odd[1]
    empty = language_id.learn_profiles(docs([], clash=True))
    assert language_id.predict_language(docs(odd_rows), empty).agg(F.max("score")).first()[0] == 0


def test_grams_against_plain_counting():
    texts = ["Ab  c1d!", "", None, "ééa ß", "x" * 50]
    grams = language_id.Grams(texts)
    for i, text in enumerate(texts):
        folded = "".join(c.lower() if c.isalpha() else " " for c in f" {text or ''} ")
        while "  " in folded:
            folded = folded.replace("  ", " ")
        wanted: dict[int, int] = {}
        for n in (1, 2, 3):
            for j in range(len(folded) - n + 1):
                g = folded[j : j + n]
                if g.strip():
                    code = 0
                    for c in g:
                        code = code << 21 | ord(c)
                    wanted[code] = wanted.get(code, 0) + 1
        codes, counts = grams.counts(i)
        assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == wanted


def test_trees_walk_like_plain_nodes():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = quality.train_forest(x, y)
    scores = forest.scores(x)
    assert ((scores >= 0.5) == y).mean() > 0.97
    for row in range(20):
        total = forest.start
        for f, t, a, b, v in zip(forest.feature, forest.threshold, forest.left, forest.right, forest.value, strict=True):
            node = 0
            while f[node] >= 0:
                node = a[node] if x[row, f[node]] <= t[node] else b[node]
            total += v[node]
        assert abs(1 / (1 + np.exp(-total)) - scores[row]) < 1e-9
    same = quality.train_forest(x, np.ones(600)).scores(x)
    assert same.min() == same.max() and quality.train_forest(x[:0], y[:0]).scores(x).min() == 0.5


def held_out_accuracy(report, labels, label):
    rows = report.filter("held_out").join(labels, "doc_id").select("predicted", label).collect()
    return sum(r.predicted == r[label] for r in rows) / len(rows)


def test_quality_on_held_out_rows(spark, docs, odd_rows):
    table, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    report = quality.quality_report(table, labels, in_fold("doc_id", 5, 0))
    assert held_out_accuracy(report, labels, "quality") >= 0.95
    forest = quality.learn_quality(table, quality.labelled_sample(labels, "quality", F.lit(False), 300))
    odd = quality.score_quality(docs(odd_rows, clash=True), forest).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r.score <= 1 for r in odd) and odd[0].score == odd[2].score


def test_toxicity_on_held_out_rows(spark, docs, odd_rows):
    folder = SF.replace("0.01", "0.1")
    table, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    held = in_fold("doc_id", 3, 1)
    model = toxicity.learn_toxicity(table, labels, held)
    rows = table.filter(held).join(labels, "doc_id").select("doc_id", "text", "toxic").collect()
    texts, truth = [(r.text or "").encode() for r in rows], np.array([r.toxic == 1 for r in rows])
    scorer = model.scorer()
    said = scorer.scores(texts) >= 0.7
    assert (said & truth).sum() >= 0.9 * truth.sum() and (said & truth).sum() >= 0.9 * said.sum()
    # The label model alone is far better than the commoner label.
    alone = scorer.posteriors(texts) > 0.5
    assert (alone != truth).mean() <= 0.5 * truth.mean() and (alone & truth).sum() >= 0.8 * truth.sum()
    # Dozens of voters, entries and patterns; none of those kept is right less often than chance.
    votes = model.evidence.votes(*scorer.matcher.counts(texts))
    assert votes.shape[1] >= 24 and (model.labels.turn != 1).any()
    one = np.ones(len(votes))
    cast = (model.labels.turned(votes) != toxicity.ABSTAIN).sum(axis=0) >= 30
    share = np.where((model.labels.turned(votes) == toxicity.TOXIC).any(axis=0), truth.mean(), 1 - truth.mean())
    assert (model.labels.accuracy(votes, one) >= share - 0.02)[cast].all()

    odd = toxicity.score_toxicity(docs(odd_rows, clash=True), model).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r.score <= 1 for r in odd) and odd[0].score == odd[2].score
    wordless = docs([(1, "$$$ !!! @#&%"), (2, None), (3, "")])
    assert toxicity.drop_toxic(wordless, model).count() == 3
    kept = toxicity.drop_toxic(docs([*odd_rows, (9, "you stupid pathetic idiot")], clash=True), model)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(k or 0 for k, _ in odd_rows)
    report = toxicity.toxicity_report(docs([]), labels, held)
    assert report.count() == 0 and report.columns == ["doc_id", "held_out", "score", "predicted"]
    unlabelled = toxicity.learn_toxicity(docs(odd_rows), labels.limit(0), F.lit(False))
    assert {r.score for r in toxicity.score_toxicity(docs(odd_rows), unlabelled).collect()} == {0.5}


def test_label_model_finds_accuracies_and_dependence():
    """Voters of known accuracy, one of them a copy of another, one wrong more often than not; few rows have a label."""
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.2
    accuracy = np.array([*np.linspace(0.95, 0.6, 10), 0.1])
    votes = np.where((rng.random((20_000, 11)) < accuracy) == truth[:, None], toxicity.TOXIC, toxicity.CLEAN)
    votes[:, 5] = votes[:, 4]
    known, at = np.unique(votes, axis=0, return_inverse=True)
    at = at.ravel()
    labelled = rng.random(20_000) < 0.05
    count = lambda mask: np.bincount(at[mask], minlength=len(known)).astype(float)
    model = toxicity.fit_label_model(known, count(~labelled), count(labelled & truth), count(labelled & ~truth))
    assert model.lean[5] == 4 and model.turn[10] == -1 and (model.turn[:5] == 1).all()
    found = model.accuracy(known, np.bincount(at, minlength=len(known)).astype(float))
    assert np.abs(found - accuracy)[[0, 1, 2, 3, 4, 6]].max() < 0.05 and abs(found[10] - 0.9) < 0.05
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.95


def test_evidence_against_plain_counting():
    """Entries of a text are found word by word; what they say follows from counts in labelled texts."""
    entries = [(b"vile", True), (b"horr", False), (b"\xc3\xa9t", False)]
    texts = [b"Vile, vile! horrid", "été éta VILE".encode(), b"vilely horr", b"", b"HORRORS!!! 12 horr!"]
    n, found, fits = toxicity.Matcher(entries).counts(texts)
    assert n.tolist() == [3, 3, 2, 0, 3] and found.tolist() == [[2, 1, 0], [1, 0, 2], [0, 0, 0], [0, 0, 0], [0, 1, 0]]
    assert [bool(f[-1]) for f in fits] == [False, False, False, False, False] and fits[4][0] == 1
    y = np.array([1, 1, 0, 0, 0])
    evidence = toxicity.Evidence.of(n, found, y)
    assert np.allclose(evidence.has, np.log([2.5 / 3 / (0.5 / 4), 1.5 / 3 / (1.5 / 4), 1.5 / 3 / (0.5 / 4)]))
    told = evidence.told(n, found)
    assert (told[found == 0] == 0).all() and told[0, 0] > toxicity.VOTING
    total = told.sum(axis=1) + np.where(found > 0, 0, evidence.lacks).sum(axis=1)
    assert np.allclose(evidence.features(n, found, fits)[:, len(entries)], np.clip(total, -12, 12) / 4)


def test_counting_stems_takes_little_memory_however_many_words_there_are():
    counts = {y: Counter({b"%05dword%06d" % (i % 99_991, i): 1 + i % 3 for i in range(y, 100_000, 2)}) for y in (0, 1)}
    plain: Counter = Counter()
    for y, words in counts.items():
        for word, n in words.items():
            for stem, whole in toxicity._stems(word):
                plain[stem, whole, y] += n
    found: Counter = Counter()
    for batch in toxicity._stem_rows(counts):
        for stem, whole, y, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            found[stem, whole, y] += n
    assert found == plain
    tracemalloc.start()
    try:
        for batch in toxicity._stem_rows(counts):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 20e6


def test_a_worker_keeps_one_operators_memory_at_a_time():
    model = sentencepiece_bpe.read_model(tokenizer_path("piece_bpe_32k.model"))
    codec = sentencepiece_bpe.codec_of(model)
    assert sentencepiece_bpe.codec_of(model) is codec
    gone = weakref.ref(codec)
    del codec
    common.forget()
    assert gone() is None
