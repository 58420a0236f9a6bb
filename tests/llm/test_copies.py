from __future__ import annotations

import os
import pathlib
import random
import re
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from martkit.llm import exact_dedup, line_dedup, links, ngram_join


def write(spark, tmp_path, rows, parts=2):
    path = str(tmp_path / f"{uuid.uuid4().hex}.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, digest string, n long").repartition(parts).write.parquet(path)
    return path


TEXTS = [(1, "a"), (2, "a"), (3, None), (4, ""), (None, "a"), (5, "b"), (6, "c"), (6, "c"), (7, "z" * 100_000), (9, "é"), (8, "é")]


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.crc32(t.cast("binary")) % 2])
def test_equal_texts(spark, tmp_path, digest):
    path = write(spark, tmp_path, [(*r, None, None) for r in TEXTS])
    rows = exact_dedup.find_copies(spark, path, digest=digest).collect()
    assert len(rows) == len(TEXTS)
    groups: dict[str, list] = {}
    for key, text in TEXTS:
        groups.setdefault(text or "", []).append(key)
    text_of = {k: t or "" for k, t in TEXTS if k is not None}
    for r in rows:
        own = groups[text_of[r.doc_id] if r.doc_id is not None else "a"]
        assert r.group_size == len(own) and r.keep_id == max(k for k in own if k is not None)
    assert sum(r.kept for r in rows) == len(groups)
    assert {r.doc_id for r in rows if r.kept} == {2, 4, 5, 6, 7, 9}


def test_state_goes_on_with_new_files(spark, tmp_path):
    path = write(spark, tmp_path, [(1, "a", None, None), (2, "b", None, None)])
    state = str(tmp_path / "state")
    exact_dedup.remember(spark, path, state)
    spark.createDataFrame([(5, "a", None, None)], "doc_id long, text string, digest string, n long").write.mode("append").parquet(path)
    seen = {r.doc_id: r for r in exact_dedup.remember(spark, path, state).collect()}
    assert (seen[5].n, seen[2].n) == (2, 1) and seen[5].place.file.endswith(".parquet")


def test_stream_leaves_the_callers_session_alone(spark, tmp_path):
    before = dict(spark.conf.getAll)
    path = write(spark, tmp_path, [(i, "hot", None, None) for i in range(200)] + [(500, "cold", None, None)])
    rows = exact_dedup.find_copies(spark, path).collect()
    assert dict(spark.conf.getAll) == before
    own = exact_dedup._own_session(spark).conf
    assert all(own.get(k) == v for k, v in {**before, **exact_dedup._SETTINGS}.items())
    assert {(r.keep_id, r.group_size) for r in rows} == {(199, 200), (500, 1)} and sum(r.kept for r in rows) == 2


def test_no_rows(spark, tmp_path):
    assert exact_dedup.find_copies(spark, write(spark, tmp_path, [], 1)).count() == 0


def classes_of(items, linked):
    parent = {i: i for i in items}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in linked:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {i: top(i) for i in items}


def test_connected(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(500, i) for i in range(501, 560)]
    frame = links.connected(spark.createDataFrame(pairs, "a long, b long"))
    wanted = classes_of({i for p in pairs for i in p}, pairs)
    assert {r.id: r.label for r in frame.collect()} == {i: c for i, c in wanted.items() if i != c}
    assert links.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_connected_takes_repeated_links(spark):
    """Each link is there several times, in both directions; an id has one label all the same."""
    rng = random.Random(2)
    once = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(200, i) for i in range(190, 215)]
    pairs = [p for a, b in once for p in ((a, b), (b, a), (a, b))] + [(None, 3), (4, None)]
    rows = links.connected(spark.createDataFrame(pairs, "a long, b long")).collect()
    wanted = classes_of({i for p in once for i in p}, once)
    assert sorted((r.id, r.label) for r in rows) == sorted((i, c) for i, c in wanted.items() if i != c)


def test_connected_starts_few_tasks(spark):
    """Links in a star take three shuffles a turn, and what is stored between them is not read by one task a file."""
    frame = spark.createDataFrame([(50, i) for i in range(100) if i != 50], "a long, b long")
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {key: spark.conf.get(key) for key in held}
    context = spark.sparkContext
    group = "test_connected_starts_few_tasks"
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        context.setJobGroup(group, group)
        rows = {tuple(r) for r in links.connected(frame).collect()}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for key, value in before.items():
            spark.conf.set(key, value)
    assert rows == {(i, 0) for i in range(1, 100)}
    status = context.statusTracker()
    stages = {s for job in status.getJobIdsForGroup(group) for s in status.getJobInfo(job).stageIds}
    # Skipped stages have no tasks that were completed.
    assert sum(info.numCompletedTasks for s in stages if (info := status.getStageInfo(s))) <= 500


def test_links_join_classes(spark):
    """Links added to known classes give what all links give at once: chains of classes, links inside one, new items."""
    known = [(i, i - i % 10) for i in range(1, 200) if i % 10]
    links_of = [[(k * 10 + 3, k * 10 + 17) for k in range(0, 12)], [(4, 9), (155, 151)], [(500, 501), (501, 77), (198, 500)], []]
    labels = spark.createDataFrame(known, "id long, label long")
    seen = list(known)
    for more in links_of:
        labels = links._with_links(labels, spark.createDataFrame(more, "a long, b long"))
        seen += more
        found = {r.id: r.label for r in labels.collect()}
        assert len(found) == labels.count()
        names = {i: i for pair in seen for i in pair}
        for _ in names:
            for a, b in seen:
                names[a] = names[b] = min(names[a], names[b])
        assert found == {i: n for i, n in names.items() if i != n}


def test_connected_shuffled(spark, monkeypatch):
    """Beyond the size for broadcasts the same classes come out of shuffled joins."""
    pairs = [(i, i + 7) for i in range(60)] + [(1000, k) for k in range(1001, 1050)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    near = {tuple(r) for r in links.connected(frame).collect()}
    monkeypatch.setattr(links, "BROADCAST_ROWS", 10)
    assert {tuple(r) for r in links.connected(frame).collect()} == near and len(near) == 60 + 49


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def similar_by_force(rows):
    sets = {k: shingles(t) for k, t in rows}
    keys = sorted(sets)
    linked = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return {k: (len(sets[k]), c) for k, c in classes_of(keys, linked).items()}


def edited(rng, words, times, vocabulary):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return words


def test_similar_documents_by_force(docs):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(80)]
    rows = [(900, None), (901, ""), (902, " \t\n"), (903, "One Two"), (904, "one two"), (905, "two one")]
    for group in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 4, 5, 6, 8, 9, 12, 20, 60, 150]))]
        for _ in range(rng.randint(1, 6)):
            rows.append((len(rows) * 7 % 577, " ".join(edited(rng, base, rng.randint(0, max(1, len(base) // 14)), vocabulary))))
    passage = [rng.choice(vocabulary) for _ in range(55)]
    rows += [(1000 + i, " ".join([*[rng.choice(vocabulary) for _ in range(60)], *passage])) for i in range(25)]
    found = ngram_join.similar_classes(docs(rows, clash=True)).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == similar_by_force(rows)


def test_a_chain_and_a_hub_are_one_class(docs):
    """Copies edited more and more are linked in a row; copies of one text, each edited elsewhere, only through it."""
    words = [f"v{i}" for i in range(120)]
    chain = [(i, " ".join(["x"] * i + words[i:])) for i in range(0, 30, 3)]
    hub = [(200, " ".join(f"h{i}" for i in range(200)))]
    for c in range(40):
        own = [f"h{i}" for i in range(200)]
        for j in range(4):
            own[(c * 4 + j * 37) % 200] = f"e{c}-{j}"
        hub.append((201 + c, " ".join(own)))
    rows = [*chain, *hub]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_classes(docs(rows)).collect()}
    assert found == similar_by_force(rows)


def test_repeated_rows_and_missing_ids(docs, odd_rows):
    found = ngram_join.similar_classes(docs([*odd_rows, (None, "same text here")])).collect()
    of = [r.component_id for r in found if r.n_shingles == 1 and r.component_id == 1]
    assert len(of) == 4 and len(found) == len(odd_rows) + 1
    frame = docs(odd_rows, clash=True)
    kept = ngram_join.drop_similar(frame)
    assert kept.columns == frame.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 3, 4, 5, 6]
    assert ngram_join.similar_classes(docs([])).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def mutated(rng, text, times):
    out = list(text)
    for _ in range(times):
        i = rng.randrange(len(out) + 1)
        kind = rng.choice("idr")
        if kind == "i" or i == len(out):
            out.insert(i, rng.choice("abé😀 "))
        elif kind == "d":
            out.pop(i)
        else:
            out[i] = rng.choice("abé😀")
    return "".join(out)


def test_edit_distance_by_force(spark):
    rng = random.Random(3)
    pairs = []
    for i in range(600):
        a = "".join(rng.choice("abé😀 ") for _ in range(rng.randint(0, 40)))
        pairs.append((i, a, mutated(rng, a, rng.randint(0, 5))))
    frame = spark.createDataFrame(pairs, "i int, la string, lb string")
    for edits in (0, 1, 2, 4):
        found = {r.i for r in line_dedup.near_pairs(frame, edits).select("i").collect()}
        assert found == {i for i, a, b in pairs if distance(a, b) <= edits}


def lines_by_force(rows, edits, least):
    places = [((k, n), line) for k, t in rows if t for n, line in enumerate(t.split("\n")) if len(line) >= least]
    lines = sorted({line for _, line in places})
    linked = [(a, b) for i, a in enumerate(lines) for b in lines[i + 1 :] if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits]
    of = classes_of(lines, linked)
    first: dict[str, tuple] = {}
    for place, line in places:
        first[of[line]] = min(first.get(of[line], place), place)
    return {
        k: t and "\n".join(x for n, x in enumerate(t.split("\n")) if len(x) < least or first[of[x]] == (k, n)) for k, t in rows
    }


def test_lines_by_force(docs):
    rng = random.Random(8)
    bases = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(8, 30))) for _ in range(20)]
    rows = [(i, "\n".join(mutated(rng, rng.choice(bases), rng.choice([0, 0, 1, 1, 2, 3])) for _ in range(rng.randint(1, 6)))) for i in range(90)]
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, "q" * 60_000 + "\n" + "q" * 60_001)]
    frame = docs(rows, clash=True).withColumn("n_chars", F.lit(0).cast("long"))
    out = line_dedup.drop_repeated_lines(frame, edits=2, least=10, chars="n_chars")
    assert out.columns == frame.columns
    found = {r.doc_id: r for r in out.collect()}
    assert {k: r.text for k, r in found.items()} == lines_by_force([r for r in rows if r[0] != 503], 2, 10) | {503: "q" * 60_000}
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in found.values())


def test_lines_of_repeated_rows(docs):
    line = "this very line stands in several documents"
    rows = [(1, line), (1, line), (None, "first of all\n" + line), (2, line + "\nshort"), (3, line.upper())]
    out = line_dedup.line_report(docs(rows)).collect()
    assert sorted((r.doc_id or 0, r.n_lines, r.n_dropped) for r in out) == [(0, 2, 0), (1, 1, 1), (1, 1, 1), (2, 2, 1), (3, 1, 0)]
    assert line_dedup.line_report(docs([])).count() == 0


def test_copies_of_short_lines(docs):
    rows = [(1, "All rights reserved.\nLes.\nA b c\nSupercalifragilistic"), (2, "All rights reserved.\nAll rights reserved!\nLes.\nA b c\nSupercalifragilistic")]
    found = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(docs(rows)).collect()}
    assert found == {1: rows[0][1], 2: "All rights reserved!\nLes.\nA b c\nSupercalifragilistic"}


def test_a_second_run_takes_old_files_and_no_changed_ones(spark, tmp_path):
    path, state = write(spark, tmp_path, [(1, "a", None, None), (2, "b", None, None)]), str(tmp_path / "state")
    assert len(exact_dedup.find_copies(spark, path, state=state).collect()) == 2
    known = set(pathlib.Path(path).glob("*.parquet"))
    spark.createDataFrame([(5, "a", None, None), (6, "c", None, None)], "doc_id long, text string, digest string, n long").coalesce(1).write.mode("append").parquet(path)
    (added,) = set(pathlib.Path(path).glob("*.parquet")) - known
    os.utime(added, (0, 10**9))
    rows = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.find_copies(spark, path, state=state).collect()}
    assert rows == {1: (5, 2), 2: (2, 1), 5: (5, 2), 6: (6, 1)}
    other = write(spark, tmp_path, [(7, "new", None, None)], parts=1)
    (changed,) = pathlib.Path(other).glob("*.parquet")
    shutil.copy(changed, added)
    shutil.copy(changed.with_name(f".{changed.name}.crc"), added.with_name(f".{added.name}.crc"))
    with pytest.raises(ValueError, match="overwritten"):
        exact_dedup.find_copies(spark, path, state=state)


def test_documents_of_one_origin_that_are_not_similar_do_not_meet(spark, monkeypatch):
    """Every two share parts of their sketches, but differ in too many bits: the last step gives no pair of them on."""
    shared = [f"w{i}" for i in range(120)]
    rows = [(k, " ".join([*shared, *(f"own{k}x{i}" for i in range(70))])) for k in range(1, 41)]
    rows += [(41, rows[0][1] + " more"), (42, rows[1][1])]
    met = []
    real = ngram_join.classes_by_keys

    def watched(members, confirm_among, *args, **kwargs):
        def among(ids):
            confirm = confirm_among(ids)
            return lambda pairs: met.append(pairs.count()) or confirm(pairs)

        return real(members, among, *args, **kwargs)

    monkeypatch.setattr(ngram_join, "classes_by_keys", watched)
    got = ngram_join.similar_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {k: {41: 1, 42: 2}.get(k, k) for k in range(1, 43)}
    assert met[-1] <= 5
