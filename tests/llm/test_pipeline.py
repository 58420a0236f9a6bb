from __future__ import annotations

import hashlib
import random

import corpus_pipeline
import sentencepiece
from pyspark.sql import functions as F

from martkit.llm.queries import ORACLES, QUERIES, tokenizer_path


def test_stages_on_planted_documents(spark, tmp_path):
    """Each stage does its work on what the one before kept; clean documents come through."""
    words = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    line = "this line of some length stands in two documents"
    some = lambda seed: " ".join(random.Random(seed).choices([f"w{i}" for i in range(3000)], k=60))
    rows = [(i, f"{some(i)}.", "en", "s", 0) for i in range(20)]
    rows += [(100 + i, f"{some(100 + i)} vile {some(200 + i)} vile horrid", "en", "s", 0) for i in range(20)]
    rows += [
        (200, f"{words('d', 80)}\n{line}", "en", "s", 0), (201, f"{words('e', 80)}\n{line}s", "en", "s", 0),
        (300, words("n", 100), "en", "s", 0), (301, words("n", 97) + " changed", "en", "s", 0),
        (400, f"{words('f', 20)} {words('b', 30)}", "en", "s", 0), (500, None, None, None, None), (501, "", "en", "s", 0),
    ]
    folder = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in range(20)] + [(100 + i, 1, 1) for i in range(20)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, words("b", 40))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/out{i}")
        docs = spark.read.parquet(f"{folder}/out{i}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    everything = {r[0] for r in rows}
    assert set(kept["drop_toxic"]) == everything - set(range(100, 120))
    assert set(kept["drop_repeated_lines"]) == set(kept["drop_toxic"])
    assert kept["drop_repeated_lines"][200].text.endswith(line) and line not in kept["drop_repeated_lines"][201].text
    assert kept["drop_repeated_lines"][201].n_chars == len(words("e", 80))
    assert set(kept["drop_similar"]) == set(kept["drop_repeated_lines"]) - {301}
    assert set(kept["drop_contaminated"]) == set(kept["drop_similar"]) - {400}
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    for key, row in kept["encode"].items():
        ids = library.encode(kept["drop_contaminated"][key].text or "")
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted((tuple(r) for r in kept["encode"].values()), key=str)


def test_every_operator_has_a_query(spark):
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
    import __spark_entry__ as entry_point

    assert {*QUERIES, "pipeline"} <= set(entry_point.queries())
    assert spark.range(1).select(F.lit(1)).count() == 1


def test_every_counterpart_is_sql():
    import __spark_entry__ as entry_point

    assert [n for n, sql in entry_point.oracle_sql().items() if not isinstance(sql, str)] == []
