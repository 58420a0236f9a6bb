"""Find equal texts in a stream of documents, keeping one row of each group.

A streaming query keeps one state row per text digest, in RocksDB on the executors' disks and in the shared folder, and
never lets it expire: how many rows had the digest, and of the row that stays its id and where its text stands.
Rows of a micro-batch are first summed where they are read, so a text that fills a third of the table reaches its state
row as one row a task.  Equal digests are only a hit: the hits' full texts are then compared with the text that stays,
and the few digests that stand for several texts are grouped anew by the text itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martkit.llm.common import cut, shared_folder, small_enough
from martkit.operators.joins import spread_join

# Digests of repeated texts that may be broadcast, to pick the hits while the texts are read; more are shuffled.
BROADCAST_DIGESTS = 200_000

# Settings of the stream's own session: state on disk, its memory bounded for all state of an executor.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    # Many small stores: no space is set aside, and only what a batch changes is stored.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# A stream passes over new files that are older than the newest it knows by more than this.
_MAX_AGE = "36500d"


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _text(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def _own_session(spark: SparkSession) -> SparkSession:
    """A session like the caller's with the stream's settings, so that streams side by side do not disturb each other."""
    own = spark.newSession()
    inherited = own.conf.getAll
    for k, v in spark.conf.getAll.items():
        if inherited.get(k) != v:
            own.conf.set(k, v)
    for k, v in _SETTINGS.items():
        own.conf.set(k, v)
    return own


def remember(
    spark: SparkSession, path: str, state: str, key: str = "doc_id", text: str = "text",
    digest: Callable[[Column], Column] = sha256, files_per_batch: int = 200,
) -> DataFrame:
    """Stream all files below ``path`` that the state has not seen yet, and return the state.

    ``(digest, doc_id, place, n)``: the largest id, the file and row where its text stands, and the rows seen.  The
    state folder may be used again: files added since, whatever their date, are all that is read then.  A file that was
    overwritten under its name is not read again.
    """
    schema = spark.read.parquet(path).schema
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(where).isFile():
        path = f"{path[:-1]}[{path[-1]}]"  # a stream takes folders or patterns
    stream = _own_session(spark).readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", _MAX_AGE).parquet(path)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    rows = stream.select(digest(_text(text)).alias("digest"), F.struct(F.col(f"`{key}`").alias("doc_id"), place.alias("place")).alias("kept"))
    grouped = rows.groupBy("digest").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    run = grouped.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
    run.option("checkpointLocation", state).start().awaitTermination()
    return spark.read.format("statestore").load(state).select(
        F.col("key.digest").alias("digest"),
        F.col("value.max.doc_id").alias("doc_id"),
        F.col("value.max.place").alias("place"),
        F.col("value.count").alias("n"),
    )


def _demand_same(rows: DataFrame, seen: DataFrame) -> None:
    """Fail if a state used again tells of other rows than the table has: files were overwritten or removed since."""
    now = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "place")).alias("last"), F.count(F.lit(1)).alias("rows"))
    same = F.col("rows").eqNullSafe(F.col("n")) & F.col("last.place").eqNullSafe(F.col("keep_place"))
    if not now.join(seen, "digest", "full").filter(~same).isEmpty():
        raise ValueError("the state does not tell of the rows of this table; files were overwritten or removed: start a new state folder")


def find_copies(
    spark: SparkSession, path: str, key: str = "doc_id", text: str = "text",
    digest: Callable[[Column], Column] = sha256, state: str | None = None,
) -> DataFrame:
    """One row per row of the table: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when all their bytes are.  A null text counts as empty, a null id is smaller than any other.  Of
    rows with the same text and the same largest id the one that stands last is kept.  An empty table gives no rows.
    A ``state`` used again must tell of all rows of the table and of no others, else this fails; that is checked once more by digest.
    ``digest`` need not tell all texts apart.  Only bytes of hits travel, never those of texts that occur once.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    value = _text(text)
    docs = spark.read.parquet(path).select(
        F.col(f"`{key}`").alias("doc_id"), value.alias("text"), place.alias("place"), digest(value).alias("digest"),
        sha256(value).alias("text_sha256"),
    )
    rows = docs.select("doc_id", "place", "digest", "text_sha256")
    kept = (F.col("place") == F.col("keep_place")).alias("kept")
    answer = ["doc_id", "keep_id", F.col("n").alias("group_size"), kept, "text_sha256"]
    if docs.isEmpty():
        none = rows.withColumns({"keep_id": F.col("doc_id"), "keep_place": F.col("place"), "n": F.lit(0).cast("long")})
        return none.select(*answer)

    folder = state or f"{shared_folder(spark)}/dedup-{uuid.uuid4().hex}"
    seen = cut(remember(spark, path, folder, key, text, digest).withColumnsRenamed({"doc_id": "keep_id", "place": "keep_place"}))
    if state:
        _demand_same(rows, seen)
    repeated = seen.filter("n > 1").select("digest", "keep_place")
    hits = docs.join(small_enough(repeated, BROADCAST_DIGESTS), "digest").select("digest", "text", "place", "keep_place")
    kept_texts = cut(hits.filter(F.col("place") == F.col("keep_place")).select("digest", F.col("text").alias("kept_text")))
    others = hits.filter(F.col("place") != F.col("keep_place")).select("digest", "text")
    differs = spread_join(others, kept_texts, ["digest"], "inner").filter(F.col("text") != F.col("kept_text"))
    mixed = cut(differs.select("digest").distinct())

    judged = rows.join(seen, "digest")
    if mixed.isEmpty():
        return judged.select(*answer)
    mixed = small_enough(mixed, BROADCAST_DIGESTS)
    unequal = docs.join(mixed, "digest").withColumn("last", F.struct("doc_id", "place"))
    by_text = unequal.groupBy("text").agg(F.max("last").alias("last"), F.count(F.lit(1)).alias("n"))
    chosen = by_text.select("text", F.col("last.doc_id").alias("keep_id"), F.col("last.place").alias("keep_place"), "n")
    regrouped = spread_join(unequal.select("doc_id", "place", "text", "text_sha256"), chosen, ["text"], "inner")
    return judged.join(mixed, "digest", "left_anti").select(*answer).unionByName(regrouped.select(*answer))
