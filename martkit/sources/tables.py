"""Read tables and scripts; stage intermediate tables on shared storage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StringType, StructType

# Fixed value: only these script files are rewritten; the first suffix matches in any letter case.
SCRIPT_GLOB = "*.{[sS][qQ][lL],bteq}"

# Text keys by which tables meet, under the names that the source tables give them.
TEXT_KEYS = (
    "acct_no", "basic_accs_rate_plan_cd", "bill_stmt_chrg_cd", "bolton_rate_plan_cd", "dlr_cd", "rate_plan_cd", "rep_cd",
    "sap_gl", "sap_prod_cd", "service_no", "svc_no", "svc_stat_cd", "sys_rate_plan_cd",
)

_local_root: str | None = None


class ParquetTables(Mapping[str, DataFrame]):
    """Tables of one folder by name, opened on first use.

    The columns named in ``text_keys`` come folded, so that every join, grouping and update by them takes keys for equal that
    differ in letter case or trailing blanks only.
    """

    def __init__(self, spark: SparkSession, root: str, names: Sequence[str], text_keys: Sequence[str] = TEXT_KEYS):
        self._spark, self._root, self._names, self._keys = spark, root.rstrip("/"), list(names), text_keys

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return fold_keys(self._spark.read.parquet(f"{self._root}/{name}.parquet"), *self._keys)

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def trim_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Blank-padded text keys without their padding, done once on read."""
    return df.withColumns({c: F.rtrim(F.col(c)) for c in columns})


def fold_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Those of the named columns that ``df`` has as text in their one form: upper case, no trailing blanks.

    Columns of other types, all other columns and the order of columns stay; a null key stays null.
    """
    wanted = {c.lower() for c in columns}
    text = [f.name for f in df.schema if f.name.lower() in wanted and isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.upper(F.rtrim(F.col(f"`{c}`"))) for c in text})


def read_scripts(spark: SparkSession, path: str, glob: str = SCRIPT_GLOB) -> DataFrame:
    """Scripts below a folder as ``(path, text)``, one row per file; paths are relative to the folder.

    An empty file has no row: Spark leaves files without bytes out.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toUri().getPath().rstrip("/")
    # Spark gives file names with %-escapes; a plus sign in them is just that.
    decoded = F.url_decode(F.regexp_replace("_metadata.file_path", "\\+", "%2B"))
    below = F.regexp_replace(decoded, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    pattern = "".join(f"\\{c}" if c in "*?[]{}" else c for c in path)  # a folder's name is no pattern
    read = spark.read.text(pattern, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    return read.select(F.substring(below, len(whole) + 2, 1 << 30).alias("path"), F.col("value").alias("text"))


class ScriptFiles(DataSource):
    """A sink of ``(path, text)`` rows: each text becomes one file under its own name, byte for byte."""

    @classmethod
    def name(cls) -> str:
        return "script_files"

    def schema(self) -> str:
        return "path string, text string"

    def writer(self, schema: StructType, overwrite: bool) -> ScriptWriter:
        return ScriptWriter(self.options["path"], uuid.uuid4().hex)


class _Written(WriterCommitMessage):
    pass


class ScriptWriter(DataSourceWriter):
    """Tasks write below a folder of the job, which takes the output's place when all are done.

    A repeated task writes the same files again, each first under a name of its own.  ``path`` is a folder that all executors share, or
    a URI of a store that pyarrow opens.
    """

    def __init__(self, path: str, job: str):
        self.path, self.job = path.rstrip("/"), job

    def _store(self) -> tuple[fs.FileSystem, str, str]:
        if "://" in self.path or self.path.startswith("file:"):
            store, root = fs.FileSystem.from_uri(quote(self.path, safe=":/%"))
        else:
            store, root = fs.LocalFileSystem(), self.path
        return store, root, f"{root}._writing-{self.job}"

    def write(self, rows: Iterator[Row]) -> WriterCommitMessage:
        store, _, held = self._store()
        for row in rows:
            parts = (row.path or "").split("/")
            if not row.path or ".." in parts or "" in parts:
                raise ValueError(f"not a path of a script: {row.path!r}")
            target = f"{held}/{row.path}"
            store.create_dir(target.rsplit("/", 1)[0], recursive=True)
            own = f"{target}.{uuid.uuid4().hex}"
            with store.open_output_stream(own, compression=None) as out:
                out.write((row.text or "").encode())
            store.move(own, target)
        return _Written()

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root, held = self._store()
        store.create_dir(held, recursive=True)
        if store.get_file_info(root).type != fs.FileType.NotFound:
            store.delete_dir(root)
        store.move(held, root)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, _, held = self._store()
        if store.get_file_info(held).type != fs.FileType.NotFound:
            store.delete_dir(held)


def write_scripts(docs: DataFrame, path: str, name: str = "path", text: str = "text") -> None:
    """One file per script, under its own path below the folder, which it replaces; a null text is an empty file."""
    spark = docs.sparkSession
    spark.dataSource.register(ScriptFiles)
    rows = docs.select(F.col(name).cast("string").alias("path"), F.col(text).cast("string").alias("text"))
    rows.write.format(ScriptFiles.name()).mode("overwrite").option("path", path).save()


def stage_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: what the cluster names in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="martkit-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


class StageArea:
    """A folder of staged tables that a job removes when it is done.

    Calling it writes a table once and reads it back.  That cuts the lineage, survives lost executors, and
    gives later joins a plain scan of known size, so that broadcast choices rest on the real size and
    adaptive skew splits apply.  A table can be dropped as soon as nothing reads it any more.  What is left goes when the
    application ends.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._folder = f"{stage_root(spark)}/stage-{uuid.uuid4().hex}"
        self._paths: list[tuple[DataFrame, str]] = []
        fs, folder = self._file_system(self._folder)
        fs.deleteOnExit(folder)

    def _file_system(self, path: str) -> tuple:
        context = self._spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(context._jsc.hadoopConfiguration()), folder

    def _delete(self, path: str) -> None:
        fs, folder = self._file_system(path)
        fs.delete(folder, True)

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self._folder}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        stored = self._spark.read.schema(df.schema).parquet(path)
        self._paths.append((stored, path))
        return stored

    def drop(self, *stored: DataFrame) -> None:
        """Delete staged tables that no later step reads."""
        for df, path in [p for p in self._paths if any(p[0] is s for s in stored)]:
            self._delete(path)
            self._paths.remove((df, path))

    def __enter__(self) -> StageArea:
        return self

    def __exit__(self, *_: object) -> None:
        self._paths.clear()
        self._delete(self._folder)


# The area of tables staged for the life of an application, by its id.
_lasting: dict[str, StageArea] = {}


def stage(df: DataFrame, name: str) -> DataFrame:
    """Stage one table for the life of the application."""
    app = df.sparkSession.sparkContext.applicationId
    if app not in _lasting:
        _lasting[app] = StageArea(df.sparkSession)
    return _lasting[app](df, name)
