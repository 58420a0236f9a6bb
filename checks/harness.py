"""Pair a Spark query with its SQL counterpart under one list of output columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.views import BASE_TABLES, GATHERED, NARROW, VIEWS, needed
from martkit.sources.tables import stage


# Stored source tables by application, folder and name.
_STORED: dict[tuple[str, str, str], DataFrame] = {}


class CheckTables(Mapping[str, DataFrame]):
    """Base tables and derived views of one test folder, by name.

    With ``stored=True`` a derived view that groups, joins or orders whole tables is written once per application and read
    back, so that no plan repeats its shuffle.  A view made row by row is derived where it is read, from the columns and rows
    that a plan asks for: writing and reading the whole of it takes longer.
    """

    def __init__(self, spark: SparkSession, folder: str, stored: bool = False):
        self._spark, self._folder, self._stored = spark, folder.rstrip("/"), stored
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            if name in VIEWS:
                self._open[name] = self._store(name) if self._stored and name in GATHERED else self._derived(name)
            elif name in BASE_TABLES:
                self._open[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
            else:
                raise KeyError(name)
        return self._open[name]

    def _store(self, name: str) -> DataFrame:
        key = (self._spark.sparkContext.applicationId, self._folder, name)
        if key not in _STORED:
            _STORED[key] = stage(self._derived(name), name)
        return _STORED[key]

    def _derived(self, name: str) -> DataFrame:
        return self.sql(NARROW.get(name, VIEWS[name]))

    def _run(self, sql: str, inputs: Mapping[str, DataFrame]) -> DataFrame:
        for name, frame in inputs.items():
            frame.createOrReplaceTempView(name)
        return self._spark.sql(sql)

    def sql(self, text: str) -> DataFrame:
        return self._run(text, {w: self[w] for w in _inputs(text)})

    def __iter__(self) -> Iterator[str]:
        return iter([*BASE_TABLES, *VIEWS])

    def __len__(self) -> int:
        return len(BASE_TABLES) + len(VIEWS)


def _inputs(sql: str) -> list[str]:
    words = set(re.findall(r"\w+", sql))
    return [n for n in [*BASE_TABLES, *VIEWS] if n in words]


# How an output column is compared: as is, date or nullable number as text, integer, number.
SPARK_CAST = {"": None, "t": "string", "i": "bigint", "n": "double"}
SQL_CAST = {"": None, "t": "VARCHAR", "i": "BIGINT", "n": "DOUBLE"}


@dataclass(frozen=True)
class Check:
    columns: tuple[tuple[str, str], ...]
    build: Callable[[CheckTables], DataFrame]
    sql: str | None
    stored: bool = False

    def spark(self, spark: SparkSession, folder: str) -> DataFrame:
        frame = self.build(CheckTables(spark, folder, self.stored))
        out = []
        for name, kind in self.columns:
            cast = SPARK_CAST[kind]
            out.append(F.col(name).cast(cast).alias(name) if cast else F.col(name))
        return frame.select(*out)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        parts = [f"{name} AS ({text.strip()})" for name, text in needed(self.sql).items()]
        parts.append(f"answer AS ({self.sql.strip()})")
        out = []
        for name, kind in self.columns:
            cast = SQL_CAST[kind]
            out.append(f"CAST({name} AS {cast}) AS {name}" if cast else name)
        return "WITH " + ",\n".join(parts) + f"\nSELECT {', '.join(out)} FROM answer"


def listed(values: Iterable[object]) -> str:
    """The values of a constant as an SQL list, in their order."""
    return "(" + ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in values) + ")"


CHECKS: dict[str, Check] = {}


def check(name: str, columns: str, sql: str | None, stored: bool = False) -> Callable:
    """Register a query.  ``columns`` lists outputs as ``name`` or ``name:kind``."""
    parsed = tuple(
        (c.split(":")[0], c.split(":")[1] if ":" in c else "") for c in columns.replace(",", " ").split()
    )

    def register(build: Callable[[CheckTables], DataFrame]) -> Callable[[CheckTables], DataFrame]:
        if name in CHECKS:
            raise ValueError(f"check {name} exists")
        CHECKS[name] = Check(parsed, build, sql, stored)
        return build

    return register
