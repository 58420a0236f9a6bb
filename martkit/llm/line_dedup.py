"""Drop lines that nearly repeat an earlier line, across all documents, with DataFrame functions alone.

Lines are near when at most ``edits`` characters are inserted, deleted or replaced.  A line cut into ``edits + 1`` segments
then has one segment that the other line contains unchanged, close to the same place; hashes of (segment, its number,
the line's length) are the keys on which lines meet.  What meets is verified by a banded bit-parallel edit distance.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from martkit.llm.common import cut, own_name, small_enough
from martkit.llm.links import classes_by_keys
from martkit.sources.tables import StageArea

EDITS = 2
# Lines of fewer characters are not near any other: a few edits could turn them into anything.
LEAST_LENGTH = 30
# Exact copies of such lines are found from so many characters on, if they have several words; what is shorter stays.
LEAST_EXACT = 10
# Repeated lines whose numbers may be broadcast when documents are read again; more are shuffled.
BROADCAST_LINES = 1_000_000


def line_keys(lines: DataFrame, edits: int, least: int) -> DataFrame:
    """``(key, id, own)`` of ``(id, line)`` rows.

    Segments are nearly even, the longer ones last.  Of a line with ``shift`` fewer characters, the unchanged segment i starts
    at most i places off by what was edited before it, and at most ``edits - i`` off by what was edited after it; these
    starts alone are tried.  A line owns the keys of its own segments.
    """
    parts = edits + 1
    tries = []
    for shift in range(edits + 1):
        for i in range(parts):
            for off in range(max(-i, shift - (edits - i)), min(i, shift + (edits - i)) + 1):
                tries.append(F.struct(*[F.lit(v).alias(n) for n, v in (("shift", shift), ("i", i), ("off", off))]))
    rows = lines.select("id", "line", F.char_length("line").alias("length")).select("*", F.explode(F.array(*tries)).alias("t"))
    rows = rows.select("id", "line", "length", (F.col("length") - F.col("t.shift")).alias("other"), "t.*").filter(F.col("other") >= least)
    rows = rows.withColumn("longer", F.col("other") % parts).withColumn("size", F.expr(f"CAST((other - longer) DIV {parts} AS INT)"))
    start = F.col("i") * F.col("size") + F.greatest(F.lit(0), F.col("longer") - (parts - F.col("i"))) + F.col("off")
    rows = rows.withColumn("start", start).withColumn("size", F.col("size") + F.when(F.col("longer") >= parts - F.col("i"), 1).otherwise(0))
    rows = rows.filter("start >= 0 AND start + size <= length")
    own = (F.col("shift") == 0) & (F.col("off") == 0)
    return rows.select(F.expr("xxhash64(substring(line, start + 1, size), i, other)").alias("key"), "id", own.alias("own"))


def letter_parity(line: Column) -> Column:
    """One bit for each of some frequent characters: whether it occurs an odd number of times."""
    mark = F.lit(0).cast("long")
    for k, c in enumerate("abcdefghijklmnopqrstuvwxyz ,.éñó"):
        times = F.char_length(line) - F.char_length(F.translate(line, c, ""))
        mark = mark.bitwiseOR(F.shiftleft((times % 2).cast("long"), k))
    return mark


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _common_prefix(a: Column, b: Column) -> Column:
    """Length of the common beginning, up to 131071 characters, by halving steps."""
    limit = F.least(F.char_length(a), F.char_length(b))
    powers = F.array(*[F.lit(1 << k) for k in range(16, -1, -1)])
    same = lambda p, k: (p + k <= limit) & (F.substring(a, p + 1, k) == F.substring(b, p + 1, k))
    return F.aggregate(powers, F.lit(0), lambda p, k: F.when(same(p, k), p + k).otherwise(p))


def _ends_differ(a: Column, b: Column, then: Callable[[Column, Column], Column]) -> Column:
    """``then`` of two texts without their common beginning."""
    pair = lambda x, y: F.struct(x.alias("a"), y.alias("b"))
    rest = lambda x, p: F.substring(x, p + 1, F.char_length(x))
    return _let(
        pair(a, b),
        lambda v: _let(
            _common_prefix(v["a"], v["b"]),
            lambda p: _let(pair(rest(v["a"], p), rest(v["b"], p)), lambda w: then(w["a"], w["b"])),
        ),
    )


def _banded_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of two character arrays if it is at most ``edits``, else a larger number; ``a`` is not the longer.

    One step per character of ``b``.  Bit k of the words stands for row j - edits + k of column j: ``up`` and ``down`` say where
    the distance rises or falls by one from the row above.  Cells outside the band count as far away.  The distance is
    followed along the diagonal that ends at the last cell.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1
    long = lambda v: F.lit(v).cast("long")
    inverse = lambda v: long(full).bitwiseXOR(v)
    behind = F.size(b) - F.size(a)
    last = F.get(F.array(*[long(1 << k) for k in range(edits + 1)]), edits - behind)  # bit of the followed diagonal
    above = (1 << (edits + 1)) - 1  # rows before the first character
    start = F.struct(long(full ^ above).alias("up"), long(above).alias("down"), behind.alias("d"))

    def step(s: Column, j: Column) -> Column:
        bits = [F.when(F.get(a, j - 1 - edits + k) == F.get(b, j - 1), 1 << k).otherwise(0) for k in range(width)]
        # One row on; the row that enters the band is one worse than the one above.
        up = F.shiftright(s["up"], 1).bitwiseOR(long(1 << (width - 1)))
        shifted = F.struct(sum(bits).cast("long").alias("eq"), up.alias("up"), F.shiftright(s["down"], 1).alias("down"))
        going = _let(shifted, lambda v: _let(diagonal(v), lambda d: following(s, j, v["up"], v["down"], d)))
        # Along a diagonal the distance never falls again.
        return F.when(s["d"] > edits, s).otherwise(going)

    def diagonal(v: Column) -> Column:
        carried = (v["eq"].bitwiseAND(v["up"]) + v["up"]).bitwiseXOR(v["up"])
        return carried.bitwiseOR(v["eq"]).bitwiseOR(v["down"]).bitwiseAND(long(full))

    def following(s: Column, j: Column, up: Column, down: Column, d: Column) -> Column:
        right_up = down.bitwiseOR(inverse(d.bitwiseOR(up)))
        right_down = up.bitwiseAND(d)
        above_up = F.shiftleft(right_up, 1).bitwiseOR(long(1)).bitwiseAND(long(full))
        above_down = F.shiftleft(right_down, 1).bitwiseAND(long(full))
        worse = F.when((j > behind) & (d.bitwiseAND(last) == 0), 1).otherwise(0)
        return F.struct(
            above_down.bitwiseOR(inverse(d.bitwiseOR(above_up))).alias("up"),
            d.bitwiseAND(above_up).alias("down"),
            (s["d"] + worse).alias("d"),
        )

    columns = F.when(F.size(b) > 0, F.sequence(F.lit(1), F.size(b))).otherwise(F.array().cast("array<int>"))
    return F.when(behind > edits, behind).otherwise(F.aggregate(columns, start, step, lambda s: s["d"]))


def edit_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of two texts in characters if it is at most ``edits``, else a larger number.

    What the texts have in common at both ends cannot change it and is cut off first.
    """
    chars = lambda t: F.filter(F.split(t, ""), lambda c: c != "")

    def between(x: Column, y: Column) -> Column:
        pair = F.struct(chars(x).alias("a"), chars(y).alias("b"))
        return _let(pair, lambda v: _banded_distance(v["a"], v["b"], edits))

    shorter = F.when(F.char_length(a) <= F.char_length(b), a).otherwise(b)
    longer = F.when(F.char_length(a) <= F.char_length(b), b).otherwise(a)
    return _ends_differ(shorter, longer, lambda x, y: _ends_differ(F.reverse(x), F.reverse(y), between))


def near_pairs(pairs: DataFrame, edits: int) -> DataFrame:
    """Of rows with lines ``la`` and ``lb``, those at most ``edits`` apart."""
    return pairs.filter(edit_distance(F.col("la"), F.col("lb"), edits) <= edits)


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(doc_id, version, no, line, id, place)``: every line of every document.

    A line's id is a 64-bit hash of it.  ``place`` orders lines by document id, then line number; a null id comes first.
    ``version`` tells texts of one document id apart.
    """
    value = F.col(f"`{text}`").cast("string")
    rows = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.xxhash64(value).alias("version"),
        F.posexplode(F.split(value, "\n", -1)).alias("no", "line"),
    )
    return rows.select("*", F.xxhash64("line").alias("id"), _place(F.col("doc_id"), F.col("no")).alias("place"))


def _place(doc: Column, no: Column) -> Column:
    low = F.coalesce(doc, F.lit(-(1 << 63))).cast("decimal(38,0)")
    return (low * F.lit(1 << 31).cast("decimal(10,0)") + no).cast("decimal(38,0)")


def _compared(least: int, exact: int) -> Column:
    """Lines that can repeat: of ``least`` characters, or of ``exact`` in several words."""
    length = F.char_length("line")
    return (length >= least) | ((length >= exact) & F.col("line").rlike(r"\S\s+\S"))


def line_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS, least: int = LEAST_LENGTH, exact: int = LEAST_EXACT
) -> DataFrame:
    """``(id, first)``: lines that repeat, exactly or nearly, and the first place of their class.

    A class is all lines that links of at most ``edits`` characters lead to; of fewer than ``least`` characters, copies alone.
    """
    lines = _lines(docs, key, text).filter(_compared(least, exact))
    with StageArea(docs.sparkSession) as stage:
        return cut(_classes(lines, edits, least, stage))


def _classes(lines: DataFrame, edits: int, least: int, stage: StageArea) -> DataFrame:
    distinct = stage(lines.groupBy("id").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n")), "distinct")
    # Keys take longer to make than to read again.
    members = stage(line_keys(lines.filter(F.char_length("line") >= least).select("id", "line"), edits, least), "keys")

    texts: dict[str, DataFrame] = {}

    def confirm_among(ids: DataFrame) -> Callable[[DataFrame], DataFrame]:
        wanted = small_enough(stage(ids, "wanted"), BROADCAST_LINES)
        found = lines.select("id", "line").join(wanted, "id").groupBy("id").agg(F.min("line").alias("line"))
        texts["of"] = found = stage(found, "texts")
        first = found.select(F.col("id").alias("a"), F.col("line").alias("la"))
        second = found.select(F.col("id").alias("b"), F.col("line").alias("lb"))
        return lambda pairs: near_pairs(pairs.join(first, "a").join(second, "b"), edits)

    def marks_among(ids: DataFrame) -> DataFrame:
        return texts["of"].join(ids, "id").select("id", letter_parity(F.col("line")).alias("mark"))

    # An edit changes how often two letters occur, at most.
    close = lambda x, y: F.bit_count(x("mark").bitwiseXOR(y("mark"))) <= 2 * edits
    labels = classes_by_keys(members, confirm_among, stage, marks_among, close)
    named = distinct.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    firsts = named.groupBy("label").agg(F.min("place").alias("first"), F.sum("n").alias("size")).filter("size > 1")
    return named.select("label", "id").join(firsts, "label").select("id", "first")


def _repeated_numbers(docs: DataFrame, key: str, text: str, edits: int, least: int, exact: int) -> DataFrame:
    """``(doc_id, version, repeated)``: the numbers of the lines of a document that are not the first of their class."""
    classes = line_classes(docs, key, text, edits, least, exact)
    lines = _lines(docs, key, text).filter(_compared(least, exact)).drop("line")
    again = lines.join(small_enough(classes, BROADCAST_LINES), "id").filter("place <> first")
    return again.groupBy("doc_id", "version").agg(F.collect_set("no").alias("repeated"))


def drop_repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str | None = None, edits: int = EDITS, least: int = LEAST_LENGTH,
    counts: tuple[str, str] | None = None, exact: int = LEAST_EXACT,
) -> DataFrame:
    """All rows of ``docs``, their texts without the lines that nearly repeat an earlier line of any document.

    Lines end at line breaks and are compared as they are.  Documents are ordered by their integer id; a null id comes first.
    Lines of fewer than ``least`` characters go only as copies, and stay if they are of fewer than ``exact`` or of one word.  A text whose lines are all repeated becomes empty; a null or empty text stays as
    it is.  Rows with the same id and text are one document and keep the same lines.  ``chars`` names a column of text lengths to
    be kept right.  ``counts`` names two columns to add: lines, and lines dropped.  Other columns pass, whatever their names.
    """
    repeated = _repeated_numbers(docs, key, text, edits, least, exact)
    names = [own_name(docs, n) for n in ("doc_id_of", "version", "repeated")]
    value = F.col(f"`{text}`").cast("string")
    versioned = docs.withColumn(names[1], F.xxhash64(value))
    joined = versioned.join(
        repeated.select(F.col("doc_id").alias(names[0]), F.col("version").alias(names[1]), F.col("repeated").alias(names[2])).withColumnRenamed(names[1], names[1] + "_r"),
        F.col(f"`{key}`").cast("long").eqNullSafe(F.col(names[0])) & (F.col(names[1]) == F.col(names[1] + "_r")),
        "left",
    )
    gone = F.col(names[2])
    lines = F.split(value, "\n", -1)
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(gone, i)), "\n")
    changes: dict[str, Column] = {text: F.when(gone.isNull(), value).otherwise(kept)}
    if counts:
        changes[counts[0]] = F.when(F.coalesce(value, F.lit("")) == "", 0).otherwise(F.size(lines)).cast("long")
        changes[counts[1]] = F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("long")
    out = joined.withColumns(changes)
    if chars:
        out = out.withColumn(chars, F.char_length(F.col(f"`{text}`")).cast(docs.schema[chars].dataType))
    return out.select(*[F.col(f"`{c}`") for c in [*docs.columns, *(counts or ())]])


def line_report(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS, least: int = LEAST_LENGTH) -> DataFrame:
    """Per row: key, lines, lines dropped, and the digest of the text that is left."""
    frame = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    out = drop_repeated_lines(frame, edits=edits, least=least, counts=("n_lines", "n_dropped"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))
