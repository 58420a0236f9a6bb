"""Rewrite database names across a corpus of texts."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from martkit.operators.joins import spread_join

# Fixed value: ASCII letters, digits and underscore make up a word.
WORD_RUN = "[A-Za-z0-9_]+"
# Where such a run begins or ends.
WORD_BORDER = "(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])"
# Bytes of entries that may go to the tasks as a constant of the plan, each counted with some bytes besides its words.
DICTIONARY_BYTES, ENTRY_BYTES = 1 << 20, 16
# Entries that one pattern may hold; with more of them every word of a text is looked up.
PATTERN_ENTRIES = 4_096
# Set around found names; a text that has this character itself is cut at all words.
MARK = "\u0001"


def swap_environment(name: Column, from_letter: str, to_letter: str) -> Column:
    """Swap the first environment letter that has a character before it; case does not count."""
    if not (len(from_letter) == len(to_letter) == 1 and (from_letter + to_letter).isalpha()):
        raise ValueError("environments are single letters")
    return F.regexp_replace(
        name, f"(?is)^(.+?){from_letter.upper()}", f"$1{to_letter.upper()}"
    )


def derive_name_map(names: DataFrame, from_letter: str, to_letter: str, name: str = "name") -> DataFrame:
    """Old and new database name for every listed name."""
    return names.select(
        F.col(name).alias("old_name"), swap_environment(F.col(name), from_letter, to_letter).alias("new_name")
    )


def checked_names(names: DataFrame, old: str = "old_name", new: str = "new_name") -> DataFrame:
    """``(word, replacement)``: the dictionary by lower-case word, one row each.

    Rows without an old or new name do not count.  An entry that is not a single word, or that has two different
    replacements, fails the job when it runs.
    """
    word = F.lower(F.col(old))
    rows = names.select(word.alias("word"), F.col(new).alias("new")).dropna()
    one = rows.groupBy("word").agg(F.min("new").alias("low"), F.max("new").alias("high"))
    message = F.when(~F.col("word").rlike(f"^{WORD_RUN}$"), F.concat(F.lit("not a single word: "), "word")).when(
        F.col("low") != F.col("high"), F.concat(F.lit("two replacements for: "), "word")
    )
    replacement = F.when(message.isNotNull(), F.raise_error(message).cast("string")).otherwise(F.col("low"))
    return one.select("word", replacement.alias("replacement"))


def _known(docs: DataFrame, dictionary: DataFrame, text: str) -> list[tuple[str, str]] | None:
    """The entries to hand to every task: the whole dictionary, or those that the texts use; none if their bytes are too many."""
    entries = dictionary
    for cut in (False, True):
        if cut:
            vocabulary = docs.select(F.explode(F.array_distinct(F.transform(_words(text), F.lower))).alias("word")).distinct()
            entries = spread_join(dictionary, vocabulary, ["word"], "left_semi")
        size = F.octet_length("word") + F.octet_length("replacement") + ENTRY_BYTES
        if (entries.agg(F.sum(size).alias("size")).first().size or 0) <= DICTIONARY_BYTES:
            return [(r.word, r.replacement) for r in entries.collect()]
    return None


def _lookup(entries: Sequence[tuple[str, str]]) -> Callable[[Column], Column]:
    """The replacement of a lower-case word, or null: a constant of small maps, the word's checksum tells in which one it is."""
    parts = 1 << max(0, len(entries).bit_length() - 2)
    maps: list[dict[str, str]] = [{} for _ in range(parts)]
    for word, replacement in entries:
        maps[zlib.crc32(word.encode()) % parts][word] = replacement
    constant = F.from_json(F.lit(json.dumps(maps)), "array<map<string,string>>")
    return lambda word: F.element_at(F.get(constant, (F.crc32(word.cast("binary")) % parts).cast("int")), word)


def _pattern(words: Iterable[str]) -> str:
    """A pattern of whole words in any letter case, which share their beginnings: few letters are tried at a place."""
    tree: dict = {}
    for word in words:
        node = tree
        for letter in word:
            node = node.setdefault(letter, {})
        node[""] = {}

    def rest(node: dict) -> str:
        ways = [letter + rest(below) for letter, below in sorted(node.items()) if letter]
        inner = ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})" if ways else ""
        return f"(?:{inner})?" if ways and "" in node else inner

    return f"(?i)(?<![A-Za-z0-9_]){rest(tree)}(?![A-Za-z0-9_])"


def _words(text: str) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_RUN), F.lit(0))


def rewrite_names(
    docs: DataFrame, names: DataFrame, text: str = "text", old: str = "old_name", new: str = "new_name"
) -> DataFrame:
    """Replace whole words by the dictionary in one pass over each text; letter case does not count.

    Names are marked by one pattern, the text is cut at the marks, and the pieces are looked up one by one, so no replacement is
    replaced again; with very many names it is cut at all words instead.  The
    dictionary goes to the texts as a constant after its bytes are counted; a longer one is cut to the vocabulary of the corpus
    first, which is found with partial sums before anything travels.  Texts stay where they are read.  If even the used entries
    are too many bytes, what each text uses is joined to it instead, and only then are texts shuffled.
    """
    dictionary = checked_names(names, old, new)
    entries = _known(docs, dictionary, text)
    if entries is None:
        return _rewrite_joined(docs, dictionary, text)
    if not entries:
        return docs
    find = _lookup(entries)
    renamed = lambda p: F.coalesce(find(F.lower(p)), p)
    out = F.array_join(F.transform(F.split(text, WORD_BORDER, -1), renamed), "")
    if len(entries) <= PATTERN_ENTRIES:
        found = F.regexp_replace(text, F.lit(_pattern(w for w, _ in entries)), F.lit(f"{MARK}$0{MARK}"))
        # Every second piece is a name.
        pieces = F.transform(F.split(found, MARK, -1), lambda p, i: F.when(i.bitwiseAND(F.lit(1)) == 1, renamed(p)).otherwise(p))
        out = F.when(F.contains(F.col(text), F.lit(MARK)), out).otherwise(F.array_join(pieces, ""))
    return docs.withColumn(text, out)


def _rewrite_joined(docs: DataFrame, dictionary: DataFrame, text: str) -> DataFrame:
    """The distinct words of each text meet the dictionary; what a text uses comes back to it as a small map."""
    words = _words(text)
    # Equal texts use the same names: they are told by two hashes, not by a key the caller would have to have.
    marks = {"_h1": F.xxhash64(text), "_h2": F.xxhash64(F.lit(1), F.col(text))}
    distinct = F.explode(F.array_distinct(F.transform(words, F.lower)))
    asked = docs.select(*[c.alias(n) for n, c in marks.items()], distinct.alias("word"))
    found = spread_join(asked, dictionary, ["word"], "inner")
    used = found.groupBy(*marks).agg(F.map_from_entries(F.collect_set(F.struct("word", "replacement"))).alias("_used"))
    joined = docs.withColumns(marks).join(used, list(marks), "left")
    pieces = F.transform(F.split(text, WORD_BORDER, -1), lambda p: F.coalesce(F.element_at("_used", F.lower(p)), p))
    changed = F.when(F.col("_used").isNotNull(), F.array_join(pieces, "")).otherwise(F.col(text))
    return joined.withColumn(text, changed).select(*docs.columns)


def name_usage(
    docs: DataFrame, names: DataFrame, doc: str = "doc_id", text: str = "text", old: str = "old_name", new: str = "new_name"
) -> DataFrame:
    """How often each dictionary word occurs in each document; only words of the dictionary leave their text."""
    dictionary = checked_names(names, old, new)
    entries = _known(docs, dictionary, text)
    words = F.transform(_words(text), F.lower)
    if entries and len(entries) <= PATTERN_ENTRIES:
        words = F.transform(F.regexp_extract_all(text, F.lit(_pattern(w for w, _ in entries)), F.lit(0)), F.lower)
    elif entries:
        find = _lookup(entries)
        words = F.filter(words, lambda w: find(w).isNotNull())
    uses = docs.select(F.col(doc), F.explode(words).alias("word")).groupBy(doc, "word").agg(F.count(F.lit(1)).alias("uses"))
    if entries is None:
        uses = spread_join(uses, dictionary, ["word"], "left_semi")
    elif not entries:
        uses = uses.limit(0)
    return uses.select(doc, F.col("word").alias("name"), "uses")
