"""Rearrange texts so that a model learns to fill in the middle, many texts in one numpy step.

A text is cut in prefix, middle and suffix at two of its tokens.  Every byte of a step moves by some shift, which is the same for
all bytes of a piece: a difference array has the changes of the shift at the cuts, its running sum is each byte's shift, and one
scatter writes all outputs.  The way back finds the marks, makes the inverse shifts and gathers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martkit.llm.common import byte_texts, columns_of, steps

# Seed, shares in a hundred, marks of prefix, suffix and middle.
SEED, REARRANGED, SUFFIX_FIRST = 42, 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")

# Fixed value: blank, tab to carriage return part tokens.
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True


@dataclass(frozen=True)
class Step:
    """Some texts one after the other, each followed by a line break that belongs to none."""

    data: np.ndarray
    starts: np.ndarray  # first byte of each text
    ends: np.ndarray

    @classmethod
    def of(cls, texts: Sequence[bytes]) -> Step:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths + 1) - 1
        return cls(np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8), ends - lengths, ends)

    def texts(self) -> list[bytes]:
        whole = self.data.tobytes()
        return [whole[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True)]


def _marks(step: Step) -> list[np.ndarray]:
    """Places of the three marks, in the order prefix, suffix, middle."""
    d = step.data
    found = np.flatnonzero((d[:-2] == 0x3C) & (d[2:] == 0x3E)) if len(d) > 2 else np.zeros(0, np.int64)
    return [found[d[found + 1] == m[1]] for m in (PREFIX, SUFFIX, MIDDLE)]


def _tokens(step: Step) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of each text; the ends of all words, and the number of words before each text.

    A token is a word with the blanks before it; blanks at the end of a text are one more.
    """
    blank = _IS_BLANK[step.data]
    word_ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1 if len(blank) > 1 else np.zeros(0, np.int64)
    # A line break follows every text, so that its last word ends no later.
    before = np.searchsorted(word_ends, step.starts, side="right")
    words = np.searchsorted(word_ends, step.ends, side="right") - before
    trailing = (step.ends > step.starts) & blank[np.maximum(step.ends - 1, 0)]
    return words + trailing, word_ends, before


def _place(units: np.ndarray, n: np.ndarray, words_end: np.ndarray, before: np.ndarray, step: Step) -> np.ndarray:
    """The byte at which so many tokens of each text end."""
    at = np.clip(before + units - 1, 0, max(len(words_end) - 1, 0))
    inner = words_end[at] if len(words_end) else step.starts
    return np.where(units == 0, step.starts, np.where(units == n, step.ends, inner))


def _numbers(ids: Sequence[object], seed: int) -> np.ndarray:
    """Four unsigned numbers of each id: the first groups of the digest of ``seed:id``; a null id counts as empty."""
    digests = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids]
    return np.frombuffer(b"".join(digests), ">u4").reshape(-1, 4).astype(np.int64)


def _shifts(size: int, places: Sequence[np.ndarray], shifts: Sequence[np.ndarray]) -> np.ndarray:
    """Shift of every byte: from each place on the shift given for it, by the running sum of the changes."""
    place, shift = np.stack(places, 1).ravel(), np.stack(shifts, 1).ravel()
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, place, np.diff(shift, prepend=0))
    return np.cumsum(change[:-1])


@dataclass(frozen=True)
class Rearranged:
    output: Step
    n: np.ndarray
    forms: np.ndarray
    prefix_chars: np.ndarray
    middle_chars: np.ndarray


def rearrange(ids: Sequence[object], texts: Sequence[bytes], seed: int = SEED, share: int = REARRANGED, first: int = SUFFIX_FIRST) -> Rearranged:
    """Outputs of some texts: which form and which cuts follows from the id alone."""
    step = Step.of(texts)
    n, word_ends, before = _tokens(step)
    h = _numbers(ids, seed)
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    marked = np.zeros(len(texts), bool)
    for m in _marks(step):
        marked[np.searchsorted(step.starts, m, side="right") - 1] = True
    plain = (step.ends == step.starts) | marked | (h[:, 2] % 100 >= share)
    forms = np.where(plain, PLAIN, np.where(h[:, 3] % 100 < first, SPM, PSM))

    a, d = step.starts, step.ends
    b, c = (_place(cuts[:, k], n, word_ends, before, step) for k in (0, 1))
    sizes = (d - a) + np.where(plain, 0, 3 * MARK)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    # Where prefix, middle and suffix begin in the output.
    psm, spm = forms == PSM, forms == SPM
    prefix = starts + np.where(psm, MARK, np.where(spm, 2 * MARK + d - c, 0))
    suffix = starts + np.where(psm, 2 * MARK + b - a, np.where(spm, MARK, c - a))
    middle = np.where(plain, starts + b - a, ends - (c - b))
    shift = _shifts(len(step.data), [a, b, c, d], [prefix - a, middle - b, suffix - c, ends - d])
    out = np.empty(int(ends[-1]) + 1 if len(ends) else 0, np.uint8)
    out[np.arange(len(step.data)) + shift] = step.data
    for at, m in ((prefix, PREFIX), (suffix, SUFFIX), (middle, MIDDLE)):
        for k in range(MARK):
            out[at[~plain] - MARK + k] = m[k]
    chars = np.concatenate([[0], np.cumsum(step.data & 0xC0 != 0x80)])
    return Rearranged(Step(out, starts, ends), n, forms, chars[b] - chars[a], chars[c] - chars[b])


def put_back(output: Step, forms: np.ndarray) -> Step:
    """The texts from outputs and forms alone."""
    moved = forms != PLAIN
    bounds = np.stack([output.starts[moved], output.ends[moved]], 1)
    own = []
    for m in _marks(output):
        # Marks of plain outputs are text.
        at = np.searchsorted(output.starts, m, side="right") - 1
        if not np.array_equal(at[moved[at]], np.flatnonzero(moved)):
            raise ValueError("an output does not have each mark once")
        own.append(m[moved[at]])
    spm = forms[moved] == SPM
    sizes = output.ends - output.starts - np.where(moved, 3 * MARK, 0)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    a, b, c, d = (starts.copy(), starts.copy(), starts.copy(), ends.copy())
    prefix, middle, suffix = (output.starts.copy() for _ in range(3))
    prefix[moved], suffix[moved], middle[moved] = (x + MARK for x in own)
    b[moved] = a[moved] + np.where(spm, own[2], own[1]) - prefix[moved]
    c[moved] = b[moved] + bounds[:, 1] - middle[moved]
    shift = _shifts(int(ends[-1]) + 1 if len(ends) else 0, [a, b, c, d], [prefix - a, middle - b, suffix - c, output.ends - d])
    return Step(output.data[np.arange(len(shift)) + shift], starts, ends)


def _parts(batches: Iterator[pa.RecordBatch], seed: int, share: int, first: int) -> Iterator[tuple[pa.RecordBatch, Rearranged]]:
    for part in steps(batches):
        yield part, rearrange(part.column(0).to_pylist(), byte_texts(part.column(1)), seed, share, first)


def _columns(part: pa.RecordBatch, done: Rearranged) -> list[pa.Array]:
    plain = done.forms == PLAIN
    lengths = [pa.array(x, pa.int64(), mask=plain) for x in (done.prefix_chars, done.middle_chars)]
    return [part.column(0), pa.array(done.n, pa.int64()), pa.array([FORMS[f] for f in done.forms], pa.string()), *lengths]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, share: int = REARRANGED, first: int = SUFFIX_FIRST) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` of every row: its text rearranged.

    ``share`` of a hundred texts are rearranged, ``first`` of a hundred of these with the suffix first.  A null or empty text has no
    token, is plain and empty; a text that holds a mark is plain.  A null key counts as empty text; rows with the same key and text
    have the same output; an empty table gives none.  Other columns do not matter, whatever their names.  A text is whole in one task.
    """
    frame = columns_of(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, done in _parts(batches, seed, share, first):
            yield pa.RecordBatch.from_arrays([*_columns(part, done), _strings(done.output)], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return frame.mapInArrow(run, f"doc_id {_key_type(frame)}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore_texts(outputs: DataFrame, key: str = "doc_id", output: str = "output", form: str = "form") -> DataFrame:
    """``(doc_id, text)``: the texts that ``fill_in_middle`` was given, empty where they were null.

    A null output counts as empty, a null form as plain.  Fails on a rearranged output that does not have each mark once.
    """
    columns = {"doc_id": F.col(f"`{key}`"), "text": F.col(f"`{output}`").cast("string"), "form": F.col(f"`{form}`").cast("string")}
    frame = outputs.select(*[c.alias(n) for n, c in columns.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            forms = np.array([FORMS.index(f or "plain") for f in part.column(2).to_pylist()], np.int64)
            back = put_back(Step.of(byte_texts(part.column(1))), forms)
            yield pa.RecordBatch.from_arrays([part.column(0), _strings(back)], names=["doc_id", "text"])

    return frame.mapInArrow(run, f"doc_id {_key_type(frame)}, text string")


def fill_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, share: int = REARRANGED, first: int = SUFFIX_FIRST) -> DataFrame:
    """As ``fill_in_middle``, with digests of the output and of the text that the way back gives; both in one pass."""
    frame = columns_of(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, done in _parts(batches, seed, share, first):
            digests = [[hashlib.sha256(t).hexdigest() for t in s.texts()] for s in (done.output, put_back(done.output, done.forms))]
            yield pa.RecordBatch.from_arrays(
                [*_columns(part, done), *[pa.array(d, pa.string()) for d in digests]],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
            )

    return frame.mapInArrow(
        run, f"doc_id {_key_type(frame)}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    )


def _strings(step: Step) -> pa.Array:
    return pa.array(step.texts(), pa.binary()).cast(pa.string(), safe=False)


def _key_type(frame: DataFrame) -> str:
    return frame.schema["doc_id"].dataType.simpleString()


def fill_sql() -> str:
    """The same answers in SQL, from the list of a text's tokens."""
    token = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
    group = lambda k: f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS UBIGINT)"
    p, s, m = (x.decode() for x in (PREFIX, SUFFIX, MIDDLE))
    joined = lambda part: f"coalesce(array_to_string({part}, ''), '')"
    return f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{token}') AS tokens,
         sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
drawn AS (
  SELECT *, CAST(len(tokens) AS BIGINT) AS n, CAST({group(0)} % (len(tokens) + 1) AS BIGINT) AS x, CAST({group(1)} % (len(tokens) + 1) AS BIGINT) AS y,
         CASE WHEN text = '' OR contains(text, '{p}') OR contains(text, '{s}') OR contains(text, '{m}') OR {group(2)} % 100 >= {REARRANGED} THEN 'plain'
              WHEN {group(3)} % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
  FROM cut
),
pieces AS (
  SELECT doc_id, text, n, form, {joined("tokens[1:least(x, y)]")} AS p, {joined("tokens[least(x, y) + 1:greatest(x, y)]")} AS m,
         {joined("tokens[greatest(x, y) + 1:]")} AS s
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{p}' || p || '{s}' || s || '{m}' || m ELSE '{s}' || s || '{p}' || p || '{m}' || m END) AS output_sha256,
       sha256(p || m || s) AS restored_sha256
FROM pieces
"""
