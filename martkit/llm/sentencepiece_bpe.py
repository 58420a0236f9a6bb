"""Encode and decode texts with a merge-type SentencePiece model, without running its merges over the text.

A list of pieces is the right encoding exactly when every two neighbours stay as they are if their joint text is
merged anew.  So the encoder walks left to right: it tries the longest piece that starts here (found by one
Aho-Corasick pass), then shorter ones, keeps a piece that is compatible with the one before, and goes back one piece
where none is, marking the position as failed in a bit field.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from martkit.llm.common import columns_of, kept

SPACE = "▁"
# Distinct words whose ids or texts a worker remembers before it starts afresh.
REMEMBERED = 300_000


@dataclass(frozen=True)
class PieceModel:
    """What encoding needs of a model file; a few megabytes at most, as pieces are few and short."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: str  # per id: n normal, b byte, o other
    prefix: bool


def read_model(path: str) -> PieceModel:
    """Read a model file.  Only merge models with byte fallback that take texts as they are fit."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    with open(path, "rb") as f:
        raw = f.read()
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(raw)
    trained, normal = proto.trainer_spec, proto.normalizer_spec
    plain = normal.name == "identity" and not normal.precompiled_charsmap and normal.escape_whitespaces
    if trained.model_type != 2 or not trained.byte_fallback or not plain or normal.remove_extra_whitespaces:
        raise ValueError("not a merge model with byte fallback and unchanged texts")
    types = [p.type for p in proto.pieces]
    if trained.treat_whitespace_as_suffix or 4 in types or 5 in types:
        raise ValueError("models with suffix spaces, own symbols or unused pieces are not covered")
    if len(proto.pieces) != SentencePieceProcessor(model_proto=raw).vocab_size():
        raise ValueError("damaged model")
    return PieceModel(
        tuple(p.piece for p in proto.pieces),
        tuple(p.score for p in proto.pieces),
        "".join({1: "n", 6: "b"}.get(t, "o") for t in types),
        normal.add_dummy_prefix,
    )


class Memory(dict):
    """Results by word, made on first use; emptied between texts once it is full."""

    def __init__(self, make: Callable[[str], str]):
        super().__init__()
        self._make = make

    def __missing__(self, word: str) -> str:
        out = self._make(word)
        if len(word) < 256:
            self[word] = out
        return out

    def of(self, words: list[str]) -> list[str]:
        if len(self) > REMEMBERED:
            self.clear()
        return list(map(self.__getitem__, words))


class PieceCodec:
    """Encoder and decoder of one model."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.prefix = SPACE if model.prefix else ""
        normal = [i for i, k in enumerate(model.kinds) if k == "n"]
        self.ids = {model.pieces[i]: i for i in normal}
        self.score = {model.pieces[i]: model.scores[i] for i in normal}
        self.byte_ids = {int(model.pieces[i][1:-1], 16): i for i, k in enumerate(model.kinds) if k == "b"}
        self.bytes = {i: bytes([b]) for b, i in self.byte_ids.items()}
        self._check_ties()
        self.merges: dict[str, list[tuple[float, str, str]]] = {}
        for piece in self.ids:
            parts, done = self._merge(piece)
            if len(parts) == 1:  # else no text ever yields it
                self.merges[piece] = done
        self.shorter: dict[str, str] = {}
        self.matcher = ahocorasick.Automaton()
        for piece in self.merges:
            if len(piece) > 1:
                self.matcher.add_word(piece, len(piece))
            for n in range(len(piece) - 1, 0, -1):
                if n == 1 or piece[:n] in self.merges:
                    self.shorter[piece] = piece[:n]
                    break
        self.matcher.make_automaton()
        self.compatible = lru_cache(1 << 17)(self._compatible)
        self.stretch = self._stretch_pattern()
        self._id_texts = {piece: str(i) for piece, i in self.ids.items()}
        # A word between single spaces is a few stretches; both are remembered.
        self._of_stretch = Memory(self._stretch_ids)
        self._of_word = Memory(lambda word: self._joined(SPACE + word))
        self._of_ids = Memory(self._surface)
        self._words_apart = self.prefix == SPACE and not any(SPACE in p.lstrip(SPACE) for p in self.merges)

    def _check_ties(self) -> None:
        """Equal scores must belong to runs of spaces: those merge from the left and stand before all else."""
        seen: dict[float, str] = {}
        for piece, score in self.score.items():
            if len(piece) > 1 and (other := seen.setdefault(score, piece)) != piece:
                if set(piece) | set(other) != {SPACE}:
                    raise ValueError(f"pieces of equal score: {piece!r}, {other!r}")

    def _merge(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """Merge a short text as the model does; also each merge's score with the last and first part after it."""
        parts, done = list(text), []
        while True:
            best, at = -math.inf, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1], -math.inf)
                if score > best:
                    best, at = score, i
            if at < 0:
                return parts, done
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            done.append((best, parts[-1], parts[0]))

    def _compatible(self, a: str, b: str) -> bool:
        """Whether merging the joint text of two pieces anew leaves the two.

        Both sides merge in their own order; of all possible merges the best score goes first, the left one on
        ties.  They are incompatible once a merge across the border is the next.
        """
        left, right = self.merges.get(a, ()), self.merges.get(b, ())
        i = j = 0
        last, first = a[-1], b[0]
        while True:
            x = left[i][0] if i < len(left) else -math.inf
            y = right[j][0] if j < len(right) else -math.inf
            across = self.score.get(last + first)
            if across is not None and across > x and across >= y:
                return False
            if i == len(left) and j == len(right):
                return True
            if x >= y:
                last = left[i][1]
                i += 1
            else:
                first = right[j][2]
                j += 1

    def _stretch_pattern(self) -> re.Pattern[str]:
        """Cut texts where no piece reaches across: before a space, around characters that no longer piece has, and
        between a letter and a mark that no piece has after a letter."""
        many = [p for p in self.merges if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in many):
            return re.compile(".+", re.DOTALL)
        joint = {c for p in many for c in p} - {SPACE}
        letters = {c for c in joint if c.isalpha()}
        after = {b for p in many for a, b in zip(p, p[1:], strict=False) if a in letters} - letters
        others = joint - letters
        group = lambda chars: "[" + "".join(map(re.escape, sorted(chars))) + "]" if chars else "(?!)"
        a, o, x = group(letters), group(others), group(after)
        return re.compile(f"{SPACE}*(?:{o}+{a}*|{a}+)(?:{x}{o}*{a}*)*|{SPACE}+|.", re.DOTALL)

    def pieces_of(self, text: str) -> list[str]:
        """Pieces of a stretch; a character without a piece stands for itself."""
        size = len(text)
        longest = [1] * size
        for end, n in self.matcher.iter(text):
            longest[end - n + 1] = n  # later ends are longer
        out: list[str] = []
        failed = at = 0
        token = text[: longest[0]]
        while True:
            end = at + len(token)
            if not failed >> end & 1 and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                if at == size:
                    return out
                token = text[at : at + longest[at]]
            elif len(token) > 1:
                token = self.shorter[token]
            else:
                # Nothing fits here: the piece before must be shorter, or end elsewhere.
                failed |= 1 << at
                token = out.pop()
                at -= len(token)

    def _stretch_ids(self, stretch: str) -> str:
        out = []
        for piece in self.pieces_of(stretch):
            if (i := self._id_texts.get(piece)) is not None:
                out.append(i)
            else:
                out += [str(self.byte_ids[b]) for b in piece.encode()]
        return ",".join(out)

    def _joined(self, text: str) -> str:
        return ",".join(self._of_stretch.of(self.stretch.findall(text)))

    def stretches(self, text: str) -> list[str]:
        """Ids of a text, comma-joined word by word."""
        if not text:
            return []
        words = text.split(" ")
        if self._words_apart and SPACE not in text and "" not in words:
            return self._of_word.of(words)
        return self._of_stretch.of(self.stretch.findall(self.prefix + text.replace(" ", SPACE)))

    def encode(self, text: str) -> list[int]:
        return [int(i) for s in self.stretches(text) for i in s.split(",")]

    def _surface(self, ids: str) -> str:
        """Text of the pieces with these ids; a run of byte pieces is UTF-8."""
        raw = []
        for i in map(int, ids.split(",")):
            raw.append(self.bytes[i] if i in self.bytes else self._plain(i))
        return b"".join(raw).decode("utf-8", "replace")

    def _plain(self, i: int) -> bytes:
        if self.model.kinds[i] == "n":
            return self.model.pieces[i].replace(SPACE, " ").encode()
        return b""

    def surfaces(self, stretches: list[str]) -> str:
        """Text of ids given stretch by stretch; the space put before a text goes."""
        text = "".join(self._of_ids.of(stretches))
        return text[1:] if self.prefix and text.startswith(" ") else text

    def decode(self, ids: list[int]) -> str:
        return self.surfaces([",".join(map(str, ids))]) if ids else ""


def codec_of(model: PieceModel) -> PieceCodec:
    """One codec per worker process and model, until another operator runs there."""
    return kept(model, lambda: PieceCodec(model))


def _on_batches(shared, schema: pa.Schema, row: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                made = [row(codec, v) for v in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, f.type) for c, f in zip(zip(*made), list(schema)[1:], strict=True)]],
                    names=schema.names,
                )

    return run


def _with_ids(codec: PieceCodec, text: str | None) -> tuple[list[int]]:
    return (codec.encode(text or ""),)


def _with_text(codec: PieceCodec, ids: list[int] | None) -> tuple[str]:
    return (codec.decode(ids or []),)


def _with_digests(codec: PieceCodec, text: str | None) -> tuple[int, str, str]:
    found = codec.stretches(text or "")
    joined = ",".join(found)
    decoded = codec.surfaces(found)
    return (
        joined.count(",") + 1 if joined else 0,
        hashlib.sha256(joined.encode()).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(),
    )


def _apply(df: DataFrame, model: PieceModel, column: str, row: Callable, fields: list[tuple[str, pa.DataType]]) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.null()), *fields])
    names = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string", pa.list_(pa.int32()): "array<int>"}
    ddl = ", ".join([f"doc_id {df.schema['doc_id'].dataType.simpleString()}", *[f"{n} {names[t]}" for n, t in fields]])
    return df.select("doc_id", column).mapInArrow(_on_batches(shared, schema, row), ddl)


def encode_texts(docs: DataFrame, model: PieceModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids)`` of each row.  A null or empty text has no ids; repeated rows give repeated rows."""
    return _apply(columns_of(docs, key, text), model, "text", _with_ids, [("ids", pa.list_(pa.int32()))])


def decode_ids(encoded: DataFrame, model: PieceModel, ids: str = "ids") -> DataFrame:
    """``(doc_id, text)`` of each row of ids; null or no ids give the empty text."""
    frame = encoded.withColumnRenamed(ids, "ids")
    return _apply(frame, model, "ids", _with_text, [("text", pa.string())])


def encoding_digests(docs: DataFrame, model: PieceModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode each row; return counts and digests in place of the ids and the text.

    One pass over the rows, nothing is shuffled.  A null text counts as empty.
    """
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    return _apply(columns_of(docs, key, text), model, "text", _with_digests, fields)
