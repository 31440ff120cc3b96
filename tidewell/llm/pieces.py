"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a Viterbi pass.

The automaton reports every piece that ends at a position, the longest first and then along its output
links. Each report relaxes the best score of that position from the position where the piece begins, so one
pass over the text finds the segmentation with the highest sum of piece scores. Ties keep the longest last
piece, which is reported first. A character that no piece covers costs ``unknown`` below the lowest score
and becomes its byte pieces.

As in SentencePiece, a text gets a space in front and spaces are written U+2581. No piece holds that sign
after another character, so the best segmentation of a text is that of its words, each with all the space signs
in front of it, and words are looked up in a bounded cache. Only spaces at the end of a text are a word of their own.

The vocabulary file is a parameter; the driver reads it once and broadcasts its pieces (a bounded table).

Defined results: a null text has null ids, an empty one has none; U+2581 in a text becomes byte pieces, so
that decoding always gives the text back; rows pass through, repeated or without an id; an empty table gives
an empty result. ``decode`` ignores control pieces and reads a null list as a null text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import map_rows, packed

SPACE = "▁"
DEFAULT_MODEL = os.path.join(os.environ.get("TIDEWELL_TOKENIZERS", "/opt/tokenizers"), "piece_bpe_32k.model")
# A word starts at a space sign that follows another character: no piece lies across that place.
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_CACHE_WORDS, _CACHED_LENGTH = 60_000, 64
# How far below the lowest score of a piece an unknown character lies.
UNKNOWN_PENALTY = 10.0


def read_pieces(model_file: str) -> list[tuple[str, float, str]]:
    """``(piece, score, kind)`` by id; kinds are piece, byte and control."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)

    def kind(i: int) -> str:
        if model.is_byte(i):
            return "byte"
        return "control" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "piece"

    return [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())]


class Codec:
    """Encodes and decodes texts with a list of pieces. One lives in each Python worker."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        scores = []
        for i, (piece, score, kind) in enumerate(pieces):
            # Spans of spaces may be scored far below all other pieces; they are no measure for unknown characters.
            if kind == "piece":
                self.automaton.add_word(piece, (len(piece), score, i))
                if set(piece) != {SPACE}:
                    scores.append(score)
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError("a piece holds a space after another character")
        self.automaton.make_automaton()
        self.bytes = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == "byte"}
        self.byte_ids = [self.bytes[f"<0x{b:02X}>"] for b in range(256)]
        self.single = {piece for piece, _, kind in pieces if kind == "piece" and len(piece) == 1}
        self.unknown = min(scores) - UNKNOWN_PENALTY
        self.values = [
            piece.replace(SPACE, " ").encode() if kind == "piece" else bytes([int(piece[1:-1], 16)]) if kind == "byte" else b""
            for piece, _, kind in pieces
        ]
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def viterbi(self, word: str) -> list[int]:
        """Ids of the best segmentation."""
        n = len(word)
        best, start, chosen = [0.0] + [-np.inf] * n, [0] * (n + 1), [-1] * (n + 1)
        covered = self.single.issuperset(word)
        done = 0  # positions that the characters without a piece of their own have relaxed
        for end, (length, score, i) in self.automaton.iter(word):
            to = end + 1
            if not covered and done < to:
                done = self._relax_unknown(word, best, start, done, to)
            total = best[to - length] + score
            if total > best[to]:
                best[to], start[to], chosen[to] = total, to - length, i
        if not covered:
            self._relax_unknown(word, best, start, done, n)
        ids: list[int] = []
        at = n
        while at:
            if chosen[at] < 0:
                ids += [self.byte_ids[b] for b in reversed(word[start[at] : at].encode("utf-8", "surrogatepass"))]
            else:
                ids.append(chosen[at])
            at = start[at]
        ids.reverse()
        return ids

    def _relax_unknown(self, word: str, best: list[float], start: list[int], done: int, upto: int) -> int:
        """Relaxes each position after ``done`` from the one before it, where the character has no piece."""
        for at in range(done + 1, upto + 1):
            if word[at - 1] not in self.single:
                best[at], start[at] = best[at - 1] + self.unknown, at - 1
        return upto

    def word_ids(self, word: str) -> bytes:
        """Ids of a word, packed. The cache has two generations, so that frequent words outlive a full one."""
        ids = self.recent.get(word)
        if ids is None:
            ids = self.older.get(word)
            if ids is None:
                ids = np.array(self.viterbi(word), np.int32).tobytes()
            if len(word) <= _CACHED_LENGTH:
                if len(self.recent) >= _CACHE_WORDS:
                    self.older, self.recent = self.recent, {}
                self.recent[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        if SPACE in text:
            # Parts between the signs are encoded apart from their spaces' sign.
            sign = np.array([self.byte_ids[b] for b in SPACE.encode()], np.int32).tobytes()
            first, *parts = text.split(SPACE)
            packed_ids = self._spaced(SPACE + first.replace(" ", SPACE))
            packed_ids += b"".join(sign + self._spaced(part.replace(" ", SPACE)) for part in parts)
        else:
            packed_ids = self._spaced(SPACE + text.replace(" ", SPACE))
        return np.frombuffer(packed_ids, np.int32)

    def _spaced(self, text: str) -> bytes:
        return b"".join(map(self.word_ids, _WORD.findall(text)))

    def decode(self, ids: Iterable[int]) -> str:
        data = b"".join(map(self.values.__getitem__, ids))
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "surrogatepass")


_CODECS: dict[str, Codec] = {}


def _codec(broadcast, name: str) -> Codec:
    """The codec of this Python worker, built from the broadcast pieces when first asked for."""
    if name not in _CODECS:
        _CODECS[name] = Codec(broadcast.value)
    return _CODECS[name]


def _pieces(spark: SparkSession, model_file: str):
    return spark.sparkContext.broadcast(read_pieces(model_file))


def encode(
    docs: DataFrame, text_col: str = "text", model_file: str = DEFAULT_MODEL, carry: list[str] | None = None
) -> DataFrame:
    """``row`` (the input, or its ``carry`` columns) and ``ids``."""
    pieces = _pieces(docs.sparkSession, model_file)
    frame = packed(docs, carry, text=F.col(f"`{text_col}`"))
    schema = T.StructType().add("row", frame.schema["row"].dataType).add("ids", T.ArrayType(T.IntegerType()))

    def run(rows: pa.Array, texts: pa.Array):
        codec = _codec(pieces, model_file)
        return rows, _lists([None if t is None else codec.encode(t) for t in texts.to_pylist()])

    return map_rows(frame, run, schema, rows=128)


def round_trip(
    docs: DataFrame, text_col: str = "text", model_file: str = DEFAULT_MODEL, carry: list[str] | None = None
) -> DataFrame:
    """``row`` (the input, or its ``carry`` columns), ``ids``, and the ``text`` that decoding them gives.

    What ``encode`` and ``decode`` do one after the other, by one Python worker for each task instead of two.
    """
    pieces = _pieces(docs.sparkSession, model_file)
    frame = packed(docs, carry, text=F.col(f"`{text_col}`"))
    schema = T.StructType().add("row", frame.schema["row"].dataType)
    schema = schema.add("ids", T.ArrayType(T.IntegerType())).add("text", "string")

    def run(rows: pa.Array, texts: pa.Array):
        codec = _codec(pieces, model_file)
        found = [None if t is None else codec.encode(t) for t in texts.to_pylist()]
        return rows, _lists(found), [None if x is None else codec.decode(x.tolist()) for x in found]

    return map_rows(frame, run, schema, rows=128)


def _lists(found: list[np.ndarray | None]) -> pa.Array:
    """Lists of ids as one Arrow column; a null stays null."""
    ends = np.cumsum([0] + [0 if x is None else len(x) for x in found])
    offsets = pa.array(ends.astype(np.int32), mask=np.array([x is None for x in found] + [False]))
    there = [x for x in found if x is not None]
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(there) if there else np.zeros(0, np.int32)))


def decode(
    encoded: DataFrame, ids_col: str = "ids", model_file: str = DEFAULT_MODEL, carry: list[str] | None = None
) -> DataFrame:
    """``row`` (the input, or its ``carry`` columns) and ``text``."""
    pieces = _pieces(encoded.sparkSession, model_file)
    frame = packed(encoded, carry, ids=F.col(f"`{ids_col}`"))
    schema = T.StructType().add("row", frame.schema["row"].dataType).add("text", "string")

    def run(rows: pa.Array, lists: pa.Array):
        codec = _codec(pieces, model_file)
        return rows, [codec.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in lists]

    return map_rows(frame, run, schema, rows=128)
