"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Both token lists of a text cover the same bytes. Every token points to the overlapping token that reaches
farthest to the right (of two that reach equally far, B's; so a B token that no A token passes points to itself).
Pointers never go back, so every chain ends at a token after which both lists end, and that token names the
group. Successor doubling (``next = next[next]``) makes every token point to its terminal one in as many rounds as
the longest chain's length has binary digits, for all texts of a batch at once.

Overlapping tokens of the two lists are linked. ``count`` of an id pair is the number of texts that hold it linked,
over the whole table. First the texts are encoded, aligned and stored, each with its different pairs and how often
they come. Then the pairs are counted. Each text looks up its pairs among the most frequent ones, which travel to
the tasks: at most ``FREQUENT_PAIRS`` of them, a bound that a count per magnitude ensures. The other pairs, each
rarer than all of these, are joined by a shuffle. So a pair that most texts hold is never a key of a join.

Texts are cut for encoding where a single space stands between two signs that aren't blank. Neither tokenizer has
a token across such a place (the vocabulary of B is checked for that), so the tokens are those of the whole text,
and memory is bounded by the part, the text's different pairs, and the longest stretch without such a place.

Tokenizer files are parameters, read once by the driver and broadcast. A is a byte-level byte-pair file whose ids
follow its merges, which is checked; it is encoded by rank. B is a SentencePiece model.

Defined results: texts that are null or empty, or whose tokens' bytes are not the space and the text, have no tokens:
zeros, and an empty group text. Rows pass through, repeated or without an id; repeated texts count as often as they
come; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import map_rows, packed, stored

_FOLDER = os.environ.get("TIDEWELL_TOKENIZERS", "/opt/tokenizers")
MODEL_A = os.path.join(_FOLDER, "byte_bpe_50k.json")
MODEL_B = os.path.join(_FOLDER, "piece_bpe_32k.model")
SPACE = "▁"
#: Pairs that travel to every task, at most: 13 bytes each.
FREQUENT_PAIRS = 1_000_000
# Texts longer than a part are cut; parts are aligned together up to a batch. In characters.
_PART, _BATCH = 1 << 16, 1 << 18
_CUT = re.compile(r"(?<=\S) (?=\S)")
# Fixed value: how byte-level vocabularies of this kind part a text before merging.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: itself if visible, else one from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteTokens:
    """A byte-level byte-pair vocabulary."""

    def __init__(self, data: bytes):
        import tiktoken

        file = json.loads(data)
        model, before = file["model"], file["pre_tokenizer"]
        signs = byte_signs()
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
        plain = (before["type"], before.get("add_prefix_space"), file["normalizer"]) == ("ByteLevel", False, None)
        if not plain or any(model["vocab"][m] != len(signs) + i for i, m in enumerate(merged)):
            raise ValueError("not a byte-level file whose ids follow its merges")
        special = {t["content"] for t in file["added_tokens"]}
        ranks = {bytes(signs[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        self.size = 1 + max(model["vocab"].values())
        self.values = [b""] * self.size
        for value, i in ranks.items():
            self.values[i] = value
        self.coder = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.coder.encode_ordinary(text) for text in texts]


class PieceTokens:
    """A SentencePiece vocabulary, which puts the space in front by itself."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.size = self.coder.get_piece_size()
        pieces = [self.coder.id_to_piece(i) for i in range(self.size)]
        self.values = [
            bytes([int(p[3:-1], 16)]) if self.coder.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.parts = not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.coder.encode([text[1:] for text in texts], num_threads=1)


def parts_of(text: str, size: int = _PART) -> Iterator[str]:
    """The text in parts of about ``size``, each but the first beginning with the single space it was cut at."""
    start = 0
    while len(text) - start > size:
        found = _CUT.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers, in order, of the A and the B tokens that end at these places and cover the same bytes."""
    n = len(ends_a)
    # The other list's token that holds a token's last byte is the overlapping one that reaches farthest.
    to_b = n + np.searchsorted(ends_b, ends_a)
    to_a = np.searchsorted(ends_a, ends_b)
    itself = n + np.arange(len(ends_b))
    successor = np.concatenate([to_b, np.where(ends_a[to_a] == ends_b, itself, to_a)])
    terminal = successor[n:] == itself
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            break
        successor = further
    number = np.cumsum(terminal) - 1
    return number[successor[:n] - n], number[successor[n:] - n]


def links_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of the tokens that overlap."""
    starts = np.concatenate([[0], ends_a[:-1]])
    first = np.searchsorted(ends_b, starts, side="right")
    times = np.searchsorted(ends_b, ends_a) - first + 1
    a = np.repeat(np.arange(len(ends_a)), times)
    before = np.cumsum(times) - times
    return a, np.arange(len(a)) - np.repeat(before - first, times)


def interleaved(group_a: np.ndarray, group_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the tokens of both lists stand when each group's A tokens come first, then its B tokens."""
    groups = int(group_b[-1]) + 1 if len(group_b) else 0
    sizes_a, sizes_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    b_before = np.cumsum(sizes_b) - sizes_b
    a_upto = np.cumsum(sizes_a)
    return np.arange(len(group_a)) + b_before[group_a], np.arange(len(group_b)) + a_upto[group_b]


class Aligner:
    """Encodes and aligns texts. One lives in each Python worker."""

    def __init__(self, data_a: bytes, data_b: bytes):
        self.a, self.b = ByteTokens(data_a), PieceTokens(data_b)
        self.lengths = [np.array([len(v) for v in t.values], np.int64) for t in (self.a, self.b)]
        self.width = max(self.a.size, self.b.size)
        # An id with each of the signs that may follow it.
        self.texts = [f"{i}{sign}" for sign in ",|;" for i in range(self.width)]

    def align(self, texts: list[str | None]) -> Iterator[Aligned]:
        """The alignment of each text, in order."""
        out = [Aligned() for _ in texts]
        waiting: list[tuple[int, str]] = []
        size = 0
        for n, text in enumerate(texts):
            if text:
                text = " " + text
                for part in parts_of(text) if self.b.parts else [text]:
                    waiting.append((n, part))
                    size += len(part)
                    if size > _BATCH:
                        self._parts(waiting, out)
                        waiting, size = [], 0
        self._parts(waiting, out)
        return iter(out)

    def _parts(self, waiting: list[tuple[int, str]], out: list[Aligned]) -> None:
        """Aligns the parts that wait, each a stretch of one line of bytes, and adds them to their texts."""
        texts = [part for _, part in waiting]
        tokens = []
        for (n, part), ids_a, ids_b in zip(waiting, self.a.encode(texts), self.b.encode(texts)):
            data = part.encode("utf-8", "surrogatepass")
            if all(b"".join(map(t.values.__getitem__, ids)) == data for t, ids in ((self.a, ids_a), (self.b, ids_b))):
                tokens.append((n, ids_a, ids_b))
            else:
                out[n].differs = True
        tokens = [t for t in tokens if not out[t[0]].differs]
        if not tokens:
            return
        ids_a, ids_b = (np.concatenate([np.array(t[k], np.int64) for t in tokens]) for k in (1, 2))
        ends_a, ends_b = np.cumsum(self.lengths[0][ids_a]), np.cumsum(self.lengths[1][ids_b])
        # A text's parts stand side by side: from here on they are one.
        texts, begins = np.unique([t[0] for t in tokens], return_index=True)
        upto_a, upto_b = (np.cumsum(np.add.reduceat([len(t[k]) for t in tokens], begins)) for k in (1, 2))
        group_a, group_b = groups_of(ends_a, ends_b)
        link_a, link_b = links_of(ends_a, ends_b)
        text_of = np.repeat(np.arange(len(texts)), np.diff(upto_a, prepend=0))[link_a]
        pairs, times = np.unique(text_of * (self.a.size * self.b.size) + ids_a[link_a] * self.b.size + ids_b[link_b], return_counts=True)
        text_of, pairs = np.divmod(pairs, self.a.size * self.b.size)
        cuts = np.searchsorted(text_of, np.arange(1, len(texts)))
        # Every id's sign: "," inside a list, "|" after a group's A tokens, ";" after the group.
        place_a, place_b = interleaved(group_a, group_b)
        shown = np.empty(len(ids_a) + len(ids_b), np.int64)
        shown[place_a] = ids_a + self.width * np.diff(group_a, append=-1).astype(bool)
        shown[place_b] = ids_b + 2 * self.width * np.diff(group_b, append=-1).astype(bool)
        shown = list(map(self.texts.__getitem__, shown.tolist()))
        a = b = 0
        for n, to_a, to_b, own, often in zip(texts, upto_a.tolist(), upto_b.tolist(), np.split(pairs, cuts), np.split(times, cuts)):
            groups = int(group_b[to_b - 1] - group_b[b]) + 1
            out[n].add(to_a - a, to_b - b, groups, own, often, "".join(shown[a + b : to_a + to_b]))
            a, b = to_a, to_b


class Aligned:
    """What is known of one text's alignment."""

    def __init__(self) -> None:
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.differs = False
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.digest = hashlib.sha256()

    def add(self, n_a: int, n_b: int, groups: int, pairs: np.ndarray, times: np.ndarray, text: str) -> None:
        if self.n_a:
            self.digest.update(b";")
        self.digest.update(text[:-1].encode())
        self.n_a, self.n_b, self.n_groups = self.n_a + n_a, self.n_b + n_b, self.n_groups + groups
        self.n_links += int(times.sum())
        self.pairs.append(pairs)
        self.times.append(times)
        if len(self.pairs) > 16:
            self._join()

    def _join(self) -> None:
        pairs, at = np.unique(np.concatenate(self.pairs), return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, at, np.concatenate(self.times))
        self.pairs, self.times = [pairs], [times]

    def row(self) -> tuple:
        if self.differs or not self.n_a:
            return 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int32)
        if len(self.pairs) > 1:
            self._join()
        return (
            self.n_a, self.n_b, self.n_groups, self.n_links, self.digest.hexdigest(),
            self.pairs[0], self.times[0].astype(np.int32),
        )


_WORKER: dict[str, object] = {}


def _once(key: str, make):
    """What ``make`` gives, kept in this Python worker under a key that is new for every call of the operator."""
    if key not in _WORKER:
        for old in [k for k in _WORKER if k.split(":")[0] == key.split(":")[0]]:
            del _WORKER[old]
        _WORKER[key] = make()
    return _WORKER[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def align_documents(
    docs: DataFrame, text_col: str = "text", model_a: str = MODEL_A, model_b: str = MODEL_B, carry: list[str] | None = None
) -> DataFrame:
    """``row`` (the input, or its ``carry`` columns), ``key`` (one a row), the numbers of tokens, groups and links,
    ``groups_sha256``, and the different ``pairs`` of linked ids (``a * size of B + b``) with their ``times``; stored."""
    shared = docs.sparkSession.sparkContext.broadcast((_read(model_a), _read(model_b)))
    frame = packed(docs, carry, key=F.monotonically_increasing_id(), text=F.col(f"`{text_col}`"))
    numbers = ", n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
    schema = T.StructType().add("row", frame.schema["row"].dataType)
    schema = T.StructType(schema.fields + T.StructType.fromDDL("key long" + numbers).fields)
    run_id = "aligner:" + uuid.uuid4().hex

    def run(rows: pa.Array, keys: pa.Array, texts: pa.Array):
        aligner = _once(run_id, lambda: Aligner(*shared.value))
        found = [x.row() for x in aligner.align(texts.to_pylist())]
        return rows, keys, *([row[k] for row in found] for k in range(7))

    return stored(map_rows(frame, run, schema, rows=128), "aligned")


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair``, ``n`` (the texts that hold it linked) and ``best`` (no pair of its A id has more); stored."""
    counts = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pairs")
    id_a = F.floor(F.col("pair") / size_b).cast("int")
    # One row for each id of A.
    most = F.broadcast(counts.groupBy(id_a.alias("id_a")).agg(F.max("n").alias("most")))
    marked = counts.withColumn("id_a", id_a).join(most, "id_a")
    return stored(marked.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def _frequent_from(counts: DataFrame, limit: int) -> int:
    """The least ``n`` such that at most ``limit`` pairs have as many, told by eighths of powers of two."""
    eighth = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(eighth.alias("e")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("least"))
    taken, least = 0, 2**62
    for r in sizes.orderBy(F.desc("e")).collect():  # at most 8 * 63 rows
        taken += r.pairs
        if taken > limit:
            break
        least = r.least
    return least


def align_tokenizers(
    docs: DataFrame,
    text_col: str = "text",
    model_a: str = MODEL_A,
    model_b: str = MODEL_B,
    carry: list[str] | None = None,
    frequent_pairs: int = FREQUENT_PAIRS,
) -> DataFrame:
    """``row`` (the input, or its ``carry`` columns), ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``
    and ``groups_sha256``."""
    aligned = align_documents(docs, text_col, model_a, model_b, carry)
    counts = pair_counts(aligned, PieceTokens(_read(model_b)).size)
    least = _frequent_from(counts, frequent_pairs)
    frequent = counts.filter(F.col("n") >= least).toArrow()  # at most ``frequent_pairs`` rows
    order = np.argsort(frequent["pair"].to_numpy())
    columns = tuple(frequent[c].to_numpy()[order] for c in ("pair", "n", "best"))
    shared = docs.sparkSession.sparkContext.broadcast(columns)
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    schema = T.StructType([aligned.schema["row"], *T.StructType.fromDDL(
        "key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "n_best long, count_sum long, rare array<struct<pair: long, times: int>>"
    ).fields])

    def run(rows, keys, n_a, n_b, n_groups, n_links, digests, pairs, times):
        known, n, best = shared.value
        offsets = pairs.offsets.to_numpy()
        flat = pairs.values.to_numpy()[offsets[0] : offsets[-1]]
        often = times.values.to_numpy()[times.offsets[0].as_py() : times.offsets[-1].as_py()].astype(np.int64)
        at = np.searchsorted(known, flat)
        at[at == len(known)] = 0
        found = known[at] == flat if len(known) else np.zeros(len(flat), bool)
        at = at[found]
        row_of = np.repeat(np.arange(len(rows)), np.diff(offsets))
        n_best, count_sum = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        np.add.at(count_sum, row_of[found], often[found] * n[at] if len(known) else often[:0])
        np.add.at(n_best, row_of[found], often[found] * best[at] if len(known) else often[:0])
        left = np.concatenate([[0], np.cumsum(np.bincount(row_of[~found], minlength=len(rows)))]).astype(np.int32)
        entries = pa.StructArray.from_arrays([pa.array(flat[~found]), pa.array(often[~found].astype(np.int32))], ["pair", "times"])
        return rows, keys, n_a, n_b, n_groups, n_links, digests, n_best, count_sum, pa.ListArray.from_arrays(pa.array(left), entries)

    looked_up = stored(map_rows(aligned, run, schema), "aligned")
    rare = looked_up.select("key", F.explode("rare").alias("link")).select("key", "link.pair", "link.times")
    rare = rare.join(counts.filter(F.col("n") < least), "pair").groupBy("key").agg(
        F.sum(F.col("times") * F.col("n")).alias("rare_sum"),
        F.sum(F.when(F.col("best"), F.col("times"))).alias("rare_best"),
    )
    zero = F.lit(0)
    return looked_up.join(rare, "key", "left").select(
        "row",
        *numbers,
        (F.col("n_best") + F.coalesce("rare_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", zero)).alias("count_sum"),
        "groups_sha256",
    )
