"""Line de-duplication over levelled sorted runs of line hashes.

``LineRuns`` holds the keys seen so far as sorted runs: tables bucketed and sorted by key hash. A new
batch is aggregated to one row per key and merge-anti-joined with each run; the keys that no run holds
become a run of level 0, the others go to a small log of repeats. ``fanout`` runs of one level are
compacted to one run of the next, so a key meets a number of runs that grows with the logarithm of the
number of batches. Runs and batches share their bucketing, so a merge shuffles neither.

Defined results: a null or empty text is one empty line; a line whose key is shorter than ``min_chars``
is never dropped; repeated rows and rows that share an id are one document; rows without an id are
returned whole and count nowhere; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import BLANKS, map_rows, packed, shuffle_partitions, stored, unpacked
from tidewell.session import shared_dir

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_KEY = ["h1", "h2"]


def line_key(line: str) -> str:
    """The line without outer blanks, A-Z in lower case."""
    line = line.strip(BLANKS)
    return line.lower() if line.isascii() else line.translate(_LOWER)


def _digest(key: str) -> bytes:
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass"))


def _hashes(min_chars: int):
    def run(ids: pa.Array, texts: pa.Array):
        docs, digests = [], []
        for doc, text in zip(ids.to_pylist(), texts.to_pylist()):
            if doc is None or not text:
                continue
            keys = {k for k in map(line_key, text.split("\n")) if len(k) >= min_chars}
            docs.extend([doc] * len(keys))
            digests.extend(map(_digest, keys))
        pair = np.frombuffer(b"".join(digests), ">i8").astype("int64").reshape(-1, 2)
        return docs, pair[:, 0], pair[:, 1]

    return run


def line_hashes(docs: DataFrame, min_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, h1, h2``: the 128-bit hash of each different key of a row."""
    source = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`"))
    return map_rows(source, _hashes(min_chars), "doc long, h1 long, h2 long")


class LineRuns:
    """Sorted runs of key hashes by level. A run's rows: ``h1, h2, n`` (documents) and ``last`` (largest id)."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.buckets = shuffle_partitions(spark)
        self.levels: dict[int, list[tuple[str, str]]] = {}
        self.repeats: list[DataFrame] = []

    def _write(self, rows: DataFrame, level: int) -> str:
        name, path = f"line_run_{uuid.uuid4().hex}", shared_dir(self.spark, f"line-run-{level}")
        rows.write.format("parquet").bucketBy(self.buckets, *_KEY).sortBy(*_KEY).option("path", path).saveAsTable(name)
        self.levels.setdefault(level, []).append((name, path))
        return name

    def _drop(self, run: tuple[str, str]) -> None:
        """Removes a run that compaction has rewritten."""
        name, path = run
        self.spark.sql(f"DROP TABLE {name}")
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def add(self, hashes: DataFrame) -> None:
        """One batch of ``doc, h1, h2``. A document must not be spread over batches."""
        batch = hashes.groupBy(*_KEY).agg(F.countDistinct("doc").alias("n"), F.max("doc").alias("last"))
        older = [run for level in sorted(self.levels, reverse=True) for run in self.levels[level]]
        if older:
            batch = stored(batch, "line-batch")
        fresh = batch
        for name, _ in older:
            fresh = fresh.join(self.spark.table(name).hint("merge"), _KEY, "left_anti")
        name = self._write(fresh, 0)
        if older:
            self.repeats.append(stored(batch.join(self.spark.table(name).hint("merge"), _KEY, "left_anti"), "line-repeats"))
        level = 0
        while len(self.levels.get(level, [])) >= self.fanout:
            level = self._compact(level)

    def _compact(self, level: int) -> int:
        """Merges the runs of a level; no key is in two runs, so this only re-sorts."""
        runs = self.levels[level]
        rows = self.spark.table(runs[0][0])
        for name, _ in runs[1:]:
            rows = rows.union(self.spark.table(name))
        self._write(rows.repartition(self.buckets, *_KEY), level + 1)
        self.levels[level] = []
        for run in runs:
            self._drop(run)
        return level + 1

    def keys(self) -> DataFrame:
        """Each key once, with the number of its documents and the largest id."""
        rows = self.repeats[:] + [self.spark.table(name) for runs in self.levels.values() for name, _ in runs]
        every = rows[0]
        for more in rows[1:]:
            every = every.union(more)
        return every.groupBy(*_KEY).agg(F.sum("n").alias("n"), F.max("last").alias("last"))


def _drop_lines(min_chars: int):
    def run(texts: pa.Array, drops: pa.Array):
        kept, n_lines, n_dropped = [], [], []
        for text, drop in zip(texts.to_pylist(), drops.to_pylist()):
            lines = (text or "").split("\n")
            n_lines.append(len(lines))
            if drop:
                gone = {np.array([d["h1"], d["h2"]], ">i8").tobytes() for d in drop}
                lines = [x for x in lines if len(k := line_key(x)) < min_chars or _digest(k) not in gone]
                text = "\n".join(lines)
            kept.append(text)
            n_dropped.append(n_lines[-1] - len(lines))
        return kept, n_lines, n_dropped

    return run


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
    fanout: int = 2,
) -> DataFrame:
    """Keys found in ``min_docs`` documents keep their lines in the document of the largest id only.

    The table is taken in ``batches`` ranges of ids, as if they had arrived one after the other. Returns
    ``row`` (the input), ``kept_text`` (null where the text is null), ``n_lines`` and ``n_dropped``.
    """
    spark = docs.sparkSession
    doc = F.col(f"`{id_col}`").cast("long")
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.select(doc.alias("doc")).approxQuantile("doc", shares, 0.01) if shares else []
    number: Column = F.lit(0)
    for cut in cuts:
        number = number + F.when(F.col("doc") > cut, 1).otherwise(0)
    lines = stored(line_hashes(docs, min_chars, id_col, text_col).withColumn("batch", number), "line-hashes", "batch")
    runs = LineRuns(spark, fanout)
    for batch in range(batches):
        runs.add(lines.filter(F.col("batch") == batch).drop("batch"))
    # Stored first: read back, the lines of a hot key can be split over tasks when they meet it.
    common = stored(runs.keys().filter(F.col("n") >= min_docs).select(*_KEY, "last"), "common-lines")
    drops = (
        lines.join(common, _KEY)
        .filter(F.col("doc") < F.col("last"))
        .groupBy("doc")
        .agg(F.collect_set(F.struct("h1", "h2")).alias("drops"))
    )
    joined = packed(docs, _doc=doc).join(drops, F.col("_doc") == F.col("doc"), "left")
    row = joined.schema["row"].dataType
    text = joined.select(F.col("row"), F.col(f"row.`{text_col}`").alias("t"), F.col("drops"))
    return _apply(text, row, min_chars)


def _apply(joined: DataFrame, row, min_chars: int) -> DataFrame:
    from pyspark.sql import types as T

    fn = _drop_lines(min_chars)
    schema = T.StructType().add("row", row).add("kept_text", "string").add("n_lines", "long").add("n_dropped", "long")

    def run(rows: pa.Array, texts: pa.Array, drops: pa.Array):
        return rows, *fn(texts, drops)

    return map_rows(joined, run, schema)


def keep_documents(result: DataFrame, text_col: str = "text", **more: Column) -> DataFrame:
    """The input's columns with the kept text in place of the text."""
    return unpacked(result, **{text_col: F.col("kept_text")}, **more)
