"""What a warehouse table consists of: numbered manifests, each committed by creating the next number.

A manifest lists the live segments of a table. A segment is a folder of rows that never changes; a load
adds one, and a merge replaces several by one. Whoever commits has read manifest ``n`` and creates
``n + 1``; if somebody else has created it meanwhile, nothing happened, and the writer looks at the new manifest before
it tries again. So two writers never both commit on the same view of a table.

A manifest also carries the run rows of the load that made it. Should its writer die before they are in the ledger, the next
writer puts them there before it commits anything (``settle``), so ledger and table agree.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidewell.operators import ledger
from tidewell.sources import files


@dataclass(frozen=True)
class Segment:
    """``buckets`` is 0 where the rows aren't bucketed by key; ``sources`` holds the landed files that went in.

    With an ``index`` the buckets hold the keys alone, in a folder of their own, and the rows lie as they were read."""

    folder: str
    rows: int
    buckets: int = 0
    sources: str | None = None
    index: bool = False


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    segments: tuple[Segment, ...] = ()
    load: dict | None = field(default=None, compare=False)

    def folders(self) -> set[str]:
        return {s.folder for s in self.segments}


def manifests_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/control/commits/{table}"


def _file(root: str, table: str, number: int) -> str:
    return f"{manifests_path(root, table)}/{number:012d}"


def read_manifest(spark: SparkSession, root: str, table: str) -> Manifest:
    """The newest manifest; an empty one before the first commit."""
    there = [int(n) for n in files.names(spark, manifests_path(root, table)) if n.isdigit()]
    if not there:
        return Manifest()
    number = max(there)
    content = json.loads(files.read_text(spark, _file(root, table, number)))
    return Manifest(number, tuple(Segment(**s) for s in content["segments"]), content["load"])


def commit(
    spark: SparkSession, root: str, table: str, seen: Manifest, segments: list[Segment], load: dict | None = None
) -> Manifest | None:
    """The manifest after ``seen``, or ``None`` where somebody else has made it."""
    made = Manifest(seen.number + 1, tuple(segments), load)
    text = json.dumps({"segments": [asdict(s) for s in segments], "load": load}, indent=1)
    return made if files.put_if_absent(spark, _file(root, table, made.number), text) else None


def settle(spark: SparkSession, ledger_path: str, manifest: Manifest) -> None:
    """Put the run rows of the manifest's load into the ledger where they are not there yet."""
    if manifest.load is None:
        return
    done = ledger.successes(ledger.read_runs(spark, ledger_path)).filter(F.col("load_id") == manifest.load["load_id"])
    if done.isEmpty():
        ledger.mark_success(spark, ledger_path, **manifest.load)
