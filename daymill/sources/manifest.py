"""Layers that change all at once: staged batches, and a manifest that says which folders count.

A promotion writes its rows to a folder of its own, where no reader looks. Then one new manifest,
written beside the old ones and renamed into place, names a folder per period: those just written, and
the old ones of all other periods. Until the rename readers see the old layer, after it the new one;
a promotion that dies before leaves nothing but a folder that ``sweep`` removes. Old batches stay for
readers that began before.

    <layer>/_manifests/000000007.json     {"2022-10": "batch=3f…/period=2022-10", …}
    <layer>/batch=3f…/period=2022-10/part-….parquet
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.sources.scans import PERIOD_COLUMN

BATCH_COLUMN = "batch"
_MANIFESTS = "_manifests"


class _Folder:
    """The few file operations needed, on whatever file system a path is of."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.files = self._path("").getFileSystem(conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def names(self, name: str = "") -> list[str]:
        path = self._path(name)
        if not self.files.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self.files.listStatus(path))

    def read(self, name: str) -> str:
        stream = self.files.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.files.create(self._path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, name: str, to: str) -> None:
        if self.files.exists(self._path(to)) or not self.files.rename(self._path(name), self._path(to)):
            raise RuntimeError(f"another promotion into {self.root} came first; promote again")

    def remove(self, name: str) -> None:
        self.files.delete(self._path(name), True)


def _numbers(folder: _Folder) -> list[int]:
    names = (name.removesuffix(".json") for name in folder.names(_MANIFESTS) if name.endswith(".json"))
    return sorted(int(name) for name in names if name.isdigit())


def _load(folder: _Folder, number: int) -> dict[str, str]:
    return json.loads(folder.read(f"{_MANIFESTS}/{number:09d}.json"))


def current(spark: SparkSession, path: str) -> dict[str, str]:
    """Period → folder below ``path``, as the newest manifest has it; empty if there is none."""
    folder = _Folder(spark, path)
    numbers = _numbers(folder)
    return _load(folder, numbers[-1]) if numbers else {}


def _publish(folder: _Folder, number: int, periods: Mapping[str, str]) -> None:
    draft = f"{_MANIFESTS}/draft-{uuid.uuid4().hex}"
    folder.write(draft, json.dumps(periods, indent=1, sort_keys=True))
    folder.rename(draft, f"{_MANIFESTS}/{number:09d}.json")


def promote_at_once(
    df: DataFrame,
    raw_root: str,
    source: str,
    rebalance: bool = False,
    periods: Sequence[str] = (),
    within: Sequence[str] = (),
) -> str:
    """Replace the periods of a source that ``df`` has rows of, and empty those of ``periods`` it has none of.

    ``df`` runs once. Other periods stay. All changes show at the same moment or not at all; of two promotions
    at the same time one fails and can be repeated. ``rebalance`` gathers rows in mixed
    order by period first; ``within`` names further columns to have folders by.
    """
    spark, path = df.sparkSession, f"{raw_root.rstrip('/')}/{source}"
    folder = _Folder(spark, path)
    last = max(_numbers(folder), default=0)
    before = _load(folder, last) if last else {}
    batch = f"{BATCH_COLUMN}={uuid.uuid4().hex}"
    rows = df.hint("rebalance", F.col(PERIOD_COLUMN)) if rebalance else df
    rows.write.partitionBy(PERIOD_COLUMN, *within).parquet(f"{path}/{batch}")
    prefix = f"{PERIOD_COLUMN}="
    written = {name.removeprefix(prefix): f"{batch}/{name}" for name in folder.names(batch) if name.startswith(prefix)}
    kept = {period: at for period, at in before.items() if period not in periods}
    _publish(folder, last + 1, kept | written)
    return path


def read_promoted(spark: SparkSession, path: str, types: Mapping[str, str], periods: Sequence[str] | None = None) -> DataFrame:
    """The rows of a layer's current folders, without the period; of ``periods`` only, if given.

    Types are declared, so no footer is read for them. A layer without manifest or such periods has no rows.
    """
    columns = {name: kind for name, kind in types.items() if name != PERIOD_COLUMN}
    listed = current(spark, path)
    chosen = [at for period, at in sorted(listed.items()) if periods is None or period in set(periods)]
    schema = ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
    if not chosen:
        return spark.createDataFrame([], schema)
    table = spark.read.schema(f"{schema}, {PERIOD_COLUMN} string, {BATCH_COLUMN} string").option("basePath", path)
    rows = table.parquet(*(f"{path}/{at}" for at in chosen))
    if periods is not None:
        rows = rows.filter(F.col(PERIOD_COLUMN).isin(list(periods)))
    return rows.drop(PERIOD_COLUMN, BATCH_COLUMN)


def sweep(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove batches that none of the newest ``keep`` manifests names, and older manifests; which batches went.

    Not while a promotion is under way: its batch is not named yet.
    """
    folder = _Folder(spark, path)
    numbers = _numbers(folder)
    named = {at.split("/")[0] for number in numbers[-keep:] for at in _load(folder, number).values()}
    for number in numbers[:-keep]:
        folder.remove(f"{_MANIFESTS}/{number:09d}.json")
    gone = [name for name in folder.names() if name.startswith(f"{BATCH_COLUMN}=") and name not in named]
    for name in gone:
        folder.remove(name)
    return gone
