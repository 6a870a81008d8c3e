"""The user dictionary: load once, or reload when older than a time to live."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwise.operators.sizing import Size, measure
from logwise.operators.words import dictionary_words
from logwise.session import checkpoint_root
from logwise.settings import DICTIONARY_TTL_MS
from logwise.sources.storage import is_folder

log = logging.getLogger(__name__)

DEFAULT_TTL_MS = DICTIONARY_TTL_MS
# Version name of the dictionary that stands in for one that failed to load.
EMPTY = "empty"


def load_words(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    jdbc_url: str | None = None,
    table: str = "user_words",
    properties: dict[str, str] | None = None,
    frame: DataFrame | None = None,
    column: str = "word",
) -> DataFrame:
    """Distinct words from a file table, a JDBC table or a given frame."""
    if frame is not None:
        src = frame
    elif path is not None:
        src = spark.read.format(fmt).load(path)
    elif jdbc_url is not None:
        src = spark.read.jdbc(jdbc_url, table, properties=properties or {})
    else:
        raise ValueError("give path, jdbc_url or frame")
    return dictionary_words(src, column)


def store_buckets(words: DataFrame, path: str, table: str, buckets: int, column: str = "word") -> DataFrame:
    """Write the distinct words below ``path`` in ``buckets`` by the word, as
    table ``table`` of the session's catalog, and read it.

    For dictionaries too large to broadcast: a join on the word that has as
    many partitions as there are buckets reads each bucket where it is needed,
    without a shuffle or sort of the dictionary, in every batch
    (:func:`logwise.operators.words.bucketed_word_counts`).
    """
    spark = words.sparkSession
    rows = dictionary_words(words, column).repartition(buckets, "word")  # one file a bucket
    writer = rows.write.format("parquet").option("path", path).bucketBy(buckets, "word").sortBy("word")
    writer.mode("overwrite").saveAsTable(table)
    return spark.table(table)


def open_buckets(spark: SparkSession, path: str, table: str, buckets: int) -> DataFrame:
    """A dictionary stored by :func:`store_buckets`, in a session whose catalog
    does not know it yet; ``buckets`` as it was written."""
    if not spark.catalog.tableExists(table):
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"create table {table} (word string) using parquet clustered by (word) sorted by (word) "
            f"into {int(buckets)} buckets location '{place}'"
        )
    return spark.table(table)


def _now_ms() -> int:
    return int(time.time() * 1000)


@dataclass
class Snapshot:
    """One loaded version of the dictionary."""

    words: DataFrame
    size: Size
    version: str
    _list: list[str] | None = field(default=None, repr=False)

    def word_list(self, max_rows: int, max_bytes: int) -> list[str] | None:
        """The words as a sorted Python list (collected once), or None when the
        snapshot is over the given bounds."""
        if not self.size.fits(max_rows, max_bytes):
            return None
        if self._list is None:
            self._list = sorted(r["word"] for r in self.words.collect())
        return self._list


class RefreshingDictionary:
    """Holds a snapshot of the dictionary and its load time.

    ``current()`` reloads when ``now - loaded_at > ttl_ms`` (strictly greater).
    A load is checkpointed to the shared checkpoint folder, so every batch that
    uses one snapshot sees the same words even if the source changes or an
    executor is lost, and its size is measured once for the broadcast check.
    Superseded snapshots are removed by Spark's checkpoint cleaner when
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on (a default of
    :func:`logwise.session.build_session`).

    With ``store_path`` (a folder in shared storage) every snapshot is written
    there as a table instead, and :meth:`for_batch` pins the snapshot each
    micro-batch used. A batch replayed after a restart, even by a new driver
    whose dictionary has been reloaded, reads its pinned snapshot and so
    produces the same counts again.

    ``on_error``: ``'keep'`` keeps the previous snapshot when a reload fails
    (the first load still raises); ``'empty'`` falls back to an empty
    dictionary; ``'raise'`` propagates.
    """

    def __init__(
        self,
        spark: SparkSession,
        loader: Callable[[], DataFrame],
        ttl_ms: int = DEFAULT_TTL_MS,
        clock: Callable[[], int] = _now_ms,
        on_error: str = "keep",
        store_path: str | None = None,
    ) -> None:
        if on_error not in ("keep", "empty", "raise"):
            raise ValueError(f"unknown on_error {on_error!r}")
        self._spark = spark
        self._loader = loader
        self.ttl_ms = ttl_ms
        self._clock = clock
        self.on_error = on_error
        self.store_path = store_path.rstrip("/") if store_path else None
        self.loaded_at: int | None = None
        self.loads = 0
        self._snap: Snapshot | None = None

    # -- snapshots -----------------------------------------------------------

    def _read_version(self, version: str) -> Snapshot:
        if version == EMPTY:
            return self._empty()
        words = self._spark.read.schema("word string").parquet(f"{self.store_path}/snapshots/version={version}")
        return Snapshot(words, measure(words), version)

    def _load(self) -> Snapshot:
        t0 = time.perf_counter()
        version = uuid.uuid4().hex
        if self.store_path:
            self._loader().select("word").write.parquet(f"{self.store_path}/snapshots/version={version}")
            snap = self._read_version(version)
        else:
            checkpoint_root(self._spark)
            words = self._loader().select("word").checkpoint(eager=True)
            snap = Snapshot(words, measure(words), version)
        log.info(
            "dictionary loaded: %d words, %d bytes, %.0f ms",
            snap.size.rows, snap.size.bytes, (time.perf_counter() - t0) * 1000,
        )
        return snap

    def _empty(self) -> Snapshot:
        return Snapshot(self._spark.createDataFrame([], "word string"), Size(0, 0), EMPTY)

    def refresh(self) -> DataFrame:
        now = self._clock()
        try:
            snap = self._load()
        except Exception:
            if self.on_error == "raise" or (self.on_error == "keep" and self._snap is None):
                raise
            log.exception("dictionary reload failed; on_error=%s", self.on_error)
            snap = self._empty() if self.on_error == "empty" else self._snap
        self._snap, self.loaded_at = snap, now
        self.loads += 1
        return snap.words

    def current_snapshot(self) -> Snapshot:
        if self._snap is None or self._clock() - self.loaded_at > self.ttl_ms:
            self.refresh()
        return self._snap

    def current(self) -> DataFrame:
        return self.current_snapshot().words

    @property
    def size(self) -> Size | None:
        return None if self._snap is None else self._snap.size

    def word_list(self, max_rows: int, max_bytes: int) -> list[str] | None:
        """The current words as a sorted Python list, collected once per
        snapshot, or None when the snapshot is over the given bounds."""
        return self.current_snapshot().word_list(max_rows, max_bytes)

    def for_batch(self, batch_id: int) -> Snapshot:
        """The snapshot micro-batch ``batch_id`` uses.

        With a ``store_path``, a driver that starts over (a restart) first
        resumes the latest snapshot pinned at or before this batch, keeping
        its load time, so a replayed batch sees the words it saw before.
        A reload is pinned once, as (version, first batch, load time): one
        small write per time to live, none per batch.
        """
        if not self.store_path:
            return self.current_snapshot()
        if self._snap is None:
            self._resume(batch_id)
        before = self._snap
        snap = self.current_snapshot()
        if snap is not before:
            self._spark.createDataFrame(
                [(snap.version, self.loaded_at)], "version string, loaded_at long"
            ).coalesce(1).write.mode("overwrite").parquet(f"{self.store_path}/pins/first_batch={batch_id}")
        return snap

    def _resume(self, batch_id: int) -> None:
        try:
            pins = self._spark.read.schema("version string, loaded_at long, first_batch long").parquet(
                f"{self.store_path}/pins"
            )
            row = pins.where(pins.first_batch <= batch_id).orderBy(pins.first_batch.desc()).first()
        except AnalysisException:  # nothing pinned yet
            row = None
        if row is not None:
            self._snap, self.loaded_at = self._read_version(row["version"]), row["loaded_at"]


def stored_versions(spark: SparkSession, store_path: str, start: str = "first_batch") -> tuple[DataFrame, DataFrame]:
    """(versions, words) of a dictionary's ``store_path``, for
    :func:`logwise.operators.versions.version_intervals`.

    ``start`` says from when a version is valid: ``first_batch``, the first
    micro-batch that used it, or ``loaded_at``, its load time in epoch
    milliseconds. So a stream's counts can be checked or made again later with
    the words each batch saw. No rows if nothing has been pinned yet.
    """
    if start not in ("first_batch", "loaded_at"):
        raise ValueError(f"unknown start {start!r}")
    root = store_path.rstrip("/")
    if not is_folder(spark, f"{root}/pins"):
        return spark.createDataFrame([], "valid_from bigint"), spark.createDataFrame([], "valid_from bigint, word string")
    pins = spark.read.schema("version string, loaded_at long, first_batch long").parquet(f"{root}/pins")
    pins = pins.select("version", F.col(start).alias("valid_from"))
    versions = pins.select("valid_from").distinct()
    if not is_folder(spark, f"{root}/snapshots"):
        return versions, spark.createDataFrame([], "valid_from bigint, word string")
    words = spark.read.schema("word string, version string").parquet(f"{root}/snapshots")
    # one row per reload
    return versions, words.join(F.broadcast(pins), "version").select("valid_from", "word")
