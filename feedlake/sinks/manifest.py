"""Publishing all tables of a day at once.

A run writes its tables into a folder beside the target. One rename then makes a
small manifest the day's newest, and with it all of them valid: until then the
former version of the day is whole, from then on the new one. Moving the files
into the published folders comes after and can be repeated: whoever opens the
day next finishes it, should the run have died.

The manifest says which input file gave which data files. A file that comes
again replaces its own rows; those of other files stay, also when these have
long left the landing folder.

Only one run at a time may write a day: it holds a lease, a file that it alone
could create. Leases are numbered. One that was held too long can be taken over,
and the number keeps the former holder from committing later.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Collection
from dataclasses import asdict, dataclass, field
from hashlib import sha256
from threading import Lock
from types import TracebackType

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlake.sinks.files import Files
from feedlake.sinks.snapshot import require_int96, table_path, zoned

#: Seconds after which a lease counts as left behind.
STALE_SECONDS = 6 * 3600.0
#: Versions of a day whose manifests stay.
KEPT_VERSIONS = 3
_TAG = 16


class DayBusy(RuntimeError):
    """Another run writes this day."""


class LeaseLost(RuntimeError):
    """Another run has taken over the day; nothing was published."""


class UnknownLineage(RuntimeError):
    """The day has published files that no manifest knows, so it is not known whose rows they hold."""


@dataclass(frozen=True)
class Entry:
    """The data files with the rows of one input file in one table; ``source`` is empty where no input file is known."""

    feed: str
    recordtype: str
    source: str
    rows: int
    files: tuple[str, ...]


@dataclass(frozen=True)
class Manifest:
    """A version of a day: its entries, the run that made it, and paths (below the target) that it made obsolete."""

    version: int = 0
    run: str = ""
    entries: tuple[Entry, ...] = ()
    gone: tuple[str, ...] = ()

    def rows(self, feed: str, recordtype: str) -> int:
        return sum(e.rows for e in self.entries if (e.feed, e.recordtype) == (feed, recordtype))

    @classmethod
    def parse(cls, text: str) -> Manifest:
        told = json.loads(text)
        entries = tuple(Entry(**{**e, "files": tuple(e["files"])}) for e in told["entries"])
        return cls(told["version"], told["run"], entries, tuple(told["gone"]))

    def text(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False)


def _day(syncday: str) -> str:
    return f"{syncday[:4]}-{syncday[4:6]}-{syncday[6:]}"


def read_manifest(spark: SparkSession, target: str, syncday: str) -> Manifest:
    """The newest manifest of a day; an empty one if there is none."""
    return _newest(Files(spark), _control(target, syncday))


def _control(target: str, syncday: str) -> str:
    return f"{target.rstrip('/')}.manifest/{_day(syncday)}"


def _newest(files: Files, control: str) -> Manifest:
    versions = [f.name for f in files.listing(control) if f.name.startswith("manifest-")]
    return Manifest.parse(files.read(f"{control}/{versions[-1]}")) if versions else Manifest()


@dataclass
class Lease:
    """The right to write a day, held while inside ``with``."""

    files: Files
    control: str
    stale_after: float = STALE_SECONDS
    number: int = 0

    def _others(self) -> list[tuple[int, float]]:
        found = [f for f in self.files.listing(self.control) if f.name.startswith("lease-")]
        return [(int(f.name[6:]), f.modified) for f in found]

    def take(self, run: str) -> None:
        held = self._others()
        fresh = [n for n, modified in held if modified + self.stale_after > time.time()]
        if fresh:
            raise DayBusy(f"{self.control} is being written (lease {max(fresh)})")
        used = [n for n, _ in held] + [_newest(self.files, self.control).version]
        self.number = max(used) + 1
        try:
            self.files.create(f"{self.control}/lease-{self.number:08d}", run)
        except FileExistsError as error:
            raise DayBusy(f"{self.control} is being written (lease {self.number})") from error

    def check(self) -> None:
        """Fails if another run has taken over, or somebody has removed the lease."""
        if max((n for n, _ in self._others()), default=0) != self.number:
            raise LeaseLost(f"{self.control}: lease {self.number} was taken over")

    def release(self) -> None:
        """Of all leases up to this one nothing is left; a later one stays."""
        for n, _ in self._others():
            if n <= self.number:
                self.files.delete(f"{self.control}/lease-{n:08d}")


@dataclass
class Publication:
    """One run's new version of a day; use it in a ``with`` block, which holds the lease.

    ``stage`` writes tables beside the target, ``commit`` makes them valid. If the
    block ends without a commit, the former version of the day stays as it was.
    """

    spark: SparkSession
    target: str
    syncday: str
    run: str
    stale_after: float = STALE_SECONDS
    replace_unmanaged: bool = False
    staged: list[Entry] = field(default_factory=list)
    committed: Manifest | None = None

    def __post_init__(self):
        self.target = self.target.rstrip("/")
        self._files = Files(self.spark)
        self._control = _control(self.target, self.syncday)
        self._stages = f"{self.target}.staged/{_day(self.syncday)}"
        self._lock = Lock()
        self._lease = Lease(self._files, self._control, self.stale_after)

    def __enter__(self) -> Publication:
        self._lease.take(self.run)
        try:
            self.former = _newest(self._files, self._control)
            if self._files.exists(f"{self._stages}/{self.former.run}") and self.former.run:
                self._apply(self.former)
            for left in self._files.listing(self._stages):
                self._files.delete(f"{self._stages}/{left.name}")  # of runs that died
        except BaseException:
            self._lease.release()
            raise
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, trace: TracebackType | None) -> None:
        if self.committed is None:
            self._files.delete(f"{self._stages}/{self.run}")
        self._lease.release()

    # --- writing -----------------------------------------------------------------------------

    def stage(
        self, df: DataFrame, feed: str, recordtype: str, source: str | None = None, sources: Collection[str] = ()
    ) -> dict[str, int]:
        """Write the sync day's rows of a table; rows of other days are held back.

        ``source`` names a column with the input file of each row, one of
        ``sources``; it is not written. Returns the numbers of rows
        ``published`` and ``held_back``, counted while writing.
        """
        require_int96(self.spark)
        due = F.to_date("snap_dt") == F.to_date(F.lit(self.syncday), "yyyyMMdd")
        seen = Observation()
        counted = df.observe(
            seen,
            F.count_if(due).alias("published"),
            F.count_if(~F.coalesce(due, F.lit(False))).alias("held_back"),
        )
        path = table_path(f"{self._stages}/{self.run}", recordtype, feed)
        tag = F.substring(F.sha2(F.col(source) if source else F.lit(""), 256), 1, _TAG)
        rows = counted.where(due).withColumn("_tag", tag)
        zoned(rows.select(*(c for c in df.columns if c != source), "_tag")).write.partitionBy("_tag").parquet(path)
        names = {_tag(s): s for s in (*sources, "")}
        found = [f.name.removeprefix("_tag=") for f in self._files.listing(path) if f.folder]
        if found:
            # a count by folder reads no column
            back = self.spark.read.schema("_tag string").parquet(path).groupBy("_tag").count()
            counts = {row["_tag"]: row["count"] for row in back.collect()}
            entries = []
            for tag in found:
                parts = [f.name for f in self._files.listing(f"{path}/_tag={tag}") if f.name.startswith("part-")]
                files = tuple(f"{tag}-{part}" for part in parts)
                entries.append(Entry(feed, recordtype, names[tag], counts.get(tag, 0), files))
            with self._lock:
                self.staged += entries
        return seen.get

    def commit(self, sources: Collection[str] = (), tables: Collection[tuple[str, str]] = ()) -> Manifest:
        """Make all that was staged valid, in place of what the day had of these input files, or of these tables whole.

        ``tables`` are pairs of feed and record type. An input file of which
        nothing was staged loses the rows it had.
        """
        sources, tables = set(sources), set(tables)
        kept, gone = [], []
        for entry in self.former.entries:
            if entry.source in sources or (entry.feed, entry.recordtype) in tables:
                gone += [f"{self._folder(entry)}/{name}" for name in entry.files]
            else:
                kept.append(entry)
        gone += self._unmanaged(tables)
        made = Manifest(self._lease.number, self.run, (*kept, *self.staged), tuple(gone))
        fresh = f"{self._control}/_{self.run}"
        self._files.create(fresh, made.text())
        self._lease.check()
        self._files.rename(fresh, f"{self._control}/manifest-{made.version:08d}.json")
        self.committed = made
        self._apply(made)
        return made

    def _unmanaged(self, tables: set[tuple[str, str]]) -> list[str]:
        """Published files of the staged tables that no manifest has; they may go only with their whole table."""
        known = {f"{self._folder(e)}/{name}" for e in self.former.entries for name in e.files}
        found = []
        for feed, recordtype in {(e.feed, e.recordtype) for e in self.staged} | tables:
            folder = self._folder(Entry(feed, recordtype, "", 0, ()))
            parts = [f"{folder}/{f.name}" for f in self._files.listing(f"{self.target}/{folder}") if f.name.endswith(".parquet")]
            strange = [part for part in parts if part not in known]
            if strange and (feed, recordtype) not in tables and not self.replace_unmanaged:
                raise UnknownLineage(f"{self.target}/{folder} has {len(strange)} files of unknown input, such as {strange[0]}")
            found += strange
        return found

    def _folder(self, entry: Entry) -> str:
        return f"{entry.recordtype}/{entry.feed}/snap_day={_day(self.syncday)}"

    def _apply(self, made: Manifest) -> None:
        """Move the files of a version to where readers look, and remove those it made obsolete; may be repeated."""
        stage = f"{self._stages}/{made.run}"
        for entry in made.entries:
            staged = f"{table_path(stage, entry.recordtype, entry.feed)}/_tag={entry.files[0][:_TAG]}" if entry.files else ""
            waiting = {f.name for f in self._files.listing(staged)} if staged else set()
            for name in entry.files:
                if name[_TAG + 1 :] in waiting:
                    self._files.make_folder(f"{self.target}/{self._folder(entry)}")
                    self._files.rename(f"{staged}/{name[_TAG + 1 :]}", f"{self.target}/{self._folder(entry)}/{name}")
        for path in made.gone:
            self._files.delete(f"{self.target}/{path}")
        for folder in {path.rpartition("/")[0] for path in made.gone}:
            if not [f for f in self._files.listing(f"{self.target}/{folder}") if not f.name.startswith((".", "_"))]:
                self._files.delete(f"{self.target}/{folder}")
        versions = [f.name for f in self._files.listing(self._control) if f.name.startswith("manifest-")]
        for name in versions[:-KEPT_VERSIONS]:
            self._files.delete(f"{self._control}/{name}")
        self._files.delete(stage)


def _tag(source: str) -> str:
    return sha256(source.encode()).hexdigest()[:_TAG]


def publish(df: DataFrame, base: str, syncday: str, feed: str, recordtype: str) -> dict[str, int]:
    """Publish the sync day's rows under ``<base>/<recordtype>/<feed>``.

    That day of the table is replaced, once all its rows are written; other days
    and tables stay. Rows of other days are held back. Returns the numbers of
    rows ``published`` and ``held_back``.
    """
    with Publication(df.sparkSession, base, syncday, uuid.uuid4().hex) as publication:
        counts = publication.stage(df, feed, recordtype)
        publication.commit(tables=[(feed, recordtype)])
    return counts
