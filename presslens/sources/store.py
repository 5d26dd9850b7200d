"""An archive of days whose state changes at once.

Days are staged as Parquet folders of a new generation, which no reader looks at. A manifest names, for each day, the generation that
holds it, its number of rows and a digest of them, and which days are still to be published; it is one small file with a
number, put in place by a rename that fails if the number is taken. Readers follow the manifest with the highest number, so they
see a change whole or not at all, and a write that dies leaves only folders that ``vacuum`` removes. Two writers that
start from the same manifest cannot both commit.

What is kept on the driver is the manifest: a few fields a day, whatever the number of rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.operators.merge import day_digest, merge
from presslens.sources import archive, manifest
from presslens.sources.files import delete, exists

GENERATION = "generation"
#: The name of the folder of rows without a day, as Spark's writers have it.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class State:
    """A manifest. ``days``: day (``NO_DAY`` for none) to generation, rows, digest; ``done``: the last batch of each stream."""

    number: int = 0
    days: dict[str, dict] = field(default_factory=dict)
    pending: tuple[str, ...] = ()
    done: dict[str, int] = field(default_factory=dict)


class Conflict(RuntimeError):
    """Another writer committed meanwhile."""


class DayStore:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str = archive.ARCHIVE, day: str = "day", link: str = "lien"):
        self.spark, self.path, self.day, self.link = spark, path.rstrip("/"), day, link
        kept = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.schema = T.StructType([*[f for f in kept.fields if f.name != day], T.StructField(day, T.DateType())])

    # Manifests

    def _log(self):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/log")
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def state(self) -> State:
        store, folder = self._log()
        if not store.exists(folder):
            return State()
        names = [s.getPath().getName() for s in store.listStatus(folder)]
        numbers = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
        if not numbers:
            return State()
        held = self.spark.read.text(f"{self.path}/log/{max(numbers):012d}.json", wholetext=True).first()[0]
        said = json.loads(held)
        return State(max(numbers), said["days"], tuple(said["pending"]), said["done"])

    def commit(self, state: State) -> State:
        """Put ``state`` in place as the manifest after its own number."""
        made = replace(state, number=state.number + 1)
        store, folder = self._log()
        jvm = self.spark._jvm
        said = json.dumps({"days": made.days, "pending": sorted(set(made.pending)), "done": made.done}, sort_keys=True)
        draft = jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}")
        out = store.create(draft)
        out.write(bytearray(said.encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(store.makeQualified(draft), store.makeQualified(jvm.org.apache.hadoop.fs.Path(folder, f"{made.number:012d}.json")), options)
        except Exception as e:
            store.delete(draft, False)
            raise Conflict(f"manifest {made.number} is there already") from e
        return made

    # Reading

    def read(self, start: str | None = None, end: str | None = None, state: State | None = None, days: set[str] | None = None) -> DataFrame:
        """The rows of the days asked for, as of one manifest; only their folders are listed and read."""
        state = state or self.state()
        chosen = [d for d in state.days if (days is None or d in days) and (d == NO_DAY and not start and not end or d != NO_DAY and (not start or d >= start) and (not end or d <= end))]
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        paths = [self.folder(d, state.days[d][GENERATION]) for d in sorted(chosen)]
        held = T.StructType([*self.schema.fields, T.StructField(GENERATION, T.StringType())])
        return self.spark.read.schema(held).option("basePath", f"{self.path}/data").parquet(*paths).select(*[F.col(f"`{f.name}`") for f in self.schema.fields])

    def folder(self, day: str, generation: str) -> str:
        return f"{self.path}/data/{GENERATION}={generation}/{self.day}={day}"

    # Writing

    def stage(self, rows: DataFrame, order: list | None = None) -> dict[str, dict]:
        """Write rows as a generation that no manifest names yet; what a manifest would say of its days.

        The digests are of what was written, so the plan of ``rows`` runs once.
        """
        generation = uuid.uuid4().hex
        path = f"{self.path}/data/{GENERATION}={generation}"
        archive.write_days(rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields]), path, self.day, order)
        found = day_digest(self.spark.read.schema(self.schema).parquet(path), self.day).collect()  # a few fields a day
        return {NO_DAY if r[self.day] is None else r[self.day].isoformat(): {GENERATION: generation, "rows": r["n"], "digest": f"{r['x']}:{r['s']}"} for r in found}

    def replace_with(self, rows: DataFrame, order: list | None = None) -> dict[str, bool]:
        """Make the archive hold ``rows``: days that differ are taken over, days without rows any more go. Those days, and whether they were emptied."""
        state = self.state()
        return self._take(state, self.stage(rows, order), set(state.days))

    def add(self, rows: DataFrame, order: list | None = None, stream: str | None = None, batch: int = 0) -> dict[str, bool]:
        """Add rows to their days, whatever their age; a row whose link one of these days has is not added again.

        ``order`` (upwards, plain columns) decides between rows of one link, those already stored before new ones. With the name of a stream
        a batch counts once: what was committed is not done again.
        """
        state = self.state()
        if stream is not None and state.done.get(stream, -1) >= batch:
            return {}
        done = state.done | ({stream: batch} if stream is not None else {})
        found = rows.select(F.coalesce(F.col(self.day).cast("string"), F.lit(NO_DAY)).alias("d")).distinct().collect()  # the days of the new rows
        if not found:
            self.commit(replace(state, done=done))
            return {}
        days = {r["d"] for r in found}
        order = order or [F.col("time_stamp"), F.col("titre")]
        merged = merge(self.read(state=state, days=days), rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields]), self.link, order)
        inside = None if "time_stamp" in self.schema.names else [F.desc_nulls_last(self.link)]
        return self._take(replace(state, done=done), self.stage(merged, inside), set())

    def _take(self, state: State, staged: dict[str, dict], over: set[str]) -> dict[str, bool]:
        """Commit the staged days that differ; days of ``over`` that were not staged are emptied."""
        changed = {d: s for d, s in staged.items() if any(state.days.get(d, {}).get(k) != s[k] for k in ("rows", "digest"))}
        emptied = over - set(staged)
        days = {d: s for d, s in (state.days | changed).items() if d not in emptied}
        if changed or emptied or state.done != self.state().done:
            self.commit(replace(state, days=days, pending=(*state.pending, *changed, *emptied)))
        for day in set(staged) - set(changed):
            delete(self.spark, self.folder(day, staged[day][GENERATION]))
        return {**dict.fromkeys(changed, False), **dict.fromkeys(emptied, True)}

    # Publishing

    def pending(self) -> DataFrame:
        """release and file of the days that changed since they were published."""
        days = [(None if d == NO_DAY else d,) for d in self.state().pending]
        return manifest.of_days(self.spark.createDataFrame(days, f"{self.day} string"), self.day)

    def publish(self, put, until: str | None = None) -> list[str]:
        """Hand each pending day (up to ``until``) and its rows to ``put``; those that went through are pending no more."""
        state, sent = self.state(), []
        for day in state.pending:
            if until is None or day == NO_DAY or day <= until:
                put(day, self.read(state=state, days={day}))
                sent.append(day)
        if sent:
            self.commit(replace(state, pending=tuple(d for d in state.pending if d not in sent)))
        return sent

    def vacuum(self) -> int:
        """Delete folders that the current manifest does not name, and older manifests; how many folders went."""
        state = self.state()
        held = {(s[GENERATION], d) for d, s in state.days.items()}
        store, folder = self._log()
        gone, data = 0, self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data")
        for generation in store.listStatus(data) if store.exists(data) else []:
            name = generation.getPath().getName().partition("=")[2]
            for day in store.listStatus(generation.getPath()):
                kept = (name, day.getPath().getName().partition("=")[2]) in held
                if day.isDirectory() and not kept:
                    store.delete(day.getPath(), True)
                    gone += 1
        for old in store.listStatus(folder) if exists(self.spark, f"{self.path}/log") else []:
            if old.getPath().getName() != f"{state.number:012d}.json":
                store.delete(old.getPath(), False)
        return gone

    # Catalog

    def register(self, name: str) -> None:
        """An external table over the current days, one partition each, with statistics for the planner."""
        state = self.state()
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING PARQUET PARTITIONED BY ({self.day}) LOCATION '{self.path}/data'")
        parts = [f"PARTITION ({self.day} = {'null' if d == NO_DAY else f'''date'{d}' '''}) LOCATION '{self.folder(d, s[GENERATION])}'" for d, s in sorted(state.days.items())]
        for at in range(0, len(parts), 500):
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts[at : at + 500])}")
        self.spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
