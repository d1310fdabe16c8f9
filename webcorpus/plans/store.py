"""A stored index: Parquet folders per run, and a catalogue of them.

One writer at a time. A run is committed by its progress rows, written last; its number is one
above the last committed run, so what an interrupted run left behind is overwritten by the next
one and never read.

    <root>/catalogue/version=<v>/                       catalogue snapshots
    <root>/indices/<folder>/docs/run_id=<r>/data=<d>/   documents (staged or kept) with rejects
    <root>/indices/<folder>/outcomes/run_id=<r>/        id, position and outcome of every record
    <root>/indices/<folder>/ids/run_id=<r>/             ids created by the run, in buckets
    <root>/indices/<folder>/progress/run_id=<r>/        what the run added per object
    <root>/indices/<folder>/snapshots/upto=<r>/         state per object and list of runs up to a run

A snapshot replaces the progress folders before it, so what a call lists doesn't grow with the runs.
"""

from __future__ import annotations

import uuid as uuidlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.operators import catalogue as ops
from webcorpus.operators import progress as progress_ops
from webcorpus.operators.mappings import Mapping, check_admissible, mapping
from webcorpus.plans import files
from webcorpus.plans.buckets import IdTable

# Index codec -> Parquet compression.
CODECS = {"default": "lz4", "best_compression": "zstd"}

OUTCOMES = """
    object_key STRING, record_idx BIGINT, doc_id STRING, pos BIGINT, outcome STRING, parse_error STRING,
    run_id BIGINT
"""

# An object's state also says why its last reading ended early, and where the next one can start: at
# the byte that opens a gzip member whose first record has that number.
STATE = progress_ops.SCHEMA + ", error STRING, resume_offset BIGINT, resume_idx BIGINT"
RUN_PROGRESS = STATE + ", data STRING, cut BIGINT"
RUNS = "run_id BIGINT, data STRING, cut BIGINT, lost BIGINT"

SNAPSHOT = 8  # runs between two snapshots


class Index:
    """One stored index."""

    def __init__(self, store: Store, info: dict, user_mapping: Mapping | None = None):
        self.spark, self.info = store.spark, info
        self.uuid, self.path = info["uuid"], f"{store.root}/indices/{info['folder']}"
        self.mapping = user_mapping or mapping(info["mapping"])
        self.compression = CODECS.get(info["codec"], info["codec"])

    def _numbers(self, kind: str, name: str, last: int = 0, done: str = "_SUCCESS") -> list[int]:
        """The complete folders ``<name>=<number>`` beyond a number, in order."""
        found = files.children(self.spark, f"{self.path}/{kind}")
        numbers = sorted(int(n.removeprefix(f"{name}=")) for n in found if n.startswith(f"{name}="))
        return [n for n in numbers if n > last and files.exists(self.spark, f"{self.path}/{kind}/{name}={n}/{done}")]

    def _snapshot(self) -> int:
        """The run that the last whole snapshot includes; 0 without one."""
        return (self._numbers("snapshots", "upto", done="runs/_SUCCESS") or [0])[-1]

    def last_run(self) -> int:
        upto = self._snapshot()
        return (self._numbers("progress", "run_id", upto) or [upto])[-1]

    def committed(self) -> list[int]:
        return sorted(r.run_id for r in self.run_list())

    def _read(self, schema: str, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def runs(self, upto: int | None = None) -> DataFrame:
        """The progress rows of the committed runs since the snapshot."""
        upto = self._snapshot() if upto is None else upto
        later = self._numbers("progress", "run_id", upto)
        return self._read(RUN_PROGRESS, [f"{self.path}/progress/run_id={r}" for r in later])

    def states(self) -> DataFrame:
        """Current state per object: counts add up, the last run says how reading ended."""
        upto = self._snapshot()
        held = self._read(STATE, [f"{self.path}/snapshots/upto={upto}/objects"] if upto else [])
        rows = held.unionByName(self.runs(upto).drop("data", "cut")).filter("object_key IS NOT NULL")
        latest = F.max_by(F.struct("error", "resume_offset", "resume_idx"), "run_id").alias("latest")
        return (
            rows.groupBy("object_key").agg(
                F.max("next_record_idx").alias("next_record_idx"), F.bool_or("done").alias("done"),
                *[F.sum(c).alias(c) for c in progress_ops.COUNTS], F.max("run_id").alias("run_id"), latest,
            )
            .select(F.lit(self.uuid).alias("index_uuid"), "*", "latest.*").drop("latest")
        )

    def progress(self) -> DataFrame:
        """Current counts per object."""
        empty = self.spark.createDataFrame([], progress_ops.SCHEMA)
        return progress_ops.commit_progress(empty, self.states().select(*empty.columns))

    def run_list(self) -> list:
        """One row per committed run: its data folder, cut position and documents to leave out."""
        upto = self._snapshot()
        held = self._read(RUNS, [f"{self.path}/snapshots/upto={upto}/runs"] if upto else [])
        lost = F.sum(F.when(F.col("data") == "staged", F.col("already_exists")).otherwise(0))
        return held.unionByName(self.runs(upto).groupBy("run_id", "data", "cut").agg(lost.alias("lost"))).collect()

    def take_snapshot(self) -> None:
        """Put the state up to the last run in one place, if enough runs were made since the last time."""
        last = self.last_run()
        if last - self._snapshot() < SNAPSHOT:
            return
        rows = [(r.run_id, r.data, r.cut, r.lost) for r in self.run_list()]
        path = f"{self.path}/snapshots/upto={last}"
        self.states().write.mode("overwrite").parquet(f"{path}/objects")
        # Written last: from here on the snapshot counts.
        self.spark.createDataFrame(rows, RUNS).coalesce(1).write.mode("overwrite").parquet(f"{path}/runs")

    def clean(self) -> None:
        """Drop the folders that the last but one snapshot replaces; what a table in use may still
        read of the last one's stays. Not while a call goes on."""
        whole = self._numbers("snapshots", "upto", done="runs/_SUCCESS")
        if len(whole) < 2:
            return
        for kind, name, upto in (("progress", "run_id", whole[-2]), ("snapshots", "upto", whole[-2] - 1)):
            for child in files.children(self.spark, f"{self.path}/{kind}"):
                if child.startswith(f"{name}=") and int(child.removeprefix(f"{name}=")) <= upto:
                    files.remove(self.spark, f"{self.path}/{kind}/{child}")

    def outcomes(self, runs: list | None = None) -> DataFrame:
        """What became of every record of the runs, up to each run's cut."""
        runs = self.run_list() if runs is None else runs
        paths = [f"{self.path}/outcomes/run_id={r.run_id}" for r in runs]
        if not paths:
            return self.spark.createDataFrame([], OUTCOMES)
        rows = self.spark.read.schema(OUTCOMES).option("basePath", f"{self.path}/outcomes").parquet(*paths)
        cuts = [F.lit(x).cast("bigint") for r in runs if r.cut is not None for x in (r.run_id, r.cut)]
        if not cuts:
            return rows
        cut = F.try_element_at(F.create_map(*cuts), F.col("run_id"))
        return rows.filter(cut.isNull() | (F.col("pos") <= cut))

    def id_table(self) -> IdTable:
        return IdTable(self.spark, f"{self.path}/ids", self.info["number_of_shards"])

    def ids(self, runs: list | None = None) -> DataFrame:
        """The ids the index holds, dealt by id into its buckets."""
        runs = self.run_list() if runs is None else runs
        return self.id_table().read([r.run_id for r in runs]).select("doc_id", "pos")

    def _data(self, runs: list) -> DataFrame:
        """All rows of the committed data folders, rejects included."""
        kept = [f"{self.path}/docs/run_id={r.run_id}/data={r.data}" for r in runs]
        if not kept:
            raise ValueError("the index has no committed run")
        return self.spark.read.option("basePath", f"{self.path}/docs").parquet(*kept)

    def lost_count(self) -> int:
        """Documents that readers have to leave out of the data folders."""
        return sum(r.lost for r in self.run_list())

    def documents(self) -> DataFrame:
        runs = self.run_list()
        docs = self._data(runs).filter("reject_reason IS NULL").drop("reject_reason", "data", "resume_offset", "resume_idx")
        lossy = [r for r in runs if r.lost]
        if not lossy:
            return docs
        lost = self.outcomes(lossy).filter("outcome = 'already_exists'").select("run_id", "pos")
        # A writer keeps these below LOST_ROWS over all runs, so they can be broadcast.
        return docs.join(F.broadcast(lost), ["run_id", "pos"], "left_anti")

    def rejects(self) -> DataFrame:
        """Rejected records, each once. (Runs cut by a budget drop what lies beyond.) Where an object
        can't be read on is said by the last run that tried."""
        rows = self._data(self.run_list()).filter("reject_reason IS NOT NULL").select(
            "object_key", "object_index", "record_idx", "reject_reason", F.col("run_id").cast("bigint").alias("run_id")
        )
        stuck = F.col("reject_reason").startswith("parse: ")
        failed = self.states().filter("error IS NOT NULL").select("object_key", "run_id")
        return rows.filter(~stuck).unionByName(rows.filter(stuck).join(failed, ["object_key", "run_id"], "left_semi"))

    def refresh(self) -> None:
        """Make appended files visible to tables and caches over this index only."""
        self.spark.catalog.refreshByPath(self.path)


class Store:
    """The catalogue of stored indexes under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _versions(self) -> list[int]:
        base = f"{self.root}/catalogue"
        return sorted(
            int(n.removeprefix("version="))
            for n in files.children(self.spark, base)
            if n.startswith("version=") and files.exists(self.spark, f"{base}/{n}/_SUCCESS")
        )

    def catalogue(self) -> DataFrame:
        versions = self._versions()
        if not versions:
            return self.spark.createDataFrame([], ops.SCHEMA)
        return self.spark.read.schema(ops.SCHEMA).parquet(f"{self.root}/catalogue/version={versions[-1]}")

    def _save(self, catalogue: DataFrame) -> None:
        version = (self._versions() or [0])[-1] + 1
        # One row per index.
        catalogue.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/catalogue/version={version}")

    def create_index(
        self,
        collection: str,
        mapping_name: str,
        codec: str = "default",
        index_name: str | None = None,
        number_of_shards: int = 1,
        number_of_replicas: int = 0,
        enable_source: bool = False,
        uuid: str | None = None,
        user_mapping: Mapping | None = None,
    ) -> str:
        """Register an index, named after its collection unless told otherwise -> its uuid."""
        if user_mapping is not None:
            if not user_mapping.allows(collection):
                raise ValueError(f"collection is outside the mapping: {collection}")
        else:
            request = self.spark.createDataFrame([(mapping_name, collection)], "mapping STRING, collection STRING")
            if error := check_admissible(request).first().error:
                raise ValueError(f"{error}: {collection}")
        uuid = uuid or uuidlib.uuid4().hex[:22]
        row = (
            uuid, index_name or collection, collection, mapping_name, uuidlib.uuid4().hex,
            number_of_shards, number_of_replicas, codec, enable_source,
        )
        new = self.spark.createDataFrame([row], ops.SCHEMA)
        names = self.catalogue().filter(F.col("index_name") == row[1])
        if not names.isEmpty():
            raise ValueError(f"index name already in use: {row[1]}")
        catalogue, errors = ops.register(self.catalogue(), new)
        self._check(errors)
        self._save(catalogue)
        return uuid

    @staticmethod
    def _check(errors: DataFrame) -> None:
        if bad := errors.first():
            raise ValueError(f"{bad.error}: {bad}")

    def open(self, target: str, user_mapping: Mapping | None = None) -> Index:
        """An index by name or uuid."""
        found = self.catalogue().filter((F.col("uuid") == target) | (F.col("index_name") == target)).first()
        if found is None:
            raise ValueError(f"no such index: {target}")
        return Index(self, found.asDict(), user_mapping)

    def progress(self) -> DataFrame:
        """Progress of all indexes."""
        state = self.spark.createDataFrame([], progress_ops.SCHEMA)
        for row in self.catalogue().collect():  # one row per index
            state = state.unionByName(Index(self, row.asDict()).progress())
        return state

    def list(self, fmt: str | None = None) -> DataFrame:
        return ops.list_indices(self.catalogue(), self.progress(), fmt)

    def rekey(self, from_uuid: str, to_uuid: str) -> None:
        """Progress is stored per folder, so the new uuid finds it without a rewrite."""
        moves = self.spark.createDataFrame([(from_uuid, to_uuid)], "from_uuid STRING, to_uuid STRING")
        none = self.spark.createDataFrame([], progress_ops.SCHEMA)
        catalogue, _, errors = ops.rekey(self.catalogue(), none, moves)
        self._check(errors)
        if from_uuid != to_uuid:
            self._save(catalogue)

    def delete(self, uuid: str, drop_data: bool = False) -> bool:
        """Drop the record first, then the data if asked -> whether there was data to drop.

        Without ``drop_data`` the folder stays as an unreferenced copy."""
        index = self.open(uuid)
        target = self.spark.createDataFrame([(index.uuid,)], "uuid STRING")
        none = self.spark.createDataFrame([], progress_ops.SCHEMA)
        catalogue, _, errors = ops.delete(self.catalogue(), none, target)
        self._check(errors)
        self._save(catalogue)
        index.id_table().drop()
        return files.remove(self.spark, index.path) if drop_data else files.exists(self.spark, index.path)
