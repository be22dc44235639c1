"""Model versions and their stages as two append-only tables.

``model_versions``: name, version, model_type, category, metrics, tags, path,
created_at. ``stage_events``: name, version, stage, at.
"""

from __future__ import annotations

import errno
import os
import urllib.parse
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

PRODUCTION, STAGING, ARCHIVED, NONE = "Production", "Staging", "Archived", "None"

VERSION_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("path", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)


# ---- views ----------------------------------------------------------------


def current_stages(events: DataFrame) -> DataFrame:
    """The last stage of every (name, version); the stage name breaks a tie in
    time."""
    return events.groupBy("name", "version").agg(
        F.max_by("stage", F.struct("at", "stage")).alias("stage"), F.max("at").alias("since")
    )


def version_view(versions: DataFrame, events: DataFrame) -> DataFrame:
    """Versions with their current stage, ``None`` before any event."""
    stages = current_stages(events)
    return versions.join(stages, ["name", "version"], "left").withColumn("stage", F.coalesce("stage", F.lit(NONE)))


def model_versions(versions: DataFrame, events: DataFrame, name: str) -> DataFrame:
    return version_view(versions.filter(F.col("name") == name), events.filter(F.col("name") == name))


def latest_versions(view: DataFrame, stage: str | None = None) -> DataFrame:
    """The highest version number per (name, stage)."""
    chosen = view if stage is None else view.filter(F.col("stage") == stage)
    return chosen.groupBy("name", "stage").agg(F.max(F.col("version").cast("int")).cast("string").alias("version"))


def compare_versions(view: DataFrame, name: str, first: str, second: str) -> DataFrame:
    """Two versions of a model side by side, one row; no row when one is
    missing."""
    pick = lambda version, suffix: view.filter((F.col("name") == name) & (F.col("version") == version)).select(
        "name",
        F.col("version").alias(f"version{suffix}"),
        F.col("stage").alias(f"stage{suffix}"),
        F.col("created_at").alias(f"created_at{suffix}"),
    )
    return pick(first, "1").join(pick(second, "2"), "name")


def retained_versions(
    view: DataFrame, staging: int = 5, unstaged: int = 10, archived: int | None = None
) -> DataFrame:
    """Versions that the retention rule keeps: every Production version, the
    newest of the other stages up to their limits."""
    limits = {STAGING: staging, NONE: unstaged}
    if archived is not None:
        limits[ARCHIVED] = archived
    limited = F.col("stage").isin(*limits)
    order = W.partitionBy("name", "stage").orderBy(F.col("version").cast("int").desc())
    # The plain rank filter lets Spark cut every group before the shuffle.
    newest = (
        view.filter(limited).withColumn("_position", F.row_number().over(order)).filter(F.col("_position") <= max(limits.values()))
    )
    limit = F.lit(None).cast("int")
    for stage, count in limits.items():
        limit = F.when(F.col("stage") == stage, count).otherwise(limit)
    return view.filter(~limited).unionByName(newest.filter(F.col("_position") <= limit).drop("_position"))


def version_tags(frame: DataFrame) -> DataFrame:
    """A ``tags`` map from category, training_date, data_version and metrics;
    a missing metric reads ``N/A``."""
    text = lambda name: F.coalesce(F.col("metrics")[name].cast("string"), F.lit("N/A"))
    return frame.withColumn(
        "tags",
        F.create_map(
            F.lit("category"),
            F.col("category"),
            F.lit("training_date"),
            F.col("training_date").cast("string"),
            F.lit("data_version"),
            F.col("data_version").cast("string"),
            F.lit("mape"),
            text("mape"),
            F.lit("r2"),
            text("r2"),
            *([F.lit("created_at"), F.col("created_at").cast("string")] if "created_at" in frame.columns else []),
        ),
    )


def promotion_events(view: DataFrame, chosen: DataFrame, stage: str, at: str) -> DataFrame:
    """The stage events that put the ``chosen`` versions (``name, version``) into a stage.

    Into production, every other production version of the same names goes to the
    archive. All names at once, by joins.
    """
    when = F.lit(at).cast("timestamp")
    chosen = chosen.select("name", "version").distinct()
    known = view.join(chosen, ["name", "version"], "left_semi").select("name", "version", F.lit(stage).alias("stage"), when.alias("at"))
    if stage != PRODUCTION:
        return known
    before = view.filter(F.col("stage") == PRODUCTION).join(chosen.select("name").distinct(), "name", "left_semi")
    archived = before.join(chosen, ["name", "version"], "left_anti").select("name", "version", F.lit(ARCHIVED).alias("stage"), when.alias("at"))
    return known.unionByName(archived)


def rollback_events(view: DataFrame, name: str, target: str, at: str) -> DataFrame:
    """The stage events of a rollback: every other Production version to
    Archived, the target version to Production."""
    when = F.lit(at).cast("timestamp")
    mine = view.filter(F.col("name") == name)
    current = mine.filter((F.col("stage") == PRODUCTION) & (F.col("version") != target)).select(
        "name", "version", F.lit(ARCHIVED).alias("stage"), when.alias("at")
    )
    promoted = mine.filter(F.col("version") == target).select(
        "name", "version", F.lit(PRODUCTION).alias("stage"), when.alias("at")
    )
    return current.unionByName(promoted)


# ---- the tables -----------------------------------------------------------


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty marker file; false if somebody else has.

    The file system decides: an exclusive create on a local or mounted one, and Hadoop's
    create without overwriting elsewhere, which HDFS and object stores with conditional
    writes do in one step.
    """
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.getScheme() == "file":
        local = system.makeQualified(place).toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            os.close(os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except OSError as error:
            if error.errno != errno.EEXIST:
                raise
            return False
        return True
    from py4j.protocol import Py4JJavaError

    try:
        system.create(place, False).close()
    except Py4JJavaError:
        if not system.exists(place):
            raise
        return False
    return True


class VersionTables:
    """The two tables under one folder. Calls that return a version or a path
    read a single value; everything else stays a DataFrame.

    Writers may register in parallel, under one name too: a number belongs to the writer
    whose marker file was created, and each append has a folder of its own, so that no
    writer's commit touches another's. Numbers of a name go up; a number may stay unused
    when its writer fails or meets another one.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.fmt = spark, fmt
        self.root = root.rstrip("/")

    def _read(self, table: str, schema: T.StructType) -> DataFrame:
        try:
            reader = self.spark.read.format(self.fmt).schema(schema)
            if self.fmt != "delta":
                reader = reader.option("recursiveFileLookup", True)
            return reader.load(f"{self.root}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _append(self, rows: DataFrame, table: str) -> None:
        # Parallel writers of one folder would remove each other's unfinished files.
        path = f"{self.root}/{table}" if self.fmt == "delta" else f"{self.root}/{table}/{uuid.uuid4().hex}"
        rows.write.mode("append").format(self.fmt).save(path)

    def _exists(self, pattern: str) -> bool:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
        system = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = system.globStatus(place)
        return found is not None and len(found) > 0

    def _claim(self, name: str | None, first: int) -> int:
        """The next free number of a name, or one that is free under every name.

        Both kinds of claims are made first and looked for afterwards, so of two that
        meet at least one sees the other and goes on.
        """
        number, claims = first, f"{self.root}/claims"
        while True:
            mine = "all" if name is None else "name-" + urllib.parse.quote(name, safe="")
            others = f"{claims}/name-*/{number}" if name is None else f"{claims}/all/{number}"
            if claim(self.spark, f"{claims}/{mine}/{number}") and not self._exists(others):
                return number
            number += 1

    def versions(self) -> DataFrame:
        return self._read("model_versions", VERSION_SCHEMA)

    def events(self) -> DataFrame:
        return self._read("stage_events", EVENT_SCHEMA)

    def view(self) -> DataFrame:
        return version_view(self.versions(), self.events())

    def register(
        self,
        name: str,
        model_type: str,
        metrics: Mapping[str, float],
        path: str,
        at: str,
        category: str = "Total",
        tags: Mapping[str, str] | None = None,
    ) -> str:
        """Append a version and return its number."""
        highest = self.versions().filter(F.col("name") == name).agg(F.max(F.col("version").cast("int"))).first()[0]
        version = str(self._claim(name, (highest or 0) + 1))
        row = self.spark.createDataFrame(
            [(name, version, model_type, category, {k: float(v) for k, v in metrics.items()}, dict(tags or {}), path)],
            T.StructType(VERSION_SCHEMA.fields[:-1]),
        ).withColumn("created_at", F.lit(at).cast("timestamp"))
        self._append(row, "model_versions")
        return version

    def register_all(self, models: DataFrame, at: str) -> str:
        """Append a version of many models at once and return its number, one that is new
        to all of them. ``models`` has ``name, model_type, category, metrics, tags, path``."""
        highest = self.versions().join(models.select("name").distinct(), "name", "left_semi").agg(F.max(F.col("version").cast("int"))).first()[0]
        version = str(self._claim(None, (highest or 0) + 1))
        rows = models.withColumns({"version": F.lit(version), "created_at": F.lit(at).cast("timestamp")})
        self._append(rows.select([f.name for f in VERSION_SCHEMA]), "model_versions")
        return version

    def promote_all(self, version: str, stage: str, at: str, names: DataFrame | None = None) -> None:
        """Put a version of many models (all that have it, or those in ``names``) into a stage."""
        chosen = self.versions().filter(F.col("version") == version).select("name", "version")
        if names is not None:
            chosen = chosen.join(names.select("name").distinct(), "name", "left_semi")
        if chosen.isEmpty():
            raise ValueError(f"no model has version {version}")
        self._append(promotion_events(self.view(), chosen, stage, at), "stage_events")

    def models_in(self, stage: str = PRODUCTION) -> DataFrame:
        """The newest version of every name in a stage, with type, category and path."""
        view = self.view()
        return view.join(latest_versions(view, stage), ["name", "stage", "version"], "left_semi")

    def promote(self, name: str, version: str, stage: str, at: str) -> None:
        if self.versions().filter((F.col("name") == name) & (F.col("version") == version)).isEmpty():
            raise ValueError(f"{name} has no version {version}")
        if stage == PRODUCTION:
            # One version at most is in production.
            events = rollback_events(self.view(), name, version, at)
        else:
            row = self.spark.createDataFrame([(name, version, stage)], "name string, version string, stage string")
            events = row.withColumn("at", F.lit(at).cast("timestamp"))
        self._append(events, "stage_events")

    def latest(self, name: str, stage: str = PRODUCTION) -> str | None:
        row = latest_versions(self.view().filter(F.col("name") == name), stage).select("version").first()
        return None if row is None else row[0]

    def path_of(self, name: str, stage: str = PRODUCTION) -> str:
        """Where the model in a stage is stored."""
        version = self.latest(name, stage)
        if version is None:
            raise ValueError(f"{name} has no version in stage {stage}")
        return self.versions().filter((F.col("name") == name) & (F.col("version") == version)).select("path").first()[0]

    def compare(self, name: str, first: str, second: str) -> DataFrame:
        pair = compare_versions(self.view(), name, first, second)
        if pair.isEmpty():
            raise ValueError("one or both versions not found")
        return pair

    def rollback(self, name: str, target: str, at: str) -> None:
        if self.versions().filter((F.col("name") == name) & (F.col("version") == target)).isEmpty():
            raise ValueError(f"{name} has no version {target}")
        self._append(rollback_events(self.view(), name, target, at), "stage_events")
