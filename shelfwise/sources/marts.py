"""Stored star schema: built once per input state, read by every analysis."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.checks import require_many_to_one
from shelfwise.operators.features import model_table
from shelfwise.operators.navigate import LATTICE, Mart, Navigator, build_mart, finer_mart
from shelfwise.operators.star import Star, build_calendar, build_star
from shelfwise.session import shared_dir, tune
from shelfwise.sources import crosswalk
from shelfwise.sources.panel import write_table

_SOURCES = ("lineitem", "orders", "part", "supplier", "nation", "region")
_STAR_TABLES = ("fact", "product", "store", "calendar")
#: Goes up when the stored tables change, so that older ones are not read.
_LAYOUT = 2
# Models this process has loaded, by session and folder.
_MODELS: dict[tuple[str, str], PipelineModel] = {}
# Folders this process has found or stored, with the schemas of their tables.
_STORED: dict[str, dict | T.StructType | tuple] = {}


def input_state(spark: SparkSession, sf_dir: str) -> int:
    """Fingerprint of the source files: names, sizes and times, no contents."""
    files = spark.read.format("binaryFile").load([f"{sf_dir}/{t}.parquet" for t in _SOURCES])
    mark = F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)")
    return int(files.select(mark.alias("mark")).agg(F.sum("mark")).first()[0])


def planned_star(spark: SparkSession, sf_dir: str) -> Star:
    """Star as a lazy plan over the source tables."""
    return build_star(
        crosswalk.raw_transactions(spark, sf_dir),
        crosswalk.raw_products(spark, sf_dir),
        crosswalk.raw_stores(spark, sf_dir),
    )


def write_star(spark: SparkSession, star: Star, root: str) -> Star:
    """Write the four tables under ``root`` and return them as read back.

    The fact is partitioned by year and sorted by its key; the calendar is
    derived from the stored fact so that the panel is computed only once.
    """
    fact_key = ("date_key", "store_num", "upc")
    write_table(star.fact, f"{root}/fact", partition_by=("year",), cluster_by=fact_key)
    write_table(star.product, f"{root}/product")
    write_table(star.store, f"{root}/store")
    for name, key in (("product", "upc"), ("store", "store_num")):
        require_many_to_one(_read(spark, f"{root}/{name}", getattr(star, name).schema), key)
    fact = _read(spark, f"{root}/fact", star.fact.schema)
    weeks = fact.select(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("week_end_date"))
    calendar = build_calendar(weeks)
    write_table(calendar, f"{root}/calendar")
    return read_star(spark, root, {t: getattr(star, t).schema for t in _STAR_TABLES} | {"calendar": calendar.schema})


def _read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table; with its schema known no footer is read to infer it."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_star(spark: SparkSession, root: str, schemas: dict[str, T.StructType] | None = None) -> Star:
    schemas = schemas or {}
    return Star(**{t: _read(spark, f"{root}/{t}", schemas.get(t)) for t in _STAR_TABLES})


def _stored(spark: SparkSession, path: str, write) -> str:
    """``path``, written by ``write(folder)`` unless an earlier session has done so.

    The work goes to a folder of its own that is renamed when it is complete;
    of two sessions the later one throws its copy away.
    """
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    final, own = where(path), where(f"{path}.{uuid.uuid4().hex}")
    files = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(final):
        write(own.toString())
        if files.exists(final) or not files.rename(own, final):
            files.delete(own, True)
    return path


def _star_path(spark: SparkSession, sf_dir: str) -> str:
    state = input_state(spark, sf_dir) % (1 << 64)
    return f"{shared_dir(spark)}/star-v{_LAYOUT}-{state:016x}"


def stored_star(spark: SparkSession, sf_dir: str) -> Star:
    """Star from the shared folder, built when missing or when inputs changed.

    Its folder is named by the fingerprint of the inputs, so later sessions
    find it.
    """
    tune(spark)
    path = _star_path(spark, sf_dir)
    if path not in _STORED:
        planned = planned_star(spark, sf_dir)
        _stored(spark, path, lambda folder: write_star(spark, planned, folder))
        _STORED[path] = {t: getattr(planned, t).schema for t in _STAR_TABLES}
    return read_star(spark, path, _STORED[path])


def stored_marts(spark: SparkSession, sf_dir: str) -> Navigator:
    """The marts of the lattice next to the stored star, each built from the smallest finer one."""
    star = stored_star(spark, sf_dir)
    built: dict[str, Mart] = {}
    for name, keys in LATTICE.items():
        path = f"{_star_path(spark, sf_dir)}-mart-{name}"
        if path not in _STORED:
            finer = finer_mart(name, built)
            planned = build_mart(star, name, finer.table if finer else None)
            _stored(spark, path, lambda folder, rows=planned, by=keys: write_table(rows, folder, cluster_by=by))
            table = _read(spark, path, planned.schema)
            _STORED[path] = (planned.schema, table.count())
        schema, rows = _STORED[path]
        built[name] = Mart(name, keys, _read(spark, path, schema), rows)
    return Navigator(star, list(built.values()))


def stored_features(spark: SparkSession, sf_dir: str, priority: tuple[str, ...]) -> DataFrame:
    """Model table next to the stored star, so that fits share one build."""
    star = stored_star(spark, sf_dir)
    path = f"{_star_path(spark, sf_dir)}-features-{'-'.join(priority)}"
    if path not in _STORED:
        key = ("week_end_date", "store_num", "upc")
        _stored(spark, path, lambda folder: write_table(model_table(star, priority), folder, cluster_by=key))
        _STORED[path] = _read(spark, path).schema
    return _read(spark, path, _STORED[path])


def stored_model(spark: SparkSession, sf_dir: str, name: str, fit) -> PipelineModel:
    """A fitted pipeline next to the stored star: fit once per state of the inputs, loaded by every other user."""
    path = model_path(spark, sf_dir, name)
    key = (spark.sparkContext.applicationId, path)
    if key not in _MODELS:
        _stored(spark, path, lambda folder: fit().write().overwrite().save(folder))
        _MODELS[key] = PipelineModel.load(path)
    return _MODELS[key]


def model_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    return f"{_star_path(spark, sf_dir)}-model-{name}"


def stored_result(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A small result next to the stored star, built once per state of the inputs."""
    path = f"{_star_path(spark, sf_dir)}-result-{name}"
    _stored(spark, path, lambda folder: write_table(build(), folder))
    return spark.read.parquet(path)


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """The same rows read back from a table in the shared folder.

    Iterative jobs (model fits, searches) read their input many times; after
    this a lost executor costs a re-read, not a recomputation.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refresh_mart(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Materialise a named result.  With partitions, only those present in
    ``df`` are replaced, so a weekly refresh rewrites just the changed weeks."""
    write_table(df, path, partition_by=partition_by)
    return df.sparkSession.read.parquet(path)
