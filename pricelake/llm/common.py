"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from pricelake.operators.places import placed
from pricelake.session import drop_paths, scratch_scope, written

__all__ = ["SLICE_ROWS", "WORD_RE", "ascii_lower", "by_shuffle", "drop_paths", "given_back", "keep_where", "map_arrow", "map_rows", "own_names", "placed", "scratch_scope", "set_aside", "table", "written"]

# A word, in every contract: a run of anything but space and the five ASCII white-space controls.
WORD_RE = r"[^\x20\x09-\x0D]+"
SLICE_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def set_aside(docs: DataFrame, *extra: Column) -> DataFrame:
    """The columns of ``docs`` under names of their own, ``own0, own1, ...``, beside ``extra`` ones.

    Whatever the input's columns are called, none can clash with those of an operator; :func:`given_back` names them again.
    """
    return docs.select(*(F.col(f"`{c}`").alias(f"own{i}") for i, c in enumerate(docs.columns)), *extra)


def own_names(docs: DataFrame) -> list[str]:
    return [f"own{i}" for i in range(len(docs.columns))]


def given_back(docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` as they were, from those that were set aside."""
    return [F.col(o).alias(c) for o, c in zip(own_names(docs), docs.columns, strict=True)]


def by_shuffle(df: DataFrame) -> DataFrame:
    """A join side that grows with the input: joined by shuffle at every size, never broadcast where it happens to be small."""
    return df.hint("merge")


def _let_workers_import(spark: SparkSession) -> None:
    """Python workers on this path find the package even if the session began elsewhere; a cluster installs it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (env.get("PYTHONPATH"), root)))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[list]], schema) -> DataFrame:
    """``mapInArrow`` with columns out: ``fn`` gets an iterator of record batches and yields lists of columns in the
    order of ``schema``, as Arrow arrays or Python lists. Nulls stay ``None`` and longs stay longs. ``fn`` gets at most
    SLICE_ROWS rows at a time, however many Spark sends, which bounds the Python objects a worker holds."""
    fields = df.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(fields)
    _let_workers_import(df.sparkSession)

    def run(batches):
        slices = (b.slice(i, SLICE_ROWS) for b in batches for i in range(0, b.num_rows, SLICE_ROWS))
        for out in fn(slices):
            columns = [c.cast(t) if isinstance(c, pa.Array) else pa.array(c, type=t) for c, t in zip(out, arrow.types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, fields)


def map_rows(df: DataFrame, fn: Callable[[Iterator[dict[str, list]]], Iterable[dict[str, list]]], schema: str) -> DataFrame:
    """``map_arrow`` over plain Python lists: ``fn`` gets an iterator of ``{column: values}``, one per batch, and
    yields the same shape with the columns of ``schema``."""
    names = df.sparkSession.createDataFrame([], schema).columns

    def run(batches):
        cols = (dict(zip(b.schema.names, (c.to_pylist() for c in b.columns), strict=True)) for b in batches)
        for out in fn(cols):
            yield [out[n] for n in names]

    return map_arrow(df, run, schema)


def keep_where(docs: DataFrame, make: Callable[[], Callable[[list[str]], list[bool]]]) -> DataFrame:
    """Rows of ``docs`` whose ``text`` (null: empty) passes; ``make()`` gives a task its test. All columns stay as they are."""

    def run(batches):
        test = make()
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            kept = b.filter(pa.array(test(texts), pa.bool_()))
            yield list(kept.columns)

    return map_arrow(docs, run, docs.schema)


def ascii_lower(col):
    """Lower-case A-Z only, as the word contracts ask; other letters stay."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
