"""Stored tables and shared scratch space."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lexiloom.schemas import DOCUMENT_SCHEMA, TOKEN_SCHEMA

CHECKPOINT_DIR = "spark.checkpoint.dir"


# Columns that are names, also where their values look like numbers.
NAMES = ("author", "document_id", "language")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Stored Parquet table, with an author named ``007`` as that string.

    Folder names have no type, so without ``schema`` the stored columns are taken as they
    are and the columns in ``NAMES`` as strings.
    """
    if schema is None:
        found = spark.read.parquet(path).schema
        schema = T.StructType(
            [T.StructField(f.name, T.StringType()) if f.name in NAMES else f for f in found]
        )
    return spark.read.schema(schema).parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Stored corpus, with authors as they were written."""
    return read_table(spark, path, DOCUMENT_SCHEMA)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Token checkpoint, with authors as they were written."""
    return read_table(spark, path, TOKEN_SCHEMA)


@cache
def _local_root(application: str) -> str:
    """One temporary folder per local application, removed when the interpreter ends."""
    root = tempfile.mkdtemp(prefix="lexiloom-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder of the session.

    Only a local session may fall back to a temporary folder of this machine; on a
    cluster, executors could not see it.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
        root = _local_root(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
