"""What the operators of this subpackage share: tables, stored intermediate results, checks of broadcast sizes."""

from __future__ import annotations

import pickle

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labeldiff.scratch import held

#: Bytes to lower case (A-Z only); the other tables below also turn separators into spaces.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: For ``bytes.translate`` and ``split``: words of ASCII letters, digits and every byte from 0x80 on, lower-cased.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: cuts the lineage, and survives lost executors. ``scratch.release`` removes it."""
    return held(df, tag)


def text_bytes(column: str = "text"):
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def shipped(spark: SparkSession, model: object):
    """A broadcast of a model of bounded size, with the code of its classes."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def received(broadcast) -> object:
    return pickle.loads(broadcast.value)


def fresh(taken: list[str], name: str) -> str:
    """A column name that clashes with none of ``taken`` (Spark compares names without case)."""
    low = {x.lower() for x in taken}
    while name.lower() in low:
        name += "_"
    return name
