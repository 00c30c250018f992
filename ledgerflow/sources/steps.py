"""Intermediate results as written tables, where a plan must not be computed twice."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ledgerflow.session import shared_folder


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as files of the shared folder: read again they are the same rows, whatever executor is lost.

    The folder is the one for checkpoints and cleaned like those.
    """
    path = f"{shared_folder(df.sparkSession)}/step-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
