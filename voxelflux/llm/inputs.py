"""What queries and pipeline read, and where they put what is their own; imports no operator, so a driver that needs one loads one."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from voxelflux.llm.store import prepare
from voxelflux.session import shared_dir

#: Where the public tokenizer files lie; the path is a parameter of the operators.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    try:
        import public_tokenizers

        return str(public_tokenizers.path(name))
    except ImportError:
        return os.path.join(TOKENIZERS, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A folder of this run's own among those that driver and executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
