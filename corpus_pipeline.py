"""A training corpus from ``documents``: each stage takes (spark, docs, sf_dir) and gives the next one's docs."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from methylspark.llm.common import Workspace, small_batches, table
from methylspark.llm.langid import stage_language
from methylspark.llm.mixing import stage_mix
from methylspark.llm.neardup import stage_near_duplicates
from methylspark.llm.packing import stage_pack
from methylspark.llm.secrets import stage_secrets



def _bounded(stage):
    """The stage in a session with bounded Arrow batches."""
    return wraps(stage)(lambda spark, docs, sf_dir: stage(small_batches(spark), docs, sf_dir))


#: (name, function) in order; every stage works on all that its predecessor kept.
STAGES = [
    ("language", _bounded(stage_language)),
    ("near_duplicates", _bounded(stage_near_duplicates)),
    ("secrets", _bounded(stage_secrets)),
    ("mix", _bounded(stage_mix)),
    ("pack", _bounded(stage_pack)),
]

#: None: language models, sketches, guess costs and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and read again."""
    space = Workspace(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = space.put(stage(spark, docs, sf_dir), name)
        space.drop(before)
        before = docs
    return docs
