"""Cutting lineage between the rounds of an iteration."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed and written to the shared checkpoint folder, which a lost executor leaves whole.

    The folder is that of ``spark.checkpoint.dir``; where none is named, a
    temporary one, on a single machine alone.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="quillgraph-")
            atexit.register(shutil.rmtree, named, True)
        context.setCheckpointDir(named)
    return df.checkpoint()
