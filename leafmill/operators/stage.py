"""Materialised stages of iterative plans."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared checkpoint folder, so that its lineage ends there.

    The folder is the session's; on one machine, as in tests, a private one is
    made where none is set.
    """
    context = df.sparkSession.sparkContext
    if not (df.sparkSession.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()):
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="leafmill-"))
    return df.checkpoint()
