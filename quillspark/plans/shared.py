"""Writing a frame to the folder that all machines share, so that its lineage is cut and it is made once."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def written(frame: DataFrame) -> DataFrame:
    """``frame`` written to ``spark.checkpoint.dir`` and read from there.

    A session on this machine alone (tests) may leave that setting out; on a cluster a folder of one machine would lose
    data, so it raises.
    """
    sc = frame.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="quillspark-"))
    return frame.checkpoint(eager=True)
