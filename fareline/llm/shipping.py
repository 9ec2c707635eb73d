"""Give the workers of a session this package, wherever the driver imported it from."""

from __future__ import annotations

import os
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame

_shipped: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(df: DataFrame) -> DataFrame:
    """`df` itself; its session's workers can import this package from now on.

    Rows hold whole texts here, so Arrow batches get fewer rows than Spark's default, if that is set.
    """
    if df.sparkSession.conf.get(_BATCH, "10000") == "10000":
        df.sparkSession.conf.set(_BATCH, "2000")
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        path = os.path.join(context._temp_dir, f"{package.name}.zip")
        with zipfile.ZipFile(path, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(path)
        _shipped.add(context.applicationId)
    return df
