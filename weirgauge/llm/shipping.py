"""Make the package importable for Python workers."""

from __future__ import annotations

import io
import pathlib
import zipfile

from pyspark.sql import SparkSession

from ..session import scratch

PACKAGE = pathlib.Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's code to the workers of an application, once.

    The archive lies in shared storage, where executors fetch it as with
    ``--py-files``; an installed package makes it redundant but does no harm.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(PACKAGE.parent))
    path = f"{scratch(spark, 'code')}/weirgauge_code.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    stream.write(bytearray(held.getvalue()))
    stream.close()
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)
