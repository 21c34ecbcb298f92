"""Makes this package importable in the Python workers of the executors."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from lapwise.operators.staging import scratch


def ship(spark: SparkSession) -> None:
    """Once per Spark context, put the package as a zip into shared storage and name it as a Python file."""
    context = spark.sparkContext
    if getattr(context, "_lapwise_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for name in sorted(root.glob("lapwise/**/*.py")):
            out.write(name, str(name.relative_to(root)))
    target = scratch(spark, "code") + ".zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.create(path)
    stream.write(bytearray(packed.getvalue()))
    stream.close()
    context.addPyFile(str(files.makeQualified(path).toString()))
    context._lapwise_shipped = True
