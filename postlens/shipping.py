"""The package for Python workers that cannot import it from where they run."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> SparkSession:
    """Send the package to the executors, once for each application; what ``--py-files`` does for a submitted job."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[0]
        archive = Path(tempfile.mkdtemp(prefix="code-")) / "postlens-code.zip"
        with zipfile.ZipFile(archive, "w") as file:
            for source in sorted(package.rglob("*.py")):
                file.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return spark
