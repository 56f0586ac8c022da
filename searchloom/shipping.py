"""Make the package importable in the Python workers of a running application."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession, modules: Iterable[Path] = ()) -> None:
    """Send this package, and single-file ``modules``, to the executors once per application.

    Not needed where the package is installed on the cluster or given to
    ``spark-submit --py-files``.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="searchloom-")) / f"searchloom-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as target:
        for source in sorted(package.rglob("*.py")):
            target.write(source, source.relative_to(package.parent))
        for module in modules:
            target.write(module, Path(module).name)
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)
