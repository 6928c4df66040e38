"""Session factory with the settings the engine relies on."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "citeweave", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config(map=CONF | conf)
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to executors, once a session: they need not have it installed."""
    package = Path(__file__).resolve().parent
    if not any(name.startswith(f"{package.name}-") for name in spark.sparkContext._python_includes):
        folder = tempfile.mkdtemp(prefix="citeweave-")  # the driver's own: Spark copies the file
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{package.name}-{Path(folder).name}", "zip", package.parent, package.name))
