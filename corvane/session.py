"""Session defaults for local runs; a cluster's own settings always win."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "corvane") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CORVANE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a session, so that tasks find it wherever they start."""
    sc = spark.sparkContext
    if getattr(sc, "_corvane_shipped", False):
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():  # else it came as an archive, and is there
        # The driver serves this file as long as it runs.
        folder = tempfile.mkdtemp(prefix="corvane-package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = Path(folder) / "corvane-package.zip"
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(str(path))
    sc._corvane_shipped = True
