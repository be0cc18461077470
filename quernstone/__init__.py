"""Evidence-to-records analytics on Spark DataFrames."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark) -> None:
    """Let Python workers import this package: sent as a zip once a session, unless they find it by their path anyway."""
    if ROOT in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] or spark.conf.get("quernstone.shipped", None):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="quernstone-"), "quernstone.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(ROOT, "quernstone")):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), ROOT))
    spark.sparkContext.addPyFile(path)
    spark.conf.set("quernstone.shipped", "yes")


def bounded_batches(spark) -> None:
    """Texts are long: unless the session says otherwise, Python workers get 1,000 rows or 16 MB at a time instead of 10,000 rows."""
    for key, default, ours in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"), ("spark.sql.execution.arrow.maxBytesPerBatch", None, str(16 << 20))):
        now = spark.conf.get(key, None)
        if now == default or (default is None and now is not None and int(re.sub(r"\D", "", now) or 0) > 16 << 20):
            spark.conf.set(key, ours)
