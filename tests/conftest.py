import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ingestry.session import ensure_session

    s = (
        SparkSession.builder.master("local[*]")
        .appName("ingestry-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ingestry-test-ckpt-"))
    ensure_session(s)
    yield s


@pytest.fixture()
def landing(tmp_path):
    """Write fixture files (bytes or text) into a fresh landing folder."""

    def write(files: dict[str, bytes | str]) -> str:
        root = tmp_path / "landing"
        root.mkdir(exist_ok=True)
        for name, body in files.items():
            p = root / name
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_bytes(body.encode("utf-8") if isinstance(body, str) else body)
        return str(root)

    return write
