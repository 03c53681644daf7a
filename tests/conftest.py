import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = str(ROOT) + os.pathsep + os.environ.get("PYTHONPATH", "")

from tidewater import build_session  # noqa: E402


@pytest.fixture(scope="session")
def samples(tmp_path_factory):
    from tests.samples import write_samples

    return write_samples(tmp_path_factory.mktemp("samples"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        "tests",
        spark__sql__shuffle__partitions="2",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set ``spark.tidewater.*`` values for one test."""
    names = set()

    def change(**values):
        for name, value in values.items():
            names.add(name)
            spark.conf.set(f"spark.tidewater.{name}", str(value))

    yield change
    for name in names:
        spark.conf.unset(f"spark.tidewater.{name}")


@pytest.fixture
def split_everything(settings):
    """Every key counts as hot and chunks are tiny, so the chunked plans are exercised."""
    settings(hotRows=1, chunkBits=2, chunkRows=7)


SF = "/root/testdata/sf0.001"
