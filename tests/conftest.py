from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    os.environ.setdefault("TMPDIR", tempfile.mkdtemp(prefix="firmdyn-tests-"))
    session = (
        SparkSession.builder.master("local[*]")
        .appName("firmdyn-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from firmdyn.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(session)  # unset in tests, so a fresh folder is used
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf0001_panel(spark):
    from firmdyn.session import materialize
    from firmdyn.sources import derived_panel, prepare_panel

    return materialize(prepare_panel(derived_panel(spark, SF0001)))


@pytest.fixture(scope="session")
def duck_sf0001():
    from tools.check_oracle import duck

    return duck(SF0001)
