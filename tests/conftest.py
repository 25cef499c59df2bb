import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.change_events import event, image  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "5000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def feed_of(spark):
    """Feed DataFrame from texts, nulls and dicts."""

    def make(*values):
        texts = [v if v is None or isinstance(v, str) else json.dumps(v) for v in values]
        return spark.createDataFrame([(None, t, None) for t in texts], "key string, value string, timestamp timestamp_ntz")

    return make


@pytest.fixture(scope="session")
def scenario():
    """Create 1, 2 and 3, update 2, delete 3; then a tombstone and a text that is not JSON."""
    one, two, three = image(1, 1, 1, 1, 100), image(2, 2, 2, 2, 100), image(3, 3, 3, 3, 300)
    updated = {**two, "quantity": 200}
    return [
        event("c", None, one, 10.0),
        event("c", None, two, 10.1),
        event("c", None, three, 10.2),
        event("u", updated, updated, 1010.3),
        event("d", three, None, 2010.4),
        None,
        "{bad",
    ]
