import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skyledger.workspace import remove_all  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_all(session)
    session.stop()


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from a dict of address -> JSON value (or raw text)."""

    def build(docs):
        rows = [(uri, body if isinstance(body, str) else json.dumps(body)) for uri, body in docs.items()]
        return spark.createDataFrame(rows, "doc_uri string, body string")

    return build


def feature(fid="i", collection=None, **members):
    """A valid feature; a member given as None is left out, properties default to a date."""
    out = {
        "type": "Feature", "id": fid, "properties": {"datetime": "2024-01-01T00:00:00Z"},
        "geometry": {"type": "Point", "coordinates": [1.5, 2]}, "bbox": [1.5, 2, 1.5, 2], "links": [], "assets": {}, "stac_extensions": [],
    }
    if collection:
        out["collection"] = collection
    out.update(members)
    return {k: v for k, v in out.items() if v is not None}
