import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def xml_dir(tmp_path):
    """Write files below a folder and return its path."""

    def write(**files):
        for name, text in files.items():
            (tmp_path / f"{name}.xml").write_text(text, encoding="utf-8")
        return str(tmp_path)

    return write


def rows(df, *cols):
    got = df.select(*cols) if cols else df
    return sorted([tuple(r) for r in got.collect()], key=str)


@pytest.fixture
def collect():
    return rows
