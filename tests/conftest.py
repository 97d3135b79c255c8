import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from feedloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = build_session("tests", "local[4]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    return session


ARTICLE = (
    "brief_date date, seq bigint, title string, url string, summary string, source_key string, source_name string,"
    " source_url string, category string, quality int, language string, published_at timestamp"
)


@pytest.fixture
def articles(spark):
    """Article rows from (brief_date, seq, title, url, summary, category, published_at), the rest filled."""

    def make(rows, quality=4, source="S"):
        full = [
            (day, seq, title, url, summary, f"{source}|u", source, "u", category, quality, "en", published)
            for day, seq, title, url, summary, category, published in rows
        ]
        return spark.createDataFrame(full, ARTICLE)

    return make
