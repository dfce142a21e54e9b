import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from clickloom.session import configure
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clickloom-test-"))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def make(spark):
    """Rows with a ``timestamp`` given as text -> events with all columns the operators read."""
    from pyspark.sql import functions as F

    def build(rows):
        full = [(str(r.get("event_id", i)), r.get("event_type", "page_view"), r["ts"], r.get("user_id", "u1"),
                 r.get("session_id", "s1"), r.get("source", "web"), r.get("properties", {"k": "1"}),
                 r.get("metadata", {"platform": "web"}), r.get("customer_segment", "A"),
                 r.get("event_revenue", 0.0)) for i, r in enumerate(rows)]
        df = spark.createDataFrame(full, "event_id string, event_type string, ts string, user_id string, "
                                   "session_id string, source string, properties map<string,string>, "
                                   "metadata map<string,string>, customer_segment string, event_revenue double")
        return df.withColumn("timestamp", F.col("ts").cast("timestamp")).drop("ts")
    return build
