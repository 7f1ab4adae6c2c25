import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from seqtally.session import checkpoint_dir
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="seqtally-test-")


def reads_df(spark, rows, sample="S"):
    """rows: list of (read_id, sequence) -> reads DataFrame with read_key."""
    data = [(sample, i, rid, seq) for i, (rid, seq) in enumerate(rows)]
    return spark.createDataFrame(
        data, "sample string, read_key long, read_id string, sequence string")


def library_df(spark, rows, barcode_set="L"):
    """rows: list of (gene, barcode) in file order."""
    from seqtally.operators.library import prepare_library
    data = [(barcode_set, i, g, b) for i, (g, b) in enumerate(rows)]
    raw = spark.createDataFrame(data, "barcode_set string, ord long, gene string, barcode string")
    return prepare_library(raw)
