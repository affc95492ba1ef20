import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__  # noqa: E402, F401  (ships Python functions with their tasks)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tandem-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of an expression over rows given as dictionaries or plain strings (column `x`)."""

    def evaluate(expression, values, schema="x string"):
        rows = [value if isinstance(value, tuple) else (value,) for value in values]
        df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
        return [row["v"] for row in df.select("i", expression.alias("v")).orderBy("i").collect()]

    return evaluate


def record(**changes):
    base = {
        "instruction": "Translate the following medical sentence from English to Spanish.",
        "input": "Our clinic closes at seven",
        "output": "El consultorio cierra temprano",
        "domain": "medical",
        "direction": "en_to_es",
    }
    return {**base, **changes}


@pytest.fixture
def records(spark):
    """A record table from keyword changes, with lengths and ids."""
    from pyspark.sql import functions as F

    from tandem.operators.profile import with_lengths
    from tandem.sources.bitext import RECORD_SCHEMA

    def build(rows):
        names = [field.split()[0] for field in RECORD_SCHEMA.split(", ")]
        data = [(i, *(record(**row)[name] for name in names)) for i, row in enumerate(rows)]
        return with_lengths(spark.createDataFrame(data, f"row_no bigint, {RECORD_SCHEMA}")).withColumn(
            "shuffle_key", F.concat(F.md5(F.concat_ws("|", "direction", "input", "output")), F.md5(F.col("row_no").cast("string")))
        )

    return build
