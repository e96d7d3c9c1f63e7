import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlight.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.log.level": "ERROR",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Evaluate column functions over a list of texts: one list of results per function."""

    def run(texts, *functions, kind="string"):
        df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], f"i INT, c {kind}")
        rows = df.select("i", *[f("c").alias(f"r{n}") for n, f in enumerate(functions)]).orderBy("i").collect()
        results = [[row[f"r{n}"] for row in rows] for n in range(len(functions))]
        return results[0] if len(functions) == 1 else results

    return run
