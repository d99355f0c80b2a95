import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from replylens.schema import MESSAGE_SCHEMA  # noqa: E402
from replylens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "replylens-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def log(spark):
    """Builds a raw message log from partial rows."""

    def build(*rows):
        names = MESSAGE_SCHEMA.fieldNames()
        full = [
            tuple(
                {
                    "id": i,
                    "job_id": 1,
                    "detected_intent": 0,
                    "message_input": "hola",
                    "message_output": "buenos días",
                    "sender_action": "ACCEPTED",
                    "final_message_sent": "buenas",
                    "sender_id": 1,
                    **row,
                }.get(n)
                for n in names
            )
            for i, row in enumerate(rows)
        ]
        return spark.createDataFrame(full, MESSAGE_SCHEMA)

    return build
