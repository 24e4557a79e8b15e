import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from repotide.contract import REPO_SCHEMA  # noqa: E402
from repotide.session import build_session  # noqa: E402

NO_VALUE = {f.name: None for f in REPO_SCHEMA.fields}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


@pytest.fixture
def repos(spark):
    """Repositories from dicts; `seq` and `id` default to the position in the list."""

    def build(*rows):
        full = []
        for n, row in enumerate(rows):
            row = {**NO_VALUE, "id": n, "seq": n, "name": f"r{n}", "language": "Python", **row}
            full.append(tuple(row[f.name] for f in REPO_SCHEMA.fields))
        return spark.createDataFrame(full, REPO_SCHEMA)

    return build


def rows(df, *columns):
    """Sorted tuples of the named columns."""
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())
