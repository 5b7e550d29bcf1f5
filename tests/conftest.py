import os

import pytest

os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from millrace.session import build

    session = build(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_chunks(monkeypatch):
    """Chunks of a few rows and few rows to a hot key, so that small tables are cut."""
    from millrace.operators import scan

    monkeypatch.setattr(scan, "CHUNK_ROWS", 7)
    monkeypatch.setattr(scan, "HOT_ROWS", 9)


def rows(df, *columns):
    """Sorted tuples of a result."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=repr)
