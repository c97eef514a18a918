import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from featuremart.session import SETTINGS, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    SETTINGS["spark.sql.warehouse.dir"] = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(cores=8, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Collected rows as a set of plain tuples, in the given column order."""

    def get(df, *columns):
        return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}

    return get
