import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from jatoba.queries.folders import ensure_work_folder  # noqa: E402
from jatoba.session import build_session  # noqa: E402


# Made at import: the parametrized columns of the tests need a running session.
SESSION = build_session(
    "jatoba-tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"}
)
SESSION.sparkContext.setLogLevel("ERROR")
ensure_work_folder(SESSION)


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()
