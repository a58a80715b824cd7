import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from jobmill.session import local_session  # noqa: E402

# Test modules build columns when they are imported, which needs a session.
SESSION = local_session(4, "jobmill-tests")
SESSION.conf.set("spark.sql.shuffle.partitions", "4")
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION
