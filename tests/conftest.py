import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventflow.session import local_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # A folder of this run: stable checkpoint names must not meet those of an earlier run.
    s = local_session(4, shuffle_partitions=4, driver_memory="6g", extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="eventflow-tests-")})
    shared_dir(s, allow_local=True)
    yield s
    s.stop()

