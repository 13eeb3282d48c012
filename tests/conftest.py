import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
os.environ["PYTHONPATH"] = os.path.dirname(os.path.dirname(__file__)) + os.pathsep + os.environ.get("PYTHONPATH", "")
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="session")
def spark():
    from lontar.session import local_session

    session = local_session(cores=4, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()
