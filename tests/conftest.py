import os

import pytest

os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from spindrift.sources.session import local_session

    session = local_session(4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
