from __future__ import annotations

import pytest

from reelhouse.sources import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(app="reelhouse-tests", memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
