from __future__ import annotations

import pytest

from tests.session import local_session


@pytest.fixture(scope="session", autouse=True)
def spark():
    session = local_session(cpus="4", memory="4g")
    yield session
    session.stop()


@pytest.fixture()
def schema_name(tmp_path):
    """A schema no other test uses."""
    return "s_" + "".join(c for c in tmp_path.name if c.isalnum()).lower() + str(abs(hash(str(tmp_path))) % 10**8)
