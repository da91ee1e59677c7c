import os

import pytest

SF = os.environ.get("TEST_LLM_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def sf():
    """The smallest tables that hold secrets and junk of every kind."""
    if not os.path.isdir(SF):
        pytest.skip("test tables are not here")
    return SF
