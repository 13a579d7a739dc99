import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from seawake.session import ensure_checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        cpus=4,
        partitions=4,
        memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__ui__showConsoleProgress="false",
    )
    ensure_checkpoint_dir(session)
    yield session
    session.stop()
