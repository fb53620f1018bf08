import pytest

from rillworks.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "rillworks-tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__bindAddress="127.0.0.1",
        spark__driver__host="127.0.0.1",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
