import tempfile

import pytest

from clicktrail.session import build_spark


@pytest.fixture(scope="session")
def spark():
    session = build_spark(
        "clicktrail-tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="clicktrail-warehouse-"),
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="clicktrail-shared-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
