from __future__ import annotations

import os
import tempfile

import pytest

from indicator_engine.session import build_session

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    home = tempfile.mkdtemp(prefix="indicator-tests-")
    session = build_session(
        "tests",
        f"local[{os.cpu_count()}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=f"{home}/warehouse",
        spark__checkpoint__dir=f"{home}/shared",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return f"{TESTDATA}/sf0.01"
