import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from quillframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def people(spark, tmp_path):
    """Three people, one without an age."""
    path = tmp_path / "people.json"
    path.write_text('{"name":"Michael"}\n{"name":"Andy","age":30}\n{"name":"Justin","age":19}\n')
    return str(path)


def values(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
