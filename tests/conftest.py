import contextlib
import io

import pytest

from isobar.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="6g", app="isobar-tests")
    yield session
    session.stop()


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
