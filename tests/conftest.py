import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from snapmart.session import checkpoint_root, local_session  # noqa: E402

T0 = dt.datetime(2024, 1, 1, 6, 0, 0)
T1 = dt.datetime(2024, 1, 2, 6, 0, 0)
T2 = dt.datetime(2024, 1, 3, 6, 0, 0)


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4)
    checkpoint_root(s)
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)
