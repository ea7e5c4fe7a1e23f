import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from punctua.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=4, app_name="punctua-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    """A fresh scratch folder per test (pytest creates a new one every time)."""
    return str(tmp_path)


def write(path: str, text: str, encoding: str = "utf-8") -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)
    return path
