import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from prefspark.session import local_session

    s = local_session(4, shuffle_partitions=8, app="prefspark-tests")
    yield s


@pytest.fixture()
def tmp(tmp_path_factory):
    return str(tmp_path_factory.mktemp("pf"))


def rows(df, order=None):
    return [r.asDict(recursive=True) for r in (df.orderBy(*order) if order else df).collect()]
