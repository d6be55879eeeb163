import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)


@pytest.fixture(scope="session")
def spark():
    from qualia.session import local_session

    s = local_session("*", shuffle_partitions=8, app="qualia-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def catalog(spark):
    from qualia import default_catalog

    return default_catalog(spark, [("COM_PREDICADO", "conformidad", "predicado", "satisfies()"),
                                   ("COM_NULOS_LISTA", "completitud", "nulos", "collectNulls()")])
