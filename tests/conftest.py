import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tramline.session import get_spark
    s = get_spark("local[8]", 8, app="tramline-tests")
    # tiny chunk threshold: every multi-row key is split, so the chunk-edge
    # logic of the sequence operators is exercised by every test
    s.conf.set("tramline.sequence.chunkRows", "4")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def seed_dir():
    from tests.fixtures.network import write_seeds
    folder = tempfile.mkdtemp(prefix="tramline-seeds-")
    write_seeds(folder)
    return folder


@pytest.fixture(scope="session")
def shipped(spark, seed_dir):
    from tramline.plans.seeded import load_seed_folder
    return load_seed_folder(spark, seed_dir)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tramline-test-")
