import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
N15 = os.path.join(ROOT, "tests", "fixtures", "n15_points.txt")


@pytest.fixture(scope="session")
def spark():
    from tessera.session import checkpoint_root, local_session

    s = local_session(cores=8, shuffle_partitions=8, app="tessera-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def n15(spark):
    """The 15-point fixture; id = line number (one small file, one partition, read in order)."""
    from tessera.sources.points import parse_points

    return parse_points(spark.read.text(N15).coalesce(1)).cache()


@pytest.fixture(scope="session")
def xy15():
    with open(N15) as f:
        return [tuple(float(v) for v in line.split(",")) for line in f]
