import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from itemrollup.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="itemrollup-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="itemrollup-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_sources(spark):
    from itemrollup.sources import synthetic_sources

    return synthetic_sources(spark, SF_SMALL)


def rows(df, *cols, order=None):
    """Collect as a sorted list of tuples of ``cols``."""
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def frame(spark, like, data):
    """A DataFrame with ``like``'s schema from a list of dicts (missing keys are NULL)."""
    names = like.columns
    return spark.createDataFrame([tuple(d.get(n) for n in names) for d in data], like.schema)
