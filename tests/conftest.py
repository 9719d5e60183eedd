import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from siteledger.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, "tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))}
    )
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
