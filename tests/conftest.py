import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cartolux.runtime import session

    s = session("tests", cores=8, **{"spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def rows():
    return lambda df, *cols: sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple((x is not None, str(type(x)), x) for x in t)) if cols else sorted((tuple(r) for r in df.collect()), key=str)
