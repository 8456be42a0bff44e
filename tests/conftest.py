import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from panelweave.lineage import clear_scratch
    from panelweave.session import build_session

    session = build_session("tests", "local[8]", 4, **{"spark__driver__memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


def rows(df, *columns):
    """Sorted tuples of the given columns."""
    out = [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
