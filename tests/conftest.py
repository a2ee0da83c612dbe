import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (SparkSession.builder.master("local[8]").appName("barsmith-tests")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(home / "shared"))
               .config("spark.sql.warehouse.dir", str(home / "warehouse")).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    from barsmith.session import configure

    yield configure(session)
    session.stop()


@pytest.fixture
def table_name(request):
    """A table name of the test's own."""
    return lambda label: f"{label}_{abs(hash(request.node.nodeid)) % 10**9}"


def rows(df, *columns):
    """The rows as sorted tuples, NULLs last."""
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()),
                  key=lambda t: tuple((v is None, 0 if v is None else v) for v in t))
