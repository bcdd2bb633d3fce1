import sys
from datetime import date
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from innmetrics import Config, MarketTables  # noqa: E402
from innmetrics.plans.pipeline import Marketplace  # noqa: E402
from innmetrics.session import local_session  # noqa: E402
from innmetrics.sources.tables import SCHEMAS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "8", app="tests", **{"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "2"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DEFAULTS = {
    "properties": [(n, f"stay {n}", "house", 50.0, n % 2, 1) for n in range(1, 40)],
    "destinations": [(0, "Bergen", "Norway"), (1, "Porto", "Portugal")],
    "hosts": [(1, "Ada", 4.5, True)],
}


@pytest.fixture
def market(spark):
    def build(config: Config | None = None, **rows) -> Marketplace:
        tables = {
            name: spark.createDataFrame(rows.get(name, DEFAULTS.get(name, [])), schema)
            for name, schema in SCHEMAS.items()
        }
        return Marketplace(MarketTables(**tables), config or Config(as_of=date(2024, 1, 20)))

    return build
