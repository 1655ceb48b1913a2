import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from boxloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


BOX_COLUMNS = "image_id string, class_id int, x1 double, y1 double, x2 double, y2 double"


@pytest.fixture(scope="session")
def boxes(spark):
    """Boxes from tuples (id, image, class, x1, y1, x2, y2, score)."""

    def make(rows, ident="det_id", size=(1920, 1080)):
        schema = f"{ident} bigint, {BOX_COLUMNS}, score double, width int, height int"
        return spark.createDataFrame([(*r, *size) for r in rows], schema)

    return make
