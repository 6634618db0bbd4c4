import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("gridframe-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_grid(spark):
    """Grid of one sheet, or of several given as ``{(workbook, sheet, title): rows}``."""
    from gridframe.sources.schemas import GRID

    def build(rows, workbook="wb", sheet="0", title="Sheet1"):
        sheets = rows if isinstance(rows, dict) else {(workbook, sheet, title): rows}
        data = [(w, s, t, i, cells) for (w, s, t), lines in sheets.items() for i, cells in enumerate(lines)]
        return spark.createDataFrame(data, GRID)

    return build


@pytest.fixture
def lines():
    """Cells of a grid in row order, or ``{row_idx: cells}`` where rows are sparse."""

    def collect(grid, sparse=False):
        rows = grid.orderBy("workbook_id", "sheet_id", "row_idx").collect()
        return {r.row_idx: r.cells for r in rows} if sparse else [r.cells for r in rows]

    return collect
