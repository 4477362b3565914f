from __future__ import annotations

import sys
from pathlib import Path

import pandas as pd
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SOURCE_COLUMNS = [
    "CustomerID", "Age", "Gender", "Tenure", "MonthlyCharges",
    "ContractType", "InternetService", "TotalCharges", "TechSupport", "Churn",
]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]")
        .appName("churnlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def f1_frame() -> pd.DataFrame:
    """Six raw customers with gaps (pandas writes integers with gaps as 61.0) and
    values on and beside the limits of the bands."""
    cells = [
        (101, 61, "Female", 36, 50.0, "One-Year", "DSL", 1800.0, "No", "Yes"),
        (102, None, "Male", 37, 50.01, None, None, None, None, "No"),
        (103, 29, None, 12, None, "Two-Year", "Fiber Optic", 95.5, "Yes", None),
        (104, 45, "Male", 13, 100.0, "Month-to-Month", "DSL", 1300.0, "Yes", "Yes"),
        (105, 36, "Female", None, 100.5, "Two-Year", None, 0.0, None, "yes"),
        (106, None, "Male", 1, 149.49, "One-Year", "Fiber Optic", 149.49, "No", "No"),
    ]
    return pd.DataFrame(cells, columns=SOURCE_COLUMNS)


@pytest.fixture
def f1_csv(tmp_path) -> str:
    path = tmp_path / "customers.csv"
    f1_frame().to_csv(path, index=False)
    return str(path)


@pytest.fixture
def paths(tmp_path):
    return {
        "staging": str(tmp_path / "staging"),
        "production": str(tmp_path / "production"),
        "metrics": str(tmp_path / "metrics"),
    }


def write_csv(tmp_path, frame: pd.DataFrame, name: str = "data.csv") -> str:
    path = tmp_path / name
    frame.to_csv(path, index=False)
    return str(path)
