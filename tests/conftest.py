import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskledger.operators.cleaning import repair_and_derive  # noqa: E402
from riskledger.schema import RAW_COLUMNS, RAW_SCHEMA  # noqa: E402
from riskledger.session import build_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        8,
        **{
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "shared"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def payments(spark):
    """Raw payments from partial rows; every column not given has an ordinary value."""
    ordinary = {
        "transaction_id": "TXN00000001",
        "customer_id": "CUST000001",
        "merchant_id": "MERCH00001",
        "transaction_datetime": dt.datetime(2024, 1, 3, 12, 0),
        "transaction_amount": 10.0,
        "payment_method": "ACH",
        "channel": "In-Store",
        "device_type": "Desktop",
        "merchant_category": "Retail",
        "customer_location": "TX",
        "transaction_status": "Approved",
        "failure_reason": "None",
        "processor_response_ms": 100,
        "is_fraud": 0,
        "is_chargeback": 0,
    }

    def build(*rows):
        filled = []
        for i, row in enumerate(rows):
            base = {**ordinary, "transaction_id": f"TXN{i:08d}"}
            filled.append(tuple({**base, **row}[c] for c in RAW_COLUMNS))
        return spark.createDataFrame(filled, RAW_SCHEMA)

    return build


@pytest.fixture(scope="session")
def clean(payments):
    """Clean payments from partial rows, identical rows kept."""
    return lambda *rows: repair_and_derive(payments(*rows))
