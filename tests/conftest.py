import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskloom.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    checkpoints = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(4, "tests", "6g", **{"spark.checkpoint.dir": checkpoints, "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


FACT = (
    "transaction_id string, customer_id string, device_id string, txn_timestamp timestamp, amount decimal(12,2), "
    "merchant_category string, channel string, city string, state string, latitude double, longitude double, "
    "is_fraud boolean, fraud_scenario string"
)
START = datetime(2026, 1, 1, 12)


@pytest.fixture
def make_fact(spark):
    """Rows given as dicts over sensible defaults."""
    from decimal import Decimal

    def make(rows):
        full = []
        for i, r in enumerate(rows):
            row = {
                "transaction_id": f"T{i:04d}", "customer_id": "C1", "device_id": "D1", "txn_timestamp": START,
                "amount": "10.00", "merchant_category": "gas", "channel": "online", "city": "A", "state": "01",
                "latitude": 0.0, "longitude": 0.0, "is_fraud": False, "fraud_scenario": None, **r,
            }
            row["amount"] = None if row["amount"] is None else Decimal(row["amount"])
            if "after" in row:
                row["txn_timestamp"] = START + timedelta(microseconds=round(row.pop("after") * 1e6))
            full.append(row)
        names = [f.split(" ")[0] for f in FACT.split(", ")]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in full], FACT)

    return make


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [("C1", 0.0, 0.0), ("C2", 10.0, 10.0), ("C3", 0.0, 0.0)],
        "customer_id string, home_latitude double, home_longitude double",
    )
