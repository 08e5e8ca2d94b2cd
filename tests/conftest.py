from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from tripmart.schema import RAW_TRIP  # noqa: E402

BASE_ROW = {
    "VendorID": 1,
    "tpep_pickup_datetime": datetime(2023, 1, 15, 10, 0),
    "tpep_dropoff_datetime": datetime(2023, 1, 15, 10, 30),
    "passenger_count": 1.0,
    "trip_distance": 2.5,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 100,
    "DOLocationID": 200,
    "payment_type": 1,
    "fare_amount": 15.0,
    "extra": 0.0,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 19.3,
    "congestion_surcharge": 0.0,
    "airport_fee": 0.0,
}


@pytest.fixture(scope="session")
def spark():
    from tripmart.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="tripmart-tests")
    yield s
    s.stop()


def make_raw(spark, rows: list[dict], month: str = "2023-01"):
    """Raw trip frame from partial rows (missing fields from BASE_ROW), numbered 1..n."""
    data = []
    for i, r in enumerate(rows, start=1):
        full = {**BASE_ROW, **r}
        data.append(tuple(full[f.name] for f in RAW_TRIP.fields) + (i, month))
    from pyspark.sql import types as T

    schema = T.StructType(
        RAW_TRIP.fields + [T.StructField("source_row_number", T.LongType()), T.StructField("source_month", T.StringType())]
    )
    return spark.createDataFrame(data, schema)


# F2: the six-row pipeline fixture (rate 1, flag N, zones 1 -> 1, optional money 0.0).
def f2_rows():
    def row(v, p, d, pas, dist, pay, fare, total):
        return {
            "VendorID": v, "tpep_pickup_datetime": p, "tpep_dropoff_datetime": d, "passenger_count": pas,
            "trip_distance": dist, "RatecodeID": 1.0, "PULocationID": 1, "DOLocationID": 1, "payment_type": pay,
            "fare_amount": fare, "extra": 0.0, "mta_tax": 0.0, "tip_amount": 0.0, "tolls_amount": 0.0,
            "improvement_surcharge": 0.0, "total_amount": total, "congestion_surcharge": 0.0, "airport_fee": 0.0,
        }

    d = datetime
    return [
        row(1, d(2023, 1, 1, 1, 0), d(2023, 1, 1, 1, 10), 1.0, 1.0, 1, 15.0, 20.0),
        row(2, d(2023, 1, 1, 1, 1), d(2023, 1, 1, 1, 11), 1.0, 2.0, 2, 30.0, 35.0),
        row(99, d(2023, 1, 2, 9, 0), d(2023, 1, 2, 9, 15), 1.0, 3.0, 99, 45.0, 50.0),
        row(1, d(2023, 1, 3, 10, 0), d(2023, 1, 3, 10, 5), 1.0, 0.0, 1, 10.0, 10.0),
        row(1, d(2023, 1, 4, 11, 0), d(2023, 1, 4, 11, 5), 1.0, 1.0, 1, -1.0, 0.0),
        row(2, d(2023, 1, 31, 23, 50), d(2023, 2, 1, 0, 10), 2.0, 4.0, 2, 60.0, 65.0),
    ]


@pytest.fixture()
def scratch(spark, tmp_path):
    return str(tmp_path)
