import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millwright.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[4]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def clean(spark):
    """The small fleet, computed once."""
    from millwright.session import stage
    from millwright.sources.lineitem_fleet import observations

    return stage(observations(spark, SMALL), "test-fleet")


CLEAN_SCHEMA = (
    "machine_id long, product_id string, type_code string, air_temperature_k double, process_temperature_k double, "
    "rotational_speed_rpm int, torque_nm double, tool_wear_min int, machine_failure int, TWF int, HDF int, PWF int, "
    "OSF int, RNF int"
)


@pytest.fixture(scope="session")
def rows(spark):
    """Build clean rows from overrides of one ordinary machine."""
    def build(*overrides):
        base = dict(machine_id=0, product_id="", type_code="M", air_temperature_k=298.1, process_temperature_k=308.6,
                    rotational_speed_rpm=1551, torque_nm=42.8, tool_wear_min=0, machine_failure=0,
                    TWF=0, HDF=0, PWF=0, OSF=0, RNF=0)
        out = []
        for i, override in enumerate(overrides, start=1):
            row = {**base, "machine_id": i, **override}
            row["product_id"] = row["product_id"] or f"{row['type_code']}{10000 + row['machine_id']}"
            out.append(tuple(row.values()))
        return spark.createDataFrame(out, CLEAN_SCHEMA)
    return build
