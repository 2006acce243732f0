import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session, scratch_dir
    s = get_session("local[4]", app="tessera-tests", shuffle_partitions=8)
    scratch_dir(s)  # tests set their own checkpoint folder when none is configured
    yield s
    s.stop()


# The six authority rows quoted as goldens (FIXTURES.md §2).
AUTHORITY_ROWS = [
    (372354, "Africa", "Zimbabwe", "Masvingo", "Bikita Distr."),
    (217493, "Asia", "Japan", "Aomori", "Kamikita-gun"),
    (218022, "Asia", "Japan", "Kumamoto", "Ashikita-gun"),
    (373035, "Africa", "Ethiopia", None, "Mirab Harerge (Zone)"),
    (375150, "Africa", "Ethiopia", "Oromia", "Mirab Shewa (Zone)"),
    (1036733, "Asia", "China", "Fujian", "Putian (City)"),
]
AUTH_SCHEMA = "irn_eluts bigint, continent string, country string, state_province string, county string"


@pytest.fixture(scope="session")
def golden_authority(spark):
    return spark.createDataFrame(AUTHORITY_ROWS, AUTH_SCHEMA)
