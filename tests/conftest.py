from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sievewell import schemas  # noqa: E402
from sievewell.plans.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=4, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(params=["true", "false"], ids=["ansi", "no-ansi"])
def either_mode(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture
def raw_frame(spark):
    def build(*records):
        return spark.createDataFrame(list(records), schemas.RAW_RECORD_SCHEMA)

    return build


@pytest.fixture
def event_frame(spark):
    def build(*events):
        return spark.createDataFrame(list(events), schemas.RAW_EVENT_SCHEMA)

    return build
