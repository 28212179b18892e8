import json
import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventloom import hashed_id_profile, numeric_id_profile, prepare  # noqa: E402

# Invented catalog: the types of the fixture columns.
TYPES = {
    **dict.fromkeys(
        "session_id event_id version platform_id country_code device_type fb_id facebook_id "
        "purchase_origin slot_id slot_location".split(),
        "string",
    ),
    **dict.fromkeys(
        "purchase_count level vip_level balance bet_amount bingo_balls_balance "
        "last_unlocked_world last_activity_ts".split(),
        "long",
    ),
    **dict.fromkeys(
        "price purchase_amount local_price real_exchange_rate avg_bet total_bet".split(), "double"
    ),
    "blackdiamond_elite_active": "boolean",
    "spins_per_spinner": "array",
}


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("eventloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="eventloom-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def hashed():
    return hashed_id_profile("hashed game")


@pytest.fixture
def numeric():
    return numeric_id_profile("numeric game")


@pytest.fixture
def types():
    return dict(TYPES)


def packet(event_type="spin", ts=1704067200123, user_id="u1", **more):
    fields = {"event_type": event_type, "ts": ts, "user_id": user_id, **more}
    return json.dumps({k: v for k, v in fields.items() if v != "ABSENT"})


def put_file(root, date_hour, name, text):
    folder = root / date_hour
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text(text)
    return path
