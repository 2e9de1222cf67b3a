import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from feedpulse.session import local_session  # noqa: E402
from feedpulse.sources.schema import FEED_ACTIONS, MESSAGE_ACTIONS  # noqa: E402

SMALL = "/root/testdata/sf0.01"
DEFAULTS = {
    "post_id": 1,
    "gender": 1,
    "age": 30,
    "country": "c",
    "city": "t",
    "os": "iOS",
    "source": "ads",
    "exp_group": 0,
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(8, "tests", spark__sql__warehouse__dir=str(warehouse))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_feed(spark):
    """feed_actions from (user_id, action, 'YYYY-mm-dd HH:MM') tuples, with optional overrides."""

    def make(*rows):
        return spark.createDataFrame([_row(FEED_ACTIONS, "action", r) for r in rows], FEED_ACTIONS)

    return make


@pytest.fixture(scope="session")
def make_messages(spark):
    """message_actions from (user_id, receiver_id, 'YYYY-mm-dd HH:MM') tuples, with overrides."""

    def make(*rows):
        return spark.createDataFrame(
            [_row(MESSAGE_ACTIONS, "receiver_id", r) for r in rows], MESSAGE_ACTIONS
        )

    return make


def _row(schema, second, row):
    user, value, at, *rest = row
    when = datetime.strptime(at if " " in at else f"{at} 12:00", "%Y-%m-%d %H:%M")
    values = {**DEFAULTS, **(rest[0] if rest else {}), "user_id": user, second: value, "time": when}
    return tuple(values[name] for name in schema.fieldNames())


@pytest.fixture(scope="session")
def sample_feed(spark):
    from oracle.sample import feed_actions

    return feed_actions(spark, SMALL).cache()


@pytest.fixture(scope="session")
def sample_messages(spark):
    from oracle.sample import message_actions

    return message_actions(spark, SMALL).cache()
