import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from revbridge.plans.registry import close_plans
    from revbridge.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, shared_dir=str(tmp_path_factory.mktemp("shared")))
    yield s
    close_plans()
    s.stop()
