import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", app_name="strata-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture
def scratch():
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def land_page(root, dataset, endpoint, season, offset, total, container_path, records,
              envelope_key="MRData"):
    """Write one landed API page the way a fetcher would."""
    inner = records
    for key in reversed(container_path):
        inner = {key: inner}
    payload = {envelope_key: {"total": str(total), "limit": "30", "offset": str(offset), **inner}}
    folder = f"{root}/{dataset}/{endpoint}/season={season}/offset={offset}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/page.json", "w") as fh:
        json.dump(payload, fh, indent=2)
