import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    wh = tempfile.mkdtemp(prefix="tessera-wh-", dir=os.environ.get("TMPDIR", "/tmp"))
    s = get_session("local[4]", 4, extra={"spark.sql.warehouse.dir": wh})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tessera-test-", dir=os.environ.get("TMPDIR", "/tmp"))


def write_jsonl(folder: str, records: list[dict], name: str = "part-0.json") -> str:
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")
    return folder


def change(event, seq, new=None, old=None, time="2024-01-01T00:00:00Z"):
    rec = {"eventName": event, "eventTime": time, "dynamodb": {"SequenceNumber": str(seq)}}
    if new is not None:
        rec["dynamodb"]["NewImage"] = new
    if old is not None:
        rec["dynamodb"]["OldImage"] = old
    return rec


def user_image(uid="123", email="test@example.com", name="Test User", created=1704067200, **extra):
    img = {"PK": {"S": f"USER#{uid}"}, "SK": {"S": "PROFILE"}, "email": {"S": email}, "name": {"S": name},
           "created_at": {"N": str(created)}, "updated_at": {"N": str(created)}}
    img.update(extra)
    return img


def task_image(uid="123", tid="t1", status="pending", priority="medium", category="work", created=1704067200,
               updated=None, **extra):
    img = {"PK": {"S": f"TASK#{uid}"}, "SK": {"S": f"TASK#{tid}"}, "title": {"S": f"Title {tid}"},
           "status": {"S": status}, "priority": {"S": priority},
           "category": {"S": category} if category is not None else {"NULL": True},
           "created_at": {"N": str(created)}, "updated_at": {"N": str(updated or created)}}
    img.update(extra)
    return img
