import json
import os

import pytest

from tallyspan import config
from tallyspan.collection import progress, requests
from tallyspan.functions.columns import shard
from tallyspan.sources import landing, readers


class Clock:
    def __init__(self):
        self.now, self.slept = 0.0, []

    def sleep(self, seconds):
        self.slept.append(seconds)
        self.now += seconds


def judge(answers, tries=10):
    clock, urls = Clock(), []

    def fetch(url, timeout):
        urls.append(url)
        a = answers.pop(0) if isinstance(answers, list) else answers(url)
        if isinstance(a, Exception):
            raise a
        return a

    pace = requests.Pace(2.0, clock=lambda: clock.now, sleep=clock.sleep)
    return requests.Judge("http://judge/", pace, tries=tries, fetch=fetch, sleep=clock.sleep), clock, urls


OK = lambda x: (200, json.dumps({"status": "OK", "result": x}))
FAILED = lambda c, status=400: (status, json.dumps({"status": "FAILED", "comment": c}))


def test_pace_waits_what_is_left():
    clock = Clock()
    pace = requests.Pace(2.0, clock=lambda: clock.now, sleep=clock.sleep)
    pace.wait()
    clock.now += 0.5
    pace.wait()
    clock.now += 5
    pace.wait()
    assert clock.slept == [1.5]
    with pytest.raises(ValueError):
        requests.Pace(0)


def test_retries_double_up_to_a_bound():
    j, clock, urls = judge([OSError("down"), FAILED("Call limit exceeded"), (502, "<html>"), (403, ""), FAILED("temporarily unavailable"), FAILED("call limit exceeded"), (500, ""), (500, ""), OK([1])])
    assert j.rated_users() == [1] and len(urls) == 9
    assert [s for s in clock.slept if s != 2.0] == [5, 10, 20, 40, 80, 160, 300, 300]
    assert urls[0] == "http://judge/user.ratedList?activeOnly=true&includeRetired=false"


@pytest.mark.parametrize("answers, kind, asked", [([FAILED("handle: not found")], requests.NotFound, 1), ([FAILED("bad field")], requests.JudgeError, 1), ([FAILED("call limit exceeded")] * 3, requests.Limited, 3), ([OSError("x")] * 3, requests.Unavailable, 3)])
def test_errors_have_kinds(answers, kind, asked):
    j, _, urls = judge(answers, tries=3)
    with pytest.raises(requests.JudgeError) as e:
        j.problemset("old")
    assert type(e.value) is kind and len(urls) == asked and urls[0].endswith("?problemsetName=old")


def test_a_collection_is_resumed(spark, tmp_path):
    """Whole users in pages; who is unknown is skipped, who failed is tried again,
    and a second run finds nothing to do."""
    from urllib.parse import parse_qs, urlparse

    down = {"cat"}

    def answer(url):
        q = {k: v[0] for k, v in parse_qs(urlparse(url).query).items()}
        if q["handle"] == "nobody":
            return FAILED("handle: User with handle nobody not found")
        if q["handle"] in down:
            return FAILED("field is wrong")
        first, n = int(q["from"]), {"_ann": 5, "bob": 4, "cat": 0}[q["handle"]]
        return OK([{"id": 100 * n + i, "author": {"members": [{"handle": q["handle"]}] * (1 + i % 2), "ghost": False}, "problem": {"contestId": 1, "index": "A"}} for i in range(first, min(n, first + 1) + 1)])

    j, _, urls = judge(answer)
    journal = progress.Journal(str(tmp_path / "p.jsonl"))
    members = [("_ann", "b", 1), ("bob", "a", None), ("cat", "a", 3), ("nobody", "a", 4)]
    assert journal.register(members) == 4 and journal.register(members[:2]) == 0
    assert [u["handle"] for u in journal.pending(1)] == ["bob", "_ann"]
    assert progress.collect(j, journal, str(tmp_path / "in"), page=2) == 9
    assert {h: u["state"] for h, u in journal.users.items()} == {"_ann": "done", "bob": "done", "cat": "error", "nobody": "skipped"}
    assert len([u for u in urls if "bob" in u]) == 3  # a last full page is followed by an empty one
    down.clear()
    with open(journal.path, "a") as f:
        f.write('{"handle": "bob", "state": "pen')  # a torn line
    again = progress.Journal(journal.path)
    assert again.users == journal.users and again.retry_errors() == 1 and again.users["cat"]["tries"] == 1
    assert progress.collect(j, again, str(tmp_path / "in"), page=2) == 0 and list(again.pending()) == []

    assert progress.Journal(journal.path).users == again.users

    raw = readers.json_lines(spark, landing.shard_globs(str(tmp_path / "in")), readers.ATTEMPT_JSON, name_as="handle")
    assert landing.audited(str(tmp_path / "in")) == 3
    assert {r.handle: r.n for r in raw.groupBy("handle").count().withColumnRenamed("count", "n").collect()} == {"_ann": 5, "bob": 4}
    rows = spark.createDataFrame([("_ann",)], "h string").select(shard("h").alias("s")).first()
    assert rows.s == landing.shard_of("_ann") and rows.s in os.listdir(tmp_path / "in")
    bands = {r.band: r for r in progress.by_band(progress.states(spark, journal.path)).collect()}
    assert (bands["a"].total, bands["a"].done, bands["a"].skipped, bands["a"].errors, bands["a"].rows) == (3, 2, 1, 0, 4)
    assert (bands["b"].rows, bands["b"].person_rows, bands["b"].pages) == (5, 2, 3)


def test_settings(tmp_path, monkeypatch):
    text = """[api]
base_url = "http://judge/"
min_interval_seconds = {0}
page_size = 1000
timeout_seconds = 60
max_attempts = 10
[cohort]
seed = 7
targets = {{ expert = 5 }}
[paths]
data_root = "/data"
"""
    (tmp_path / "c.toml").write_text(text.format(2.5))
    s = config.load(str(tmp_path / "c.toml"))
    assert (s.base_url, s.landing, s.warehouse, s.targets, s.keep_problem_name) == ("http://judge", "/data/user_status", "/data/warehouse", {"expert": 5}, True)
    monkeypatch.setenv(config.DATA_ROOT, "/else")
    monkeypatch.setenv(config.WAREHOUSE, "/w")
    assert (config.load(str(tmp_path / "c.toml")).journal, s.warehouse) == ("/else/progress.jsonl", "/w")
    (tmp_path / "c.toml").write_text(text.format(0.5))
    with pytest.raises(ValueError, match="below"):
        config.load(str(tmp_path / "c.toml"))
