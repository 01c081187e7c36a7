"""Envelopes read in splits give what a reader of the whole file gives."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tallyspan.sources import readers

SCHEMA = "status string, result array<struct<handle: string, rating: int, tags: array<string>, home: struct<city: string, at: array<struct<x: int>>>>>"


def whole(spark, path):
    return readers.json_array(spark, path, SCHEMA).select(F.explode("result").alias("r")).select("r.*")


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def small_splits(spark):
    for k, v in {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}.items():
        spark.conf.set(k, v)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


ODD = ['a}b', 'a{b', '"quoted"', "back\\", '\\"}{', "new\nline", '},{"handle":"no"', "", "ünï 中文", '"result":[{', "x" * 700]


def envelope(seed, n, **more):
    rnd = random.Random(seed)
    text = lambda: rnd.choice(ODD)
    some = [{"handle": f"{i}{text()}", "rating": rnd.choice([None, i]), "other": {"deep": {"er": text()}}, "tags": [text() for _ in range(rnd.randint(0, 3))], "home": rnd.choice([None, {}, {"city": text(), "at": [{"x": 1}, {}]}])} for i in range(n)]
    return {"comment": text(), "meta": {"handle": "no", "in": {}}, "before": [{"handle": "no"}, 5, {}], "numbers": [1, 2], "status": "OK", "result": some} | more | {"after": [{"handle": "no"}], "end": {"result": [{"handle": "no"}]}}


@pytest.mark.parametrize("seed", range(4))
def test_splits_at_any_byte(spark, tmp_path, small_splits, seed):
    for name, n in (("a", 60), ("b", 7)):
        (tmp_path / f"{name}.json").write_text(json.dumps(envelope(seed, n), indent=seed % 3 or None, ensure_ascii=seed % 2 == 0))
    for path in (f"{tmp_path}/a.json", str(tmp_path)):
        got = readers.json_envelope(spark, path, SCHEMA, "result")
        assert rows(got) == rows(whole(spark, path)) and got.count() == (60 if path.endswith("a.json") else 67)
    assert spark.read.option("lineSep", "}").text(f"{tmp_path}/a.json").rdd.getNumPartitions() > 8


def test_fields_without_elements(spark, tmp_path, small_splits):
    for name, x in {"none": {}, "null": {"result": None}, "empty": {"result": []}, "scalars": {"result": [1, "a"]}, "one": {"result": [{"handle": "h"}]}}.items():
        (tmp_path / name).write_text(json.dumps({"a": [{"handle": "no"}]} | x | {"z": {"handle": "no"}}))
        got = [r.handle for r in readers.json_envelope(spark, str(tmp_path / name), SCHEMA, "result").collect()]
        assert got == (["h"] if name == "one" else [])
    (tmp_path / "nothing").write_text("")
    assert readers.json_envelope(spark, str(tmp_path / "nothing"), SCHEMA, "result").count() == 0
