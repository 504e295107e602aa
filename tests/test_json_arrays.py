"""Arrays in JSON files, cut at every place that a split can cut."""

from __future__ import annotations

import json
import random

import pytest

from harbormill.sources.json_arrays import json_array_records, read_json_arrays

SPLITTING = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


@pytest.fixture
def split_bytes(spark):
    before = [spark.conf.get(k) for k in SPLITTING]

    def set_to(size: str) -> None:
        spark.conf.set(SPLITTING[0], size)
        spark.conf.set(SPLITTING[1], "0")

    yield set_to
    for key, value in zip(SPLITTING, before, strict=True):
        spark.conf.set(key, value)


def _text(rng):
    return "".join(rng.choice('ab{}[]",:\\\n é') for _ in range(rng.randrange(40)))


def _value(rng, depth=0):
    kind = rng.random()
    if kind < 0.5 or depth > 2:
        return _text(rng)
    if kind < 0.8:
        return [_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {_text(rng): _value(rng, depth + 1) for _ in range(rng.randrange(3))}


@pytest.mark.parametrize("size", ["700", "9k", "128m"])
def test_records_do_not_depend_on_the_splits(spark, tmp_path, split_bytes, size):
    rng = random.Random(5)
    expected = []
    for n, indent in enumerate([None, 1, None]):
        objects = [{"Id": 1000 * n + i, ("Title" if i % 2 else "TITLE"): _text(rng), "more": _value(rng)} for i in range(120)]
        (tmp_path / f"f{n}.json").write_text(json.dumps(objects, indent=indent, ensure_ascii=n == 1) + "\n" * n)
        expected += objects
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text(" [ ]\n")
    split_bytes(size)
    got = [json.loads(r.record) for r in json_array_records(spark, str(tmp_path)).collect()]
    assert sorted(got, key=lambda o: o["Id"]) == expected
    read = read_json_arrays(spark, str(tmp_path), "id int, title string").collect()
    assert sorted(tuple(r) for r in read) == [(o["Id"], o.get("Title", o.get("TITLE"))) for o in expected]


def test_a_file_is_read_by_several_tasks(spark, tmp_path, split_bytes):
    objects = [{"id": i, "t": "x" * 500} for i in range(2000)]
    (tmp_path / "one.json").write_text(json.dumps(objects))
    split_bytes("64k")
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
    assert read_json_arrays(spark, str(tmp_path), "id bigint").agg({"id": "sum"}).first()[0] == sum(range(2000))


@pytest.mark.parametrize(
    "text",
    ['[{"a":1},{"b":2', '[{"a":1}', '{"a":1}', '[{"a":1}] x', '[1,{"a":1}]', '[{"a":1},,{"a":2}]', '[{"a":"x}]', '{"a":1}\n{"a":2}\n'],
)
def test_what_is_no_array_of_objects_fails(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="not one array of objects|MALFORMED|Malformed|parse|JSON"):
        read_json_arrays(spark, str(tmp_path), "a bigint").collect()


def test_keys_in_any_case_and_values_that_do_not_fit(spark, tmp_path):
    (tmp_path / "a.json").write_text('\ufeff[{"A": 1, "a": 2}, {"a": "x"}, {"b": 3}, {"a": null},{}]')
    assert sorted([r.a for r in read_json_arrays(spark, str(tmp_path), "A bigint").collect()], key=str) == [1, None, None, None, None]
