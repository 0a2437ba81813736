"""One JSON object read by many tasks."""
import json
import random

import pytest

from spendframe.sources.json_object import _pieces, read_entries
from spendframe.sources.raw import read_json_map, read_label_map


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def awkward(rng, n):
    pieces = ['a', ',', ', ', '"', '\\', '{', '}', '[', ']', ':', ' ', 'é', '日本', '\n', '\t', '": "', '"},{"', '\\"']
    text = lambda: "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
    return {f"{i}{text()}": text() for i in range(n)}


def written(folder, obj, form):
    path = f"{folder}/x.json"
    with open(path, "w", encoding="utf-8") as f:
        if form == "lines":
            f.write("\n".join(json.dumps({k: v}, ensure_ascii=False) for k, v in obj.items()) + "\n")
        else:
            json.dump(obj, f, ensure_ascii=False, indent=form, separators=(",", ":") if form is None else None)
    return path


@pytest.mark.parametrize("form", [None, 1, "lines"])
def test_one_object_by_many_tasks(spark, small_splits, tmpdir_fresh, form):
    """Strings hold commas, quotes, braces and backslashes, and cross the borders of splits."""
    obj = awkward(random.Random(1), 300)
    path = written(tmpdir_fresh, obj, form)
    assert _pieces(spark, path).rdd.getNumPartitions() > 8
    assert {r.key: r.value for r in read_json_map(spark, path).collect()} == obj


def test_object_under_a_name(spark, small_splits, tmpdir_fresh):
    obj = {str(i): random.Random(i).choice(["Yes", "No"]) for i in range(400)}
    for root in ({"target": obj}, {"source": "a, b", "made": {"by": [1, 2]}, "target": obj}):
        got = read_label_map(spark, written(tmpdir_fresh, root, None)).collect()
        assert {r.id: r.label for r in got} == obj and len(got) == len(obj)


def test_nested_values_and_numbers(spark, small_splits, tmpdir_fresh):
    obj = {f"k{i}": {"a": [i, {"b": "x,}"}], "c": None} for i in range(60)}
    got = {r.key: json.loads(r.value) for r in read_json_map(spark, written(tmpdir_fresh, obj, None)).collect()}
    assert got == obj
    numbers = {f"k{i}": i for i in range(200)}
    got = read_entries(spark, written(tmpdir_fresh, numbers, None), (), "bigint").collect()
    assert {r.key: r.value for r in got} == numbers


def test_empty_object_and_repeated_keys(spark, tmpdir_fresh):
    with open(f"{tmpdir_fresh}/x.json", "w") as f:
        f.write('{}\n{"a": "1", "a": "2"}\n{ }\n')
    assert sorted(read_json_map(spark, f"{tmpdir_fresh}/x.json").collect()) == [("a", "1"), ("a", "2")]


@pytest.mark.parametrize("text", [
    '{"a": "1", "b" "2"}', '{"a": "1", "b": "2"', '{"a": "1", "b": "2}', '{"a": "1",, "b": "2"}', '{"a": "1", b}',
    '{"a": "1", "b": "2"}}'])
def test_broken_entries_and_files_fail(spark, small_splits, tmpdir_fresh, text):
    with open(f"{tmpdir_fresh}/x.json", "w") as f:
        f.write(text)
    with pytest.raises(Exception, match="JSON object|no entr"):
        read_json_map(spark, f"{tmpdir_fresh}/x.json").collect()
