"""JSON documents read in splits, against Python's own parser."""

import json
import random

import pytest

from tidemill.sources.pages import read_json_elements, read_json_pages


@pytest.fixture(params=[64, 1 << 20])
def block(spark, request):
    """Blocks of a few bytes, so that strings and elements cross many of them, and one block for all."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], str(request.param))
    spark.conf.set(names[1], "1")
    yield request.param
    for name, value in zip(names, old):
        spark.conf.set(name, value)


def some_value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind < 3:
        return "".join(rng.choice('ab{}[]",:\\ \né𝛼') for _ in range(rng.randrange(12)))
    if kind == 3:
        return rng.choice([None, True, 1.5, -3])
    if kind == 4:
        return [some_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f"k{i}{rng.choice('}{')}": some_value(rng, depth + 1) for i in range(rng.randrange(4))}


def write(path, value, **style):
    with open(path, "w", encoding="utf-8") as out:
        out.write(value if isinstance(value, str) else json.dumps(value, **style))


def texts(frame):
    return [json.loads(r["value"]) for r in frame.orderBy("_seq").collect()]


def test_arrays_objects_and_envelopes(spark, folder, block):
    rng = random.Random(block)
    for i, style in enumerate(({}, {"indent": 2, "ensure_ascii": False}, {"separators": (",", ":")})):
        elements = [{"id": n, "v": some_value(rng)} for n in range(25)]
        write(f"{folder}/array{i}.json", elements, **style)
        assert texts(read_json_elements(spark, f"{folder}/array{i}.json")) == elements
        around = {"meta": {"inner": {"orders": [{"id": 0}]}}, "empty": [], "note": '"orders":[{', "orders": elements, "next": {"a": {}}, "tags": ["x}"]}
        write(f"{folder}/page{i}.json", around, **style)
        if i:
            assert texts(read_json_elements(spark, f"{folder}/page{i}.json", "orders")) == elements
    write(f"{folder}/one.json", elements[3], indent=1)
    assert texts(read_json_elements(spark, f"{folder}/one.json")) == [elements[3]]
    several = read_json_elements(spark, [f"{folder}/array{i}.json" for i in range(3)])
    assert several.count() == 75 and several.select("_seq").distinct().count() == 75


def test_empty_documents(spark, folder):
    for i, (text, key) in enumerate((("", None), ("[]", None), (" [ ]\n", None), ('{"rows": []}', "rows"), ('{"n": 1, "rows": [ ] }\n', "rows"), (" {}\n", None))):
        write(f"{folder}/{i}.json", text)
        assert texts(read_json_elements(spark, f"{folder}/{i}.json", key)) == ([{}] if "{}" in text else [])


@pytest.mark.parametrize(
    ("text", "key"),
    [
        ('[{"a": 1}', None), ('[{"a": 1},', None), ('[{"a": "x}', None), ('[{"a": 1}, 5]', None), ('[5, {"a": 1}]', None), ("[1, 2]", None),
        ('{"rows": [{"a": 1}]', "rows"), ('{"other": 1}', "rows"), ('{"other": [{"a": 1}]}', "rows"),
        ('{"rows": [{"a": 1}], "more": [{"a": 2}]}', "rows"), ('{"more": [{"rows": [{"a": 2}]}], "rows": [{"a": 1}]}', "rows"),
    ],
)
def test_documents_that_fail(spark, folder, text, key):
    write(f"{folder}/bad.json", text)
    with pytest.raises(Exception, match="cut or malformed|not an array of objects"):
        read_json_elements(spark, f"{folder}/bad.json", key).collect()


def test_typed_rows_and_tasks(spark, folder, block):
    write(f"{folder}/p.json", {"orders": [{"id": n, "name": f"n{n}}}"} for n in range(40)]})
    rows = read_json_pages(spark, f"{folder}/p.json", "id int, name string", "orders")
    assert rows.columns == ["id", "name", "_seq"]
    assert [(r.id, r.name) for r in rows.orderBy("_seq").collect()] == [(n, f"n{n}}}") for n in range(40)]
    scans = spark.read.option("lineSep", "}").text(f"{folder}/p.json").rdd.getNumPartitions()
    assert (scans > 10) == (block == 64)
    with pytest.raises(Exception, match="MALFORMED|cannot be parsed|Malformed"):
        read_json_pages(spark, f"{folder}/p.json", "id boolean, name string", "orders").collect()
