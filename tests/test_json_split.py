import json
import random

import pytest

from meshroad.sources.geojson import read_zip_polygons, unreadable_features, read_features
from meshroad.sources.json_split import array_objects

NASTY = ['}', '{"', '"}', '\\', '\\"}', '}{', '",{', 'ü}€', '[{', '', 'plain', '\\\\}', ':{', '\n}\t']


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def random_object(rnd, deep=0):
    value = lambda: rnd.choice([rnd.choice(NASTY), rnd.random(), None, [1, [2.5, rnd.choice(NASTY)]], {}, [{}], [[]]])
    return {rnd.choice(NASTY) + str(k): random_object(rnd, deep + 1) if deep < 3 and rnd.random() < 0.4 else value() for k in range(rnd.randrange(4))}


def random_document(rnd):
    doc = {}
    for k in range(rnd.randrange(1, 5)):
        doc[rnd.choice(NASTY) + str(k)] = rnd.choice([rnd.choice(NASTY), 3, random_object(rnd), [], [1, 2]])
    doc["features"] = [random_object(rnd) for _ in range(rnd.randrange(0, 25))]
    if rnd.random() < 0.5:
        doc["end"] = rnd.choice([random_object(rnd), rnd.choice(NASTY), [random_object(rnd)]])
    return doc


@pytest.mark.parametrize("block, documents", [(10**8, 12), (400, 12), (37, 4)])
def test_objects_of_arrays_equal_a_json_parser_wherever_the_text_is_cut(spark, tmp_path, small_blocks, block, documents):
    rnd, want = random.Random(5), {}
    for k in range(documents):
        doc = random_document(rnd)
        text = json.dumps(doc, indent=rnd.choice([None, 1]), ensure_ascii=rnd.random() < 0.5) + rnd.choice(["", "\n", " \n"])
        (tmp_path / f"d{k}.json").write_text(text, encoding="utf-8")
        want[f"d{k}.json"] = [x for v in doc.values() if isinstance(v, list) for x in v if isinstance(x, dict)]
    small_blocks(block)
    got = {}
    for r in sorted(array_objects(spark, str(tmp_path)).collect(), key=lambda r: r.place):
        got.setdefault(r.file.rpartition("/")[2], []).append(json.loads(r.text))
    assert got == {k: v for k, v in want.items() if v}


def feature(zip_code, x, **more):
    ring = [[x, 30.0], [x + 1, 30.0], [x + 1, 31.0], [x, 31.0], [x, 30.0]]
    return {"type": "Feature", "properties": {"ZCTA5CE10": zip_code, **more}, "geometry": {"type": "Polygon", "coordinates": [ring]}}


def test_a_document_is_read_by_many_tasks_like_lines_are(spark, tmp_path, small_blocks):
    features = [feature(str(70000 + k), -100.0 + k / 50, name='odd } "name" {' * (k % 4)) for k in range(300)]
    doc = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x}"}}, "links": [{"href": "y"}], "features": features}
    (tmp_path / "z.json").write_text(json.dumps(doc))
    (tmp_path / "z.jsonl").write_text("\n".join(map(json.dumps, features)))
    small_blocks(8_000)
    assert spark.read.option("lineSep", "}").text(str(tmp_path / "z.json")).rdd.getNumPartitions() > 4
    rows = [sorted((r.zip, str(r.mp)) for r in read_zip_polygons(spark, str(tmp_path / f"z.{e}"), line_delimited=e == "jsonl").collect()) for e in ("json", "jsonl")]
    assert rows[0] == rows[1] and len(rows[0]) == 300


def test_what_is_no_feature_is_left_out_and_what_cannot_be_read_fails(spark, tmp_path):
    good = json.dumps(feature("78701", -98.0))
    (tmp_path / "cut.json").write_text('{"type": "FeatureCollection", "features": [' + good + ', {"type": "Feature", "properties": {"ZCTA5CE10": "1"}, "geometry": {"type": "Polygon", "coordinates": [[[1, 2')
    with pytest.raises(ValueError):
        read_zip_polygons(spark, str(tmp_path / "cut.json"))
    assert [r.zip for r in read_zip_polygons(spark, str(tmp_path / "cut.json"), unreadable="drop").collect()] == ["78701"]
    (tmp_path / "none.json").write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": null, "geometry": null}, {"id": 1}]}')
    features = read_features(spark, str(tmp_path / "none.json"))
    assert features.count() == 1 and unreadable_features(features).count() == 1
    (tmp_path / "empty.json").write_text('{"type": "FeatureCollection", "features": []}')
    assert read_zip_polygons(spark, str(tmp_path / "empty.json")).count() == 0
