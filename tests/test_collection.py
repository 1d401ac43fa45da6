"""FeatureCollections read in splits against the standard JSON parser."""
import json
import os
import random

import pytest

from trackwise.sources import files as FS
from trackwise.sources.collection import collection_features


def _collection(rng, n):
    odd = ["a}b", "{", '"', "\\", '\\"', "}{", "[", "]", "null", "é\U0001F600", "x" * 30, "", '"features":[{', "\n"]
    text = lambda: "".join(rng.choice(odd) for _ in range(rng.randrange(4)))
    deep = lambda k: {text() + str(i): deep(k - 1) if rng.random() < 0.5 and k else text() for i in range(rng.randrange(3))}

    def feature():
        f = {"type": "Feature", "properties": deep(3), "geometry": {"type": "Point", "coordinates": [rng.random(), rng.random()]}}
        if rng.random() < 0.3:
            f["id"] = rng.choice([text() + "k", rng.randrange(99)])
        return f if rng.random() < 0.9 else None
    doc = {"type": "FeatureCollection", "na}me": text()}
    if rng.random() < 0.6:
        doc["crs"] = {"type": "name", "properties": {"features": [{"type": text()}]}}
        doc["others"] = [{"no": text()}, None, {"no": {"deep}": 1}}]
        doc["bbox"] = [1, 2, None, 4]
    doc["features"] = [feature() for _ in range(n)]
    if rng.random() < 0.6:
        doc["after}"] = [{"x": 1}, {}]
        doc["last"] = {"features": [{"type": "Feature"}]}
    return doc


@pytest.mark.parametrize("size", ["64", "300", "5000", "134217728"])
def test_any_split_size_gives_the_parsers_features(spark, tmpdir_path, size):
    rng = random.Random(7)
    want = {}
    for k, n in enumerate((0, 1, 2, 40, 40, 40)):
        doc = _collection(rng, n)
        body = json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2]))
        with open(os.path.join(tmpdir_path, f"c{k}.json"), "w", encoding="utf-8") as f:
            f.write(body + rng.choice(["", "\n"]))
        want |= {(f"c{k}.json", i): f for i, f in enumerate(doc["features"]) if f is not None}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        rows = collection_features(spark, os.path.join(tmpdir_path, "*.json")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == len(want) > 80
    assert {(os.path.basename(r.file), r.i): json.loads(r.text) for r in rows} == want


def test_other_documents_have_no_features(spark, tmpdir_path):
    for k, body in enumerate(['{"type":"Feature","geometry":{"type":"Point","coordinates":[1,2]}}', '{"features":[]}', '{"features":null}', "{}", "",
                              '{"features":[null],"x":{"y":{}}}', '{"a":"\\"features\\":[","b":{"type":"Feature"}}']):
        with open(os.path.join(tmpdir_path, f"o{k}.json"), "w") as f:
            f.write(body)
    assert FS.read_geojson(spark, os.path.join(tmpdir_path, "*.json"), "x").count() == 0


def test_long_strings_and_written_collections(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "long.json")
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "id": str(i), "properties": {"note": '\\"}{é' * 40_000}, "geometry": {"type": "Point", "coordinates": [i, 2]}} for i in range(3)]}
    with open(p, "w") as f:
        json.dump(doc, f)
    got = FS.read_geojson(spark, p, "l")
    assert {(r.feature_id, len(r.tags["note"]), r.minx) for r in got.collect()} == {(str(i), 200_000, float(i)) for i in range(3)}
    out = os.path.join(tmpdir_path, "out")
    FS.write_geojson(got, out, 2)
    again = FS.read_geojson(spark, f"{out}/b=*/*.txt", "l")
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))
