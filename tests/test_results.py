"""Results of any kind survive; the release gate reports what it does not know."""

from __future__ import annotations

import pytest

from boxloom.constants import CAMERAS
from boxloom.operators import manifest as m
from boxloom.sources import results

LINES = [
    '{"id":1,"data":{"image_id":"i1",  "k":[1,2.50]},"annotations":[{"id":7,"was_cancelled":true,"completed_by":"a\\"b","lead_time":1.50,"result":'
    '[{"type":"rectanglelabels","id":"r","original_width":1000,"original_height":500,"score":0.5,"value":{"x":10,"y":20,"width":30,"height":40,"rectanglelabels":["Car"]}},'
    '{"b":{"y":1e2,"x":[ ]},"type":"sonar","a":"\\u00e9"}]},{"id":8,"result":[]}]}',
    '{"id":2,"data":{"image_id":"i2"},"annotations":[]}',
    '{"id":3,"data":{"image_id":"i3"},"annotations":[{"id":1,"result":[{"type":"rectanglelabels","value":{"x":"far","y":1,"width":2,"height":3}},{"type":"choices","id":"c","from_name":"q","value":{"choices":["A","B"]}},'
    '{"type":"polygonlabels","id":"p","original_width":200,"original_height":100,"value":{"points":[[10,20],[30,40]],"polygonlabels":["Road"]}},'
    '{"type":"keypointlabels","id":"k","original_width":200,"original_height":100,"value":{"x":50,"y":25,"keypointlabels":["Head"]}},"words",{"no":"type"},12]}]}',
    "no json at all",
]


@pytest.fixture
def rows(spark, tmp_path):
    path = str(tmp_path / "export")
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(path)
    return results.read_results(spark, path)


def test_every_byte_comes_back(spark, rows, tmp_path):
    results.write_results(rows, str(tmp_path / "again"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "again")).collect()) == sorted(LINES)


def test_kinds_are_counted_with_their_schema(rows):
    got = {(r["type"], r["known"]): r for r in results.result_types(rows).collect()}
    assert {k: r["results"] for k, r in got.items()} == {
        ("rectanglelabels", True): 2, ("sonar", False): 1, ("choices", True): 1, ("polygonlabels", True): 1, ("keypointlabels", True): 1, (None, False): 3}
    assert got[None, False]["unreadable"] == 1 and got["sonar", False]["unreadable"] == 0
    assert "b: OBJECT<x: ARRAY" in got["sonar", False]["schema"]


def test_values_of_known_kinds(rows):
    box = {r["image_id"]: r for r in results.result_boxes(rows).collect()}
    assert [round(box["i1"][n]) for n in ("x1", "y1", "x2", "y2")] == [100, 100, 400, 300] and box["i1"]["score"] == 0.5
    assert box["i3"]["x1"] is None and box["i3"]["label"] is None
    assert [(r["question"], r["choice"]) for r in results.result_choices(rows).collect()] == [("q", "A"), ("q", "B")]
    polygon = results.result_polygons(rows).first()
    assert [(p["x"], p["y"]) for p in polygon["points"]] == [(20.0, 20.0), (60.0, 40.0)] and polygon["label"] == "Road"
    point = results.result_keypoints(rows).first()
    assert (point["x"], point["y"], point["label"]) == (100.0, 25.0, "Head")


def test_tasks_without_results_and_bad_lines_stay(rows):
    empty = rows.filter("raw IS NULL").collect()
    assert sorted((r["image_id"] or "", r["line"] or "") for r in empty) == [("", LINES[3]), ("i1", ""), ("i2", "")]


def test_gate_reports_unknown_cameras_sizes_paths_and_contents(spark):
    name, w, h = CAMERAS[0][1:4]
    good = [(k, 0, camera, width, height, f"p{k}", f"s{k}") for k, (_, camera, width, height, _) in enumerate(CAMERAS)]
    rows = good + [(10, 1, "seventh", w, h, "p10", "s10"), (11, 2, None, w, h, "p11", "s11"), (12, 3, name, None, h, "p0", "s12"), (13, 4, name, w, h, None, "s0"), (14, 5, name, w, h, None, None)]
    images = spark.createDataFrame(
        [(*r, "d", True) for r in rows], "image_id long, frame_id long, camera_id string, width int, height int, relative_path string, sha256 string, dataset_id string, is_keyframe boolean")
    none = spark.createDataFrame([], "annotation_id long, image_id long, class_id int")
    found = {(r["check"], r["detail"]) for r in m.validate_release(images, none, [c[1] for c in CAMERAS]).collect() if r["check"] != "missing_camera"}
    assert found == {("image_size", "10"), ("image_size", "11"), ("image_size", "12"), ("duplicate_path", "p0"), ("duplicate_content", "s0")}
