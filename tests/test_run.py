import json

import pytest

from inkspan import run

TEXT = "The war in Germany was won by the allied army, said the mayor, and the troops of the navy came home to the harbor. " * 3


def test_steps_from_listing_to_export(spark, tmp_path):
    (tmp_path / "list").mkdir()
    (tmp_path / "details").mkdir()
    (tmp_path / "list" / "page_1.json").write_text(json.dumps({"data": [{"id": "commonwealth:a"}, {"id": "commonwealth:b"}], "meta": {"pages": {"total_count": 3, "last_page?": False}}}))
    (tmp_path / "list" / "page_2.json").write_text(json.dumps({"data": [{"id": "commonwealth:c"}], "meta": {"pages": {"last_page?": True}}}))
    for key, year, flag in (("a", 1917, True), ("b", 1880, True), ("c", 1917, False)):
        attributes = {"has_transcription_bsi": flag, "title_info_primary_tsi": f"T{key}", "date_facet_yearly_itim": [year], "date_start_dtsi": f"{year}-05-01T00:00:00Z", "filenames_ssim": ["p.jpg"]}
        (tmp_path / "details" / f"commonwealth:{key}.json").write_text(json.dumps({"data": {"attributes": attributes}}))
        (tmp_path / "details" / f"commonwealth:{key}.txt").write_text(TEXT)
    config = {"data": str(tmp_path / "data"), "collections": [{"newspaper": "N", "collection": "C", "base": f"file://{tmp_path}/list"}], "details": f"file://{tmp_path}/details", "periods": {"wwi": [1914, 1918]}, "config": {"per_page": 2}}
    (tmp_path / "archive.json").write_text(json.dumps(config))
    a = run.archive_of(str(tmp_path / "archive.json"))
    assert run.run(spark, a) == list(run.STEPS)
    assert run.run(spark, a) == []  # all is there
    read = lambda name: spark.read.parquet(f"{a.data}/{name}").collect()
    assert sorted(r.record_id for r in read("texts")) == ["commonwealth:a", "commonwealth:b"]
    assert sorted(r.date for r in read("days")) == ["1880-05-01", "1917-05-01"]
    assert [(r.ark_id, r.period) for r in read("export")] == [("a", "wwi")]
    assert len(read("scores")) == 10 and "the N " in read("pairs")[0].question
    assert run.run(spark, a, ["days"], again=True) == ["days"]
    with pytest.raises(ValueError):
        run.run(spark, a, ["nothing"])
    assert run.archive_of(str(tmp_path / "archive.json"), test=True, data="elsewhere").config.max_pages == 2
