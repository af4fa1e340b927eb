import json

import pytest
from pyspark.sql import functions as F

from inkspan import config, functions, models, sinks
from inkspan.operators import articles, corpus, records
from inkspan.sources import files, listing, pages
from inkspan.streaming import ingest


def test_dates_and_ids(spark):
    rows = [(["1917-05-01T00:00:00Z"], "1917-05-01", [1917, 1918], "commonwealth:acommonwealth:b"), ([""], "1900", [], "x"), ([], "", None, None), (None, "bad!", None, "commonwealth:")]
    df = spark.createDataFrame(rows, "date_iso array<string>, date_start string, year array<int>, record_id string")
    got = df.select(records.day_of(), records.year_of(), records.short_id("record_id")).collect()
    assert [tuple(r) for r in got] == [("1917-05-01", 1917, "ab"), ("1900", 1900, "x"), ("unknown", 0, None), ("bad!", 0, "")]


def test_first_by_handles_null_keys(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), (None, 5), (None, 4)], "k string, seq int")
    assert {tuple(r) for r in records.first_by(df, "k", "seq").collect()} == {("a", 1), (None, 4)}


def test_unwrap_needs_a_list(spark):
    with pytest.raises(ValueError):
        records.unwrap(spark.createDataFrame([("x",)], "records string"))


def test_numbering_is_consecutive(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("o"))
    assert [r.n for r in articles.numbered(df, "o").orderBy("o").collect()] == list(range(1000))


def test_era_first_match_wins(spark):
    df = spark.createDataFrame([("World War II", ""), ("prohibition", None), (None, "nothing")], "q string, a string")
    assert [r.e for r in df.select(corpus.era("q", "a").alias("e")).collect()] == ["WWI era (1914-1918)", "Interwar (1919-1938)", "unclassified"]


def test_truth_null_is_not_empty(spark):
    df = spark.createDataFrame([(None,), ([],), ([("t", "x")],)], "ground_truths array<struct<title:string,ark_id:string>>")
    assert {(r.state, r.size, r.n) for r in corpus.truth_partition(df).collect()} == {("null", None, 1), ("empty", None, 1), ("populated", 1, 1)}


def test_missing_question_collapses(spark):
    df = spark.createDataFrame([(None, "", 1), ("", None, 2), ("q", "wwi", 3), ("q", "wwii", 4), ("r", "wwii", 5)], "question string, period string, id int")
    assert {r.id for r in articles.export_pairs(df, ["wwi"], "id").collect()} == {1, 3}


def test_prefer_ocr_even_if_empty(spark):
    recs = spark.createDataFrame([("a", "api text"), ("b", "api text")], "ark_id string, raw_text string")
    vlm = spark.createDataFrame([("a", "")], "ark_id string, text string")
    got = {r.ark_id: (r.text, r.ocr_source) for r in articles.prefer_ocr(recs, vlm).collect()}
    assert got == {"a": ("", "dots.ocr"), "b": ("api text", "api")}


def test_answer_parsing(spark):
    texts = ['{"question": "q", "answer": "a"}', '```json\n{"question": "q"}\n```', "no json", None]
    got = [r.p for r in spark.createDataFrame([(t,) for t in texts], "t string").select(models.parsed("t").alias("p")).collect()]
    assert [p and (p.question, p.answer, p.confidence) for p in got] == [("q", "a", "medium"), ("q", "", "medium"), None, None]
    assert models.parse_answer(texts[1]) == {"question": "q"} and models.parse_answer("x") is None


def test_model_seams(spark):
    df = spark.createDataFrame([("a  b\nc",), (None,)], "t string")
    assert [r.c for r in df.select(models.correct_texts("t").alias("c")).collect()] == ["a b c", None]
    pages = spark.createDataFrame([(bytearray(b"x"),), (None,)], "content binary")
    broken = lambda: (lambda image: 1 / 0)
    assert [r.t for r in pages.select(models.read_pages("content", broken).alias("t")).collect()] == ["", ""]


def test_json_shapes(spark, tmp_path):
    schema = spark.createDataFrame([], "id string, tags array<string>").schema
    (tmp_path / "a.json").write_text(json.dumps({"year": 1900, "records": [{"id": "1", "tags": []}, {"id": "2", "tags": ["é"]}]}))
    (tmp_path / "b.json").write_text(json.dumps([{"id": "3", "tags": None}]))
    (tmp_path / "c.json").write_text(json.dumps({"year": 1901}))
    got = files.read_records(spark, f"{tmp_path}/*.json", schema)
    assert {r.id for r in got.collect()} == {"1", "2", "3"}
    assert files.read_json(spark, f"{tmp_path}/none.json", schema).count() == 0


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nbad\n{"a": 2}\n')
    schema = spark.createDataFrame([], "a int").schema
    rows = files.read_jsonl(spark, f"{tmp_path}/x.jsonl", schema, strict=False).cache()
    assert rows.where("_corrupt is null").count() == 2 and rows.where("_corrupt is not null").count() == 1
    with pytest.raises(Exception):  # noqa: B017
        files.read_jsonl(spark, f"{tmp_path}/x.jsonl", schema).collect()


def test_text_folder(spark, tmp_path):
    (tmp_path / "one.txt").write_bytes(b"caf\xe9 ok")
    (tmp_path / "two.TXT").write_text("zwei")
    (tmp_path / "no.md").write_text("x")
    assert {tuple(r) for r in files.read_texts(spark, str(tmp_path)).collect()} == {("one", "caf� ok"), ("two", "zwei")}


def test_images(spark, tmp_path):
    (tmp_path / "ark").mkdir()
    (tmp_path / "ark" / "page_0002.jpg").write_bytes(b"\x00\x01")
    (tmp_path / "ark" / "p.PNG").write_bytes(b"z")
    assert {(r.mime, r.base64) for r in files.read_images(spark, str(tmp_path)).collect()} == {("image/jpeg", "AAE="), ("image/png", "eg==")}
    assert [(r.ark_id, r.page_no) for r in files.read_ocr_pages(spark, str(tmp_path)).collect()] == [("ark", 2)]


def test_listing_source(spark, tmp_path):
    base = tmp_path / "c"
    base.mkdir()
    (base / "page_1.json").write_text(json.dumps({"data": [{"id": "a"}, {"id": "b"}], "meta": {"pages": {"total_count": 3}}}))
    (base / "page_2.json").write_text(json.dumps({"data": [{"id": "c"}], "meta": {"pages": {"total_count": 3, "last_page?": True}}}))
    listing.register(spark)
    cs = json.dumps([{"newspaper": "N", "collection": "C", "base": f"file://{base}"}])
    df = spark.read.format("archive_ids").option("collections", cs).load()
    assert [r.id for r in df.orderBy("id").collect()] == ["a", "b", "c"]
    assert spark.read.format("archive_ids").option("collections", cs).option("maxPages", 1).load().count() == 2


def test_details(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"data": {"attributes": {"has_transcription_bsi": True, "title_info_primary_tsi": "T"}}}))
    (tmp_path / "a.txt").write_text("text " * 20)
    (tmp_path / "b.json").write_text(json.dumps({"data": {"attributes": {}}}))
    ids = spark.createDataFrame([("a", "N", "C"), ("b", "N", "C"), ("z", "N", "C")], "id string, newspaper string, collection string")
    got = {r.record_id: r.status for r in listing.fetch_details(ids, f"file://{tmp_path}").collect()}
    assert got == {"a": "done", "b": "not_transcribed", "z": "failed"}


def test_retry_waits_and_gives_up():
    calls, slept = [], []

    def fetch(url, timeout):
        calls.append(url)
        if len(calls) < 3:
            raise listing.Transient("x")
        return b"ok"

    retry = config.Retry()
    assert listing.get_with_retry("u", retry, fetch, slept.append) == b"ok" and slept == [2, 5]
    assert listing.get_with_retry("u", retry, lambda *a: 1 / 0, slept.append) is None


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("r1", [1900], ["1900-01-02"], "", "é"), ("r2", [], [], "", None)], "record_id string, year array<int>, date_iso array<string>, date_start string, t string")
    sinks.write_by_day(df, f"{tmp_path}/days")
    sinks.write_by_day(df.where("record_id = 'r1'"), f"{tmp_path}/days")
    got = spark.read.parquet(f"{tmp_path}/days")
    assert {(r.record_id, r.date_part) for r in got.collect()} == {("r1", "1900-01-02"), ("r2", "unknown")}
    sinks.append_by_year(df, f"{tmp_path}/years")
    sinks.write_jsonl(df, f"{tmp_path}/lines", single=True)
    assert spark.read.json(f"{tmp_path}/lines").count() == 2
    sinks.write_report(df, f"{tmp_path}/report.json")
    assert "é" in (tmp_path / "report.json").read_text()


def test_stream_resumes(spark, tmp_path):
    src, out, log = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/log"
    src.mkdir()
    schema = spark.createDataFrame([], "record_id string, seq int").schema
    for k in range(2):
        (src / f"{k}.json").write_text(json.dumps({"record_id": f"r{k}", "seq": k}) + "\n")
        ingest.run_available(ingest.landing(spark, str(src), schema), out, log)
    assert sorted(r.record_id for r in spark.read.parquet(out).collect()) == ["r0", "r1"]


def test_stream_upsert_keeps_first(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    schema = spark.createDataFrame([], "record_id string, seq int").schema
    for k in range(2):
        (src / f"{k}.json").write_text("".join(json.dumps({"record_id": r, "seq": 10 * k + n}) + "\n" for n, r in enumerate(("a", "b"))))
        ingest.log_batches(ingest.landing(spark, str(src), schema), f"{tmp_path}/t", f"{tmp_path}/log")
    assert {tuple(r) for r in ingest.current(spark, f"{tmp_path}/t", "record_id", "seq").collect()} == {("a", 0), ("b", 1)}
    ingest.compact(spark, f"{tmp_path}/t", f"{tmp_path}/c", "record_id", "seq")
    assert spark.read.parquet(f"{tmp_path}/c").count() == 2 and ingest.current(spark, f"{tmp_path}/c", "record_id", "seq").count() == 2


def test_sql_functions(spark):
    functions.register(spark, "ink_")
    assert spark.sql("select ink_clean_tier1('a-\\nb |x ( y ) , z') as t").first().t == "ab Ix (y), z"


def test_config(tmp_path):
    p = tmp_path / "c.json"
    p.write_text('{"max_pages": 5, "retry": {"max_retries": 2}}')
    c = config.load_config(str(p), text_col="clean_text")
    assert (c.max_pages, c.retry.max_retries, c.text_col, c.for_test().max_pages) == (5, 2, "clean_text", 2)
    with pytest.raises(TypeError):
        config.load_config(None, nonsense=1)


def test_bpe_tokens(spark):
    import base64

    import tiktoken

    path, pattern = "/opt/tokenizers/byte_bpe_50k.tiktoken", r"\p{L}+|[^\p{L}]+"
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["Hello, wörld", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.n for r in df.select(models.bpe_tokens("t", path, pattern).alias("n")).collect()] == [len(encoding.encode_ordinary(t)) if t else 0 for t in texts]


def test_discovery(spark, tmp_path):
    for name in ("a/1900.json", "a/ids.json", "b/1901.json", "b/1901_tmp.json"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("{}")
    assert {(r.collection, r.year) for r in files.year_files(spark, str(tmp_path)).collect()} == {("a", 1900), ("b", 1901)}


def test_page_join_and_manifest(spark):
    df = spark.createDataFrame([("a", 2, "zwei"), ("a", 1, "eins"), ("a", 3, None)], "ark_id string, page_no int, text string")
    line = "\n\n--- PAGE BREAK ---\n\n"
    assert [r.text for r in records.join_pages(df).collect()] == [f"eins{line}zwei{line}"]


def test_export_summary(spark):
    qa = spark.createDataFrame([(1, "Q?", "A" * 100, "wwi", "document", "high", "x llm")], "id int, question string, answer string, period string, question_type string, confidence string, notes string")
    text = sinks.export_summary(articles.export_counts(qa), qa, "id")
    assert "source       llm" in text and "A: " + "A" * 80 in text and "A" * 81 not in text


def test_issue_is_rendered_in_eighty_columns(spark):
    row = {"newspaper": None, "issue_date": None, "date_start": "1917-05-31T00", "collection": "C", "page_count": None, "char_count": 1234567, "source_url": None, "raw_text": "Word " * 200 + ". " + "End."}
    schema = "newspaper string, issue_date string, date_start string, collection string, page_count int, char_count int, source_url string, raw_text string"
    df = spark.createDataFrame([tuple(row.values())], schema)
    got = df.select(records.render_issue(True).alias("full"), records.render_issue().alias("short")).first()
    assert got.full == records.rendered(row, True) and got.short == records.rendered(row, False)
    lines = got.full.split("\n")
    assert max(map(len, lines)) == 80 and lines[0] == "=" * 80 and lines[1] == "  UNKNOWN NEWSPAPER" and lines[2] == "  1917-05-31"
    assert "  Length      : 1,234,567 characters" in lines and "  Pages       : ?" in lines
    assert "".join(got.full.split("FULL TEXT")[1].split()).rstrip("=") == "".join(row["raw_text"].split())
    assert "".join(got.short.split("chars)")[1].split("[...")[0].split()) == "".join(row["raw_text"][:600].split())


def test_pages_are_downloaded_once(spark, tmp_path):
    import json as j

    src, out = tmp_path / "src", tmp_path / "out"
    src.mkdir()
    (src / "p1").mkdir()
    image = lambda name: {"images": [{"resource": {"@id": f"file://{src}/full/{name}", "service": None}}]}
    (src / "full").mkdir()
    for k in (1, 2):
        (src / "full" / f"{k}.jpg").write_bytes(bytes([k]))
    rows = [{"ark_id": "a", "sequences": [{"canvases": [image("1.jpg"), image("2.jpg"), image("gone.jpg")]}]}, {"ark_id": "b", "sequences": None}]
    schema = "ark_id string, sequences array<struct<canvases array<struct<images array<struct<resource struct<`@id` string, service struct<`@id` string>>>>>>>>"
    df = spark.read.schema(schema).json(spark.sparkContext.parallelize([j.dumps(r) for r in rows]))
    first = [tuple(r) for r in pages.download_pages(df, str(out)).collect()]
    assert first == [("a", 3, 2, False)] and (out / "a" / ".done").read_text() == "2 pages\n"
    assert (out / "a" / "page_0002.jpg").read_bytes() == b"\x02" and not (out / "a" / "page_0003.jpg").exists()
    assert [tuple(r) for r in pages.download_pages(df, str(out)).collect()] == [("a", 3, 0, True)]


def test_stream_windows_drop_late_rows(spark, tmp_path):
    """Rows later than the watermark are left out; streams are joined and cleared of repetitions within it."""
    src = tmp_path / "in"
    src.mkdir()
    schema = spark.createDataFrame([], "event_id int, event_type string, user_id int, ts timestamp").schema
    batches = [[(1, "a", 1, "2024-01-01T00:10:00"), (2, "a", 1, "2024-01-01T00:20:00"), (2, "a", 1, "2024-01-01T00:20:00")], [(3, "a", 2, "2024-01-01T09:00:00")], [(4, "a", 1, "2024-01-01T00:30:00"), (5, "a", 2, "2024-01-01T14:00:00")], [(6, "a", 9, "2024-01-02T14:00:00")]]
    for name, make in {"hourly": ingest.hourly, "dedupe": lambda s: ingest.deduplicated(s, "event_id", "ts"), "joined": lambda s: ingest.joined_streams(s, s.select("event_id", "ts"), "event_id", "ts").select("a.event_id")}.items():
        for f in src.iterdir():
            f.unlink()
        for k, rows in enumerate(batches):
            (src / f"{k}.json").write_text("".join(json.dumps(dict(zip(schema.names, r, strict=True))) + "\n" for r in rows))
            ingest.run_available(make(ingest.landing(spark, str(src), schema, files=1)), f"{tmp_path}/{name}", f"{tmp_path}/{name}-log")
        got = spark.read.parquet(f"{tmp_path}/{name}").collect()
        if name == "hourly":
            assert sorted((r.start.hour, r.events) for r in got) == [(0, 3), (9, 1), (14, 1)]
        if name == "dedupe":
            assert sorted(r.event_id for r in got) in ([1, 2, 3, 4, 5, 6], [1, 2, 3, 5, 6])
        if name == "joined":
            assert sorted({r.event_id for r in got}) >= [1, 2, 3]


def test_envelopes_without_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"generated_at": "x", "newspaper": "N", "records": null}')
    (tmp_path / "b.json").write_text('[{"id": "1", "newspaper": "N"}, {"id": "2"}]')
    (tmp_path / "c.json").write_text('{"generated_at": "y", "records": [{"id": "3"}]}')
    t = lambda ddl: spark.createDataFrame([], ddl).schema
    got = files.read_records(spark, str(tmp_path), t("id string, newspaper string"), t("generated_at string"))
    assert sorted((r.id, r.generated_at) for r in got.collect()) == [("1", None), ("2", None), ("3", "y")]
