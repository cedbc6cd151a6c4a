"""Versions, resumption, repositories, index statistics, sinks and documents that arrive over time."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from termloom.operators import corpus, stats
from termloom.sources import manifests, sinks
from termloom.streaming import ingest


def test_pipeline_text():
    steps = corpus.parse_pipeline(["# all", "populate", "", "tag2chk --candidate-filter=off --fast"])
    assert steps[1] == corpus.Step("tag2chk", (("candidate-filter", "off"), ("fast", "True")))
    assert corpus.parse_settings(["$x = 1", "# y", "lang = en"]) == {"lang": "en"}


def test_versions():
    registry = corpus.Registry()
    one = corpus.parse_pipeline(["populate", "xml2txt"])
    two = corpus.parse_pipeline(["populate", "xml2txt --a=b"])
    assert registry.advance(one, "populate", 4).processed == 4
    assert registry.advance(one, "xml2txt", 3).version == "01"
    with pytest.raises(ValueError):
        registry.advance(one, "xml2txt", 2)
    assert registry.resolve(two, "xml2txt", create=True).version == "02"
    with pytest.raises(LookupError):
        corpus.Registry().resolve(one, "populate")


def test_repository(spark):
    have = spark.createDataFrame([(1,), (2,)], "doc_id int")
    batch = spark.createDataFrame([(2,), (3,), (3,)], "doc_id int")
    assert [r["doc_id"] for r in corpus.add_to_repository(have, batch).collect()] == [3]
    assert tuple(stats.membership(batch, have, "doc_id").first()) == (1, 2)
    assert [tuple(r) for r in stats.duplicates(batch, "doc_id").collect()] == [(3, 2)]
    assert {r["doc_id"] for r in corpus.pending(batch, have).collect()} == {3}


def test_indexes(spark):
    lines = spark.createDataFrame([(0, "A41 - clothes"), (1, "  A41B shirts"), (2, "  B68"), (3, "A42 - hats"), (4, "  A42B")], "line_no int, line string")
    assert {tuple(r) for r in stats.domain_table(lines).collect()} == {("A41B", "A41"), ("B68", "A41"), ("A42B", "A42")}
    xml = "<bibliographic-data><classification-ipc><section>C</section>\n<class>01</class><subclass>B</subclass></classification-ipc><classification-ipcr sequence='1'><section>A</section><class>41</class><subclass>D</subclass></classification-ipcr><classification-ipcr><section>A</section></classification-ipcr></bibliographic-data><classification-ipc><section>Z</section><class>1</class><subclass>Z</subclass></classification-ipc>"
    frame = spark.createDataFrame([(xml,)], "x string")
    assert frame.select(stats.classification_codes(F.col("x")).alias("c")).first()["c"] == ["A-41-D", "C-01-B"]
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, n int, v string")
    assert {(r["k"], r["v"]) for r in stats.latest_by(rows, ["k"], F.col("n")).collect()} == {("a", "y"), ("b", "z")}
    paths = spark.createDataFrame([("/a/US4192770A.xml",), ("/b/USD123456S1.xml",)], "p string")
    assert [r[0] for r in paths.select(stats.short_id(F.col("p"))).collect()] == ["4192770", "D123456"]
    index = spark.createDataFrame([("1", "p"), ("2", "q"), ("2", "r")], "short_id string, path string")
    got = {r["short_id"]: r["path"] for r in stats.unique_path(spark.createDataFrame([("1",), ("2",), ("3",)], "short_id string"), index).collect()}
    assert got == {"1": "p", "2": None, "3": None}
    years = stats.years_and_domains(spark.createDataFrame([(1,), (2,)], "doc_id int"), spark.createDataFrame([(1, "20010203")], "doc_id int, date string"), spark.createDataFrame([(2, "A41")], "doc_id int, domain string"))
    assert {tuple(r) for r in years.collect()} == {(1, "2001", None), (2, "9999", "A41")}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a_0", "1999", "red box", ["x=1", "y=2"])], "uid string, year string, term string, features array<string>")
    sinks.feature_files(rows, f"{tmp_path}/f")
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/f").collect()] == ["a_0\t1999\tred box\tx=1\ty=2"]
    index = spark.createDataFrame([("1", "A41", "1999"), ("2", "A41", "1980"), ("3", "B01", "1999")], "id string, domain string, year string")
    sinks.by_domain_and_year(index, f"{tmp_path}/d", ["A41"])
    assert [(r["value"], r["domain"], r["year"]) for r in spark.read.text(f"{tmp_path}/d").collect()] == [("1", "A41", 1999)]
    sinks.create(rows, f"{tmp_path}/c")
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        sinks.create(rows, f"{tmp_path}/c")
    files = manifests.from_directory(spark, f"{tmp_path}/f")
    assert files.count() >= 1 and files.first()["year"] == "0000"
    listing = sinks.manifest_listing(spark.createDataFrame([("t.xml", 0, "row")], "target string, ord int, line string"), spark.createDataFrame([(0, "t.xml"), (1, "u.xml")], "line_no int, target string"))
    assert [r["line"] for r in listing.orderBy("line_no", "kind", "ord").collect()] == ["t.xml", "\trow", "u.xml"]


def test_documents_over_time(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "doc_id int, text string").write.parquet(source)
    stage = lambda d: d.withColumn("n", F.length("text"))
    for _ in range(2):  # the second time with another checkpoint: all is read again, nothing added
        stream = spark.readStream.schema("doc_id int, text string").parquet(source)
        ingest.follow(stream, out, stage).awaitTermination()
    assert sorted(r["doc_id"] for r in spark.read.parquet(out).collect()) == [1, 2]


def _corpus(spark, path, **more):
    docs = spark.createDataFrame([(i, f"<year>{1990 + i}</year>\n<title>Glass house {i}</title>\n<abstract>The red stones fall slowly</abstract>") for i in range(6)], "line_no long, content string")
    manifest = docs.selectExpr("line_no", "'1999' AS year", "concat('/f/', line_no) AS source", "cast(line_no AS string) AS target")
    files = docs.where("line_no <> 5").selectExpr("concat('/f/', line_no) AS path", "content")
    return corpus.Corpus(spark, path, manifest, files, source="signal-processing", **more)


def test_a_killed_run_is_continued(spark, tmp_path):
    whole = _corpus(spark, f"{tmp_path}/a")
    want = sorted((r["uid"], r["year"], r["term"]) for r in whole.run().collect())
    assert {u.split("_")[0] for u, _, _ in want} == set("01234") and ("2_0", "1992", "glass house") in want
    cut = _corpus(spark, f"{tmp_path}/b")
    cut.run(limit=2)
    cut.run_stage("populate")
    cut.run_stage("xml2txt", 1)

    def dies():
        raise RuntimeError("killed")

    again = _corpus(spark, f"{tmp_path}/b", tagger=dies)
    with pytest.raises(Exception, match="killed"):
        again.run_stage("txt2tag")
    assert cut.table("txt2tag").count() == 2  # the stage that died left nothing
    assert sorted((r["uid"], r["year"], r["term"]) for r in _corpus(spark, f"{tmp_path}/b").run().collect()) == want
    assert cut.run_stage("tag2chk") == 0  # nothing is done twice
    runs = {(r["stage"], r["limit"]) for r in cut.runs().collect()}
    assert {("populate", 2), ("populate", 4), ("xml2txt", 1), ("txt2tag", 4), ("tag2chk", 0)} <= runs
    assert all(r["engine"] and r["seconds"] >= 0 for r in cut.runs().collect())
    with pytest.raises(ValueError):
        cut.run_stage("xml2txt", 1)  # no more input


def test_no_stage_broadcasts_what_grows_with_the_corpus(spark, tmp_path):
    made = _corpus(spark, f"{tmp_path}/a")
    made.run(limit=2)
    for before, step in zip([None, *made.pipeline], made.pipeline, strict=False):
        inputs = made.manifest if before is None else made.table(before.stage)
        for frame in (corpus.pending(inputs, made.table(step.stage), "line_no"), getattr(made, made.STAGE[step.stage])(inputs, {})):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "Join" in plan and "Broadcast" not in plan, (step, plan)
    for frame in (corpus.view(made.manifest, made.table("populate"), "line_no"), corpus.add_to_repository(made.table("populate"), made.table("populate"), "line_no")):
        assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()


def test_options_make_versions(spark, tmp_path):
    steps = corpus.parse_pipeline(["populate", "xml2txt", "txt2tag", "tag2chk --candidate-filter=on --chunker-rules=en_w_of"])
    kept = _corpus(spark, f"{tmp_path}/a", pipeline=steps)
    plain = _corpus(spark, f"{tmp_path}/a")
    assert kept.version("txt2tag") == plain.version("txt2tag") and kept.version("tag2chk") != plain.version("tag2chk")
    assert {r["term"] for r in kept.run(limit=1).collect()} == {"glass house", "red stones fall"}
    assert plain.table("tag2chk") is None and plain.run_stage("tag2chk", 1) == 1


def test_chinese_run(spark, tmp_path):
    from termloom.functions import tagging
    from termloom.operators import segmenting

    docs = spark.createDataFrame([(0, "/f", "<year>1999</year>\n<title>玻璃(文)</title>\n<abstract>系统。房子</abstract>")], "line_no long, source string, content string")
    manifest = docs.selectExpr("line_no", "'1999' AS year", "source", "'a' AS target")
    made = corpus.Corpus(spark, f"{tmp_path}/cn", manifest, docs.selectExpr("source AS path", "content"), source="signal-processing", language="cn", segmenter=segmenting.by_character, tagger=tagging.number_tagger)
    terms = {r["term"] for r in made.run().collect()}
    assert terms >= {"玻 璃", "系 统 。", "房 子"} and not any("end" in t for t in terms)
    assert [r["stage"] for r in made.runs().orderBy("at").collect()] == list(corpus.STAGES["cn"])


def test_new_repository(spark, tmp_path):
    corpus.create_repository(spark, f"{tmp_path}/r", "patents")
    tables = corpus.open_repository(spark, f"{tmp_path}/r", "patents")
    assert set(tables) == {"ids", "files", "dates"} and all(t.count() == 0 for t in tables.values())
    with pytest.raises(Exception, match="exists"):
        corpus.create_repository(spark, f"{tmp_path}/r", "patents")
    with pytest.raises(ValueError):
        corpus.create_repository(spark, f"{tmp_path}/s", "maps")
