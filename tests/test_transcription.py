"""Parsing, line and metadata builds, sinks and the command line on small transcriptions."""

from __future__ import annotations

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from folioworks import cli
from folioworks.errors import MalformedLocusError, MissingPageContextError, SmokeTestError
from folioworks.functions import ids
from folioworks.operators import lines as L
from folioworks.operators import metadata as M
from folioworks.sources import ivtff, sinks, tables

SAMPLE = """#=IVTFF Eva- 2.0 M 5
# lost comment
# second
<f1r>      <! $Q=A $P=B $F=a $B=1 $I=H $L=A $H=1 $C=2 $X=V>
# on a line
<f1r.1,@P0;H>       fachys.ykal
<f1r.3,+P0;H>       ch?edy.[a:o]l{note}
<f1r.4,=L0;H>       @140;.Iol
<f1r.5,@Cc>         dropped
<f1v>      <! $Q=A $L=B $L=A $B=x>

<f1v.1,@P0>         daiin<->ol<$>
<f99r.2,*R1;T>      elsehere
<f2r>      <! $Q=A $L=B>
<f75r>     <! $Q=M>
<f75r.1,@P0;H>      oka!in
# trailing
"""


@pytest.fixture(scope="module")
def parsed(spark):
    return ivtff.parse_text(spark, SAMPLE)


def test_pages_variables_and_comments(parsed):
    got = parsed.pages.orderBy("page_ord").collect()
    assert [r.page_id for r in got] == ["f1r", "f1v", "f2r", "f75r"]
    v = got[0].variables
    assert (v.quire, v.page_in_quire, v.folio, v.bifolio, v.illustration, v.language, v.hand, v.cluster, v.extraneous) == ("A", "B", "a", 1, "H", "A", "1", 2, "V")
    assert got[1].variables.language == "A" and got[1].variables.bifolio is None and got[1].variables.hand is None
    assert got[0].comments == ["lost comment", "second"] and got[1].comments == []


def test_loci_belong_to_the_last_header(parsed):
    got = parsed.loci.orderBy("line_no").collect()
    assert [(r.page_ord, r.locus_page_id, r.locus_number, r.position, r.locus_type, r.subtype, r.transcriber, r.line_index) for r in got] == [
        (1, "f1r", 1, "@", "P", 0, "H", 1),
        (1, "f1r", 3, "+", "P", 0, "H", 2),
        (1, "f1r", 4, "=", "L", 0, "H", 3),
        (2, "f1v", 1, "@", "P", 0, None, 1),
        (2, "f99r", 2, "*", "R", 1, "T", 2),
        (4, "f75r", 1, "@", "P", 0, "H", 1),
    ]
    assert got[0].comments == ["on a line"] and got[0].raw_locator == "<f1r.1,@P0;H>" and got[0].text == "fachys.ykal"
    assert got[4].locus_id == "f99r:2"


def test_formats_last_one_wins(spark, parsed):
    assert parsed.formats.collect()[0][1:] == ("Eva-", "2.0 M 5")
    two = ivtff.parse_text(spark, "#=IVTFF 1.0\n#=IVTFF 2.0  x \n")
    assert two.formats.collect()[0][1:] == ("2.0", "x")
    assert ivtff.parse_text(spark, "#=IVTFF 1.0").formats.collect()[0][2] is None


@pytest.mark.parametrize("line", ["<f1r.2,@Cc> x", "<f1r.P.1;H> z", "<fRos.1,@P0> q", "<f1r.4,=L0;HH> v", "no locus"])
def test_odd_lines_are_skipped_or_raise(spark, line):
    content = f"<f1r> <! $Q=A>\n{line}\n"
    assert ivtff.parse_text(spark, content).loci.count() == 0
    with pytest.raises(MalformedLocusError, match="line 2 is of no known kind"):
        ivtff.parse_text(spark, content, strict=True)


@pytest.mark.parametrize(("line", "due"), [("<f1r.3,P> y", ("f1r", 3, None, "P", None, None, "y")), ("<f85v3.2,+P0> w", ("f85v3", 2, "+", "P", 0, None, "w"))])
def test_sparse_loci(spark, line, due):
    row = ivtff.parse_text(spark, f"<f1r>\n{line}").loci.first()
    assert (row.locus_page_id, row.locus_number, row.position, row.locus_type, row.subtype, row.transcriber, row.text) == due


def test_orphans(spark):
    assert ivtff.parse_text(spark, "<f1r.1,@P0> x\n").loci.count() == 0
    with pytest.raises(MissingPageContextError):
        ivtff.parse_text(spark, "<f1r.1,@P0> x\n", strict=True)


@pytest.mark.parametrize("content", ["", "#=IVTFF 2.0\n# only comments\n"])
def test_nothing_to_parse(spark, content):
    parsed = ivtff.parse_text(spark, content)
    assert parsed.pages.count() == parsed.loci.count() == L.line_table(parsed.lines).count() == 0


def test_files_with_other_breaks_and_bytes(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"<f1r>\r\n<f1r.1,@P0> a\xffb\r<f1r.2,@P0> c\x0bd\n")
    got = ivtff.read_ivtff(spark, str(tmp_path / "a.txt")).loci.orderBy("line_no").collect()
    assert [r.text for r in got] == ["a�b", "c\x0bd"]


def test_a_repeated_header_counts_anew(spark):
    got = ivtff.parse_text(spark, "<f1r>\n<f1r.1,P> a\n<f1v>\n<f1r>\n<f1r.2,P> b\n").loci.orderBy("line_no").collect()
    assert [(r.page_ord, r.line_index) for r in got] == [(1, 1), (3, 1)]


def test_line_table(parsed):
    got = {r.line_id: r for r in L.line_table(parsed.lines, "src", "v").collect()}
    assert list(got["f1r:1"].asDict()) == L.COLUMNS
    one = got["f1r:3"]
    assert (one.text_clean, one.has_uncertain, one.has_alternatives, one.char_count, one.word_count, one.section, one.line_type) == ("chedy.al", True, True, 7, 2, "herbal", "paragraph")
    codes = got["f1r:4"]
    assert (codes.text_clean, codes.has_high_ascii, codes.char_count, codes.word_count) == ("@140;.iol", True, 3, 1)
    assert got["f1v:2"].line_type == "radius" and got["f75r:1"].has_illegible and got["f75r:1"].text_clean == "okain"


def test_report_and_smoke(parsed):
    table = L.line_table(parsed.lines).cache()
    report = L.build_report(parsed.lines, table)
    assert (report["total_pages"], report["pages_with_lines"], report["page_ids_without_lines"]) == (4, 3, ["f2r"])
    assert report["lines_by_type"] == {"paragraph": 4, "label": 1, "radius": 1}
    assert report["pages_by_language"] == {"A": 2, "B": 1, "unknown": 1} and report["format_options"] == "2.0 M 5"
    assert not L.run_smoke_test(table, report)
    assert L.run_smoke_test(table, report, least_lines=5, least_pages=2, languages=("A",))
    with pytest.raises(SmokeTestError):
        L.run_smoke_test(table, report, strict=True)


def test_reading_order(spark):
    pages = ["f10r", "f2v", "f2r", "f85v3", "f85v1", "odd", "f2r"]
    rows = spark.createDataFrame([(p, i) for i, p in enumerate(pages)], "page_id string, i int")
    got = rows.orderBy(ids.reading_order(F.col("page_id"), F.col("i"))).collect()
    assert [(r.page_id, r.i) for r in got] == [("f2r", 2), ("f2r", 6), ("f2v", 1), ("f10r", 0), ("f85v1", 4), ("f85v3", 3), ("odd", 5)]


METADATA = """<f1r> <! $Q=A $L=A $H=1 $I=H>
<f1r.1,@P0> a
<f1r.2,@P0> b
<f1r.3,@L0> c
<f1v> <! $Q=A $L=A>
<f1v.1,@P0> d
<f2r> <! $Q=A $L=A>
<f2r.1,@C0>
<f75r> <! $Q=M $L=B>
<f75r.1,@P0> e
<f85v3> <! >
<f85v1> <! >
<f12r> <! $Q=A>
"""


def test_rollups(spark):
    records = M.page_records(ivtff.parse_text(spark, METADATA).lines).cache()
    pages = {r.page_id: r for r in records.collect()}
    one = pages["f1r"]
    assert (one.folio_id, one.side, one.folio_number, one.quire_id, one.line_count, one.label_count, one.has_text, one.is_foldout_panel) == ("f1", "recto", 1, "qA", 2, 1, True, False)
    assert one.section.value == "herbal_a" and one.section.confidence == "medium" and one.section.disputed
    assert not pages["f2r"].has_text and pages["f85v3"].total_panels == 6 and pages["f12r"].is_missing
    folios = {r.folio_id: r for r in M.folio_records(records).collect()}
    assert (folios["f1"].recto_page_id, folios["f1"].verso_page_ids, folios["f1"].total_lines, folios["f1"].is_foldout, folios["f1"].panel_count) == ("f1r", ["f1v"], 3, False, None)
    assert (folios["f85"].verso_page_ids, folios["f85"].panel_count, folios["f85"].recto_page_id) == (["f85v1", "f85v3"], 2, None)
    quires = {r.quire_id: r for r in M.quire_records(records).collect()}
    assert set(quires) == {"qA", "qM"}
    assert (quires["qA"].folio_ids, quires["qA"].page_count, quires["qA"].is_complete, quires["qA"].sections) == (["f1", "f2", "f12"], 4, False, ["herbal_a"])
    assert M.totals(records).first().asDict() == {"total_pages": 7, "total_folios": 5, "total_quires": 2, "total_lines": 4}
    report = M.build_report(records, M.folio_records(records), M.quire_records(records))
    assert report["complete_quires"] == 1 and report["pages_by_language"] == {"A": 3, "B": 1, "unknown": 3}


@pytest.mark.parametrize(
    ("page", "illustration", "due"),
    [("f1r", None, "herbal"), ("f70r", None, "astronomical"), ("f80r", None, "biological"), ("f85r", None, "cosmological"), ("f95r", None, "pharmaceutical"), ("f110r", None, "recipes"), ("invalid", None, None), ("f1r", "S", "stars"), ("f1r", "?", "herbal"), ("f999r", None, "recipes")],
)
def test_sections_of_pages(spark, page, illustration, due):
    row = spark.createDataFrame([(page, illustration)], "p string, i string")
    assert row.select(ids.section_of_page(F.col("p"), F.col("i")).alias("s")).first().s == due


@pytest.mark.parametrize(("number", "due"), [(1, "herbal_a"), (25, "herbal_a"), (26, "herbal_b"), (50, "herbal_b"), (74, "unknown"), (75, "biological"), (85, "cosmological"), (87, "pharmaceutical"), (103, "recipes"), (200, "unknown")])
def test_sections_of_folios(spark, number, due):
    assert spark.range(1).select(ids.section_of_folio(F.lit(number)).alias("s")).first().s == due


def test_page_ids(spark):
    rows = spark.createDataFrame([("f85v3",), ("F1R",)], "p string").select(ids.parse_page_id(F.col("p")).alias("x")).collect()
    assert [tuple(r.x) for r in rows] == [(85, "v", 3), (1, "r", None)]
    with pytest.raises(Exception, match="no page id"):
        spark.createDataFrame([("invalid!",)], "p string").select(ids.parse_page_id(F.col("p"))).collect()
    got = spark.createDataFrame([(p,) for p in ("f85v1", "f86v2", "f85v", "f1r", "f50v")], "p string").select(ids.is_foldout(F.col("p")).alias("x")).collect()
    assert [r.x for r in got] == [True, True, True, False, False]


def test_canonical_json_and_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(2, "é/“x”", None), (1, "a", True)], "n int, b string, a boolean")
    digest = sinks.write_canonical_jsonl(rows, str(tmp_path / "x.jsonl"), "n")
    data = (tmp_path / "x.jsonl").read_bytes()
    assert data.decode() == '{"a":true,"b":"a","n":1}\n{"a":null,"b":"é/“x”","n":2}\n' and hashlib.sha256(data).hexdigest() == digest
    sinks.write_sums({"x.jsonl": digest}, str(tmp_path / "SHA256SUMS"))
    assert sinks.check_sums(str(tmp_path / "SHA256SUMS")) == {"x.jsonl": True}
    assert sinks.write_canonical_jsonl(rows.limit(0), str(tmp_path / "e.jsonl")) == hashlib.sha256(b"").hexdigest()
    sinks.write_split(rows, str(tmp_path / "set"))
    assert spark.read.parquet(str(tmp_path / "set/train.parquet")).count() == 2
    (tmp_path / "t.md").write_text("{{A}} {{B}}")
    sinks.render_card(str(tmp_path / "t.md"), str(tmp_path / "o.md"), {"A": "1"})
    assert (tmp_path / "o.md").read_text() == "1 {{B}}"


def test_command_line(spark, tmp_path):
    source = tmp_path / "s.txt"
    source.write_text(SAMPLE)
    out = str(tmp_path / "out")
    assert cli.main(["lines", "--source", str(source), "--output-dir", out], spark) == 0
    assert cli.main(["check", "--output-dir", out, "--lines", "6", "--pages", "3"], spark) == 0
    assert cli.main(["check", "--output-dir", out, "--lines", "7"], spark) == 1
    assert cli.main(["check", "--output-dir", str(tmp_path / "none")], spark) == 1
    assert cli.main(["lines", "--source", str(source), "--output-dir", out, "--smoke-test", "--format", "jsonl"], spark) == 1
    assert cli.main(["metadata", str(source), "-o", out, "--parquet"], spark) == 0
    assert spark.read.parquet(f"{out}/folios.parquet").columns[-1] == "section_disputed"
    assert json.load(open(f"{out}/release_manifest.json"))["statistics"]["total_lines"] == 6
    assert cli.main(["mismatch", f"zl={source}", f"it={source}", "bad=/none", "-o", out], spark) == 0
    assert json.load(open(f"{out}/mismatch_report.json"))["agreement_rate"] == 1.0
    assert cli.main(["profile", str(source)], spark) == 1


def test_sources(spark, tmp_path):
    good = tmp_path / "g.jsonl"
    good.write_text('{"a": 1}\n\n{"a": 2}\n')
    assert tables.read_jsonl(spark, str(good), "a int").count() == 2
    (tmp_path / "b.jsonl").write_text('{"a": 1}\nnope\n')
    with pytest.raises(Exception):  # noqa: B017
        tables.read_jsonl(spark, str(tmp_path / "b.jsonl"), "a int").collect()
    got = tables.file_hashes(spark, str(good)).first()
    assert got.sha256 == tables.sha256_of_file(str(good)) and got.source_version == got.sha256[:12]
    assert tables.load_source(spark, "nobody", "x") is None and tables.load_source(spark, "it", str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        tables.load_sources(spark, {"it": str(good)})
    assert tables.source_table(spark).where("is_eva").count() == 2
    url = good.as_uri()
    assert tables.fetch(url, str(tmp_path / "c/x"), got.sha256) and not tables.fetch(url, str(tmp_path / "c/x"), got.sha256)
    with pytest.raises(ValueError):
        tables.fetch(url, str(tmp_path / "c/y"), "0")
    assert not (tmp_path / "c/y").exists()


def test_every_public_name_is_there():
    import folioworks

    assert all(getattr(folioworks, name) is not None for name in folioworks.__all__) and set(folioworks.__all__) <= set(dir(folioworks))
    with pytest.raises(AttributeError):
        folioworks.nothing  # noqa: B018


def test_bad_json_lines_are_named(spark, tmp_path):
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n\n{"a": \n[1]\n')
    with pytest.raises(ValueError, match="line 3 is no JSON object"):
        tables.read_jsonl(spark, str(tmp_path / "b.jsonl"), "a int")


def test_large_files_are_read_in_splits(spark, tmp_path):
    """A file in many splits gives what one split gives: numbers, pages, comments and indexes."""
    rng = random.Random(3)
    lines = ["#=IVTFF Eva- 2.0", "<f9r.1,@P0;H> too early"]
    for page in range(40):
        lines += [f"# about {page}", f"<f{page + 1}r> <! $L=A>"]
        lines += [rng.choice([f"<f{page + 1}r.{i},@P0;H> daiin.{i}", "", "# said", "odd"]) for i in range(rng.randint(0, 30))]
    (tmp_path / "s.txt").write_text("\n".join(lines) + "\n")
    path = str(tmp_path / "s.txt")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    tables_of = lambda x: [sorted(map(str, f.collect())) for f in (ivtff.loci(x), ivtff.pages(x), ivtff.strict_errors(x), ivtff.pages_with_counts(x))]
    whole = tables_of(ivtff.read_lines(spark, path))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        read = ivtff.read_lines(spark, path)
        assert read.select("split").distinct().count() > 10
        assert [(r.line_no, r.line) for r in read.orderBy("line_no").collect()] == list(enumerate(lines, 1))
        assert tables_of(read) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    one = ivtff.lines_of(spark.createDataFrame([("x", "\n".join(lines))], "file string, value string"))
    assert sorted(r.line_index for r in ivtff.loci(one).collect()) == sorted(r.line_index for r in ivtff.loci(ivtff.read_lines(spark, path)).collect())


def test_registry_is_fetched_locked_and_verified(spark, tmp_path):
    source = tmp_path / "s.txt"
    source.write_text("#=IVTFF\n<f1r>\n<f1r.P.1;H> daiin\n")
    page = tmp_path / "p.html"
    page.write_text("<p>A concordance</p>")
    registry = str(tmp_path / "r.json")
    tables.write_registry({"s": tables.Source("s", source.as_uri()), "p": tables.Source("p", page.as_uri()), "none": tables.Source("none", (tmp_path / "none").as_uri())}, registry)
    assert cli.main(["fetch", registry, "--cache", str(tmp_path / "c")], spark) == 1
    found = tables.read_registry(registry)
    assert {n: s.status for n, s in found.items()} == {"s": "verified", "p": "verified", "none": "failed"} and found["s"].sha256 == tables.sha256_of_file(str(source))
    assert tables.registry_table(spark, found).count() == 3
    saved = str(tmp_path / "v/results.json")
    assert cli.main(["verify", registry, "--keywords", "p=concordance,index", "--save", saved], spark) == 1
    got = json.load(open(saved))
    assert got["s"]["passed"] and got["p"]["passed"] and not got["none"]["passed"] and not got["_run"]["all_passed"]
    assert got["s"]["status"] == 200 and got["s"]["structure"]["line_count"] == 1
    del found["none"]
    source.write_text("nothing here")
    tables.write_registry(found, registry)
    assert cli.main(["verify", registry, "--save", saved], spark) == 1
    got = json.load(open(saved))
    assert got["s"]["warnings"] and len(got["s"]["errors"]) == 2


def test_splits_of_a_data_set(spark, tmp_path):
    rows = spark.createDataFrame([(1, "train"), (2, "test"), (3, "train")], "n int, split string")
    sinks.write_splits(rows, str(tmp_path / "set"))
    got = spark.read.parquet(str(tmp_path / "set"))
    assert {(r.n, r.split) for r in got.collect()} == {(1, "train"), (2, "test"), (3, "train")}
    assert spark.read.parquet(str(tmp_path / "set/split=train")).count() == 2


def test_check_finds_the_first_line_out_of_order(spark, tmp_path, capsys):
    source = tmp_path / "s.txt"
    source.write_text(SAMPLE)
    out = str(tmp_path / "out")
    cli.main(["lines", "--source", str(source), "--output-dir", out], spark)
    path = tmp_path / "out/lines.jsonl"
    lines = path.read_text().splitlines()
    path.write_text("\n".join(lines[::-1]) + "\n")
    capsys.readouterr()
    assert cli.main(["check", "--output-dir", out, "--lines", "6", "--pages", "3", "--json"], spark) == 1
    got = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert got["checks_run"] == 12 and got["failures"] == [f"[ORDERING] {json.loads(lines[-2])['line_id']}: comes before the line before it"]
    path.write_text("\n".join(json.dumps({"line_id": f"f1r:{i}"}) for i in range(9)))
    assert cli.main(["check", "--output-dir", out, "--json"], spark) == 1
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["failures"][5] == "... and 4 more"


def test_schemas_by_name(tmp_path):
    from folioworks.operators import quality

    assert quality.load_schema("transcription_lines") is quality.load_schema("transcription_lines.schema.json") is quality.LINES_SCHEMA
    (tmp_path / "own.json").write_text('{"type": "object"}')
    assert quality.load_schema("own", str(tmp_path)) == quality.load_schema(str(tmp_path / "own")) == {"type": "object"}
    with pytest.raises(FileNotFoundError):
        quality.load_schema("nobody")


def test_lines_are_made_once_for_all_checks(spark):
    """The checks share one reading of the lines, and long methods are not left to the JVM's interpreter."""
    from pyspark.sql import functions as F

    from folioworks.operators import quality as Q
    from folioworks.sources import ivtff

    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(value):
        calls.add(1)
        return value

    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    lines = spark.createDataFrame([("a", 1, "<f1r> <! $Q=A $Q=B $B=x $C=7>"), ("a", 2, "<f1r.1,@P0;H> {n}da?in \x01x ")], "file string, line_no long, line string")
    got = ivtff.loci(lines, comments=False, with_page=True).first()
    assert (got.text, got.locus_number, got.transcriber, got.variables.quire, got.variables.bifolio, got.variables.cluster) == ("{n}da?in \x01x", 1, "H", "B", None, 7)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000
    row = ("f1r:1", "f1r", 1, 1, "da?in", "da?in", False, False, False)
    frame = spark.createDataFrame([row] * 3, "line_id string, page_id string, line_number int, line_index int, text string, text_clean string, has_illegible boolean, has_uncertain boolean, has_high_ascii boolean")
    found = Q.invariant_failures(frame.withColumn("text", seen("text")), None, 5, 5)
    assert {r.invariant for r in found.collect()} == {"TEXT_CLEAN_NO_MARKERS", "TEXT_CLEAN_CHARSET", "HAS_UNCERTAIN_CONTRACT", "LINE_ID_UNIQUE", "LINE_INDEX_SEQUENTIAL", "RECORD_COUNT", "PAGE_COUNT"}
    assert calls.value == 3
