"""File fixtures (FIXTURES.md section 5): archives, XML, merge, publish, retention, streams, runs."""

import glob
import os
import zipfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL, digest
from regfold.operators.merge import merge_by_date, union_parts, with_load_date
from regfold.operators.shapes import project
from regfold.plans import publish as pub
from regfold.plans import commits
from regfold.plans.daily import daily_run, read_drop, run_report, slice_checks
from regfold.plans.fanout import read_published
from regfold.plans.specs import SPEC_BY_NAME, specs_for
from regfold.sources import archive, landing, xmlsource
from regfold.sources.fixtures import build_main
from regfold.streaming.intake import consume_once, read_sink

ORG_XML = """<?xml version="1.0" encoding="UTF-8"?>
<Entities>
  <Entity><entity_id>{a}</entity_id><page>0</page><s_name>Org {a}</s_name><s_acctbal>10.5</s_acctbal></Entity>
  <Entity><entity_id>{b}</entity_id><page>0</page><s_name>Org {b}</s_name><s_acctbal>-1.25</s_acctbal></Entity>
</Entities>
"""


def _zip(path, entries):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in entries.items():
            z.writestr(name, text)


def test_archives_good_and_bad(spark, tmp_path):
    zdir = tmp_path / "zips"
    zdir.mkdir()
    _zip(zdir / "good.zip", {"ORG_2022-01-01_1.XML": ORG_XML.format(a=1, b=2),
                             "ORG_2022-01-01_2.XML": ORG_XML.format(a=3, b=4)})
    (zdir / "bad.zip").write_bytes(b"this is no zip archive")
    rows = archive.archive_entries(spark, str(zdir)).collect()
    good = sorted(r.entry for r in rows if r.error is None)
    bad = [r for r in rows if r.error is not None]
    assert good == ["ORG_2022-01-01_1.XML", "ORG_2022-01-01_2.XML"]
    assert len(bad) == 1 and bad[0].archive == "bad.zip"

    out = tmp_path / "xml"
    rep = archive.extract_archives(spark, str(zdir), str(out)).collect()
    pieces = sorted(os.path.basename(f) for f in glob.glob(str(out / "data" / "*" / "*" / "*.XML")))
    assert pieces == [g + ".00001.XML" for g in good]  # one naming rule
    assert sum(r.error is not None for r in rep) == 1


def test_truncated_xml_keeps_earlier_rows(spark, tmp_path):
    body = "".join(f"<Entity><entity_id>{i}</entity_id><s_name>n{i}</s_name></Entity>\n" for i in range(5))
    (tmp_path / "t_2022-01-01_1.XML").write_text("<Entities>\n" + body + "<Entity><entity_id>9</entity_id><s_na")
    schema = T.StructType.fromDDL("entity_id STRING, s_name STRING")
    df = xmlsource.read_xml(spark, str(tmp_path), schema, corrupt=True)
    good, bad = xmlsource.split_errors(df)
    assert sorted(int(r.entity_id) for r in good.collect()) == [0, 1, 2, 3, 4]
    bad_rows = bad.collect()  # a query on the corrupt column alone is refused by Spark
    assert len(bad_rows) == 1 and bad_rows[0]._corrupt_record
    assert len(good.collect()) + len(bad_rows) == len(df.collect())


def test_windows_1251_xml(spark, tmp_path):
    text = '<?xml version="1.0" encoding="windows-1251"?>\n<Entities><Entity><entity_id>1</entity_id>' \
           '<s_name>ООО Ромашка</s_name></Entity></Entities>'
    (tmp_path / "c.XML").write_bytes(text.encode("cp1251"))
    schema = T.StructType.fromDDL("entity_id STRING, s_name STRING")
    row = xmlsource.read_xml(spark, str(tmp_path), schema, charset="windows-1251").first()
    assert row.s_name == "ООО Ромашка"


def test_pretty_and_one_line_xml_same_rows(spark, tmp_path):
    one = "<Entities>" + "".join(f"<Entity><entity_id>{i}</entity_id><s_name>n{i}</s_name></Entity>"
                                 for i in range(20)) + "</Entities>"
    pretty = "<Entities>\n" + "".join(
        f"  <Entity>\n    <entity_id>{i}</entity_id>\n    <s_name>n{i}</s_name>\n  </Entity>\n" for i in range(20)
    ) + "</Entities>\n"
    (tmp_path / "one").mkdir()
    (tmp_path / "pretty").mkdir()
    (tmp_path / "one" / "a.XML").write_text(one)
    (tmp_path / "pretty" / "a.XML").write_text(pretty)
    schema = T.StructType.fromDDL("entity_id STRING, s_name STRING")
    a = xmlsource.read_xml(spark, str(tmp_path / "one"), schema).drop("src_file").toPandas()
    b = xmlsource.read_xml(spark, str(tmp_path / "pretty"), schema).drop("src_file").toPandas()
    assert digest(a) == digest(b) and len(a) == 20


def test_xml_round_trip_of_main_table(spark, tmp_path):
    main = build_main(spark, SF_SMALL, "egrul", page_size=50)
    xmlsource.write_xml(main, str(tmp_path / "x"))
    back = xmlsource.read_xml(spark, str(tmp_path / "x"), xmlsource.string_schema(main.schema))
    for name in ("ul_info", "ulrules_info", "ulstatus_info", "ullicenses_info", "ulokved_info", "uluch_fl_info"):
        spec = SPEC_BY_NAME[name]
        assert digest(project(main, spec).toPandas()) == digest(project(back, spec).drop("src_file").toPandas()), name


def test_old_schema_column_is_null_after_union(spark, tmp_path):
    (tmp_path / "new").mkdir()
    (tmp_path / "old").mkdir()
    (tmp_path / "new" / "X_EGRUL_2022-01-02_1.XML").write_text(ORG_XML.format(a=1, b=2))
    old = ORG_XML.format(a=3, b=4).replace("<s_acctbal>10.5</s_acctbal>", "").replace(
        "<s_acctbal>-1.25</s_acctbal>", "")
    (tmp_path / "old" / "X_EGRUL_2022-01-02_1.XML").write_text(old)
    df = read_drop(spark, {"new": str(tmp_path / "new"), "old": str(tmp_path / "old")}, "egrul")
    rows = {int(r.entity_id): r for r in df.collect()}
    assert rows[1].s_acctbal == "10.5" and rows[3].s_acctbal is None
    assert rows[3].schema_version == "old" and str(rows[3].load_date) == "2022-01-02" and rows[3].part == "1"
    t = project(df, SPEC_BY_NAME["ul_info"]).collect()
    assert {r.schema_version for r in t} == {"new", "old"}


def test_non_adjacent_dates_all_merged(spark):
    names = ["ul_info_2022-01-01_1.parquet", "ul_info_2022-01-02_1.parquet", "ul_info_2022-01-01_2.parquet"]
    parts = [spark.createDataFrame([(i, n, n.split("_")[-1][0])], "x INT, src_file STRING, part STRING")
             for i, n in enumerate(names)]
    merged = merge_by_date(with_load_date(union_parts(parts)), "ul_info").collect()
    by = {str(r.load_date): r for r in merged}
    assert by["2022-01-01"].n_rows == 2 and by["2022-01-01"].n_parts == 2
    assert by["2022-01-02"].n_rows == 1 and by["2022-01-01"].slice_name == "ul_info_2022-01-01"


def test_publish_twice_equals_once(spark, tmp_path):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn(
        "load_date", F.trunc(F.to_date("o_orderdate"), "year"))
    root = str(tmp_path / "pub")
    pub.publish(df, root, "egrip", "orders")
    once = pub.read_published(spark, root).count()
    pub.publish(df, root, "egrip", "orders")
    assert pub.read_published(spark, root).count() == once == df.count()
    # a rerun of one slice replaces only that slice
    pub.publish(df.where(F.year("o_orderdate") == 1995), root, "egrip", "orders")
    assert pub.read_published(spark, root).count() == df.count()
    m = pub.manifest(pub.read_published(spark, root)).collect()
    assert all(r.n_files >= 1 and r.n_bytes > 0 and r.mem_limit == 30 for r in m)
    assert sum(r.n_rows for r in m) == df.count()


def test_retention_ages(spark):
    now = F.to_timestamp(F.lit("2024-01-30 12:00:00"))
    drops = spark.createDataFrame([("2024-01-09_13-00-00.parquet",),   # 20 d 23 h
                                   ("2024-01-09_12-00-00.parquet",),   # 21 d 0 h
                                   ("not-a-drop.parquet",)], "drop_name STRING")
    r = {x.drop_name: x for x in pub.retention(drops, now).collect()}
    assert r["2024-01-09_13-00-00.parquet"].age_days == 20 and not r["2024-01-09_13-00-00.parquet"].expired
    assert r["2024-01-09_12-00-00.parquet"].age_days == 21 and r["2024-01-09_12-00-00.parquet"].expired
    assert r["not-a-drop.parquet"].unparsable and not r["not-a-drop.parquet"].expired


def test_drop_index_names_unique(spark):
    sl = spark.createDataFrame([("egrul", "ul_info", "2024-01-01"), ("egrul", "ul_info", "2024-01-02"),
                                ("egrip", "ip_info", "2024-01-01")], "registry STRING, table STRING, load_date STRING")
    idx = pub.drop_index(sl, F.to_timestamp(F.lit("2024-01-30 23:59:59"))).collect()
    names = [r.drop_name for r in idx]
    assert len(set(names)) == 3 and "2024-01-31_00-00-00.parquet" in names


def test_stream_consumes_each_file_once(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    land = str(tmp_path / "landing")
    ev.where("event_id % 2 = 0").write.parquet(land + "/a")
    args = dict(src_dir=land + "/*", schema=ev.schema, sink_dir=str(tmp_path / "sink"),
                checkpoint_dir=str(tmp_path / "ckpt"))
    first = consume_once(spark, **args)
    assert first["rows"] == ev.where("event_id % 2 = 0").count()
    assert consume_once(spark, **args)["rows"] == 0
    ev.where("event_id % 2 = 1").write.parquet(land + "/b")
    assert consume_once(spark, **args)["rows"] == ev.where("event_id % 2 = 1").count()
    assert read_sink(spark, args["sink_dir"]).count() == ev.count()


def test_landing_listing_with_class_and_parent(spark):
    html = ('<a class="clearfix" href="/d/x.zip">x</a><a href="/d/y.zip">y</a>'
            '<a class="big clearfix" href="/d">up</a><a class="clearfix" href="/d/z.zip">z</a>')
    pages = spark.createDataFrame([(1, "/d", html)], "page_id BIGINT, url STRING, html STRING")
    links = landing.listing_links(pages, parent="url").collect()
    assert [r.file_name for r in links] == ["x.zip", "z.zip"]
    st = spark.createDataFrame([(200, "<p>files</p>"), (200, "<b>ERROR:</b>"), (404, "<p/>"), (200, "<br/>")],
                               "status INT, html STRING")
    got = [r.v for r in st.select(landing.listing_status("status", "html").alias("v")).collect()]
    assert got == ["found", "none", "failed", "found"]


def test_empty_drop_reports_empty(spark, tmp_path):
    assert slice_checks(spark, str(tmp_path / "nothing"), {"egrip": {"2024-01-30": "x"}}) is None
    rep = run_report(spark, "egrip", None).collect()
    assert len(rep) == 15 and all(r.status == "empty" and r.n_rows == 0 for r in rep)


def test_daily_run_end_to_end(spark, tmp_path):
    """Fixture mains -> XML drop files -> zips (one bad) -> daily run -> 50 published tables."""
    zips = {}
    for reg in ("egrip", "egrul"):
        main = build_main(spark, SF_SMALL, reg, page_size=40)
        xdir = str(tmp_path / "gen" / reg)
        xmlsource.write_xml(main.repartition(2), xdir)
        zdir = tmp_path / "zips" / reg
        zdir.mkdir(parents=True)
        files = sorted(glob.glob(os.path.join(xdir, "part-*.xml")))
        _zip(zdir / "drop.zip", {f"DROP_{reg.upper()}_2024-01-30_{i + 1}.XML": open(f).read()
                                 for i, f in enumerate(files)})
        (zdir / "broken.zip").write_bytes(b"PK\x03\x04 truncated")
        zips[reg] = {"new": str(zdir)}
    out = str(tmp_path / "out")
    res = daily_run(spark, zips, out, "2024-01-30", parallel=4)
    report = {r.table: r for r in res.report.collect()}
    assert len(report) == 50
    assert all(r.n_bad_values == 0 for r in report.values())  # typed values survive the XML trip
    assert all(r.n_rows == r.n_expected and r.status in ("ok", "empty") for r in report.values())
    assert res.audit.where("code = '03'").count() == 2
    audit = spark.read.parquet(os.path.join(out, "_audit"))
    assert audit.where("code = '03'").count() == 2 and {str(r.run_date) for r in audit.collect()} == {"2024-01-30"}
    assert spark.read.parquet(os.path.join(out, "_runs")).count() == 50
    for reg in ("egrip", "egrul"):
        main = build_main(spark, SF_SMALL, reg)
        for spec in specs_for(reg):
            got = read_published(spark, out, reg, spec.name)
            want = project(main, spec)
            assert report[spec.name].n_rows == want.count(), spec.name
            cols = ["entity_id", *spec.group, *spec.fields] + (["is_main"] if spec.shape == "M" else [])
            assert digest(got.select(*cols).toPandas()) == digest(want.select(*cols).toPandas()), spec.name
            assert {str(r.load_date) for r in got.select("load_date").distinct().collect()} == {"2024-01-30"}


def test_type_errors_split_after_read(spark, tmp_path):
    rows = "".join(f"<Event><event_id>{i}</event_id><value>{'n/a' if i % 3 == 0 else i + 0.5}</value></Event>"
                   for i in range(9))
    (tmp_path / "e.XML").write_text(f"<Events>{rows}</Events>")
    typed = T.StructType.fromDDL("event_id BIGINT, value DOUBLE")
    df = xmlsource.read_xml(spark, str(tmp_path), xmlsource.string_schema(typed), row_tag="Event", corrupt=True)
    staged = df.write.parquet(str(tmp_path / "staged")) or spark.read.parquet(str(tmp_path / "staged"))
    good, bad = xmlsource.split_errors(staged, typed)
    assert sorted(r.event_id for r in good.collect()) == [1, 2, 4, 5, 7, 8]
    assert dict(good.dtypes)["value"] == "double"
    b = bad.collect()
    assert sorted(int(r.event_id) for r in b) == [0, 3, 6] and all(r.bad_fields == ["value"] for r in b)


def test_same_entry_name_in_two_archives_kept_apart(spark, tmp_path):
    zdir = tmp_path / "zips"
    zdir.mkdir()
    _zip(zdir / "a.zip", {"X_EGRUL_2022-01-01_1.XML": ORG_XML.format(a=1, b=2)})
    _zip(zdir / "b.zip", {"X_EGRUL_2022-01-01_1.XML": ORG_XML.format(a=3, b=4)})
    out = tmp_path / "xml"
    archive.extract_archives(spark, str(zdir), str(out)).collect()
    df = read_drop(spark, {"new": str(out)}, "egrul", extracted=True)
    assert sorted(int(r.entity_id) for r in df.collect()) == [1, 2, 3, 4]


def test_stream_takes_xml_drops_once(spark, tmp_path):
    land = tmp_path / "xml"
    land.mkdir()
    (land / "X_EGRUL_2022-01-01_1.XML").write_text(ORG_XML.format(a=1, b=2))
    schema = T.StructType.fromDDL("entity_id STRING, page STRING, s_name STRING, s_acctbal STRING")
    args = dict(src_dir=str(land), schema=schema, sink_dir=str(tmp_path / "sink"),
                checkpoint_dir=str(tmp_path / "ckpt"), fmt="xml", options={"rowTag": "Entity"})
    assert consume_once(spark, **args)["rows"] == 2
    (land / "X_EGRUL_2022-01-02_1.XML").write_text(ORG_XML.format(a=3, b=4))
    assert consume_once(spark, **args)["rows"] == 2
    assert consume_once(spark, **args)["rows"] == 0
    assert sorted(int(r.entity_id) for r in read_sink(spark, args["sink_dir"]).collect()) == [1, 2, 3, 4]


def test_big_xml_entries_are_cut_at_record_ends(spark, tmp_path):
    """An entry above split_bytes lands as several well-formed pieces with the same rows."""
    recs = "".join(f"<Entity><entity_id>{i}</entity_id><page>0</page><s_name>Орг {i}</s_name></Entity>\n"
                   for i in range(300))
    for enc in ("utf-8", "windows-1251"):
        text = f'<?xml version="1.0" encoding="{enc}"?>\n<Entities>\n{recs}</Entities>\n'
        zdir = tmp_path / enc / "zips"
        zdir.mkdir(parents=True)
        with zipfile.ZipFile(zdir / "d.zip", "w") as z:
            z.writestr("X_EGRUL_2022-01-03_7.XML", text.encode(enc))
        out = tmp_path / enc / "xml"
        archive.extract_archives(spark, str(zdir), str(out), split_bytes=2000).collect()
        pieces = sorted(os.path.basename(f) for f in glob.glob(str(out / "data" / "*" / "*" / "*.XML")))
        assert len(pieces) > 5 and pieces[0] == "X_EGRUL_2022-01-03_7.XML.00001.XML"
        df = read_drop(spark, {"new": str(out)}, "egrul", extracted=True)
        rows = df.collect()
        assert sorted(int(r.entity_id) for r in rows) == list(range(300))
        assert {r.s_name for r in rows if r.entity_id == "5"} == {"Орг 5"}
        assert {(str(r.load_date), r.part) for r in rows} == {("2022-01-03", "7")}
        assert all(r._corrupt_record is None for r in rows)


def test_cli_retention(spark, tmp_path, capsys):
    from regfold.__main__ import main

    for name in ("2024-01-09_12-00-00.parquet", "2024-01-20_00-00-00.parquet", "junk.parquet"):
        (tmp_path / name).write_bytes(b"x")
    assert main(["retention", "--names", str(tmp_path), "--now", "2024-01-30 12:00:00"]) == 0
    out = capsys.readouterr().out
    assert "2024-01-09_12-00-00.parquet" in out and "junk.parquet" in out
    assert "2024-01-20_00-00-00.parquet" not in out


def test_entries_in_archive_subfolders_kept_apart(spark, tmp_path):
    zdir = tmp_path / "zips"
    zdir.mkdir()
    _zip(zdir / "a.zip", {"one/X_EGRUL_2022-01-01_1.XML": ORG_XML.format(a=1, b=2),
                          "two/X_EGRUL_2022-01-01_1.XML": ORG_XML.format(a=3, b=4)})
    out = tmp_path / "xml"
    archive.extract_archives(spark, str(zdir), str(out)).collect()
    df = read_drop(spark, {"new": str(out)}, "egrul", extracted=True)
    rows = df.collect()
    assert sorted(int(r.entity_id) for r in rows) == [1, 2, 3, 4]
    assert {(str(r.load_date), r.part) for r in rows} == {("2022-01-01", "1")}


def test_bad_nested_values_are_counted(spark, tmp_path):
    """A leaf that does not cast turns null in its table and is counted in the report."""
    from regfold.operators.shapes import bad_value_counts

    rec = ("<Entity><entity_id>{i}</entity_id><page>{p}</page><s_name>n</s_name><s_acctbal>{a}</s_acctbal>"
           "<ulstatus><l_orderkey>{i}</l_orderkey><l_partkey>7</l_partkey><l_quantity>{q}</l_quantity></ulstatus>"
           "</Entity>")
    body = rec.format(i=1, p=0, a="1.5", q="2.0") + rec.format(i=2, p=0, a="oops", q="x") + rec.format(i=3, p=0, a="2", q="3")
    (tmp_path / "X_EGRUL_2022-01-01_1.XML").write_text(f"<Entities>{body}</Entities>")
    df = read_drop(spark, {"new": str(tmp_path)}, "egrul")
    counts = {r.table_name: r.n_bad_values for r in bad_value_counts({"egrul": df}).collect()}
    assert counts["ul_info"] == 1 and counts["ulstatus_info"] == 1 and counts["ulpolnom_info"] == 0
    t = {r.entity_id: r for r in project(df, SPEC_BY_NAME["ulstatus_info"]).collect()}
    assert t[2].l_quantity is None and t[1].l_quantity == 2.0


def test_cli_retention_delete(spark, tmp_path, capsys):
    from regfold.__main__ import main

    for name in ("2024-01-09_12-00-00.parquet", "2024-01-20_00-00-00.parquet", "junk.parquet"):
        (tmp_path / name).write_bytes(b"x")
    assert main(["retention", "--names", str(tmp_path), "--now", "2024-01-30 12:00:00", "--delete"]) == 0
    assert sorted(os.listdir(tmp_path)) == ["2024-01-20_00-00-00.parquet", "junk.parquet"]


def test_daily_run_with_nothing_usable(spark, tmp_path):
    """Only a broken archive landed: the run finishes, every table is reported empty and the
    archive failure is recorded."""
    zdir = tmp_path / "zips"
    zdir.mkdir()
    (zdir / "broken.zip").write_bytes(b"not a zip")
    out = str(tmp_path / "out")
    res = daily_run(spark, {"egrul": {"new": str(zdir)}}, out, "2024-02-01")
    rep = res.report.collect()
    assert len(rep) == 50 and all(r.status == "empty" and r.n_rows == 0 for r in rep)
    assert [r.code for r in res.audit.collect()] == ["03"]
    assert spark.read.parquet(os.path.join(out, "_audit")).count() == 1


def test_report_marks_mismatch(spark):
    from regfold.plans.daily import check_report

    report = spark.createDataFrame([("egrul", "ul_info", 10, "ok", "7"), ("egrul", "ulkvhp", 0, "empty", "0")],
                                   "registry STRING, table STRING, n_rows BIGINT, status STRING, digest STRING")
    checks = spark.createDataFrame([("egrul", "ul_info", 11, 0), ("egrul", "ulkvhp", 0, 0)],
                                   "registry STRING, table_name STRING, n_expected BIGINT, n_bad_values BIGINT")
    got = {r.table: r.status for r in check_report(report, checks).collect()}
    assert got == {"ul_info": "mismatch", "ulkvhp": "empty"}
    checks = checks.withColumn("n_expected", F.when(F.col("table_name") == "ul_info", 10).otherwise(0))
    for own, status in (("7", "ok"), ("8", "mismatch")):
        written = spark.createDataFrame([("egrul", "ul_info", 10, own)],
                                        "registry STRING, table STRING, rows_written BIGINT, digest_written STRING")
        assert {r.table: r.status for r in check_report(report, checks, written).collect()} == {"ul_info": status, "ulkvhp": "empty"}


def test_damaged_entries_leave_no_rows_at_any_size(spark, tmp_path):
    """Good, lower-case, damaged (small, and cut into pieces) and odd entries of one archive: the same rows
    and notices whatever the piece size."""
    def xml(ids):
        recs = "".join(f"<Entity><entity_id>{i}</entity_id><s_name>{'n%d' % i}</s_name></Entity>\n" for i in ids)
        return f"<Entities>\n{recs}</Entities>\n".encode()

    seen = []
    for split in (10**9, 500):
        zdir, out = tmp_path / f"zips{split}", str(tmp_path / f"out{split}")
        zdir.mkdir()
        with zipfile.ZipFile(zdir / "d.zip", "w", compression=zipfile.ZIP_STORED) as z:
            z.writestr("X_EGRUL_2022-01-03_1.XML", xml(range(40)))
            z.writestr("X_EGRUL_2022-01-03_2.xml", xml(range(100, 140)))
            z.writestr("X_EGRUL_2022-01-03_3.XML", xml(range(200, 240)))
            z.writestr("readme.XML", xml([300]))
            z.writestr("notes.txt", "no document")
        data = (zdir / "d.zip").read_bytes()
        (zdir / "d.zip").write_bytes(data.replace(b"n239", b"n23X", 1))  # its checksum no longer fits
        rep = archive.extract_archives(spark, str(zdir), out, split_bytes=split).collect()
        rows = read_drop(spark, {"new": out}, "egrul", extracted=True).collect()
        seen.append((sorted((r.entry, r.error is None) for r in rep), sorted(
            (int(r.entity_id), r.src_file, str(r.load_date)) for r in rows)))
    assert seen[0] == seen[1]
    failed = {e for e, ok in seen[0][0] if not ok}
    assert failed == {"X_EGRUL_2022-01-03_3.XML", "notes.txt"}
    assert [i for i, _, _ in seen[0][1]] == [*range(40), *range(100, 140), 300]
    assert {d for i, _, d in seen[0][1] if i == 300} == {"None"}


def test_whole_entities_and_reruns(spark, tmp_path):
    """XML without a page gives root rows; a second run of a date replaces slices, report and notices, also
    of a table that has become empty; an empty landing is a notice; other dates stay on a plain session."""
    zdir, empty, out = tmp_path / "z", tmp_path / "e", str(tmp_path / "out")
    zdir.mkdir()
    empty.mkdir()
    el = next(s for s in specs_for("egrul") if s.name == "ulstatus_info")

    def run(date, body):
        _zip(zdir / "d.zip", {f"X_EGRUL_{date}_1.XML": f"<Entities><Entity><entity_id>1</entity_id>{body}</Entity></Entities>"})
        return daily_run(spark, {"egrul": {"new": str(zdir)}, "egrip": {"new": str(empty)}}, out, date)

    item = f"<{el.element}><{el.fields[0]}>1</{el.fields[0]}></{el.element}>"
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        run("2024-01-29", item)
        first = run("2024-01-30", item)
        rows = {r.table: r.n_rows for r in first.report.collect()}
        assert rows["ul_info"] == 1 and rows["ulstatus_info"] == 1
        assert [(r.code, r.dir) for r in first.audit.collect()] == [("02", str(empty))]
        second = run("2024-01-30", "")
        rows = {r.table: (r.n_rows, r.status) for r in second.report.collect()}
        assert rows["ul_info"] == (1, "ok") and rows["ulstatus_info"] == (0, "empty")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert spark.read.parquet(os.path.join(out, "_runs")).count() == 100  # two dates, one of them twice
    assert spark.read.parquet(os.path.join(out, "_audit")).count() == 2
    assert {str(r.load_date) for r in read_published(spark, out, "egrul", "ulstatus_info").collect()} == {"2024-01-29"}


def test_links_in_any_quoting_and_null_status(spark):
    html = """<A HREF='a.zip?x=1&amp;y=2' CLASS="b DATA">1</A><a class=DATA href=c.zip>2</a><a data-href="no" class='DATA'>3</a>
              <a title="a > b" class="DATA" href="d.zip">4</a>"""
    df = spark.createDataFrame([(1, html)], "page_id INT, html STRING")
    got = [(r.href, r.file_name) for r in landing.listing_links(df, link_class="DATA").orderBy("pos").collect()]
    assert got == [("a.zip?x=1&y=2", "a.zip?x=1&y=2"), ("c.zip", "c.zip"), ("d.zip", "d.zip")]
    st = spark.createDataFrame([(None, "<p>")], "status INT, html STRING")
    assert st.select(landing.listing_status("status", "html").alias("v")).first().v == "failed"


def test_rare_table_is_one_file(spark, tmp_path):
    df = spark.range(0, 400, 1, 40).selectExpr("id", "date'2024-01-30' AS load_date")
    path = pub.publish(df, str(tmp_path), "egrul", "rare")
    assert len(glob.glob(path + "/load_date=2024-01-30/*.parquet")) == 1
    assert spark.read.parquet(path).count() == 400


def test_daily_run_takes_entries_once(spark, tmp_path):
    """A second day loads only dates with a new entry, each from all its entries; a repeated run loads its own again."""
    zdir, out = tmp_path / "z", str(tmp_path / "out")
    zdir.mkdir()

    def published():
        rows = read_published(spark, out, "egrul", "ul_info").collect()
        return sorted((str(r.load_date), r.entity_id) for r in rows)

    def counts(res):
        return {r.table: r.n_rows for r in res.report.collect()}["ul_info"]

    _zip(zdir / "a.zip", {"X_EGRUL_2024-01-29_1.XML": ORG_XML.format(a=1, b=2), "X_EGRUL_2024-01-30_1.XML": ORG_XML.format(a=3, b=4)})
    (zdir / "broken.zip").write_bytes(b"no archive")
    run = lambda date, **kw: daily_run(spark, {"egrul": {"new": str(zdir)}}, out, date, **kw)
    assert counts(run("2024-01-30")) == 4
    first = published()
    # nothing new: no rows, the broken archive is still reported, slices stay
    idle = run("2024-01-31")
    assert counts(idle) == 0 and [r.code for r in idle.audit.collect()] == ["03"] and published() == first
    # a late part of a date that is out already: its rows join those of the date
    _zip(zdir / "b.zip", {"X_EGRUL_2024-01-30_2.XML": ORG_XML.format(a=5, b=6)})
    assert counts(run("2024-02-01")) == 4
    want = [("2024-01-29", 1), ("2024-01-29", 2), *(("2024-01-30", k) for k in (3, 4, 5, 6))]
    assert published() == want
    assert counts(run("2024-02-01")) == 4 and published() == want  # the same run again
    # a replaced entry is new
    _zip(zdir / "a.zip", {"X_EGRUL_2024-01-29_1.XML": ORG_XML.format(a=7, b=8), "X_EGRUL_2024-01-30_1.XML": ORG_XML.format(a=3, b=4)})
    drops = str(tmp_path / "drops")
    assert counts(run("2024-02-02", drop_dir=drops, bucket_name="store", pilot_name="me")) == 2
    assert published() == [("2024-01-29", 7), ("2024-01-29", 8), *want[2:]]
    slices = spark.read.parquet(os.path.join(out, "_manifest")).where("run_date = '2024-02-02' and table = 'ul_info'").collect()
    assert [(str(r.load_date), r.n_rows, r.bucket_name, r.pilot_name, r.file_mask) for r in slices] == [
        ("2024-01-29", 2, "store", "me", [".parquet"])]
    names = [n for r in slices for n in r.drop_names]
    assert len(names) == 1 and spark.read.parquet(os.path.join(drops, names[0])).count() == 2
    assert counts(run("2024-02-03", once=False)) == 6


def test_drop_files_in_an_odd_folder(spark, tmp_path):
    """Folder names with spaces and percent signs; a drop file for each file; expired ones go."""
    df = spark.range(10).selectExpr("id", "date_add(date'2024-01-01', cast(id % 3 as int)) AS load_date")
    root, drops = str(tmp_path / "out 1+1"), str(tmp_path / "drops 100%")
    pub.publish(df, root, "egrul", "t")
    idx = pub.write_drops(pub.read_published(spark, root), drops, F.to_timestamp(F.lit("2024-01-09 11:59:59"))).collect()
    assert sorted(os.listdir(drops)) == sorted(r.drop_name for r in idx) == [
        "2024-01-09_11-59-59.parquet", "2024-01-09_12-00-00.parquet", "2024-01-09_12-00-01.parquet"]
    by_name = {r.drop_name: r for r in idx}
    for name in os.listdir(drops):
        ids = {r.id for r in spark.read.parquet(os.path.join(drops, name)).collect()}
        assert ids == {r.id for r in df.where(F.col("load_date") == F.lit(by_name[name].load_date)).collect()}
    gone = pub.expire_drops(spark, drops, F.to_timestamp(F.lit("2024-01-30 12:00:00")), delete=True)
    assert sorted(r.drop_name for r in gone.collect()) == ["2024-01-09_11-59-59.parquet", "2024-01-09_12-00-00.parquet"]
    assert os.listdir(drops) == ["2024-01-09_12-00-01.parquet"]


def test_every_landed_file_and_entry_counts(spark, tmp_path):
    """Archives and entries of any name are loaded, each archive apart; what is no archive is a notice 03, never 02."""
    zdir, out = tmp_path / "z", str(tmp_path / "out")
    zdir.mkdir()
    xml = lambda k: ORG_XML.format(a=2 * k, b=2 * k + 1)
    for k, name in enumerate(["a.zip", "a.ZIP", "a", "_a.zip", ".a.zip", "~a.zip"]):
        _zip(zdir / name, {"X_EGRUL_2024-01-30_1.XML": xml(k)})
    _zip(zdir / "names.zip", {"_EGRUL_2024-01-30_1.XML": xml(6), "_sub/X_EGRUL_2024-01-30_1.XML": xml(7),
                              ".EGRUL_2024-01-30_1.XML": xml(8), "~_EGRUL_2024-01-30_1.XML": xml(9)})
    (zdir / "notes.txt").write_text("no archive")
    res = daily_run(spark, {"egrul": {"new": str(zdir)}}, out, "2024-01-30")
    rows = read_published(spark, out, "egrul", "ul_info").collect()
    assert sorted((str(r.load_date), r.entity_id) for r in rows) == [("2024-01-30", k) for k in range(20)]
    assert [(r.code, r.file) for r in res.audit.collect()] == [("03", "notes.txt")]
    xml_dir = str(tmp_path / "xml")
    archive.extract_archives(spark, str(zdir), xml_dir).collect()
    names = {r.src_file for r in read_drop(spark, {"new": xml_dir}, "egrul", extracted=True).collect()}
    assert names == {"X_EGRUL_2024-01-30_1.XML", "_EGRUL_2024-01-30_1.XML", "_sub__X_EGRUL_2024-01-30_1.XML",
                     ".EGRUL_2024-01-30_1.XML", "~_EGRUL_2024-01-30_1.XML"}
    only = tmp_path / "only"
    only.mkdir()
    (only / "X.TXT").write_text("no archive")
    assert [r.code for r in daily_run(spark, {"egrul": {"new": str(only)}}, out, "2024-01-31").audit.collect()] == ["03"]


def test_archives_take_files_by_path_in_chunks(spark, tmp_path):
    """A file goes into its entry and out of a spoilt archive in chunks: no task ever holds one whole."""
    import inspect

    from regfold.plans import extra_queries as q

    text = os.urandom(3 << 20) * 3
    (tmp_path / "in").mkdir()
    for k in range(6):
        (tmp_path / "in" / f"{k}.xml").write_bytes(b"%d" % k + text)
    rows = [(f"{'d/' if k < 4 else ''}{k}.XML", str(tmp_path / "in" / f"{k}.xml")) for k in range(6)]
    df = spark.createDataFrame(rows, "entry STRING, path STRING").coalesce(1)
    whole, landed = str(tmp_path / "whole"), str(tmp_path / "landed")
    made = archive.zip_partitions(df, whole, "entry", "path", from_files=True).collect()
    assert sum(r["n_entries"] for r in made) == 6
    with zipfile.ZipFile(f"{whole}/{made[0]['archive']}") as z:
        assert {n: z.read(n) for n in z.namelist()} == {n: open(p, "rb").read() for n, p in rows}
    archive.zip_partitions(df.where("false"), whole, "entry", "path", prefix="empty", from_files=True).count()
    q._spoil(spark, whole, landed)
    found = {r["entry"]: r["error"] for r in archive.archive_entries(spark, landed, "drop_*").collect()}
    assert set(found) == {n for n, _ in rows}
    assert all((found[n] is not None) == n.startswith("d/") for n in found), found
    assert sorted(os.listdir(landed)) == sorted(os.listdir(whole))
    for helper in (q._xml_files, q._land, q._spoil, q._zip_files, q.q_daily_late_parts):
        assert '"content"' not in inspect.getsource(helper)  # binaryFile's column of whole files


def test_xml_main_stages_packed_files(spark, tmp_path, monkeypatch):
    """The XML that only goes out to come back lies packed; the rows are those of the plain files."""
    from regfold.plans import extra_queries as q

    monkeypatch.setattr(q, "_stage", lambda _, name: str(tmp_path / name))
    got = q.q_xml_main(spark, SF_SMALL)
    files = glob.glob(str(tmp_path / "xml" / "*" / "*" / "part-*"))
    assert files and all(f.endswith(".xml.gz") for f in files)
    main = build_main(spark, SF_SMALL, "egrip")
    xmlsource.write_xml(main, str(tmp_path / "plain"))
    size = sum(os.path.getsize(f) for f in glob.glob(str(tmp_path / "plain" / "part-*.xml")))
    assert 4 * sum(map(os.path.getsize, files)) < size
    want = project(main, SPEC_BY_NAME["noteegrip_info"])
    assert digest(got.drop("registry", "load_date").toPandas()) == digest(want.toPandas())


def test_expanded_xml_is_packed_and_read_back(spark, tmp_path):
    """Packed pieces: the same entries, records and errors as plain ones; dropping them leaves the report."""
    zdir = tmp_path / "zips"
    zdir.mkdir()
    _zip(zdir / "a.zip", {"X_EGRUL_2022-01-01_1.XML": ORG_XML.format(a=1, b=2), "_x/X_EGRUL_2022-01-02_2.XML": ORG_XML.format(a=3, b=4),
                          "X_EGRUL_2022-01-03_3.XML": ORG_XML.format(a=5, b=6).replace("</s_name>", "", 1), "notes.txt": "no XML"})
    rows, reports = [], []
    for packed in (False, True):
        out = str(tmp_path / f"xml-{packed}")
        rep = archive.extract_archives(spark, str(zdir), out, split_bytes=100, packed=packed)
        reports.append(digest(rep.drop("attempt").toPandas()))
        files = glob.glob(f"{out}/data/*/*/*")
        assert len(files) > 3 and all(f.endswith(".XML.gz" if packed else ".XML") for f in files)
        rows.append(digest(read_drop(spark, {"new": out}, "egrul", extracted=True).select(
            "entity_id", "s_name", "s_acctbal", "src_file", "load_date", "part", "entry_id").toPandas()))
    assert rows[0] == rows[1] and reports[0] == reports[1] and rows[0][1] == 5
    archive.drop_pieces(out)
    assert not os.path.exists(f"{out}/data") and rep.count() > 0


def test_daily_run_keeps_one_copy_on_disk(spark, tmp_path, monkeypatch):
    """When the detail tables are written the expanded XML is gone and shuffle files go with their query;
    the test's drop leaves nothing but its landed archives."""
    from regfold.plans import daily
    from regfold.plans import extra_queries as q
    from regfold.session import FREE_SHUFFLES

    monkeypatch.setattr(daily, "staging_dir", lambda _, name: str(tmp_path / "work"))
    seen = []
    write = daily.fan_out_all

    def spy(session, *args, **kwargs):
        seen.append((glob.glob(str(tmp_path / "work" / "xml" / "**" / "*.XML*"), recursive=True), session.conf.get(FREE_SHUFFLES)))
        return write(session, *args, **kwargs)

    monkeypatch.setattr(daily, "fan_out_all", spy)
    before = spark.conf.get(FREE_SHUFFLES, None)
    landed = q._land(spark, SF_SMALL, "egrul", str(tmp_path / "drop"))
    left = [f for f in glob.glob(str(tmp_path / "drop" / "**"), recursive=True) if os.path.isfile(f)]
    assert left and all(f.startswith(landed + os.sep) for f in left), left
    res = daily_run(spark, {"egrul": {"new": landed}}, str(tmp_path / "out"), "2024-01-30")
    assert seen == [([], "true")] and spark.conf.get(FREE_SHUFFLES, None) == before
    assert {r.status for r in res.report.where("registry = 'egrul'").collect()} <= {"ok", "empty"}
    assert res.report.where("n_rows > 0").count() > 30


def test_late_parts_keep_only_what_is_still_needed(spark, tmp_path, monkeypatch):
    """The generated XML is packed, and it, the whole archives and the replaced landing folder go when they have been used."""
    from regfold.plans import daily
    from regfold.plans import extra_queries as q

    monkeypatch.setattr(q, "_stage", lambda _, name: str(tmp_path))
    monkeypatch.setattr(q, "_slices_by_entity", lambda *_: None)
    seen = []

    def files():
        found = [p.relative_to(tmp_path) for p in tmp_path.rglob("*") if p.is_file() and p.suffix != ".crc" and p.name != "_SUCCESS"]
        return {str(p.parts[0]) for p in found}, {p.suffix for p in found}

    monkeypatch.setattr(daily, "daily_run", lambda *args, **kwargs: seen.append(files()))
    q.q_daily_late_parts(spark, SF_SMALL)
    assert seen == [({"xml", "landed-1"}, {".gz", ".zip"}), ({"landed-2"}, {".zip"})]
