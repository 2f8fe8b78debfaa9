"""What the daily intake must not lose: neighbours of bad entries, parts of a date, slices under a failed run, broken records."""

import glob
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, digest
from regfold.operators.shapes import project, project_together, together
from regfold.plans import commits, daily, fanout
from regfold.plans.compaction import compact, file_counts
from regfold.plans.daily import daily_run, verify
from regfold.plans.specs import specs_for
from regfold.sources import archive
from regfold.sources.fixtures import build_main
from regfold.sources.records import Records


def xml(ids):
    rows = "".join(f"<Entity><entity_id>{i}</entity_id><s_name>n{i}</s_name></Entity>\n" for i in ids)
    return f"<Entities>\n{rows}</Entities>\n"


def put(path, entries):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in entries:
            z.writestr(name, text)


def spoil(path, entry, how):
    data = bytearray(path.read_bytes())
    with zipfile.ZipFile(path) as z:
        infos = z.infolist()
        at = z.start_dir
    for i in infos:
        if i.filename == entry:
            if how == "header":
                data[i.header_offset] ^= 0xFF
            else:  # called encrypted
                data[i.header_offset + 6] |= 1
                data[at + 8] |= 1
        at += 46 + len(i.orig_filename.encode()) + len(i.extra) + len(i.comment)
    path.write_bytes(bytes(data))


def published(spark, out, table="ul_info"):
    return sorted((str(r.load_date), r.entity_id) for r in fanout.read_published(spark, out, "egrul", table).collect())


D = "2024-01-30"


@pytest.mark.filterwarnings("ignore:Duplicate name")
def test_bad_entries_cost_their_neighbours_nothing(spark, tmp_path):
    """Damaged headers, encrypted entries, names that repeat or flatten to one, in one archive; a day later nothing is loaded again."""
    zdir, out = tmp_path / "z", str(tmp_path / "out")
    zdir.mkdir()
    put(zdir / "a.zip", [(f"X_EGRUL_{D}_1.XML", xml([1, 2])), (f"X_EGRUL_{D}_2.XML", xml([3])), (f"X_EGRUL_{D}_3.XML", xml([4, 5])),
                         (f"X_EGRUL_{D}_4.XML", xml([6])), (f"x/X_EGRUL_{D}_5.XML", xml([7])), (f"x__X_EGRUL_{D}_5.XML", xml([8])),
                         (f"X_EGRUL_{D}_6.XML", xml([9])), (f"X_EGRUL_{D}_6.XML", xml([10]))])
    spoil(zdir / "a.zip", f"X_EGRUL_{D}_2.XML", "header")
    spoil(zdir / "a.zip", f"X_EGRUL_{D}_4.XML", "flag")
    run = lambda date: daily_run(spark, {"egrul": {"new": str(zdir)}}, out, date)
    first = run(D)
    want = [(D, k) for k in (1, 2, 4, 5, 7, 8, 9, 10)]
    assert published(spark, out) == want
    assert [r.code for r in first.audit.collect()] == ["03", "03"]
    assert {r.table: r.status for r in first.report.collect()}["ul_info"] == "ok"
    seen = spark.read.parquet(os.path.join(out, "_intake"))
    assert seen.count() == 8 and seen.where("error is not null").count() == 2
    idle = run("2024-01-31")  # damaged entries are known: nothing is loaded, no date is touched
    assert sum(r.n_rows for r in idle.report.collect()) == 0 and published(spark, out) == want
    (zdir / "a.zip").unlink()  # the folder is replaced: an entry lands again, whole, and a late part
    put(zdir / "a.zip", [(f"X_EGRUL_{D}_2.XML", xml([3]))])
    put(zdir / "late.zip", [(f"X_EGRUL_{D}_9.XML", xml([20, 21]))])
    late = run("2024-02-01")
    assert published(spark, out) == sorted([*want, (D, 3), (D, 20), (D, 21)])
    row = {r.table: r for r in late.report.collect()}["ul_info"]
    assert (row.n_rows, row.n_expected, row.status) == (11, 11, "ok")


def test_a_failed_run_leaves_slices_and_is_repeated(spark, tmp_path, monkeypatch):
    zdir, out = tmp_path / "z", str(tmp_path / "out")
    zdir.mkdir()
    put(zdir / "a.zip", [(f"X_EGRUL_{D}_1.XML", xml([1, 2]))])
    daily_run(spark, {"egrul": {"new": str(zdir)}}, out, D)
    put(zdir / "a.zip", [(f"X_EGRUL_{D}_1.XML", xml([1, 2, 3]))])
    real = fanout.write_table

    def dies(df, root, registry, table, *more):
        if table == "ul_name":
            raise RuntimeError("lost")
        return real(df, root, registry, table, *more)

    monkeypatch.setattr(fanout, "write_table", dies)
    with pytest.raises(RuntimeError, match="lost"):
        daily_run(spark, {"egrul": {"new": str(zdir)}}, out, "2024-01-31")
    assert published(spark, out) == [(D, 1), (D, 2)]
    monkeypatch.setattr(fanout, "write_table", real)
    daily_run(spark, {"egrul": {"new": str(zdir)}}, out, "2024-01-31")
    assert published(spark, out) == [(D, 1), (D, 2), (D, 3)]
    # the folders of the run that died are gone, those of the commit before are kept for its readers
    state = commits.current(out)
    runs = {commits.value_in(p, "run") for p in glob.glob(f"{out}/registry=egrul/table=ul_info/run=*")}
    assert runs == {run for _, run in state.runs} and state.number == 2
    # a value garbled behind the manifest's back is found
    assert {r.status for r in verify(spark, out).collect()} == {"ok"}
    path = commits.slice_folders(spark, out, state.slices, "ul_info")[0]
    rows = [r.asDict() for r in spark.read.parquet(path).collect()]
    schema = spark.read.parquet(path).schema
    rows[0]["s_name"] = "garbled"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)
    bad = [r for r in verify(spark, out).collect() if r.status != "ok"]
    assert [(r.table, r.n_rows, r.n_found, r.status) for r in bad] == [("ul_info", 3, 3, "mismatch")]


def test_a_broken_tag_costs_one_record(spark, tmp_path):
    zdir, out = tmp_path / "z", str(tmp_path / "out")
    zdir.mkdir()
    good = xml(range(300))
    bad = good.replace("<s_name>n100</s_name>", "<s_name>n100</s_nam>").replace("n200</s_name></Entity>", "n200</s_name>")
    put(zdir / "a.zip", [(f"X_EGRUL_{D}_1.XML", bad), (f"X_EGRUL_{D}_2.XML", xml([1000]) + "<Entity>" + "x")])
    res = daily_run(spark, {"egrul": {"new": str(zdir)}}, out, D)
    assert [i for _, i in published(spark, out)] == [*(k for k in range(300) if k not in (100, 200)), 1000]
    notices = sorted((r.code, r.file, r.message) for r in res.audit.collect())
    at = [bad.index("<Entity><entity_id>100<"), bad.index("<Entity><entity_id>200<")]
    assert [(c, f) for c, f, _ in notices] == [("04", f"X_EGRUL_{D}_1.XML")] * 2 + [("04", f"X_EGRUL_{D}_2.XML")]
    assert all(any(f"byte: {k}" in m for _, _, m in notices) for k in at)


def records_of(text, size, encoding="utf-8"):
    data = text.encode(encoding)
    at = [min(size * 3, len(data))]

    def read():
        at[0] += size
        return data[at[0] - size:at[0]]

    cut = Records(data[:at[0]], read, "Entity")
    got = list(cut.runs())
    return cut, b"".join(r for r, _, _ in got if r is not None), [(o, e) for r, o, e in got if r is None]


@pytest.mark.parametrize("size", [40, 64, 1000, 10**6])
def test_records_of_odd_files(size):
    head = '<?xml version="1.0" encoding="{}"?>\n<Root a="1">\n'
    for encoding in ("utf-8", "windows-1251"):
        body = "<Entity><n>Орг &amp; Ко</n></Entity>\n<Entity x='1'><n><![CDATA[a < b]]></n></Entity><Entity/>\n"
        cut, got, bad = records_of(head.format(encoding) + body * 5 + "</Root>\n", size, encoding)
        assert got.decode(encoding).replace("\n", "") == (body * 5).replace("\n", "") and not bad
        assert cut.trailer == b"</Root>\n" and cut.header.decode(encoding) == head.format(encoding)
    broken = ["<Entity><n>1</m></Entity>", "<Entity><n>&nope;</n></Entity>", "<Entity><n 1</n></Entity>", "<Entity><n>\x01</n></Entity>"]
    for b in broken:
        text = head.format("utf-8") + "<Entity>1</Entity>" + b + "<Entity>2</Entity></Root>"
        _, got, bad = records_of(text, size)
        assert got == b"<Entity>1</Entity><Entity>2</Entity>" and [o for o, _ in bad] == [text.index(b)]
    _, got, bad = records_of(head.format("utf-8") + "<Entity>1</Entity><Entity>2<Entity>3</Entity></Root>", size)
    assert got == b"<Entity>1</Entity><Entity>3</Entity>" and len(bad) == 1  # its end is missing, the next one stays
    _, got, bad = records_of(head.format("utf-8") + "<Entity>1</Entity><Entity>2", size)
    assert got == b"<Entity>1</Entity>" and len(bad) == 1
    assert not records_of(head.format("utf-8") + "</Root>", size)[0].found


def test_tables_from_one_scan_have_their_rows(spark):
    """Fewer scans than tables, and the same rows as table by table."""
    assert sum(len(together(list(specs_for(r)))) for r in ("egrip", "egrul")) <= 35
    for registry in ("egrip", "egrul"):
        main = build_main(spark, SF_SMALL, registry, page_size=40).persist()
        for group in together(list(specs_for(registry))):
            if len(group) > 1:
                both = project_together(main, group).persist()
                for spec in group:
                    want = project(main, spec)
                    assert digest(both.where(F.col("table") == spec.name).select(want.columns).toPandas()) == digest(want.toPandas())
                both.unpersist()
        main.unpersist()


def test_compaction_keeps_rows_and_old_files_for_readers(spark, tmp_path):
    out = str(tmp_path)
    df = spark.range(0, 4000, 1, 40).selectExpr("id AS entity_id", "CAST(id % 7 AS STRING) AS s_name",
                                                "IF(id % 2 = 0, date'2024-01-30', null) AS load_date")
    df.write.partitionBy("load_date").parquet(f"{out}/registry=egrul/table=ul_info/run=r1")
    commits.commit(out, commits.State().after(D, "r1", {"egrul": [D, commits.UNDATED]}))
    before = fanout.read_published(spark, out, "egrul", "ul_info")
    want = digest(before.toPandas())
    assert compact(spark, out) == {"egrul": [D, commits.UNDATED]}
    assert [r.n_files for r in file_counts(spark, out).collect()] == [1, 1]
    assert digest(fanout.read_published(spark, out, "egrul", "ul_info").toPandas()) == want == digest(before.toPandas())
    assert compact(spark, out) == {}


def test_tasks_follow_bytes(spark, tmp_path, monkeypatch):
    """Large entries whose names sort together do not share a task beyond one stretch of bytes."""
    monkeypatch.setattr(archive, "TASK_BYTES", 1000)
    sizes = [900] * 5 + [10] * 200 + [5000] + [10] * 50
    rows = [("a.zip" if k < 150 else "b.zip", "p", f"e{k:04d}", 0, k, str(k), n, 1, 1, None) for k, n in enumerate(sizes)]
    spread = archive._spread(spark.createDataFrame(rows, archive.LIST_SCHEMA))
    per_task = [sum(r.size for r in part) for part in spread.rdd.glom().collect() if part]
    assert sum(per_task) == sum(sizes) and sorted(per_task)[-1] <= 6000 and sorted(per_task)[-2] <= 2000
    assert daily.ENTRY_FAULTS
