"""Column functions C1-C13 and S1/S2 on their edge cases."""

from pyspark.sql import functions as F

from regfold.functions import dates, names, paths
from regfold.sources.landing import drop_path


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_file_stem(spark):
    assert _one(spark, names.file_stem(F.lit("A_EGRUL_2022-01-01_1.XML"))) == "A_EGRUL_2022-01-01_1"
    assert _one(spark, names.file_stem(F.lit("a.xml"))) == "a.xml"          # case-sensitive
    assert _one(spark, names.file_stem(F.lit("a.XML.00002.XML"))) == "a"    # first .XML
    assert _one(spark, names.file_stem(F.lit("plain"))) == "plain"


def test_part_name_and_date_key(spark):
    pn = names.part_name(F.lit("ul_info"), F.lit("VO_EGRUL_2022-01-05_3"), F.lit("egrul"))
    assert _one(spark, pn) == "ul_info_2022-01-05_3"
    assert _one(spark, names.date_key(pn)) == "2022-01-05"
    # no register token: the whole stem follows the table name
    assert _one(spark, names.part_name(F.lit("t"), F.lit("_x_1"), F.lit("egrip"))) == "t_x_1"
    assert _one(spark, names.slice_name(F.lit("ul_info"), F.lit("2022-01-05"))) == "ul_info_2022-01-05"


def test_drop_name_sequence(spark):
    ts = F.to_timestamp(F.lit("2024-12-31 23:59:58"))
    assert _one(spark, names.drop_name(ts, F.lit(0))) == "2024-12-31_23-59-58.parquet"
    assert _one(spark, names.drop_name(ts, F.lit(3))) == "2025-01-01_00-00-01.parquet"


def test_dates(spark):
    d = F.to_date(F.lit("2023-01-01"))
    assert _one(spark, dates.folder_date(d)) == "01.01.2023"
    assert _one(spark, dates.drop_folder(d)) == "01.01.2023_FULL"
    assert _one(spark, dates.drop_folder(F.to_date(F.lit("2023-01-02")))) == "02.01.2023"
    assert _one(spark, dates.parse_drop_time(F.lit("2024-01-09_12-00-00"))) is not None
    assert _one(spark, dates.parse_drop_time(F.lit("2024-13-09_12-00-00"))) is None
    now = F.to_timestamp(F.lit("2024-01-30 12:00:00"))
    assert _one(spark, dates.age_days(F.to_timestamp(F.lit("2024-01-09 12:00:01")), now)) == 20
    assert _one(spark, dates.age_days(F.to_timestamp(F.lit("2024-01-09 12:00:00")), now)) == 21
    assert _one(spark, dates.age_days(F.to_timestamp(F.lit("2024-02-01 00:00:00")), now)) == -2  # floor


def test_paths_and_routing(spark):
    assert _one(spark, paths.base_name(F.lit("/a/b/c.zip"))) == "c.zip"
    assert _one(spark, paths.base_name(F.lit("c.zip"))) == "c.zip"
    assert _one(spark, paths.registry_of_url(F.lit("https://x/?dir=EGRIP_405/01.01.2022"))) == "egrip"
    assert _one(spark, paths.registry_of_url(F.lit("https://x/?dir=EGRUL/01.01.2022"))) == "egrul"
    assert _one(spark, paths.registry_of_url(F.lit("https://x/"))) == "egrul"  # default
    got = {(r.registry, r.schema_version): r.remote_dir for r in paths.route_table(spark).collect()}
    assert got[("egrip", "new")] == "?dir=EGRIP_405" and got[("egrul", "old")] == "?dir=EGRUL"
    p = drop_path(F.lit("https://h"), F.lit("egrul"), F.lit("new"), F.to_date(F.lit("2022-01-01")))
    assert _one(spark, p) == "https://h/?dir=EGRUL_406/01.01.2022_FULL"
