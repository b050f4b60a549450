from pyspark.sql import functions as F
import pytest

from meshroad.config import BBox, StateConfig, TEXAS, vmt_table
from meshroad.operators.volume import adjust_volume
from meshroad.plans import reports
from meshroad.plans.validate import _audited, audit_by_year, nearest_audit, totals, validate
from meshroad.sources import sinks

MATCHED = "Crash_ID long, Crash_Year int, Nearest_Station_LocationId string, Station_Count double, Station_Year long, Distance_Miles double"


@pytest.fixture(scope="module")
def out(spark):
    rows = [(i, 2016 + i % 2, f"s{i % 5}", 100.0 + i, 2015 + i % 9, i / 40) for i in range(40)]
    rows += [(100, 2016, None, None, None, None), (101, 2016, "s1", 10.0, None, 0.5), (102, 2017, "s1", 10.0, 2010, 0.5)]
    df = adjust_volume(spark.createDataFrame(rows, MATCHED), vmt_table(spark, [TEXAS]))
    return df.selectExpr("*", "30.0D as Latitude", "-97.0D as Longitude", "78701L as ZIP_Code", "Crash_Year as file_year").cache()


def test_volume_formula_and_gaps(spark, out):
    r = out.filter("Crash_ID = 3").first()
    assert (r.year_gap, r.VMT_Crash, r.VMT_Station) == (1, 273200.0, 282200.0)
    assert r.Adt_Curnt_Amt == 103.0 * (273200 / 282200) and r.Adt_Curnt_Year == 2017
    labels = {r.Crash_ID: r.aadt_match_type for r in out.filter("Crash_ID >= 100").collect()}
    assert set(labels.values()) == {"MISSING"}


def test_zero_mileage_gives_null(spark):
    df = spark.createDataFrame([(1, 2016, "s", 5.0, 2015, 0.1)], MATCHED)
    vmt = spark.sql("select * from values (2015, 0D), (2016, 7D) as t(vmt_year, vmt)")
    assert adjust_volume(df, vmt).first().VMT_Multiplier is None


def test_good_output_passes_every_check(out):
    got = {r.validation: r for r in validate(out, TEXAS).collect()}
    assert len(got) == 24 and all(r.passed for r in got.values()), [r for r in got.values() if not r.passed]
    assert got["V02 Crash_Year 2016"].msg == "distinct values = [2016]"
    assert got["V14 fill rate 2016"].msg.startswith("20/22 (90.91%)")


BAD = {
    "V02": ("Crash_Year", "2019"), "V03": ("Latitude", "cast(null as double)"), "V04": ("Distance_Miles", "1.5D"),
    "V05": ("ZIP_Code", "cast(null as bigint)"), "V06": ("year_gap", "year_gap + 1"), "V07": ("VMT_Multiplier", "VMT_Multiplier * 1.00001D"),
    "V08": ("Adt_Curnt_Amt", "Adt_Curnt_Amt * 1.0001D"), "V09": ("aadt_match_type", "'MISSING'"),
}


@pytest.mark.parametrize("check", BAD)
def test_one_bad_row_fails_its_check(out, check):
    column, value = BAD[check]
    spoilt = out.withColumn(column, F.expr(f"case when Crash_ID = 2 then {value} else {column} end"))
    failed = {r.validation[:3] for r in validate(spoilt, TEXAS).collect() if not r.passed}
    assert check in failed and failed <= {check, "V06", "V07", "V08"}


def test_range_gap_schema_and_label_rules(out):
    low = out.withColumn("Adt_Curnt_Amt", F.lit(1.0)).withColumn("Station_Count", F.col("Adt_Curnt_Amt") / F.col("VMT_Multiplier"))
    assert {r.validation for r in validate(low, TEXAS).collect() if not r.passed} >= {"V13 AADT range 2016", "V13 AADT range 2017"}
    empty = out.withColumns({"Adt_Curnt_Amt": F.lit(None).cast("double"), "year_gap": F.lit(None).cast("bigint"), "aadt_match_type": F.lit("MISSING")})
    failed = {r.validation[:3] for r in validate(empty, TEXAS).collect() if not r.passed}
    assert failed == {"V12", "V13"}
    no_column = validate(out.drop("Distance_Miles"), TEXAS).filter("validation like 'V01%'").collect()
    assert not any(r.passed for r in no_column) and "Distance_Miles" in no_column[0].msg
    unlabelled = out.withColumn("aadt_match_type", F.expr("case when Crash_ID <> 2 then aadt_match_type end"))
    assert totals(validate(unlabelled, TEXAS)).first().n_fail == 0  # a missing label is not a wrong one
    outside = out.withColumn("Longitude", F.expr("case when Crash_ID = 2 then -120D else Longitude end"))
    assert {r.validation for r in validate(outside, TEXAS).collect() if not r.passed} == {"V03 bounds 2016"}


def test_reasons_bins_and_histograms(out):
    r = reports.missing_reasons(out).first()
    assert (r.total, r.missing, r.no_coords, r.no_station, r.no_station_year, r.no_vmt) == (43, 3, 0, 1, 1, 1)
    left = [b.n for b in reports.distance_bins(out).orderBy("bin").collect()]
    right = [b.n for b in reports.distance_bins(out, closed="right").orderBy("bin").collect()]
    assert sum(left) == sum(right) == 40 and left == [4] * 10 and right == [5] + [4] * 8 + [3]
    assert [h.n for h in reports.equal_width_histogram(out, "Distance_Miles", 4).orderBy("bin").collect()] == [10, 10, 12, 10]
    assert reports.equal_width_histogram(out.filter("Crash_ID = 1"), "Distance_Miles", 4).filter("n > 0").first().bin == 2
    gaps = {h.bin: h.n for h in reports.unit_histogram(out, "year_gap").collect()}
    assert sum(gaps.values()) == 41 and min(gaps) == 0 and max(gaps) == 7


def test_export_and_sample(spark, out):
    export = reports.final_export(out.drop("ZIP_Code"))
    assert len(export.columns) == 10 and export.filter("ZIP_Code is null").count() == 43
    a = reports.sample_filled(out.repartition(1), n=5).collect()
    assert a == reports.sample_filled(out.repartition(7), n=5).collect() and len(a) == 5
    anonymous = out.drop("Crash_ID")
    assert len(set(reports.sample_filled(anonymous, n=10).select("Crash_ID").collect())) == 10


def test_write_read_and_audit(spark, out, tmp_path):
    sinks.write_yearly(out.drop("file_year"), str(tmp_path / "o"), compact=True)
    back = sinks.read_yearly(spark, str(tmp_path / "o"))
    assert back.count() == 43 and validate(back, TEXAS).filter("not passed").count() == 0
    assert "PartitionFilters: [isnotnull(file_year" in back.filter("file_year = 2016")._jdf.queryExecution().executedPlan().toString()
    counts = sinks.write_validation(validate(back, TEXAS), str(tmp_path / "v")).first()
    assert (counts.n_pass, counts.n_fail) == (24, 0)
    (tmp_path / "drop").mkdir()
    for name in ("Cleaned_Data_2016.csv", "Cleaned_Data_Final_2016.csv", "Cleaned_Data_x.csv", "other.csv"):
        (tmp_path / "drop" / name).write_text("a,b\n1,2\n")
    assert [tuple(r) for r in sinks.read_yearly_csv(spark, str(tmp_path / "drop")).collect()] == [("1", "2", 2016)]


def test_audit_finds_a_wrong_match(spark):
    stations = spark.createDataFrame([("a", 30.0, -97.0), ("b", 30.004, -97.0)], "station_id string, station_lat double, station_lon double")
    d = 0.003 * 3.141592653589793 / 180 * 3958.8
    cols = "Crash_ID long, Crash_Year int, Latitude double, Longitude double, Nearest_Station_LocationId string, Distance_Miles double"
    good = [(1, 2020, 30.001, -97.0, "a", d / 3), (2, 2020, 30.003, -97.0, "b", d / 3), (3, 2019, 30.0, -97.0, "b", 9.0)]
    assert nearest_audit(spark.createDataFrame(good, cols), stations).first().asDict() | {"worst_miles": 0} == dict(
        n=2, agree=2, id_mismatches=0, distance_mismatches=0, worst_miles=0, passed=True)
    bad = nearest_audit(spark.createDataFrame([(1, 2020, 30.001, -97.0, "b", d)], cols), stations).first()
    assert (bad.id_mismatches, bad.distance_mismatches, bad.passed) == (1, 1, False)


def test_audit_of_each_year_takes_its_first_crashes(spark):
    stations = spark.createDataFrame([("a", 30.0, -97.0), ("b", 30.004, -97.0)], "station_id string, station_lat double, station_lon double")
    d = 0.001 * 3.141592653589793 / 180 * 3958.8
    cols = "Crash_ID long, Crash_Year int, Latitude double, Longitude double, Nearest_Station_LocationId string, Distance_Miles double"
    rows = [(i, 2018 + i % 3, 30.001, -97.0, "b" if i % 3 == 1 and i > 10 else "a", d) for i in range(60)] + [(99, 2021, 30.0, -97.0, None, None)]
    out = spark.createDataFrame(rows, cols).repartition(4)
    found = {r.Crash_Year: r for r in audit_by_year(out, stations, n=1000).collect()}
    assert sorted(found) == [2018, 2019, 2020] and all(r.n == 20 for r in found.values())
    assert [found[y].passed for y in sorted(found)] == [True, False, True] and found[2019].id_mismatches == 16
    some = audit_by_year(out, stations, n=5)
    assert [r.n for r in some.collect()] == [5, 5, 5]
    ids = [r.Crash_ID for r in _audited(out, stations, 5, 42, 1.0, each_year=True).collect()]
    want = [i for y in range(3) for i in sorted((i for i in range(60) if i % 3 == y), key=lambda i: (i * 48271 + 42) % 2147483647)[:5]]
    assert sorted(ids) == sorted(want)
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan


def test_states_are_validated_with_their_own_box_and_mileage(spark, out):
    other = StateConfig(code="XX", bbox=BBox(0, 1, 0, 1), vmt={y: 2 * v for y, v in TEXAS.vmt.items()})
    both = out.withColumn("state", F.lit("TX")).unionByName(out.withColumn("state", F.lit("XX"))).unionByName(out.withColumn("state", F.lit("??")))
    got = {(r.state, r.file_year, r.validation[:3]): r for r in validate(both, TEXAS, states=[TEXAS, other]).collect()}
    alone = {(r.file_year, r.validation[:3]): r for r in validate(out, TEXAS).collect()}
    for (year, check), r in alone.items():
        assert (got["TX", year, check].passed, got["TX", year, check].msg.replace("20 cols", "")[-9:]) == (r.passed, r.msg.replace("19 cols", "")[-9:])
        assert got["XX", year, check].passed == (r.passed and check != "V03")  # the ratio of doubled miles is the same
    rows = {y: sum(1 for r in out.collect() if r.file_year == y) for y in {r.file_year for r in out.select("file_year").collect()}}
    assert all(got["??", y, "V03"].msg == f"0 null, {n} out-of-state" for y, n in rows.items())
