import json

import pytest

from meshroad.config import BBox, INCIDENT_NAME_VARIANTS, STATION_NAME_VARIANTS, StateConfig, TEXAS, TEXAS_VMT
from meshroad.operators.match import candidate_pairs, match_names, propose_names
from meshroad.plans.enrich import OUTPUT_COLUMNS, enrich
from meshroad.sources import sinks
from meshroad.sources.csv import csv_columns, file_columns, read_crashes, read_csv_text, read_stations
from meshroad.sources.geojson import read_zip_polygons

PREAMBLE = "State export\nmade on, 2024\n\nsee notes\n"
CRASHES = """ Crash_ID ,Crash_Date,Latitude,Longitude,ZIP_Code,Note
1,06/07/2020,30.001,-97.0,1,"a, quoted comma"
2,6/7/20,30.5,-97.0
3,06/07/2021,30.0,-97.001,1,x,extra,more
4,06/07/2021,bad,-97.0,1,x
"""
STATIONS = " TRFC_STATN_ID,LATITUDE ,LONGITUDE,LATEST_AADT_QTY,LATEST_AADT_YR,Other\n S1 ,30.0,-97.0,1000,2019,z\nS1,30.0,-97.0,900,2016,z\n"


def square(x0, y0, x1, y1):
    return {"type": "Polygon", "coordinates": [[[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]]}


def test_preamble_and_bad_lines(spark, tmp_path):
    f = tmp_path / "c.csv"
    f.write_text(PREAMBLE + CRASHES)
    kept = read_csv_text(spark, str(f), preamble_lines=4)
    assert kept.columns == ["Crash_ID", "Crash_Date", "Latitude", "Longitude", "ZIP_Code", "Note"]
    rows = {r.Crash_ID: r for r in kept.collect()}
    assert sorted(rows) == ["1", "2", "3", "4"] and rows["1"].Note == "a, quoted comma" and rows["2"].ZIP_Code is None
    dropped = read_csv_text(spark, str(f), preamble_lines=4, bad_lines="drop")
    assert sorted(r.Crash_ID for r in dropped.collect()) == ["1", "2", "4"]
    f2 = tmp_path / "d.csv"
    f2.write_text(CRASHES)
    assert sorted(map(tuple, read_csv_text(spark, str(f2)).collect()), key=str) == sorted(map(tuple, kept.collect()), key=str)
    assert sorted(r.Crash_ID for r in read_csv_text(spark, str(f2), bad_lines="drop").select("Crash_ID").collect()) == ["1", "2", "4"]


def text_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def jobs_of(spark, run):
    spark.sparkContext.setJobGroup(name := f"counted-{run}", "counted")
    made = run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)), made


def test_jobs_do_not_grow_with_the_files(spark, tmp_path):
    counts = []
    for n in (3, 2000):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            header = ("id,a", "a,id,b", " id ,a")[i % 3]
            (folder / f"f {i:04d} [x]%2B.csv").write_text(f"{header}\n{i},x\n")
        jobs, df = jobs_of(spark, lambda: read_csv_text(spark, str(folder)))  # noqa: B023
        counts.append(jobs)
        assert sorted(df.columns) == ["a", "b", "id"] and df.count() == n
        assert df.filter("a = 'x'").count() == n - (n + 1) // 3
    assert counts[1] <= counts[0] + 2  # Spark lists many paths in a job of its own


def test_files_with_preambles_and_headers_of_their_own(spark, tmp_path):
    (tmp_path / "a.csv").write_text("made today\nid,note\nid,note\n1,made today\nmade today\n2,\"say \"\"hi\"\", then\"\n")
    (tmp_path / "b.csv").write_text("other, preamble\nnote,id,more\nx,3,y\n\n")
    (tmp_path / "c.csv").write_text("only a preamble\n")
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text("p\nid,note\n")
    got = read_csv_text(spark, str(tmp_path), preamble_lines=1, file_column="file").selectExpr("id", "note", "more", "right(file, 5) file")
    assert text_rows(got) == sorted([("id", "note", None, "a.csv"), ("1", "made today", None, "a.csv"), ("made today", None, None, "a.csv"),
                                     ("2", 'say "hi", then', None, "a.csv"), ("3", "x", "y", "b.csv")], key=str)
    assert {r.file[-5:]: r.names for r in file_columns(spark, str(tmp_path), 1).collect()} == {
        "a.csv": ["id", "note"], "b.csv": ["note", "id", "more"], "e.csv": ["id", "note"]}
    with pytest.raises(ValueError, match="no header"):
        read_csv_text(spark, str(tmp_path / "d.csv"))
    with pytest.raises(ValueError, match="line breaks"):
        read_csv_text(spark, str(tmp_path), preamble_lines=1, multi_line=True)


def test_quoted_line_breaks_blank_and_repeated_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,,Id,_overflow,"a, b"\n1,2,3,4,"first\nsecond ""x"""\n5,6,7,8,9,10\n11\n')
    got = read_csv_text(spark, str(tmp_path / "a.csv"), multi_line=True)
    assert got.columns == ["id", "_c1", "Id_2", "_overflow", "a, b"]
    assert text_rows(got) == [("1", "2", "3", "4", 'first\nsecond "x"'), ("11", None, None, None, None), ("5", "6", "7", "8", "9")]
    assert text_rows(read_csv_text(spark, str(tmp_path / "a.csv"), multi_line=True, bad_lines="drop"))[-1][0] == "11"
    assert text_rows(csv_columns(spark, str(tmp_path / "a.csv"))) == [("Id_2", 2), ("_c1", 1), ("_overflow", 3), ("a, b", 4), ("id", 0)]


def test_yearly_files_and_their_columns(spark, tmp_path):
    for year, text in ((2020, "Crash_ID,Adt_Curnt_Amt\n1,5.0\n"), (2021, "Adt_Curnt_Amt,Crash_ID,Extra\nbad,2,z\n")):
        (tmp_path / f"Cleaned_Data_{year}.csv").write_text(text)
    (tmp_path / "Cleaned_Data_notes.csv").write_text("x\n1\n")
    rows = sinks.read_yearly_csv(spark, str(tmp_path)).select("Crash_ID", "Adt_Curnt_Amt", "Extra", "file_year")
    assert text_rows(rows.selectExpr("cast(Crash_ID as string) i", "Adt_Curnt_Amt", "Extra", "file_year")) == [("1", 5.0, None, 2020), ("2", None, "z", 2021)]
    assert text_rows(sinks.yearly_columns(spark, str(tmp_path), "files")) == [
        (2020, "Adt_Curnt_Amt"), (2020, "Crash_ID"), (2021, "Adt_Curnt_Amt"), (2021, "Crash_ID"), (2021, "Extra")]


def test_only_the_years_and_states_that_are_written_change(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(r, "state string, Crash_ID string, Crash_Year int")
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        sinks.write_yearly(rows(("TX", "1", 2020), ("TX", "2", 2021), ("N+ Y:%", "3", 2020)), path, fmt=fmt)
        sinks.write_yearly(rows(("TX", "9", 2020)), path, fmt=fmt)
        got = sinks.read_yearly(spark, path, fmt=fmt).selectExpr("state", "cast(Crash_ID as string) i", "file_year")
        assert text_rows(got) == [("N+ Y:%", "3", 2020), ("TX", "2", 2021), ("TX", "9", 2020)]


def test_geojson_both_layouts(spark, tmp_path):
    feats = [{"type": "Feature", "properties": {"ZCTA5CE10": "78701"}, "geometry": square(-98, 29, -97, 30)},
             {"type": "Feature", "properties": {"ZCTA5CE10": "78702"}, "geometry": {
                 "type": "MultiPolygon", "coordinates": [square(0, 0, 1, 1)["coordinates"], square(2, 2, 3, 3)["coordinates"]]}},
             {"type": "Feature", "properties": {"ZCTA5CE10": "p"}, "geometry": {"type": "Point", "coordinates": [0, 0]}}]
    doc, lines = tmp_path / "z.json", tmp_path / "z.jsonl"
    doc.write_text(json.dumps({"type": "FeatureCollection", "features": feats}, indent=1))
    lines.write_text("\n".join(map(json.dumps, feats)))
    for path, by_line in ((doc, False), (lines, True)):
        got = {r.zip: r.mp for r in read_zip_polygons(spark, str(path), line_delimited=by_line).collect()}
        assert sorted(got) == ["78701", "78702"] and len(got["78702"]) == 2 and got["78701"][0][0][1] == [-97.0, 29.0]


def test_from_files_to_output_in_two_states(spark, tmp_path):
    (tmp_path / "c.csv").write_text(PREAMBLE + CRASHES)
    (tmp_path / "s.csv").write_text(STATIONS)
    (tmp_path / "z.json").write_text(json.dumps({"features": [{"properties": {"ZCTA5CE10": "78701"}, "geometry": square(-98, 29, -96, 31)}]}))
    tx = StateConfig(code="TX", bbox=TEXAS.bbox, vmt=TEXAS_VMT, preamble_lines=4)
    xx = StateConfig(code="XX", bbox=BBox(29, 31, -98, -96), vmt={2019: 1, 2020: 3, 2021: 5}, preamble_lines=4)
    crashes = [read_crashes(spark, str(tmp_path / "c.csv"), s) for s in (tx, xx)]
    stations = [read_stations(spark, str(tmp_path / "s.csv"), s) for s in (tx, xx)]
    zips = read_zip_polygons(spark, str(tmp_path / "z.json"))
    one = enrich(crashes[0].drop("state"), stations[0].drop("state"), tx, polygons=zips)
    assert tuple(one.columns) == OUTPUT_COLUMNS
    got = {r.Crash_ID: r for r in one.collect()}
    assert sorted(got) == ["1", "2", "3"] and got["1"].Station_Count == 1000.0 and got["2"].aadt_match_type == "MISSING"
    assert got["3"].Adt_Curnt_Amt == 1000.0 * (285200 / 288400) and got["3"].ZIP_Code == 78701
    polygons = zips.selectExpr("'TX' as state", "*").unionByName(zips.selectExpr("'XX' as state", "*"))
    both = enrich(crashes[0].unionByName(crashes[1]), stations[0].unionByName(stations[1]), tx,
                  polygons=polygons, states=[tx, xx], by=["state"])
    rows = {(r.state, r.Crash_ID): r.Adt_Curnt_Amt for r in both.collect()}
    assert len(rows) == 6 and rows["TX", "3"] == got["3"].Adt_Curnt_Amt and rows["XX", "3"] == 5000.0


def test_name_proposals(spark, tmp_path):
    (tmp_path / "h.csv").write_text("LAT,Latitude,CaseNumbr,IncidentDate,LNG,Postal Code,unrelated\n1,2,3,4,5,6,7\n")
    names = csv_columns(spark, str(tmp_path / "h.csv"))
    got = {r.canonical: (r.actual, r.score, r.tag) for r in propose_names(names, INCIDENT_NAME_VARIANTS).collect()}
    assert got == {"Crash_ID": ("CaseNumbr", 90, "check"), "Crash_Date": ("IncidentDate", 100, "exact"),
                   "Latitude": ("LAT", 100, "exact"), "Longitude": ("LNG", 100, "exact"), "ZIP_Code": ("Postal Code", 100, "exact")}
    assert {r.canonical for r in propose_names(names, STATION_NAME_VARIANTS).collect()} == set(STATION_NAME_VARIANTS)


def test_names_of_two_tables(spark):
    import random

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    rnd = random.Random(1)
    right = ["".join(rnd.choice("abab ") for _ in range(rnd.randrange(1, 14))) for _ in range(60)] + ["aaaaaaaaaa", "Main Street", "main street", "", None, "--", "Market Street"]
    left = []
    for w in [w for w in right if w]:
        cut, letter = rnd.randrange(len(w) + 1), rnd.choice("abxyz")
        left += [w, w[:cut] + w[cut + 1:], w[:cut] + letter + w[cut:], w.upper()]
    left += [None, "", "!!", "nothing alike"]
    plain = lambda w: "".join(c for c in w.lower() if c.isascii() and c.isalnum())
    for least in (68, 80, 100):
        want = {}
        for w in set(left):
            best = None
            for r in sorted({min(x for x in right if x and plain(x) == p) for p in {plain(x) for x in right if x} if p}):
                if w and plain(w):
                    n = max(len(plain(w)), len(plain(r)))
                    score = 100 * (n - distance(plain(w), plain(r))) // n
                    if score >= least and (best is None or score > best[1]):
                        best = (r, score)
            want[w] = best or (None, None)
        for bytes_ in (1 << 20, 0):
            df = match_names(spark.createDataFrame([(w,) for w in left], "name string"), spark.createDataFrame([(w,) for w in right], "name string"),
                             least=least, broadcast_bytes=bytes_)
            assert {r.name: (r.match, r.score) for r in df.collect()} == want
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Cross" not in plan and "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="least"):
        match_names(df, df, least=60)


def test_names_of_few_words_meet_few_others(spark):
    """Names made of few words share most pieces; the candidates must not be all pairs."""
    colours, things, brands, kinds = "large small red blue hot cold".split(), "ring bolt plate screw".split(), range(1, 26), "ECONOMY LARGE PROMO".split()
    right = [f"{c} {t} Brand#{b} {k}" for c in colours for t in things for b in brands for k in kinds]
    left = [n[:i % len(n)] + n[i % len(n) + 1:] for i, n in enumerate(right)]
    frames = [spark.createDataFrame([(n,) for n in names], "name string") for names in (left, right)]
    plain = [f.selectExpr("lower(regexp_replace(name, '[^A-Za-z0-9]', '')) as plain").distinct() for f in frames]
    assert candidate_pairs(*plain, 95).count() < len(left) * len(right) / 10
    got = {r.name: (r.match, r.score) for r in match_names(*frames).collect()}
    assert set(got) == set(left) and all(m is not None and s >= 90 for m, s in got.values())
