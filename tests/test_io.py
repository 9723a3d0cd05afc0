import json
import os
import tempfile

import pytest

from catchment import schemas
from catchment.sources import files, sinks
from helpers import rows


def test_typed_csv_with_grouping_marks_and_na(spark, tmp_path):
    p = tmp_path / "pops.csv"
    p.write_text('DBUID,pop\n35061234001,"1,234"\n35061234002,NA\n35069999001,x\n35069999002,\n')
    df = files.read_block_pops(spark, str(p))
    assert rows(df) == [("35061234001", 1234.0, "35061234"), ("35061234002", None, "35061234"),
                        ("35069999001", None, "35069999"), ("35069999002", None, "35069999")]


def test_destinations_csv_renames_and_booleans(spark, tmp_path):
    p = tmp_path / "d.csv"
    p.write_text("cpso,lat,lng,family_physician,french\n1,45.1,-75.2,TRUE,FALSE\n2,45.2,-75.3,TRUE,TRUE\n3,45.3,-75.4,NA,TRUE\n")
    df = files.read_destinations(spark, str(p))
    assert df.columns == ["dest_id", "lat", "lon", "in_scope", "sub"]
    assert rows(df) == [("1", 45.1, -75.2, True, False), ("2", 45.2, -75.3, True, True), ("3", 45.3, -75.4, None, True)]


def test_geojson_polygon_and_multipolygon(spark, tmp_path):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"zone_id": "7", "name": "a", "name_alt": ""},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
        {"type": "Feature", "properties": {"zone_id": "8", "name": "b", "name_alt": "bb"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]],
                                                              [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
    ]}
    p = tmp_path / "z.geojson"
    p.write_text(json.dumps(fc))
    df = files.read_zones_geojson(spark, str(p))
    got = {r["zone_id"]: r for r in df.collect()}
    assert got[7]["name_alt"] == "" and len(got[7]["rings"]) == 1 and got[7]["rings"][0][1]["x"] == 1.0
    assert len(got[8]["rings"]) == 2 and got[8]["rings"][1][0]["y"] == 5.0


def test_partitioned_sink_requires_mode(spark, tmp_path):
    df = spark.createDataFrame([("b", "d", "auto", 1.0, 60.0), ("b", "d", "pedestrian", 1.0, 600.0)], schemas.OD)
    out = str(tmp_path / "od")
    sinks.write_partitioned(df, out, by="mode")
    assert {"mode=auto", "mode=pedestrian"} <= set(os.listdir(out))
    back = files.read_od(spark, out)
    assert back.where("mode = 'auto'").count() == 1
    with pytest.raises(ValueError):
        sinks.write_partitioned(df.drop("mode"), str(tmp_path / "x"), by="mode")


def test_area_attributes_and_block_points(spark, tmp_path):
    p = tmp_path / "da.csv"
    p.write_text("area_id,attribute_id,a,b,value,v2,v3\n35061234,7002,x,y,12.5,1,2\n35061235,7002,x,y,NA,,\n")
    df = files.read_area_attributes(spark, str(p))
    assert rows(df.select("area_id", "attribute_id", "value")) == [("35061234", "7002", 12.5), ("35061235", "7002", None)]
    q = tmp_path / "pts.csv"
    q.write_text("DBUID,lon,lat\n35061234001,-75.7,45.4\n35061234002,x,45.5\n")
    pts = files.read_block_points(spark, str(q))
    assert rows(pts) == [("35061234001", -75.7, 45.4), ("35061234002", None, 45.5)]


def test_single_file_table_sink(spark, tmp_path):
    df = spark.createDataFrame([("Overall", "time_all", 1.5), ("Rural", "time_all", None)], "c string, v string, p double")
    out = str(tmp_path / "t")
    sinks.write_table_file(df, out)
    parts = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(parts) == 1
    text = open(os.path.join(out, parts[0])).read().splitlines()
    assert text[0] == "c,v,p" and "Rural,time_all,NA" in text


def test_published_order_kept_per_partition(spark, tmp_path):
    import random
    rnd = random.Random(3)
    data = [(m, i, rnd.random()) for m in ("auto", "pedestrian") for i in range(300)] + [("auto", 999, None)]
    df = spark.createDataFrame(data, "mode string, zone_id int, time_all double").repartition(7)
    out = str(tmp_path / "pub")
    sinks.write_published(df, out, order=[("time_all", True)], by="mode")
    for m in ("auto", "pedestrian"):
        back = spark.read.schema("zone_id int, time_all double").option("header", True).option("nullValue", "NA").csv(f"{out}/mode={m}")
        vals = [r["time_all"] for r in back.collect()]
        nn = [v for v in vals if v is not None]
        assert nn == sorted(nn, reverse=True)
        assert vals[-1] is None if m == "auto" else None not in vals


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    p = tmp_path / "d.csv"
    p.write_text("french,extra,cpso,lng,lat,family_physician\nTRUE,9,1,-75.2,45.1,FALSE\nFALSE,9,2,-75.3,45.2,TRUE\n")
    assert rows(files.read_destinations(spark, str(p))) == [("1", 45.1, -75.2, False, True), ("2", 45.2, -75.3, True, False)]
    q = tmp_path / "bad.csv"
    q.write_text("cpso,lat,lng,french\n1,45.1,-75.2,TRUE\n")
    with pytest.raises(ValueError, match="family_physician"):
        files.read_destinations(spark, str(q))
    z = tmp_path / "lookup.csv"
    z.write_text("zone_id,block_id\n99999999999,a\n7,b\nx,c\n1e999,d\n")
    assert rows(files.read_table(spark, str(z), schemas.LOOKUP)) == [("a", None), ("b", 7), ("c", None), ("d", None)]
    a = tmp_path / "area.csv"
    a.write_text("T_DATA_DONNEE,DAUID,TEXT_ID\n12.5,35061234,7002\n")
    assert rows(files.read_area_attributes(spark, str(a))) == [("35061234", "7002", 12.5)]


def test_stored_tables_go_in_one_call(spark):
    from catchment.session import drop_stored, materialize, shared_dir, stored_dir

    folder = stored_dir(spark).removeprefix("file:")
    other = shared_dir(spark).removeprefix("file:") + "/catchment-tables/another-application"
    os.makedirs(other, exist_ok=True)
    assert materialize(spark.range(3)).count() == 3 and os.listdir(folder)
    drop_stored(spark)
    assert not os.path.exists(folder) and os.path.exists(other)
    assert materialize(spark.range(4)).count() == 4


def od_rows(spark, path):
    return rows(files.read_od(spark, path).select("mode", "block_id", "distance"))


def test_rewriting_one_mode_keeps_the_others(spark, tmp_path):
    df = spark.createDataFrame([("a", "d", "auto", 1.0, 1.0), ("b", "d", "pedestrian", 2.0, 2.0)], schemas.OD)
    auto, walk = df.where("mode = 'auto'"), df.where("mode = 'pedestrian'")
    out = str(tmp_path / "od")
    sinks.write_partitioned(auto, out)
    sinks.write_partitioned(walk, out)
    sinks.write_partitioned(auto.withColumn("distance", auto.distance + 9), out)
    assert od_rows(spark, out) == [("auto", "a", 10.0), ("pedestrian", "b", 2.0)]
    sinks.write_partitioned(auto.limit(0), out)  # holds no mode: nothing goes
    assert len(od_rows(spark, out)) == 2
    sinks.write_partitioned(walk, out, expect=["auto", "pedestrian"])  # both are meant, one is empty now
    assert od_rows(spark, out) == [("pedestrian", "b", 2.0)]
    sinks.write_partitioned(auto, out, replace="all")
    assert od_rows(spark, out) == [("auto", "a", 1.0)]
    with pytest.raises(ValueError, match="replace"):
        sinks.write_partitioned(auto, out, replace="some")
    failing = auto.withColumn("distance", auto.distance / 0)  # ends the job under ANSI rules
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.write_partitioned(failing, out)
    assert od_rows(spark, out) == [("auto", "a", 1.0)]


def test_publishing_one_mode_keeps_the_others(spark, tmp_path):
    df = spark.createDataFrame([("auto", 1, 5.0), ("auto", 2, 7.0), ("pedestrian", 1, None)], "mode string, zone_id int, time_all double")
    out = str(tmp_path / "gap")

    def published():
        return rows(spark.read.option("header", True).option("nullValue", "NA").schema("zone_id int, time_all double, mode string").csv(out))

    for m in ("auto", "pedestrian"):
        sinks.write_published(df.where(df["mode"] == m), out, [("time_all", True)], by="mode")
    assert published() == [(1, 5.0, "auto"), (1, None, "pedestrian"), (2, 7.0, "auto")]
    sinks.write_published(df.where("zone_id = 2"), out, by="mode")
    assert published() == [(1, None, "pedestrian"), (2, 7.0, "auto")]
    sinks.write_published(df.where("zone_id = 2"), out, by="mode", replace="all")
    assert published() == [(2, 7.0, "auto")]


def test_bucketed_od_needs_no_exchange(spark, tmp_path):
    from catchment.operators.nearest import nearest_k_mean

    od = spark.createDataFrame([(f"b{i % 40}", f"d{i % 7}", m, float(i % 13), float(i % 17)) for i in range(400) for m in ("auto", "walk")], schemas.OD)
    out = str(tmp_path / "od")
    sinks.write_od_buckets(od.repartition(5), out, 4)
    back = files.read_od_buckets(spark, out)
    assert rows(back) == rows(od.select(*back.columns))
    means = nearest_k_mean(back, keys=["block_id", "mode"])
    means.collect()
    plan = means._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert rows(means) == rows(nearest_k_mean(od, keys=["block_id", "mode"]))
    one = back.where("mode = 'auto'")
    assert one.count() == 400 and "PartitionFilters: [isnotnull(mode" in one._jdf.queryExecution().executedPlan().toString()
    sinks.write_od_buckets(od.where("mode = 'auto'"), out, 2)  # written anew
    assert files.read_od_buckets(spark, out).count() == 400


def test_failures_of_a_typed_scan(spark, tmp_path):
    p = tmp_path / "pops.csv"
    p.write_text('DBUID,pop,note\n1,"1,234",a\n2,unknown,b\n3,NA,c\n4,,d\n5,12\n6,7,x,y,z\n"q""7",many,e\n')
    typed, failed = files.read_csv_checked(spark, str(p), schemas.BLOCK_POPS_CSV, rename={"DBUID": "block_id"})
    assert typed.columns == ["block_id", "pop"]
    assert rows(typed) == rows(files.read_csv(spark, str(p), schemas.BLOCK_POPS_CSV, rename={"DBUID": "block_id"}))
    got = sorted((r["column"] or "", r.text, json.loads(r.row)["DBUID"]) for r in failed.collect())
    assert got == [("", "5,12", "5"), ("", "6,7,x,y,z", "6"), ("pop", "many", 'q"7'), ("pop", "unknown", "2")]
    assert {r.file for r in failed.collect()} == {"pops.csv"}
    d = tmp_path / "d.csv"
    d.write_text("1,45.1,-75.2,maybe,FALSE\n2,north,-75.3,TRUE,TRUE\n")
    typed, failed = files.read_csv_checked(spark, str(d), schemas.DESTINATIONS_CSV, header=False)
    assert sorted((r["column"], r.text) for r in failed.collect()) == [("family_physician", "maybe"), ("lat", "north")]
    assert typed.count() == 2
