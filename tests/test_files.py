from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from matchday import schema
from matchday.functions.scalars import cast_stats
from matchday.sources import files
from matchday.sources.messages import land_flagged, split_quarantine, to_messages

OLD = "Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR,\n" + "".join(
    f'E0,{day:02}/08/08,"Team, A{day}",B{day},{day % 4},,H,\n' for day in range(1, 29)
)
NEW = "Div,Date,HomeTeam,AwayTeam,FTR,FTHG,FTAG,HS,AS,B365H\n" + "".join(
    f"SP1,{day:02}/08/2021,C{day},D{day},A,{day % 3},2,{day},{day + 1},1.{day}\n" for day in range(1, 29)
) + ",,,,,,,,,\n"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "E0_0809.csv").write_text(OLD)
    (tmp_path / "E0_0910.csv").write_text(OLD)
    (tmp_path / "SP1_2122.csv").write_text(NEW)
    (tmp_path / "D1_2122.csv").write_text("<html>not found</html>")
    (tmp_path / "notes.txt").write_text("x" * 2_000)
    return str(tmp_path)


def test_csv_scan_is_text_with_null_blanks(spark, folder):
    rows = files.csv_scan(spark, f"{folder}/E0_0809.csv")
    assert set(dict(rows.dtypes).values()) == {"string"}
    assert rows.where(F.col("FTAG").isNull()).count() == 28


def test_file_gate(spark, folder):
    names = {row["path"].rsplit("/", 1)[1] for row in files.accepted(files.list_files(spark, folder)).collect()}
    assert names == {"E0_0809.csv", "E0_0910.csv", "SP1_2122.csv"}


def test_no_file_is_an_error(spark, tmp_path):
    (tmp_path / "E0_0809.csv").write_text("x")
    with pytest.raises(ValueError):
        files.csv_union(spark, str(tmp_path))


def test_column_names():
    assert files.column_names("\ufeffDiv,Date,,FTR,FTR, HS ") == ["Div", "Date", "_c2", "FTR", "_c4", "HS"]
    assert files.column_names("_c1,,_corner,a,A") == ["_c1", "_c1_", "_corner", "a", "_c4"]


def test_odd_columns_are_kept(spark, tmp_path):
    lines = "Date,HomeTeam,AwayTeam,HY,HY,,_corner\n" + "".join(f"{i},a,b,1,2,3,4\n" for i in range(99))
    (tmp_path / "E0_0809.csv").write_text(lines)
    (tmp_path / "E0_0910.csv").write_text("<html>,x\n" * 99)
    rows = files.csv_union(spark, str(tmp_path))
    assert rows.count() == 99
    first = rows.first()
    assert [first[name] for name in ("HY", "_c4", "_c5", "_corner", "Season")] == ["1", "2", "3", "4", "0809"]


def test_csv_union_by_name(spark, folder):
    rows = files.csv_union(spark, folder).cache()
    assert {"HS", "AS", "B365H", "Season", "League"} <= set(rows.columns)
    counts = {(r["Season"], r["League"]): r["count"] for r in rows.groupBy("Season", "League").count().collect()}
    assert counts == {("0809", "E0"): 28, ("0910", "E0"): 28, ("2122", "SP1"): 29}
    old = rows.where("Season = '0809' AND Date = '03/08/08'").first()
    assert (old["HomeTeam"], old["FTHG"], old["FTAG"], old["FTR"], old["HS"]) == ("Team, A3", "3", None, "H", None)
    new = rows.where("Season = '2122' AND Date = '03/08/2021'").first()
    assert (new["FTR"], new["FTHG"], new["FTAG"], new["AS"], new["B365H"]) == ("A", "0", "2", "4", "1.3")


def test_one_scan_for_all_layouts(spark, tmp_path):
    head = "Date,HomeTeam,AwayTeam,"
    for year in range(10, 40):
        lines = f"x{year},{head}a,A\n" + "".join(f"{year},d{i},h,w,{i},{i + 1}\n" for i in range(60))
        (tmp_path / f"E0_{year}{year + 1}.csv").write_text(lines)
    rows = files.csv_union(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" csv") == 1
    assert rows.count() == 30 * 60
    row = rows.where("Season = '2021' AND Date = 'd7'").first()
    assert [row[name] for name in ("x20", "x21", "a", "_c5")] == ["20", None, "7", "8"]


def test_csv_to_messages_and_back(spark, folder, same):
    rows = files.csv_union(spark, folder)
    flagged = land_flagged(to_messages(rows), schema.SHORT_MESSAGE, schema.NATURAL_KEY)
    good, bad = split_quarantine(flagged)
    assert good.count() == 84
    # the line of commas became a message with Season and League only
    assert [row["raw"] for row in bad.collect()] == ['{"Season":"2122","League":"SP1"}']
    shared = [name for name in schema.SHORT_MESSAGE_FIELDS if name in rows.columns]
    same(good.select(*shared), rows.where("Date IS NOT NULL").select(*shared))


def test_raw_copy(spark, folder, tmp_path):
    out = str(tmp_path / "bronze")
    for _ in range(2):
        files.write_bronze(files.raw_lines(spark, folder), out)
    kept = spark.read.parquet(out)
    assert dict(kept.dtypes)["season"] == "string"
    lines = kept.where("season = '0910'").orderBy("block_start", "position").collect()
    assert "\n".join(row["line"] for row in lines) + "\n" == OLD


def test_dirty_messages(spark):
    texts = ['{"FTHG":2,"FTR":"H"}', '{"FTHG":2.0,"AS":5,"x":1}', "{bad", None, '{"Season":"0809","League":"E0"}']
    sent = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    flagged = cast_stats(land_flagged(sent, schema.MESSAGE, [], ["i"]), ["FTHG", "AS"])
    rows = {row["i"]: row for row in flagged.collect()}
    assert (rows[0]["FTHG"], rows[0]["FTR"], rows[0]["quarantined"]) == (2, "H", False)
    assert (rows[1]["FTHG"], rows[1]["AS"], rows[1]["FTR"]) == (2, 5, None)
    assert rows[2]["quarantined"] and rows[3]["quarantined"]
    keyed = land_flagged(sent, schema.MESSAGE, schema.NATURAL_KEY, ["i"])
    assert keyed.where("i = 4 AND quarantined").count() == 1
    assert keyed.where("i = 2").first()["raw"] == "{bad"


def test_publish_and_report(spark, folder, tmp_path):
    from matchday.plans.publish import LONG_FIRST_YEAR, expected_files, publish

    out = str(tmp_path / "sent")
    report = publish(spark, folder, "json", {"path": out}).collect()
    assert len(report) == 80
    published = {(r["season"], r["league"]): r["rows"] for r in report if r["status"] == "published"}
    assert published == {("0809", "E0"): 28, ("0910", "E0"): 28, ("2122", "SP1"): 29}
    assert spark.read.json(out).count() == 85
    assert expected_files(spark, LONG_FIRST_YEAR).count() == 120


def test_even_files(spark, tmp_path):
    from matchday.streaming.sinks import replace_batch

    replace_batch(str(tmp_path / "out"), even_files=True)(spark.range(0, 1_000, 1, 8), 0)
    assert len([n for n in os.listdir(tmp_path / "out" / "batch_id=0") if n.endswith(".parquet")]) == 1


def test_headers_read_first_blocks_only(spark, tmp_path):
    line = "1,a,b,2\n"
    for year in range(10, 16):
        (tmp_path / f"E0_{year}{year + 1}.csv").write_text("\n\nDate,HomeTeam,AwayTeam,x\n" + line * 200_000)
    (tmp_path / "E0_2021.csv").write_text("Date,HomeTeam,AwayTeam," + ",".join(f"c{i}" for i in range(5_000)) + "\n" + line * 10)
    found = files.headers(spark, str(tmp_path)).collect()
    assert len(found) == 7 and all(row["error"] is None for row in found)
    by_name = {row["path"][-8:-4]: row for row in found}
    assert by_name["1011"]["header"] == "Date,HomeTeam,AwayTeam,x"
    assert by_name["2021"]["header"].endswith(",c4999")
    assert sum(row["bytes_read"] for row in found) <= 6 * files.FIRST_BLOCK + 2 * by_name["2021"]["length"]


def test_headers_by_a_pass_over_the_text(spark, folder, monkeypatch):
    """Where Python cannot open the store."""
    fast = files.headers(spark, folder).select("path", "length", "header").collect()
    monkeypatch.setattr(files, "RANGED", {})
    slow = files.headers(spark, folder).select("path", "length", "header").collect()
    assert sorted(map(tuple, fast)) == sorted(map(tuple, slow)) and len(fast) == 3


def test_unreadable_and_rejected_files(spark, folder, tmp_path):
    import gzip

    (tmp_path / "I1_0809.csv.gz").write_bytes(b"no gzip at all" * 100)
    (tmp_path / "F1_0809.csv.gz").write_bytes(gzip.compress(OLD.encode() + os.urandom(3_000).hex().encode(), 0))
    (tmp_path / "D1_0910.csv").write_text("<html>,x\n" * 99)
    (tmp_path / "odd.csv").write_text(OLD)
    found = {row["path"].rsplit("/", 1)[1]: row["reason"] for row in files.rejected_files(spark, folder).collect()}
    assert found.pop("I1_0809.csv.gz").startswith("error")
    assert found == {"notes.txt": "name", "D1_2122.csv": "size", "D1_0910.csv": "header", "odd.csv": "no season and league"}
    counts = {row["League"]: row["count"] for row in files.csv_union(spark, folder).groupBy("League").count().collect()}
    assert counts["F1"] == 29 and "I1" not in counts


def test_report_of_a_run_with_bad_files(spark, folder, tmp_path):
    from matchday.plans.publish import publish

    (tmp_path / "I1_0809.csv.gz").write_bytes(b"no gzip at all" * 100)
    (tmp_path / "X9_0809.csv").write_text(OLD)
    out = str(tmp_path / "sent")
    report = {(r["season"], r["league"]): (r["rows"], r["status"]) for r in publish(spark, folder, "json", {"path": out}).collect()}
    assert len(report) == 81
    assert report["0809", "I1"] == (0, "failed") and report["0809", "X9"] == (28, "unexpected")
    assert report["0809", "E0"] == (28, "published") and report["0809", "F1"] == (0, "missing")
    assert spark.read.json(out).count() == 113


def test_flagged_rows(spark, tmp_path):
    head = "Date,HomeTeam,AwayTeam,FTHG,Note\n"
    good = "".join(f'{i:02}/08/08,"T, {i}",B,1,\n' for i in range(1, 40))
    bad = "01/08/08,A,B,1,x,7,8\n02/08/08,A,B\n,,,,\n03/08/08,,B,2,n\n" + head + "\n"
    (tmp_path / "E0_0809.csv").write_text(head + good + bad)
    (tmp_path / "E0_0910.csv").write_text("Date,AwayTeam,HomeTeam\n" + "01/08/09,B,A\n" * 40 + "01/08/09,B,A,3\n")
    rows = files.csv_flagged(spark, str(tmp_path)).cache()
    assert rows.where("reason IS NULL").count() == 79
    assert sorted((row["reason"], row["raw"]) for row in rows.where("reason IS NOT NULL").collect()) == [
        ("blank", ",,,,"), ("key", "03/08/08,,B,2,n"), ("ragged", "01/08/08,A,B,1,x,7,8"), ("ragged", "01/08/09,B,A,3"),
        ("ragged", "02/08/08,A,B"),
    ]
    row = rows.where("reason IS NULL AND Date = '05/08/08'").first()
    assert (row["HomeTeam"], row["AwayTeam"], row["FTHG"], row["Note"], row["Season"]) == ("T, 5", "B", "1", None, "0809")
