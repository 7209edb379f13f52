import gzip
import json

import pytest
from pyspark.sql import functions as F

from homespan.config import CENSUS_VARIABLES, FEED_FILES
from homespan.schemas import MARKET, MARKET_COLUMNS
from homespan.sources.delimited import read_feed, read_feeds, union_feeds
from homespan.sources.files import folders, listing, read_text, replace_text
from homespan.sources.landings import land, latest, records
from homespan.sources.payloads import (
    PayloadError, labour_table, open_series, open_tables, read_payloads, series_payloads, table_payloads,
)
from homespan.sources.tables import (
    TableMismatch, Written, materialize, name_view, open_view, preview, publish_view, read_table, verify_table, write_table,
)
from homespan.sources.versions import replace_table
from tests.frames import PRICED, values


def feed_text(*rows, columns=MARKET_COLUMNS):
    lines = ["\t".join(columns)] + ["\t".join(r.get(c, PRICED.get(c, "")) for c in columns) for r in rows]
    return "\n".join(lines) + "\n"


def write_feed(path, text):
    path.write_bytes(gzip.compress(text.encode()) if path.suffix == ".gz" else text.encode())
    return str(path)


@pytest.mark.parametrize("name", ["f.tsv000", "f.tsv000.gz"])
def test_feed_is_all_text_named_by_header(spark, tmp_path, name):
    path = write_feed(tmp_path / name, feed_text({}, {"MEDIAN_DOM": "NA"}))
    feed = read_feed(spark, path)
    assert feed.schema == MARKET
    assert values(feed, "MEDIAN_DOM") == [("30",), ("NA",)]
    assert values(read_feed(spark, path, MARKET, spread=True), "CITY") == [("Alpha",)] * 2


def test_declared_schema_rejects_another_header(spark, tmp_path):
    turned = tuple(reversed(MARKET_COLUMNS))
    path = write_feed(tmp_path / "f.tsv000", feed_text({}, columns=turned))
    with pytest.raises(Exception, match="(?i)header"):
        read_feed(spark, path, MARKET).collect()


def test_all_grains_and_their_union(spark, tmp_path):
    for i, name in enumerate(FEED_FILES.values()):
        extra = MARKET_COLUMNS if i else MARKET_COLUMNS[1:]
        write_feed(tmp_path / name, feed_text(*[{}] * (i + 1), columns=extra))
    feeds = read_feeds(spark, str(tmp_path))
    assert list(feeds) == list(FEED_FILES)
    union = union_feeds(feeds)
    counts = {r[0]: r[1] for r in values(union.groupBy("GRAIN").count())}
    assert counts == {grain: i + 1 for i, grain in enumerate(FEED_FILES)}
    assert union.filter("CITY IS NULL").count() == 1
    assert list(read_feeds(spark, str(tmp_path), grains=["city"])) == ["city"]


CENSUS_HEADER = list(CENSUS_VARIABLES)


def test_array_payloads_follow_their_own_header(spark, tmp_path):
    row = ["A city, Texas", "70000", "1", "2", "3", "4", "5", None, "48", "001"]
    turned = list(reversed(CENSUS_HEADER))
    (tmp_path / "a.json").write_text(json.dumps([CENSUS_HEADER, row, row]))
    (tmp_path / "b.json").write_text(json.dumps([turned, list(reversed(row))], indent=1))
    (tmp_path / "empty.json").write_text(json.dumps([CENSUS_HEADER]))
    (tmp_path / "broken.json").write_text('[["NAME", ')
    (tmp_path / "error.json").write_text("<html>Service Unavailable</html>")
    (tmp_path / "short.json").write_text(json.dumps([["NAME"], ["B city, Texas"]]))
    parsed = table_payloads(read_payloads(spark, str(tmp_path)))
    assert values(parsed.require_rows()) == [tuple(row)] * 3
    reasons = {r[0].rsplit("/", 1)[1]: r[1] for r in values(parsed.rejected, "PAYLOAD_FILE", "REASON")}
    assert reasons == {
        "empty.json": "no rows", "broken.json": "unreadable", "error.json": "unreadable",
        "short.json": "header lacks columns",
    }


def test_short_rows_lack_only_their_last_cells(spark):
    payloads = spark.createDataFrame([('[["a","b"],["1"],["2","3"]]',)], "PAYLOAD string")
    assert values(table_payloads(payloads, ["b", "a"]).rows) == [(None, "1"), ("3", "2")]


def series(series_id, *points):
    keys = ("year", "period", "periodName", "value")
    return {"seriesID": series_id, "data": [dict(zip(keys, p, strict=True)) for p in points]}


def test_series_payloads_give_every_point_of_every_series(spark, tmp_path):
    good = {"status": "OK", "Results": {"series": [
        series("LAUMT481910000000003", ("2024", "M01", "January", "3.9"), ("2024", "M02", "February", "4.1")),
        series("OTHER", ("2023", "M12", "December", "5")),
    ]}}
    (tmp_path / "good.json").write_text(json.dumps(good, indent=2))
    (tmp_path / "empty.json").write_text(json.dumps({"Results": {"series": [series("X")]}}))
    (tmp_path / "none.json").write_text(json.dumps({"Results": {"series": None}}))
    (tmp_path / "broken.json").write_text('{"Results": ')
    parsed = series_payloads(read_payloads(spark, str(tmp_path)))
    table = labour_table(parsed.require_rows())
    assert sorted(values(table)) == [
        ("Dallas-Fort Worth", 2024, "February", 4.1), ("Dallas-Fort Worth", 2024, "January", 3.9),
        ("OTHER", 2023, "December", 5.0),
    ]
    reasons = {r[0].rsplit("/", 1)[1]: r[1] for r in values(parsed.rejected, "PAYLOAD_FILE", "REASON")}
    assert reasons == {"empty.json": "no data", "none.json": "unreadable", "broken.json": "unreadable"}


def test_q15_no_usable_payload_raises_with_the_reason(spark, tmp_path):
    (tmp_path / "empty.json").write_text(json.dumps({"Results": {"series": [series("X")]}}))
    with pytest.raises(PayloadError, match="no data"):
        series_payloads(read_payloads(spark, str(tmp_path))).require_rows()


def test_bad_rate_text_fails(spark):
    body = json.dumps({"Results": {"series": [series("X", ("2024", "M01", "January", "-"))]}})
    points = series_payloads(spark.createDataFrame([(body,)], "PAYLOAD string")).rows
    with pytest.raises(Exception, match="not a number"):
        labour_table(points).collect()


def test_write_overwrites_counts_and_reads_back(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10), path)
    df = spark.range(7).selectExpr("id % 3 AS k", "id AS v")
    written = write_table(df, path, partition_by=["k"])
    assert written.rows == 7
    table = verify_table(spark, written)
    assert table.columns == ["k", "v"] and table.count() == 7
    with pytest.raises(TableMismatch, match="7 rows instead of 8"):
        verify_table(spark, Written(path, "parquet", 8, read_table(spark, path).schema))


def test_null_partition_key_survives(spark, tmp_path):
    written = write_table(spark.sql("SELECT 1 AS v, CAST(NULL AS INT) AS YEAR UNION ALL SELECT 2, 2020"),
                          str(tmp_path / "t"), partition_by=["YEAR"])
    assert sorted(values(verify_table(spark, written)), key=str) == [(1, None), (2, 2020)]


def test_views_by_path_and_by_frame(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(4), path)
    open_view(spark, path, "stored_market")
    assert spark.sql("SELECT count(*) FROM stored_market").first()[0] == 4
    assert spark.sql(f"SELECT count(*) FROM parquet.`{path}`").first()[0] == 4
    name_view(read_table(spark, path), "session_market")
    assert spark.sql("SELECT max(id) FROM session_market").first()[0] == 3


def test_preview_is_ordered(spark):
    assert values(preview(spark.range(100).repartition(5), ["id"], 3)) == [(0,), (1,), (2,)]


def test_materialize_cuts_the_plan(spark):
    stored = materialize(spark.range(5).selectExpr("id * 2 AS x"))
    assert "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(values(stored)) == [(0,), (2,), (4,), (6,), (8,)]


def test_files_in_order_hold_sorted_rows(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id", "CASE WHEN id % 9 > 0 THEN pmod(hash(id), 50) END AS k").repartition(7)
    write_table(rows, str(tmp_path / "t"), order_by=["-k", "id"], files=6)
    files = sorted((tmp_path / "t").glob("part-*"))
    assert len(files) == 6
    got = [tuple(r) for f in files for r in spark.read.parquet(str(f)).select("k", "id").collect()]
    assert got == sorted(got, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert len(got) == 5000


def test_order_holds_within_each_partition(spark, tmp_path):
    rows = spark.range(900).selectExpr("id % 3 AS y", "pmod(hash(id), 400) AS k").repartition(5)
    write_table(rows, str(tmp_path / "t"), partition_by=["y"], order_by=["k"], files=4)
    for y in range(3):
        files = sorted((tmp_path / f"t/y={y}").glob("part-*"))
        got = [r[0] for f in files for r in spark.read.parquet(str(f)).collect()]
        assert got == sorted(got) and len(got) == 300


def test_a_write_that_dies_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(10), path)
    dies = spark.range(100).selectExpr("CASE WHEN id = 99 THEN raise_error('killed') ELSE id END AS id")
    with pytest.raises(Exception, match="killed"):
        replace_table(dies.selectExpr("cast(id AS bigint) AS id"), path)
    assert read_table(spark, path).count() == 10

    def refuse(written):
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        replace_table(spark.range(20), path, check=refuse)
    assert read_table(spark, path).count() == 10
    held = read_table(spark, path)
    replace_table(spark.range(30), path)
    assert (read_table(spark, path).count(), held.count()) == (30, 10)
    replace_table(spark.range(40), path)
    assert len(folders(spark, path)) == 2


def test_a_table_may_be_replaced_by_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(4):
        old = read_table(spark, path) if (tmp_path / "t").exists() else spark.range(1)
        replace_table(old.unionByName(old), path)
    assert read_table(spark, path).count() == 16


def test_small_files_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "deep/er/note")
    assert read_text(spark, path) is None and listing(spark, path) == []
    for text in ("one", "zwei é\n"):
        replace_text(spark, path, text)
        assert read_text(spark, path) == text
    assert [n for n, _, _ in listing(spark, str(tmp_path / "deep/er"))] == ["note"]


def test_landing_keeps_rows_and_rejects_of_one_parse(spark, tmp_path):
    row = ["A city, Texas", "70000", "1", "2", "3", "4", "5", None, "48", "001"]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps([CENSUS_HEADER, row, row]))
    (folder / "empty.json").write_text(json.dumps([CENSUS_HEADER]))
    (folder / "broken.json").write_text('[["NAME", ')
    landed = land(open_tables(read_payloads(spark, str(folder))), str(tmp_path / "t"))
    assert (landed.accepted_payloads, landed.rejected_payloads, landed.row_count) == (1, 2, 2)
    assert values(landed.rows, *CENSUS_HEADER) == [tuple(row)] * 2 and landed.rows.count() == landed.row_count
    aside = {r[0].rsplit("/", 1)[1]: r[1:] for r in values(landed.rejected, "PAYLOAD_FILE", "REASON", "PAYLOAD")}
    assert aside == {"empty.json": ("no rows", json.dumps([CENSUS_HEADER])), "broken.json": ("unreadable", '[["NAME", ')}
    with pytest.raises(PayloadError, match="2 payloads set aside, 1 allowed"):
        land(open_tables(read_payloads(spark, str(folder))), str(tmp_path / "t"), allowed=1)
    assert read_table(spark, str(tmp_path / "t")).count() == 4
    (folder / "a.json").unlink()
    with pytest.raises(PayloadError, match="no usable payload: broken.json .unreadable., empty.json .no rows."):
        land(open_tables(read_payloads(spark, str(folder))), str(tmp_path / "t"))


def test_the_payload_is_parsed_once(spark):
    payloads = spark.createDataFrame([("f", None, "[]")], "PAYLOAD_FILE string, LANDED_AT timestamp, PAYLOAD string")
    for opened in (open_tables(payloads), open_series(payloads)):
        plan = records(opened)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def test_the_same_response_twice_changes_no_row(spark):
    rows = [("b.json", 2, 0, "48", "1", "new"), ("a.json", 1, 0, "48", "1", "old"), ("a.json", 1, 1, "48", "2", "only"),
            ("c.json", 2, 0, "48", "1", "last name"), ("c.json", 2, 1, None, "9", "x"), ("c.json", 2, 2, None, "9", "x")]
    df = spark.createDataFrame(rows, "PAYLOAD_FILE string, LANDED_AT int, POSITION int, state string, place string, NAME string")
    want = [("48", "1", "last name"), ("48", "2", "only"), (None, "9", "x"), (None, "9", "x")]
    once = latest(df, ["state", "place"])
    assert sorted(values(once), key=str) == sorted(want, key=str)
    again = df.unionByName(df.filter("state IS NOT NULL").withColumn("PAYLOAD_FILE", F.concat("PAYLOAD_FILE", F.lit("~"))))
    assert sorted(values(latest(again, ["state", "place"])), key=str) == sorted(want, key=str)


def test_status_of_a_refused_response_is_named(spark):
    bodies = [('{"status": "REQUEST_NOT_PROCESSED", "Results": {}}',), ('{"Results": {"series": [{"seriesID": "X", "data": null}]}}',)]
    opened = open_series(spark.createDataFrame(bodies, "PAYLOAD string"))
    assert values(opened, "REASON", "ROWS") == [("refused: REQUEST_NOT_PROCESSED", None), ("no data", None)]


def test_catalog_view_is_seen_by_another_session(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(6).selectExpr("id", "id % 2 AS YEAR"), path, partition_by=["YEAR"])
    assert publish_view(spark, path, "shared_market").count() == 6
    assert spark.newSession().sql("SELECT count(*) FROM shared_market WHERE YEAR = 1").first()[0] == 3
    replace_table(spark.range(8).selectExpr("id", "id % 2 AS YEAR"), path, partition_by=["YEAR"])
    assert publish_view(spark, path, "shared_market").count() == 8
    spark.sql("DROP VIEW shared_market")
