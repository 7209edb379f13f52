"""The whole run on landed files: seven columns of text in, ranking out."""

import gzip
import json

import pytest

from homespan.__main__ import main
from homespan.config import CENSUS_VARIABLES, FEED_FILES, MarketSettings, PipelinePaths
from homespan.plans.pipeline import run_pipeline
from homespan.plans.standard import market_reports, place_reports
from homespan.schemas import CENSUS, GOLD, LABOUR, SILVER, schema_differences
from homespan.sources.payloads import PayloadError
from homespan.operators.audit import AUDITED
from homespan.sources.files import current_path, folders
from homespan.sources.tables import read_table
from tests.frames import PRICED, values
from tests.test_sources import feed_text, series

CITIES = ("Alpha", "Beta", "Gamma", "Delta")


@pytest.fixture
def landed(tmp_path):
    rows = []
    for i, city in enumerate(CITIES):
        for year in (2023, 2024):
            for month in ("01", "02"):
                rows.append({
                    "CITY": city, "PERIOD_END": f"{year}-{month}-28", "MEDIAN_SALE_PRICE": str(100_000 * (i + 1)),
                    "MEDIAN_DOM": str(20 + 5 * i),
                    "PARENT_METRO_REGION": "Houston, TX" if city == "Delta" else "Dallas, TX",
                })
    rows += [{"CITY": "Alpha", "MEDIAN_SALE_PRICE": "NA"}, {"CITY": "Tulsa", "STATE_CODE": "OK"}]
    feeds, census, labour = (tmp_path / d for d in ("feeds", "census", "labour"))
    for folder in (feeds, census, labour):
        folder.mkdir()
    (feeds / FEED_FILES["city"]).write_bytes(gzip.compress(feed_text(*rows).encode()))
    places = [
        [f"{c} city, Texas", str(50_000 + 10_000 * i), "1", str(1000 + i), str(10 + i * 5), "100", "1000", str(900 - 50 * i), "48", str(i)]
        for i, c in enumerate(CITIES)
    ]
    places[1][1] = "-666666666"
    (census / "places.json").write_text(json.dumps([list(CENSUS_VARIABLES), *places]))
    points = [("2024", "M01", "January", "4.0"), ("2024", "M02", "February", "5.0"), ("2023", "M01", "January", "9.0")]
    (labour / "series.json").write_text(json.dumps({"Results": {"series": [series("LAUMT481910000000003", *points)]}}))
    return PipelinePaths(str(feeds), str(census), str(labour), str(tmp_path / "warehouse"))


def test_run_writes_every_layer(spark, landed):
    done = run_pipeline(spark, MarketSettings(), landed)
    assert {name: stage.written.rows for name, stage in done.items()} == {
        "bronze": 17, "silver": 16, "gold": 8, "census_landing": 4, "census": 3, "labour_landing": 3, "labour": 3,
        "combined": 3, "ranking": 2, "feed_audit": 49, "cleaning_audit": 7,
    }
    for name, declared in (("silver", SILVER), ("gold", GOLD), ("census", CENSUS), ("labour", LABOUR)):
        assert schema_differences(done[name].table, declared) == []
    ranking = values(read_table(spark, landed.ranking).orderBy("RANK"), "RANK", "CITY", "UNEMPLOYMENT_RATE")
    assert ranking == [(1, "Gamma", 4.5), (2, "Alpha", 4.5)]


def test_second_run_replaces_the_first(spark, landed):
    run_pipeline(spark, MarketSettings(), landed)
    done = run_pipeline(spark, MarketSettings(state_code="OK", metro_word="x"), landed)
    assert done["gold"].table.count() == 1 and done["ranking"].table.count() == 0


def test_a_failed_stage_stops_the_ones_after_it(spark, landed):
    from pathlib import Path

    (Path(landed.labour_payloads) / "series.json").write_text('{"status": "REQUEST_NOT_PROCESSED"}')
    with pytest.raises(PayloadError, match="series.json .refused: REQUEST_NOT_PROCESSED"):
        run_pipeline(spark, MarketSettings(), landed)
    assert not Path(landed.ranking).exists()


def test_every_standard_report_runs_on_the_stored_tables(spark, landed):
    settings = MarketSettings(current_year=2024, base_year=2023, home_type="All Residential", focus_cities=None,
                              list_floor=1, deal_floor=1, score_floor=1, panel_cities=CITIES, trend_city="Alpha")
    done = run_pipeline(spark, settings, landed)
    reports = market_reports(done["gold"].table, done["labour"].table, settings)
    reports |= place_reports(done["census"].table, done["ranking"].table, settings)
    empty = [name for name, df in reports.items() if df.isEmpty()]
    assert empty == ["benchmark_overlap"]
    assert values(reports["yearly_trend"], "YEAR", "TOTAL_SOLD") == [(2023, 20), (2024, 20)]


def test_command_line_shows_a_report(spark, landed, capsys):
    main(["--feeds", landed.feeds, "--census", landed.census_payloads, "--labour", landed.labour_payloads,
          "--warehouse", landed.warehouse, "--report", "ranking_head"])
    out = capsys.readouterr().out
    assert "ranking: 2 rows" in out and "|Gamma" in out


def rerun(spark, landed, monkeypatch, **options):
    """The steps that run, in the order in which they begin."""
    from homespan.plans import pipeline

    begun = []
    for name in ("run_feed_audit", "run_market", "run_places", "run_labour", "run_ranking"):
        plain = getattr(pipeline, name)
        monkeypatch.setattr(pipeline, name, lambda *a, plain=plain, name=name: begun.append(name[4:]) or plain(*a))
    try:
        pipeline.run_pipeline(spark, MarketSettings(), landed, **options)
    finally:
        monkeypatch.undo()
    return begun


def test_steps_begin_after_what_they_read(spark, landed, monkeypatch):
    begun = rerun(spark, landed, monkeypatch)
    assert sorted(begun) == ["feed_audit", "labour", "market", "places", "ranking"]
    assert begun.index("market") < begun.index("places") and begun[-1] == "ranking"


def test_labour_and_market_run_side_by_side(spark, landed, monkeypatch):
    """Each waits in its step for the other to have begun."""
    from threading import Barrier

    from homespan.plans import pipeline

    both = Barrier(2, timeout=60)
    for name in ("run_market", "run_labour"):
        plain = getattr(pipeline, name)
        monkeypatch.setattr(pipeline, name, lambda *a, plain=plain: both.wait() is not None and plain(*a))
    pools = []
    plain_places = pipeline.run_places
    monkeypatch.setattr(pipeline, "run_places", lambda *a: pools.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool")) or plain_places(*a))
    assert run_pipeline(spark, MarketSettings(), landed)["ranking"].written.rows == 2
    assert pools == ["places"]


def test_a_failed_run_goes_on_where_it_failed(spark, landed, monkeypatch):
    from pathlib import Path

    file = Path(landed.labour_payloads) / "series.json"
    good = file.read_text()
    file.write_text("<html>")
    with pytest.raises(PayloadError, match="series.json .unreadable"):
        run_pipeline(spark, MarketSettings(), landed)
    gold, places = (current_path(spark, p) for p in (landed.gold, landed.census))
    assert read_table(spark, landed.census).count() == 3
    file.write_text(good)
    assert rerun(spark, landed, monkeypatch, resume=True) == ["labour", "ranking"]
    assert (current_path(spark, landed.gold), current_path(spark, landed.census)) == (gold, places)
    assert values(read_table(spark, landed.ranking).orderBy("RANK"), "CITY") == [("Gamma",), ("Alpha",)]
    assert rerun(spark, landed, monkeypatch, resume=True) == []
    assert len(rerun(spark, landed, monkeypatch)) == 5


def test_changed_inputs_are_run_again(spark, landed, monkeypatch):
    from pathlib import Path

    run_pipeline(spark, MarketSettings(), landed)
    census = Path(landed.census_payloads) / "places.json"
    table = json.loads(census.read_text())
    (census.parent / "later.json").write_text(json.dumps([table[0], table[1][:1] + ["99000"] + table[1][2:]]))
    assert rerun(spark, landed, monkeypatch, resume=True) == ["places", "ranking"]
    assert dict(values(read_table(spark, landed.census), "CITY", "MEDIAN_INCOME"))["Alpha"] == 99000.0


def test_unusable_payloads_are_recorded_or_refused(spark, landed):
    from pathlib import Path

    (Path(landed.census_payloads) / "broken.json").write_text('[["NAME"')
    done = run_pipeline(spark, MarketSettings(), landed)
    aside = values(done["census_landing"].table.filter("REJECTED"), "PAYLOAD_FILE", "REASON", "PAYLOAD")
    assert [(f.rsplit("/", 1)[1], r, p) for f, r, p in aside] == [("broken.json", "unreadable", '[["NAME"')]
    assert done["census"].written.rows == 3
    before = current_path(spark, landed.census_landing)
    with pytest.raises(PayloadError, match="1 payloads set aside, 0 allowed: broken.json .unreadable"):
        run_pipeline(spark, MarketSettings(allowed_rejects=0), landed)
    assert current_path(spark, landed.census_landing) == before
    assert run_pipeline(spark, MarketSettings(allowed_rejects=1), landed)["ranking"].written.rows == 2


def test_cells_are_counted_while_silver_is_written(spark, landed):
    from pathlib import Path

    file = Path(landed.feeds) / FEED_FILES["city"]
    rows = gzip.decompress(file.read_bytes()).decode()
    bad = [{"CITY": "Beta", "PERIOD_END": "31/12/2024", "HOMES_SOLD": "many"}, {"CITY": "Beta", "MEDIAN_SALE_PRICE": "?"}]
    file.write_bytes(gzip.compress((rows + feed_text(*bad).split("\n", 1)[1]).encode()))
    (Path(landed.feeds) / FEED_FILES["national"]).write_text(feed_text({"MEDIAN_DOM": "NA"}, {"PERIOD_END": "soon"}))
    done = run_pipeline(spark, MarketSettings(), landed)
    counted = {r[0]: r[1:] for r in values(done["cleaning_audit"].table.drop("SOURCE"))}
    assert set(counted) == set(AUDITED) and {c[0] for c in counted.values()} == {19}
    assert counted["PERIOD_END"] == (19, 19, 0, 1) and counted["HOMES_SOLD"] == (19, 19, 0, 1)
    assert counted["MEDIAN_SALE_PRICE"] == (19, 19, 1, 1)
    assert done["silver"].written.rows == 19 - 2
    feeds = {(r["SOURCE"], r["COLUMN_NAME"]): tuple(r)[1:2] + tuple(r)[3:] for r in done["feed_audit"].table.collect()}
    assert len(feeds) == 7 * len(AUDITED)
    assert feeds["city", "PERIOD_END"] == (True, 20, 20, 0, 1)
    assert feeds["national", "PERIOD_END"] == (True, 2, 2, 0, 1) and feeds["national", "MEDIAN_DOM"] == (True, 2, 2, 1, 0)
    assert feeds["zip", "HOMES_SOLD"] == (False, 0, 0, 0, 0)


def test_gold_view_is_seen_by_another_session(spark, landed):
    run_pipeline(spark, MarketSettings(gold_view="all_market"), landed)
    run_pipeline(spark, MarketSettings(gold_view="all_market"), landed)
    assert spark.newSession().sql("SELECT count(*) FROM all_market WHERE YEAR = 2024").first()[0] == 4
    spark.sql("DROP VIEW all_market")


def test_only_the_last_two_versions_stay(spark, landed):
    for _ in range(3):
        run_pipeline(spark, MarketSettings(), landed)
    assert len(folders(spark, landed.gold)) == 2


def test_report_tables_are_stored_in_order(spark, landed, tmp_path):
    main(["--feeds", landed.feeds, "--census", landed.census_payloads, "--labour", landed.labour_payloads,
          "--warehouse", landed.warehouse, "--report", "price_trend", "--report-tables", str(tmp_path / "reports")])
    table = read_table(spark, str(tmp_path / "reports/price_trend"))
    assert values(table, "YEAR", "PROPERTY_TYPE") == [(2023, PRICED["PROPERTY_TYPE"]), (2024, PRICED["PROPERTY_TYPE"])]
