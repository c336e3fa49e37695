"""Ingest: hand-written landed JSON with the edge cases of SURVEY §5.1,
fixed-schema reading, first-wins / last-wins loads."""

import json

from pyspark.sql import functions as F

from pitchlake.operators import normalize as B
from pitchlake.sources import raw as R
from pitchlake.sources import sinks as K


def _write(tmp_path, name, obj):
    p = tmp_path / name
    p.write_text(json.dumps(obj, indent=2))
    return str(p)


def stat(pid, code, value):
    d = {"participant_id": pid, "type": {"code": code}, "data": {"value": value}}
    return d


def test_stats_document_edge_cases(spark, tmp_path):
    doc = {"fetch_timestamp": "2024-01-01 10:00:00", "fixture_id": 7, "fixture_data_with_stats": {"data": {
        "id": 7, "periods": [
            {"id": 1, "description": "1st-half", "statistics": [
                stat(10, "ball-possession", "54.64%"), stat(10, "goals", 3.7), stat(10, "fouls", "3.7"),
                stat(10, "tackles", "abc"), stat(10, "shots-total", 4), stat(10, "shots-total", 6),
                stat(11, "unknown-code", 5), stat(11, "goals", None),
                stat(0, "goals", 1), {"participant_id": 12, "type": {"code": "goals"}}]},
            {"id": 2, "description": "", "statistics": [stat(10, "goals", 1)]},
            {"id": 3, "description": "Overtime", "statistics": [stat(10, "goals", "2")]}]}}}
    path = _write(tmp_path, "stats_7.json", doc)
    raw = R.read_raw(spark, path, "stats")
    rows, bad = B.normalize_stats(raw)
    got = {(r.team_id, r.period): r for r in rows.collect()}
    a = got[(10, "first_half")]
    assert (a.ball_possession, a.goals, a.fouls, a.tackles, a.shots_total) == (54.64, 3, None, None, 6)
    # team 11 only had unusable statistics: its row exists, all NULL (Q10)
    b = got[(11, "first_half")]
    assert b.goals is None and b.ball_possession is None
    # participant 0 and the item without data are skipped; unknown period label passes through
    assert (0, "first_half") not in got and (12, "first_half") not in got
    assert got[(10, "Overtime")].goals == 2
    assert [r.period_id for r in bad.collect()] == [2]


def test_corrupt_file_is_kept_aside(spark, tmp_path):
    p = tmp_path / "broken.json"
    p.write_text('{"fetch_timestamp": "x", "fixture_id": ')
    raw = R.read_raw(spark, str(p), "stats")
    assert R.corrupt_records(raw).count() == 1


def test_schedule_edge_cases(spark, tmp_path):
    def fx(fid, parts, scores, state=5):
        return {"id": fid, "league_id": 1, "starting_at": "2024-01-02 15:00:00", "state_id": state,
                "participants": parts, "scores": scores}
    home = {"id": 100, "meta": {"location": "home", "winner": True}}
    away = {"id": 200, "meta": {"location": "away", "winner": False}}
    sc = lambda d, p, g: {"description": d, "participant_id": p, "score": {"goals": g}}
    doc = {"fetch_timestamp": "t", "season_id": 9, "schedule_data": {"data": [
        {"id": 1, "rounds": [{"id": 5, "season_id": 9, "finished": True, "fixtures": [
            fx(1, [home, away], [sc("2ND_HALF", 200, 1), sc("CURRENT", 100, 2), sc("1ST_HALF", 200, 0)]),
            fx(2, [home], []),
            fx(3, [home, {"id": 300, "meta": {"location": "home"}}], []),
            fx(4, [home, away], [], state=5),
            dict(fx(7, [home, away], []), starting_at="soon"),
            fx(5, [home, away], [sc("CURRENT", 100, None), sc("1ST_HALF", 100, 1), sc("1ST_HALF", 200, 1)], 99)]},
            {"id": None, "season_id": 9, "fixtures": [fx(6, [home, away], [])]}]}]}}
    raw = R.read_raw(spark, _write(tmp_path, "sched.json", doc), "schedules")
    ok, bad = B.normalize_schedules(raw)
    got = {r.fixture_id: r for r in ok.collect()}
    # scores may come from different preference entries per side
    assert (got[1].home_score, got[1].away_score, got[1].result, got[1].status) == (2, 1, "H", "FT")
    # no scores: winner flags decide for a finished status
    assert (got[4].home_score, got[4].result) == (None, "H")
    # NULL goals are skipped for the next preference; unknown state -> UNKNOWN
    assert (got[5].home_score, got[5].away_score, got[5].status, got[5].result) == (1, 1, "UNKNOWN", "D")
    reasons = {r.fixture_id: r.reject_reason for r in bad.collect()}
    assert sorted(reasons) == [2, 3, 6, 7] and not set(reasons) & set(got)
    # a round without an id and an unreadable kick-off are rejected with the reason
    assert "missing:round_id" in reasons[6] and "missing:start_time" in reasons[7]


def test_odds_and_pressure(spark, tmp_path):
    odd = lambda **kw: dict({"fixture_id": 1, "market_id": 1, "bookmaker_id": 20, "label": "Home", "value": "1.80",
                             "probability": "54.64%", "winning": "yes", "participants": {"a": 1}}, **kw)
    doc = {"fetch_timestamp": "t", "fixture_id": 1, "prematch_odds_data": {"data": [
        odd(), odd(label="Away", winning=1, value=2.5), odd(bookmaker_id=99), odd(label=None), odd(label="Draw", winning=2)]}}
    ok, bad, filtered = B.normalize_odds(R.read_raw(spark, _write(tmp_path, "odds.json", doc), "odds"))
    rows = {r.label: r for r in ok.collect()}
    assert (rows["Home"].value, rows["Home"].probability, rows["Home"].winning) == (1.8, 54.64, True)
    assert rows["Away"].winning is True and rows["Draw"].winning is None
    assert json.loads(rows["Home"].participants) == {"a": 1}
    assert bad.count() == 1 and filtered.count() == 1

    pdoc = {"fetch_timestamp": "t", "fixture_id": 2, "fixture_data_with_pressure": {"data": {"id": 2, "pressure": [
        {"id": 1, "minute": 0, "participant_id": 5, "pressure": 0}, {"id": 2, "minute": 3, "participant_id": 5},
        {"id": 3, "minute": 4, "participant_id": "x", "pressure": 1.5}]}}}
    okp, badp = B.normalize_pressure(R.read_raw(spark, _write(tmp_path, "p.json", pdoc), "pressure"))
    assert [(r.minute, r.pressure_index, r.event_type) for r in okp.collect()] == [(0, 0.0, "pressure")]
    assert badp.count() == 2


def test_latest_snapshot(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "a"), (1, "2024-02-01", "b"), (2, "2024-01-05", "c")],
                               "fixture_id long, fetch_timestamp string, payload string")
    got = sorted((r.fixture_id, r.payload) for r in R.latest_snapshot(df, "fixture_id").collect())
    assert got == [(1, "b"), (2, "c")]


def test_market_dimension(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text("market_description,market_id,bookmaker_name,bookmaker_id\n"
                 "  Fulltime Result ,  1 ,  Bet365 , 2\n\tMatch Winner,1, Bet365,2\n"
                 "Fulltime Result,1,Bet365,2\nAsian Handicap, 6 ,Pinnacle,20\n")
    dim = R.read_market_dim(spark, str(p))
    rows = sorted((r.market_id, r.market_description, r.canonical_market) for r in dim.collect())
    assert rows == [(1, "Fulltime Result", "Fulltime Result"), (1, "Match Winner", "Fulltime Result"),
                    (6, "Asian Handicap", "Asian Handicap")]


def test_insert_ignore_first_wins_and_idempotent(spark):
    schema = "k long, h double, v string, o int"
    batch = spark.createDataFrame([(1, None, "a", 2), (1, None, "b", 1), (2, 1.0, "c", 1), (None, 1.0, "x", 1)], schema)
    first = K.insert_ignore(None, batch, ["k", "h"], order=["o"], required=["k"])
    assert sorted((r.k, r.v) for r in first.collect()) == [(1, "b"), (2, "c")]
    again = K.insert_ignore(first, batch, ["k", "h"], order=["o"], required=["k"])
    assert again.count() == 0  # replaying the batch inserts nothing
    distinct = K.insert_ignore(first, batch, ["k", "h"], order=["o"], null_distinct=True, required=["k"])
    assert sorted(r.v for r in distinct.collect()) == ["a", "b"]  # NULL key parts never collide


def test_upsert_last_wins_keeps_created(spark):
    ex = spark.createDataFrame([(1, "old", "2020-01-01 00:00:00", "2020-01-01 00:00:00")],
                               "k long, v string, created_at string, updated_at string") \
        .select("k", "v", F.col("created_at").cast("timestamp"), F.col("updated_at").cast("timestamp"))
    batch = spark.createDataFrame([(1, "mid", 1), (1, "new", 2), (2, "fresh", 1)], "k long, v string, seq int")
    out = {r.k: r for r in K.upsert(ex, batch.drop("seq"), ["k"]).collect()}
    assert out[1].v in ("mid", "new") and str(out[1].created_at).startswith("2020-01-01")
    assert out[1].updated_at > out[1].created_at and out[2].v == "fresh"
    ordered = {r.k: r.v for r in K.upsert(ex.withColumn("seq", F.lit(0)), batch, ["k"], order="seq").collect()}
    assert ordered[1] == "new"


def test_upsert_orders_by_value_and_keeps_untouched_stamps(spark):
    ex = spark.createDataFrame([(1, "old", "2020-01-01", "2023-01-01"), (2, "kept", "2020-01-01", "2023-01-01")],
                               "k long, v string, c string, u string") \
        .selectExpr("k", "v", "cast(c as timestamp) created_at", "cast(u as timestamp) updated_at")
    batch = spark.createDataFrame([(1, "ninth", 9), (1, "tenth", 10)], "k long, v string, seq int")
    out = {r.k: r for r in K.upsert(ex, batch, ["k"], order="seq").collect()}
    assert out[1].v == "tenth" and out[1].updated_at.year > 2023 and out[1].created_at.year == 2020
    assert (out[2].v, out[2].updated_at.year, out[2].created_at.year) == ("kept", 2023, 2020)


def test_latest_snapshot_of_documents_with_variants(spark):
    docs = spark.createDataFrame([(1, "2024-01-01", '{"a": 1}'), (1, "2024-01-03", '{"a": "x"}'), (2, "2024-01-02", None)],
                                 "fixture_id long, fetch_timestamp string, j string")
    docs = docs.withColumn("payload", F.parse_json("j"))
    out = {r.fixture_id: r.j for r in R.latest_snapshot(docs, "fixture_id").collect()}
    assert out == {1: '{"a": "x"}', 2: None}


def test_market_dim_with_padded_header_names(spark, tmp_path):
    p = tmp_path / "real.csv"
    p.write_text(" Market_description , Market_id , bookmaker name , bookmaker_id \nFulltime Result , 1 , bet365 , 2 \n")
    assert [tuple(r) for r in R.read_market_dim(spark, str(p)).select("market_id", "market_description", "bookmaker_name", "bookmaker_id").collect()] \
        == [(1, "Fulltime Result", "bet365", 2)]


def test_text_that_is_no_number_counts_as_missing(spark):
    from pitchlake.operators.features import require_numeric
    df = spark.createDataFrame([("1.5",), ("n/a",), (None,)], "x string")
    assert [r.x for r in require_numeric(df, ["x"]).collect()] == [1.5]


def test_write_read_csv_and_checkpoint(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5), (2, None)], "a long, b double")
    K.write_dataset(df, str(tmp_path / "d"), fmt="csv")
    back = K.read_dataset(spark, str(tmp_path / "d"), "a long, b double", fmt="csv")
    assert sorted(back.collect()) == sorted(df.collect())
    cut = K.checkpoint_table(df, "unit_test_table")
    assert cut.count() == 2 and spark.sparkContext.getCheckpointDir()


def test_observe_counts_during_write(spark, tmp_path):
    df, obs = K.observe_counts(spark.range(10), "load", {"even": F.col("id") % 2 == 0})
    df.write.mode("overwrite").parquet(str(tmp_path / "o"))
    assert obs.get == {"rows": 10, "even": 5}


def test_load_report_and_audit(spark):
    items = spark.range(5)
    rep = K.load_report(items, items.filter("id > 1"), items.filter("id = 0")).first()
    assert (rep["items"], rep.rows_stored, rep.rows_rejected, rep.empty_items) == (5, 3, 1, 0)
    a = K.with_audit(spark.createDataFrame([(1, None)], "team_id long, country_id long"), ["team_id"],
                     {"country_id": -1}, ts="2024-01-01 00:00:00").first()
    assert a.country_id == -1 and a.id is not None and a.created_at == a.updated_at


def test_both_outputs_of_one_parse(spark, tmp_path):
    good = {"fetch_timestamp": "2024-01-02 03:04:05", "fixture_id": 5, "fixture_data_with_stats": {"data": {"id": 5, "periods": []}}}
    (tmp_path / "good.json").write_text(json.dumps(good, indent=2))
    (tmp_path / "broken.json").write_text('{"fetch_timestamp": ')
    ok, bad = R.split_corrupt(R.read_raw(spark, str(tmp_path), "stats"))
    assert [r.fixture_id for r in ok.collect()] == [5]
    assert [r._source_file.split("/")[-1] for r in bad.collect()] == ["broken.json"]
    assert bad.columns == ok.columns


def test_newest_files_are_chosen_by_name(spark, tmp_path):
    def land(fixture, stamp, text=None):
        doc = {"fetch_timestamp": stamp, "fixture_id": fixture, "fixture_data_with_pressure": {"data": {"id": fixture, "pressure": []}}}
        (tmp_path / f"pressure_{fixture}_{stamp}.json").write_text(text or json.dumps(doc, indent=1))
    land(1, "20240101_000000", "never {parsed")
    land(1, "20240301_000000")
    land(2, "20240101_120000")
    (tmp_path / "notes.json").write_text("not a landed file")
    docs, seen = R.read_newest(spark, str(tmp_path), "pressure")
    assert sorted((r.fixture_id, r.fetch_timestamp, r._corrupt_record) for r in docs.collect()) == [
        (1, "20240301_000000", None), (2, "20240101_120000", None)]
    seen = K.checkpoint_table(seen, "seen")
    land(2, "20231231_000000", "older than what is held")
    land(2, "20240201_000000")
    again, new = R.read_newest(spark, str(tmp_path), "pressure", seen)
    assert [(r.fixture_id, r.fetch_timestamp) for r in again.collect()] == [(2, "20240201_000000")]
    nothing, _ = R.read_newest(spark, str(tmp_path), "pressure", seen.unionByName(K.checkpoint_table(new, "seen")))
    assert nothing.count() == 0 and nothing.columns == docs.columns


def test_every_cause_of_a_pressure_reject_is_named(spark):
    item = '{"id": 1, "minute": %s, "participant_id": %s, "pressure": %s}'
    docs = [(0, item % (1, 2, 3)), (9, item % ("null", 2, '"x"')), (9, item % ('"12"', "null", "null")), (9, item % (0, 1, 0))]
    text = ['{"fetch_timestamp": "t", "fixture_data_with_pressure": {"data": {"id": %d, "pressure": [%s]}}}' % d for d in docs]
    ok, bad = B.normalize_pressure(R.parse_documents(spark.createDataFrame([(t,) for t in text], "doc string"), "pressure"))
    assert sorted(r.reject_reason for r in bad.collect()) == [
        "missing:fixture_id", "missing:minute,unreadable:pressure_index", "missing:participant_id,missing:pressure_index"]
    assert [(r.minute, r.pressure_index) for r in ok.collect()] == [(0, 0.0)]
