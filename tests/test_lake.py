"""Raw files to a checked lake, with the awkward cases of the payloads."""

import pytest
from pyspark.sql import functions as F

from quotelake.__main__ import main
from quotelake.operators.quality import QualityError
from quotelake.plans import analytics
from quotelake.plans.entities import ENTITIES
from quotelake.plans.feeds import FEEDS, export_posts, read_staged
from quotelake.plans.lake import Lake
from quotelake.sources.readers import read_json_documents
from quotelake.streaming.incremental import entities_of, joined_entities_of, merge_new_files
from tests.raw_files import post, write_raw


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    write_raw(f"{base}/raw")
    made = Lake(spark, f"{base}/raw", f"{base}/staging", f"{base}/lake")
    made.stage()
    made.build()
    return made


def test_all_checks_pass(lake):
    lake.check()
    report = {r["table_name"]: (r["row_count"], r["duplicates"]) for r in lake.lake_report().collect()}
    assert len(report) == 26
    assert all(duplicates == 0 for _, duplicates in report.values())


def test_second_build_changes_nothing(lake):
    before = {e: rows(lake.table(e)) for e in ENTITIES}
    lake.build()
    assert {e: rows(lake.table(e)) for e in ENTITIES} == before


def test_each_ticker_has_its_own_isin(lake):
    found = {r["ticker"]: r["isin"] for r in lake.table("tickers_info_dim").collect()}
    assert found == {"MMM": "US88579Y1010", "AOS": "US8318652091"}


def test_news_once_per_ticker(lake):
    assert lake.table("news_dim").count() == 8
    assert lake.table("tickers_news_fact").count() == 9


def test_markets(lake):
    assert rows(lake.table("markets_dim")) == sorted(
        [("us_market", "USA"), ("de_market", "Germany"), (None, "NoAbbr")], key=repr
    )
    assert lake.table("market_indexes_dim").count() == 4


def test_report_dimension_joins_five_feeds(lake):
    assert {r["reporting_id"] for r in lake.table("financial_report_dim").collect()} == {
        "MMM_2021-12-31_year", "MMM_2020-12-31_year", "MMM_2021-12-31_quarter", "MMM_2021_year", "MMM_2Q2022_quarter",
    }
    reports = lake.table("financial_report_dim").select("reporting_id")
    for fact in ("financials", "balancesheet", "cashflow", "earnings", "shares"):
        assert lake.table(f"tickers_{fact}_fact").join(reports, "reporting_id", "left_anti").count() == 0


def test_statement_with_missing_and_extra_metrics(lake):
    found = lake.table("tickers_cashflow_fact").where("reporting_id = 'MMM_2021-12-31_year'").first()
    assert str(found["change_to_net_income"]) == "100.01"
    assert found["net_income"] is None and found["investments"] is None


def test_action_key_is_the_day(lake):
    assert [r["id"] for r in lake.table("tickers_actions_fact").collect()] == ["AOS_1987-10-26"]


def test_hashtags(lake):
    assert rows(lake.table("hashtags_dim").select("hashtag", "tweet_id")) == [("AOS", 1), ("MMM", 1), ("mmm", 2)]


def test_user_counters_and_latest_name(lake):
    users = {r["user_id"]: r for r in lake.table("user_id_dim").collect()}
    assert (users[1]["user_followers_count"], users[1]["user_name"]) == (30, "Ann B")
    assert (users[2]["user_followers_count"], users[2]["friends_count"]) == (10, 8)


def test_posts_are_kept_per_tagged_ticker(lake):
    pairs = rows(lake.table("tickers_tweets_users_fact").select("tweet_id", "ticker"))
    assert pairs == [(1, "AOS"), (1, "MMM"), (2, "MMM"), (6, "ABT"), (7, "ABT")]


def test_bars(lake):
    bars = lake.table("tickers_historical_prices_fact")
    assert bars.where("ticker = 'AOS'").count() == 4
    assert bars.where("date = '2022-12-27' and ticker = 'MMM'").count() == 5
    assert [r["date"] for r in lake.recent_bars("MMM", n=2).collect()] == ["2022-12-27", "2023-01-03"]
    assert [r["datetime"] for r in lake.bars_since("MMM", "1m", "2022-12-25").collect()] == [
        "2022-12-27 09:30:00", "2022-12-27 09:31:00",
    ]


def test_price_filters_reach_the_folders_and_the_scan(lake):
    plan = lake.bars_since("MMM", "1h", "2022-12-25")._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "(month#" in filters and ">= 2022-12" in filters and "(interval#" in filters and "= 1h" in filters
    assert "EqualTo(ticker,MMM)" in plan
    posts = lake.posts_per_day("MMM")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(id_range" in posts


def test_newest_bars_open_the_newest_months(spark, tmp_path):
    """Twenty months of bars; the last few are found without the others."""
    rows_in = [(f"20{y}-{m:02d}-{d:02d} 00:00:00", f"20{y}-{m:02d}-{d:02d}", t, float(d), "1d")
               for y in (21, 22) for m in range(1, 11) for d in range(1, 6) for t in ("MMM", "ABT") if t == "MMM" or (y, m) < (22, 3)]
    schema = "datetime string, date string, ticker string, close double, interval string"
    rows_in += [(None, None, "MMM", 0.5, "1d")]
    made = Lake(spark, f"{tmp_path}/raw", f"{tmp_path}/staging", f"{tmp_path}/lake")
    prices = ENTITIES["tickers_historical_prices_fact"]
    prices.update(spark, made.lake_dir, spark.createDataFrame(rows_in, schema))

    def months(df):
        return {r[0].split("month=")[1][:7] for r in df.select(F.input_file_name()).distinct().collect()}

    whole = made.table("tickers_historical_prices_fact")
    for ticker, n, most in (("MMM", 3, 1), ("MMM", 12, 4), ("ABT", 7, 16), ("MMM", 1000, 21), ("nobody", 3, 21)):
        assert len(months(made._newest_bars(ticker, "1d", n, "datetime"))) <= most
        assert rows(made.recent_bars(ticker, n=n)) == rows(analytics.recent_bars(whole, ticker, "1d", n))
        assert rows(made.price_vs_posts(ticker, n).select(whole.columns)) == rows(analytics.daily_bars(whole, ticker, "1d", n))
    assert months(made._newest_bars("MMM", "1d", 3, "datetime")) == {"2022-10"}


def test_analyses(lake):
    assert rows(lake.posts_per_day("MMM")) == [("2022-12-25", 1), ("2022-12-26", 1)]
    feed = lake.news_feed("MMM").collect()
    assert [r["uuid"] for r in feed] == [f"n{i}" for i in range(7, -1, -1)]
    assert str(feed[-1]["provider_publish_time"]) == "2022-12-25 20:26:40"
    assert lake.ticker_profile("MMM").count() == 1
    assert [(r["date"], r["cnt"]) for r in lake.price_vs_posts("MMM").collect()] == [
        ("2022-12-23", 0), ("2022-12-27", 0), ("2023-01-03", 0),
    ]


def test_holder_of_both_types(lake):
    assert rows(lake.table("holders_dim")) == [("Vanguard", "institutional"), ("Vanguard", "mutual fund")]
    assert lake.table("tickers_holders_fact").count() == 1


def test_later_batch_replaces_values(spark, tmp_path):
    import pandas as pd

    write_raw(f"{tmp_path}/raw")
    made = Lake(spark, f"{tmp_path}/raw", f"{tmp_path}/staging", f"{tmp_path}/lake")
    names = ["tickers_historical_prices_fact"]
    made.stage(["tickers_historical_prices"])
    made.build(names)
    late = {"ts": pd.to_datetime(["2022-12-27", "2022-12-28"]), "MMM_Close": [1.0, 2.0], "NEW_Close": [3.0, float("nan")]}
    pd.DataFrame(late).to_parquet(
        f"{tmp_path}/raw/tickers_historical_prices/1d/part.parquet", coerce_timestamps="us", index=False
    )
    made.stage(["tickers_historical_prices"])
    made.build(names)
    daily = made.table(names[0]).where("interval = '1d'").select("date", "ticker", "close", "open")
    assert rows(daily.where("ticker = 'MMM'")) == [
        ("2022-12-23", "MMM", 103.0, 100.0), ("2022-12-27", "MMM", 1.0, None), ("2022-12-28", "MMM", 2.0, None),
        ("2023-01-03", "MMM", 105.0, 102.0),
    ]
    assert rows(daily.where("ticker = 'NEW'")) == [("2022-12-27", "NEW", 3.0, None)]
    assert daily.where("ticker = 'AOS'").count() == 2
    before = rows(made.table(names[0]))
    made.expire(keep=1)
    assert rows(made.table(names[0])) == before


def test_preview_and_duplicate_listing(lake):
    count, columns, head = lake.preview_staged("tickers_news", 3)
    assert (count, columns[0]) == (9, "uuid")
    assert [r["uuid"] for r in head.collect()] == ["n0", "n0", "n1"]
    assert lake.duplicates("tickers_news_fact").count() == 0


def test_command_line(lake, capsys):
    folders = ["--raw", lake.raw_dir, "--staging", lake.staging_dir, "--lake", lake.lake_dir, "--local-cores", "8"]
    main(["stage", "tickers_isin", *folders])
    main(["build", "news_dim", "tickers_info_dim", *folders])
    assert capsys.readouterr().out.split() == ["news_dim", "8", "tickers_info_dim", "2"]
    main(["check", *folders])
    with pytest.raises(SystemExit):
        main(["build", "no_such_entity", *folders])


def test_posts_exported_as_documents(spark, lake, tmp_path):
    export_posts(spark, lake.staging_dir, f"{tmp_path}/posts")
    schema = FEEDS["tweets"].schema
    back = read_json_documents(spark, f"{tmp_path}/posts", schema).select(schema.fieldNames())
    staged = read_staged(spark, "tweets", lake.staging_dir)
    assert rows(back.distinct()) == rows(staged.distinct()) and back.count() == staged.count()


def test_first_n_symbols(lake):
    assert [r[0] for r in lake.universe(2).collect()] == ["MMM", "AOS"]
    assert lake.symbols_text(2).first()["symbols"] == "MMM AOS"


def test_staging_the_first_symbols_only(spark, tmp_path):
    write_raw(f"{tmp_path}/raw")
    made = Lake(spark, f"{tmp_path}/raw", f"{tmp_path}/staging", f"{tmp_path}/lake")
    made.stage(["tickers_isin", "tickers_historical_prices", "tweets", "markets_indexes"], symbols=1)

    def found(feed, column):
        return {r[0] for r in read_staged(spark, feed, made.staging_dir).select(column).collect()}

    assert found("tickers_isin", "symbol") == {"MMM"}
    assert found("tickers_historical_prices", "ticker") == {"MMM"}
    assert found("tweets", "ticker") == {"MMM"}
    assert len(found("markets_indexes", "market")) == 4


def test_files_and_folders_do_not_change_what_is_merged(spark, tmp_path):
    """The rows of every feed in one file and in many give the tables of a whole build."""
    write_raw(f"{tmp_path}/raw")
    whole = Lake(spark, f"{tmp_path}/raw", f"{tmp_path}/staging", f"{tmp_path}/lake")
    whole.stage()
    whole.build()
    spread = Lake(spark, f"{tmp_path}/many", f"{tmp_path}/none", f"{tmp_path}/merged")
    scatter(f"{tmp_path}/raw", f"{tmp_path}/many")
    for feed, spec in FEEDS.items():
        universe = whole.universe() if spec.needs_universe else None
        merge_new_files(spark, feed, spread.raw_dir, spread.lake_dir, f"{tmp_path}/checkpoint", universe)
        for entity in entities_of(feed):
            if not ENTITIES[entity].any_source:
                assert rows(spread.table(entity)) == rows(whole.table(entity)), entity
    assert rows(spread.table("financial_report_dim")) == rows(whole.table("financial_report_dim"))


def scatter(source, target):
    """Copies raw files line by line, and arrays element by element, into files of one record each."""
    import json
    import os
    import shutil

    for folder, _, names in os.walk(source):
        there = folder.replace(source, target, 1)
        os.makedirs(there, exist_ok=True)
        for name in names:
            path = os.path.join(folder, name)
            if not name.endswith((".json", ".jsonl", ".txt")):
                shutil.copy(path, there)
                continue
            text = open(path).read()
            parts = [json.dumps([r]) for r in json.loads(text)] if text.startswith("[") else text.splitlines()
            for i, part in enumerate(parts):
                with open(os.path.join(there, f"{i}-{name}"), "w") as out:
                    out.write(part + "\n")


def test_counters_of_a_user_in_two_files(spark, tmp_path):
    import json
    import os

    raw = f"{tmp_path}/raw"
    os.makedirs(f"{raw}/tweets")
    old = post(1, "a #MMM", ["MMM"], user=5, name="Old", followers=99, created="2022-12-25 10:00:00")
    new = post(2, "b #MMM", ["MMM"], user=5, name="Ann", followers=3, created="2022-12-26 10:00:00")
    for name, record in (("a", new), ("b", old)):
        with open(f"{raw}/tweets/{name}.json", "w") as out:
            json.dump([record], out)
    universe = spark.createDataFrame([("MMM",)], "Symbol string")
    merge_new_files(spark, "tweets", raw, f"{tmp_path}/lake", f"{tmp_path}/checkpoint", universe)
    made = Lake(spark, raw, f"{tmp_path}/staging", f"{tmp_path}/lake")
    assert [(u["user_name"], u["user_followers_count"]) for u in made.table("user_id_dim").collect()] == [("Ann", 99)]


def test_empty_feed_fails_the_check(spark, tmp_path):
    write_raw(f"{tmp_path}/raw", actions=False)
    made = Lake(spark, f"{tmp_path}/raw", f"{tmp_path}/staging", f"{tmp_path}/lake")
    made.stage()
    with pytest.raises(QualityError, match="no entries in: tickers_actions"):
        made.check()


def test_new_files_are_merged_as_they_come(spark, tmp_path):
    import json

    write_raw(f"{tmp_path}/raw")
    made = Lake(spark, f"{tmp_path}/raw", f"{tmp_path}/staging", f"{tmp_path}/lake")
    arguments = ("tweets", made.raw_dir, made.lake_dir, f"{tmp_path}/checkpoint", made.universe())
    merge_new_files(spark, *arguments)
    assert made.table("tweets_dim").count() == 4
    with open(f"{tmp_path}/raw/tweets/c.json", "w") as out:
        json.dump([post(8, "late #ABT", ["ABT"]), post(2, "edited #MMM", ["MMM"], created="2022-12-26 10:00:00")], out)
    merge_new_files(spark, *arguments)
    texts = {r["tweet_id"]: r["text"] for r in made.table("tweets_dim").collect()}
    assert set(texts) == {1, 2, 6, 7, 8} and texts[2] == "edited #MMM"
    assert "tweets_dim" in entities_of("tweets") and "tickers_info_dim" not in entities_of("tickers_info")


def test_profiles_are_joined_from_three_feeds_as_they_come(spark, tmp_path):
    import json

    write_raw(f"{tmp_path}/raw")
    whole = Lake(spark, f"{tmp_path}/raw", f"{tmp_path}/staging", f"{tmp_path}/whole")
    whole.stage()
    whole.build(["tickers_info_dim"])
    made = Lake(spark, whole.raw_dir, f"{tmp_path}/staging", f"{tmp_path}/lake")
    for feed in ("tickers_isin", "tickers_info", "tickers_major_holders"):
        assert joined_entities_of(feed) == ["tickers_info_dim"]
        merge_new_files(spark, feed, made.raw_dir, made.lake_dir, f"{tmp_path}/checkpoint")
    assert rows(made.table("tickers_info_dim")) == rows(whole.table("tickers_info_dim"))
    with open(f"{tmp_path}/raw/tickers_isin/later.json", "w") as out:
        json.dump({"isin": "US-NEW", "symbol": "MMM"}, out)
    merge_new_files(spark, "tickers_isin", made.raw_dir, made.lake_dir, f"{tmp_path}/checkpoint")
    before, after = ({r["ticker"]: r.asDict() for r in x.table("tickers_info_dim").collect()} for x in (whole, made))
    assert after["MMM"] == {**before["MMM"], "isin": "US-NEW"}
    assert {k: v for k, v in after.items() if k != "MMM"} == {k: v for k, v in before.items() if k != "MMM"}


def test_report_feeds_reach_the_shared_dimension_one_by_one(spark, tmp_path):
    write_raw(f"{tmp_path}/raw")
    made = Lake(spark, f"{tmp_path}/raw", f"{tmp_path}/staging", f"{tmp_path}/lake")
    for feed in ("tickers_cashflow", "tickers_shares"):
        merge_new_files(spark, feed, made.raw_dir, made.lake_dir, f"{tmp_path}/checkpoint")
    found = {r["reporting_id"] for r in made.table("financial_report_dim").collect()}
    assert found == {"MMM_2021-12-31_year", "MMM_2020-12-31_year", "MMM_2021-12-31_quarter", "MMM_2021_year"}
    assert made.table("tickers_cashflow_fact").count() == 3
