"""Writes a small set of raw payload files in the layout the feeds read."""

import json
import os

import pandas as pd


def _lines(path, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part.json", "w") as out:
        out.writelines(json.dumps(r) + "\n" for r in rows)


def post(id, text, tags, user=1, name="Ann", followers=10, friends=5, created="2022-12-25 10:00:00", lang="en"):
    return {
        "id": id, "created_at": created, "in_reply_to_status_id": None, "truncated": False, "full_text": text,
        "entities": None if tags is None else {"hashtags": [{"text": t} for t in tags]},
        "metadata": {"iso_language_code": lang}, "retweet_count": 1, "source": "web", "source_url": "http://s",
        "user": {
            "id": user, "name": name, "location": "X", "description": "d", "verified": False,
            "followers_count": followers, "friends_count": friends, "created_at": "2010-01-02 03:04:05",
        },
    }


def write_raw(raw, actions=True):
    os.makedirs(raw, exist_ok=True)
    with open(f"{raw}/universe.csv", "w") as out:
        out.write("Symbol\nMMM\nAOS\nABT\n")

    _lines(f"{raw}/markets_indexes", [
        {"abbreviation": "us", "market": "USA", "index": [{"id": "SP500", "name": "S&P 500"}, {"id": None, "name": "?"}]},
        {"abbreviation": "de", "market": "Germany", "index": [{"id": "DAX", "name": "DAX"}, {"id": "SP500", "name": "S&P"}]},
        {"abbreviation": "xx", "market": "Empty", "index": []},
        {"abbreviation": None, "market": "NoAbbr", "index": [{"id": "NA1", "name": "n"}]},
    ])
    _lines(f"{raw}/tickers_exchanges", [
        {"exchange": "NYSE", "market": "us_market", "symbol": "MMM"},
        {"exchange": "NYSE", "market": "us_market", "symbol": "AOS"},
        {"exchange": None, "market": "us_market"},
        {"exchange": "XETRA", "market": "de_market"},
    ])
    _lines(f"{raw}/tickers_info", [
        {"symbol": "MMM", "industry": "Conglomerates", "sector": "Industrials", "zip": "55144", "city": "Saint Paul",
         "state": "MN", "country": "US", "currency": "USD", "exchange": "NYSE", "marketCap": 66000000000,
         "fundFamily": "None", "uuid": "u1"},
        {"symbol": "AOS", "industry": "Building", "sector": "Industrials", "zip": "53224", "city": "Milwaukee",
         "country": "US", "currency": "USD", "exchange": "NYSE", "lastSplitFactor": "NaN", "uuid": "u2"},
        {"symbol": "AOS", "industry": "Building", "sector": "Industrials", "zip": "53224", "city": "Milwaukee",
         "country": "US", "currency": "USD", "exchange": "NYSE", "lastSplitFactor": "NaN", "uuid": "u2"},
        {"symbol": None, "zip": None},
    ])
    _lines(f"{raw}/tickers_isin", [{"isin": "US88579Y1010", "symbol": "MMM"}, {"isin": "US8318652091", "symbol": "AOS"}])
    labels = [
        "% of Shares Held by All Insider", "% of Shares Held by Institutions",
        "% of Float Held by Institutions", "Number of Institutions Holding Shares",
    ]
    _lines(f"{raw}/tickers_major_holders", [
        *[{"symbol": "MMM", "value": v, "label": x} for v, x in zip(["0.12%", "67.20%", "67.28%", "2632"], labels)],
        {"symbol": "MMM", "value": "1%", "label": None},
        *[{"symbol": "AOS", "value": v, "label": x} for v, x in zip(["bad", "75.00%", "", "901"], labels)],
    ])
    for kind in ("institutional", "mutualfund"):
        _lines(f"{raw}/tickers_holders/{kind}", [
            {"Holder": "Vanguard", "Shares": 47 if kind == "institutional" else 9, "Date Reported": "2022-09-29 00:00:00",
             "% Out": 0.086, "Value": 5_000_000_000, "symbol": "MMM"},
        ])
    for kind, strike in (("calls", 100), ("puts", 90)):
        _lines(f"{raw}/tickers_options/{kind}", [
            {"contractSymbol": f"MMM{kind[0].upper()}{strike}", "lastTradeDate": "2022-12-01 15:00:00", "strike": strike,
             "lastPrice": 1.5, "inTheMoney": True, "symbol": "MMM"},
        ])
    _lines(f"{raw}/tickers_analysis", [
        {"Period": "0q", "Max Age": 1, "End Date": "2022-12-31", "Growth": 0.05, "Earnings Estimate Avg": 2.675,
         "Eps Trend 7Days Ago": "2.4", "Eps Revisions Up Last7Days": "abc", "symbol": "MMM"},
    ])
    for feed, metric in (
        ("tickers_balancesheet", "Total Liab"), ("tickers_cashflow", "Change To Netincome"),
        ("tickers_financials", "Total Revenue"),
    ):
        for folder, dates in (("yearly", ["2021-12-31", "2020-12-31"]), ("quarterly", ["2021-12-31"])):
            _lines(f"{raw}/{feed}/{folder}", [
                {"symbol": "MMM", "metric": metric, **{d: 100.005 + i for i, d in enumerate(dates)}},
                {"symbol": "MMM", "metric": "Net Income", **{d: None for d in dates}},
                {"symbol": "MMM", "metric": "Some Extra Metric", **{d: 1.0 for d in dates}},
            ])
    _lines(f"{raw}/tickers_earnings/yearly", [{"Year": 2021, "Revenue": 35355000000, "Earnings": 5921000000, "symbol": "MMM"}])
    _lines(f"{raw}/tickers_earnings/quarterly", [{"Quarter": "2Q2022", "Revenue": 8702000000, "Earnings": 78000000, "symbol": "MMM"}])
    _lines(f"{raw}/tickers_eps", [
        {"Earnings Date": "2022-10-25 06:00:00-04:00", "EPS Estimate": 2.6, "Reported EPS": 2.69, "Surprise(%)": 0.0331, "symbol": "MMM"},
        {"Earnings Date": "2023-01-24 06:00:00-05:00", "EPS Estimate": 2.4, "Reported EPS": float("nan"), "Surprise(%)": None, "symbol": "MMM"},
    ])
    if actions:
        _lines(f"{raw}/tickers_actions", [{"Date": "1987-10-26 00:00:00", "Dividends": 0.01, "Stock Splits": 0, "symbol": "AOS"}])
    _lines(f"{raw}/tickers_news", [
        *[{"uuid": f"n{i}", "title": f"t{i}", "publisher": "p", "link": "l", "providerPublishTime": 1672000000 + i,
           "type": "STORY", "symbol": "MMM", "thumbnail": {"x": 1}} for i in range(8)],
        {"uuid": "n0", "title": "t0", "publisher": "p", "link": "l", "providerPublishTime": 1672000000, "type": "STORY", "symbol": "AOS"},
    ])
    _lines(f"{raw}/tickers_recommendations", [
        {"Date": "2022-10-01 12:30:00", "Firm": "UBS", "To Grade": "Sell", "From Grade": "", "Action": "main", "symbol": "MMM"},
    ])
    _lines(f"{raw}/tickers_shares", [{"Year": 2021, "BasicShares": 579000000, "symbol": "MMM"}])

    times = {
        "1d": ["2022-12-23", "2022-12-27", "2023-01-03"],
        "1h": ["2022-12-27 09:30:00", "2022-12-27 10:30:00"],
        "1m": ["2022-12-27 09:30:00", "2022-12-27 09:31:00"],
    }
    for interval, stamps in times.items():
        os.makedirs(f"{raw}/tickers_historical_prices/{interval}", exist_ok=True)
        frame = {"ts": pd.to_datetime(stamps)}
        for ticker, base in (("MMM", 100.0), ("AOS", 50.0)):
            for k, name in enumerate(["Open", "High", "Low", "Close", "Volume"]):
                values = [base + k + i for i in range(len(stamps))]
                if ticker == "AOS":
                    values[0] = float("nan")
                frame[f"{ticker}_{name}"] = values
        pd.DataFrame(frame).to_parquet(
            f"{raw}/tickers_historical_prices/{interval}/part.parquet", coerce_timestamps="us", index=False
        )

    os.makedirs(f"{raw}/tweets", exist_ok=True)
    posts = [
        post(1, "buy #MMM and #AOS", ["MMM", "AOS", "MMM"], followers=10, name="Ann", created="2022-12-25 10:00:00"),
        post(2, "again #mmm now", ["mmm"], followers=30, name="Ann B", created="2022-12-26 10:00:00"),
        post(3, "RT @x: #MMM", ["MMM"]),
        post(4, "kaufen #MMM", ["MMM"], lang="de"),
        post(5, "nothing #ZZZ", ["ZZZ"]),
        post(6, "no list #ABT", None, user=2),
        post(7, "empty list #ABT", [], user=2, followers=3, friends=8, created="2022-12-26 11:00:00"),
        post(7, "empty list #ABT", [], user=2, followers=3, friends=8, created="2022-12-26 11:00:00"),
    ]
    with open(f"{raw}/tweets/a.json", "w") as out:
        json.dump(posts[:4], out, indent=1)
    with open(f"{raw}/tweets/b.json", "w") as out:
        json.dump(posts[4:], out, indent=1)
