"""Merge policies, picks, expressions and parsers on small rows."""

import pytest
from pyspark.sql import functions as F

from tidewright.functions import codes, titles, values
from tidewright.operators import documents, facts, jobs, keyed, quality, serving, store
from tidewright.sources import disclosures, lending, tidy


@pytest.mark.parametrize(
    "old_at, new_at, value",
    [(1, 2, "n"), (2, 2, "n"), (3, 2, "o"), (None, 2, "n"), (1, None, "o")],
)
def test_guard(spark, old_at, new_at, value):
    old = spark.createDataFrame([(1, old_at, "o")], "k int, at int, v string")
    new = spark.createDataFrame([(1, new_at, "n")], "k int, at int, v string")
    assert [r.v for r in keyed.merge_upsert(old, new, ["k"], guard="at").collect()] == [value]


def test_policies(spark):
    form = "k int, a string, b string, c string, tag string"
    old = spark.createDataFrame([(1, "x", "x", "x", "personal-only"), (2, "y", "y", "y", "commercial-ok")], form)
    new = spark.createDataFrame([(1, None, None, "z", "factual-cite"), (3, "w", "w", "w", None)], form)
    policy = {"b": keyed.MERGE, "c": keyed.KEEP, "tag": keyed.STRICTER}
    got = {r.k: tuple(r)[1:] for r in keyed.merge_upsert(old, new, ["k"], policy).collect()}
    assert got == {1: (None, "x", "x", "personal-only"), 2: ("y", "y", "y", "commercial-ok"), 3: ("w", "w", "w", None)}


def test_fold_keeps_last_known(spark):
    new = spark.createDataFrame([(1, 1, "a", "p"), (1, 2, None, None)], "k int, at int, m string, r string")
    assert [tuple(r) for r in keyed.fold_batch(new, ["k"], ["at"], ["m"]).select("m", "r").collect()] == [("a", None)]


@pytest.mark.parametrize(
    "text, number",
    [("1,234,567", 1234567.0), ("-15.5", -15.5), ("△123", -123.0), ("▲1", -1.0), ("(12)", -12.0), ("(注1)", None), ("－", None), ("", None), ("1_0", 10.0), ("1d", None), ("nan", None), ("1e999", None), (None, None), ("　 △ 5 ", -5.0), ("1△2", None), ("(3)(", -3.0), ("5-", None), ("１２", 12.0)],
)
def test_parse_numeric(spark, text, number):
    row = spark.createDataFrame([(text,)], "t string").select(values.parse_numeric(F.col("t")).alias("n")).first()
    assert row.n == number


@pytest.mark.parametrize(
    "raw, code, ticker, key",
    [("7203", "7203", "7203", "7203"), ("１３０ａ", "130A", "130A", "130A"), ("72030", "72030", "7203", "7203"), ("25935", "25935", None, "25935"), ("﻿0001 ", "0001", "0001", "0001"), ("72", "72", None, None), (None, "", None, None)],
)
def test_codes(spark, raw, code, ticker, key):
    c = F.col("c")
    row = spark.createDataFrame([(raw,)], "c string").select(codes.normalize_stock_code(c), codes.source_code_to_ticker(c), codes.margin_code_to_key(c)).first()
    assert tuple(row) == (code, ticker, key)


@pytest.mark.parametrize(
    "title, label",
    [("決算短信の訂正", "短信"), ("短信", "その他"), ("株式の分割（1株を3株）の修正", "株式分割"), ("株式分割の修正と業績予想の修正", "業績修正"), ("株式分割の訂正", "株式分割"), ("上場廃止のおそれ", "その他"), ("子会社の上場廃止", "その他"), ("完全子会社化と上場廃止", "上場廃止"),
     ("株主優待", "優待"), ("優待", "その他"), ("上場廃止に該当しない旨", "その他"), ("上場廃止の可能性", "その他"), ("上場廃止に伴う配当予想の修正", "配当修正"), ("種類株式の上場廃止", "その他"), ("持分法適用会社の上場廃止", "その他"), ("新規上場", "新規上場"), ("有価証券報告書", "有報"), ("四半期報告書", "四半期報告")],
)
def test_titles(spark, title, label):
    assert spark.createDataFrame([(title,)], "t string").select(titles.classify_title(F.col("t"))).first()[0] == label


def test_summary_prefers_consolidated_and_skips_zero_forecast(spark):
    rows = [
        ("d", "x:NetSales", "CurrentYearDuration", "2024-03-31", "単体", "5", 0),
        ("d", "x:NetSales", "CurrentYearDuration", "2024-03-31", "連結", "△7", 1),
        ("d", "x:Sales", "NextYearDuration_ForecastMember", "", "連結", "0", 2),
        ("f", "x:TypeOfCurrentPeriodDETAIL", "C", "", "", "1Q", 0),
        ("f", "x:CurrentFiscalYearEndDateDEI", "C", "", "", "2025-03-31", 1),
        ("f", "x:CurrentPeriodEndDateDEI", "C", "", "", "2024-09-30", 2),
        ("f", "x:Sales", "CurrentYear_NextAccumulated_ForecastMember", "", "連結", "3", 3),
        ("d", "x:Sales", "CurrentYearDuration_ForecastMember", "", "連結", "9", 3),
        ("e", "x:NetSales", "Prior1YearDuration", "2023-03-31", "連結", "1", 0),
    ]
    df = spark.createDataFrame(rows, "doc_id string, element string, context_ref string, period_end string, consolidated string, value string, ord long").withColumn("instant_date", F.lit(""))
    got = facts.summarize(df, {"sales": ["NetSales"]}, {"ahead": ["Sales"]}, ()).orderBy("doc_id").collect()
    assert [(r.doc_id, r.sales, r.ahead, r.consolidated, r.disclosure_type) for r in got] == [("d", -7.0, 9.0, "連結", "本決算"), ("f", None, 3.0, "連結", "1Q")]
    assert str(got[1].fiscal_period_end) == "2024-09-30"


@pytest.mark.parametrize(
    "title, ratio, factor",
    [("1 株を 3 株に", "1:3", 3.0), ("５株を１株に併合", "5:1", 0.2), ("1：5", "1:5", 5.0), ("0株を3株", None, None), ("分割", None, None), ("1株につき2株", "1:2", 2.0)],
)
def test_split_terms(spark, title, ratio, factor):
    row = spark.createDataFrame([(title,)], "t string").select(titles.split_terms(F.col("t")).alias("s")).first().s
    assert (row and row.ratio, row and row.factor) == (ratio, factor)


def test_effective_dates_and_links(spark):
    told = [("効力発生日 2026年4月1日", "2026-04-01"), ("効力発生日に先立つ基準日を2026年4月1日", None), ("効力発生（２０２６年２月３０日）", None), ("2026年4月1日", None)]
    rows = spark.createDataFrame(told, "t string, d string").select(F.date_format(titles.effective_date(F.col("t")), "yyyy-MM-dd").alias("got"), "d").collect()
    assert all(r.got == r.d for r in rows), rows
    links = [("https://a/rd.php?https://b/x/1.pdf", "1"), ("https://b/2.PDF?q=1#f", "2"), ("https://x.pdf", None), ("https://b/.pdf", None), ("https://b/3.html", None), (None, None)]
    assert all(r.got == r.d for r in spark.createDataFrame(links, "t string, d string").select(titles.document_id(F.col("t")).alias("got"), "d").collect())


def test_business_days_and_market_time(spark):
    import datetime as dt

    days = [dt.date(2024, 1, 1) + dt.timedelta(k) for k in range(14)]
    rows = spark.createDataFrame([(a, b, n) for a in days for b in days for n in range(4)], "a date, b date, n int")

    def add(day, n):
        while n:
            day += dt.timedelta(1)
            n -= day.weekday() < 5
        return day

    for r in rows.select("*", values.weekend_days(F.col("a"), F.col("b")).alias("w"), values.add_business_days(F.col("a"), F.col("n")).alias("d")).collect():
        assert r.w == sum((r.a + dt.timedelta(k)).weekday() >= 5 for k in range(1, (r.b - r.a).days + 1)) and r.d == add(r.a, r.n), r
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        at = F.timestamp_seconds(F.lit(1704067200 - 9 * 3600))  # midnight of 2024-01-01 in the market's zone
        row = spark.range(1).select(F.date_format(values.market_day(at), "yyyy-MM-dd").alias("day"), F.unix_seconds(values.market_midnight(F.lit("2024-01-01").cast("date"))).alias("start"), F.unix_seconds(values.submit_time(F.lit("2024-01-01 00:00"))).alias("submitted")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == ("2024-01-01", 1704067200 - 9 * 3600, 1704067200 - 9 * 3600)


def test_clip_round_and_strictest(spark):
    row = spark.range(1).select(values.clip(F.repeat(F.lit("あ"), 2001)).alias("c"), values.round_half_even(F.lit(0.00125), 4).alias("a"), values.round_half_even(F.lit(2.675), 2).alias("b")).first()
    assert row.c == "あ" * 1990 + "…(省略)" and (row.a, row.b) == (round(0.00125, 4), round(2.675, 2))
    tags = spark.createDataFrame([("commercial-ok",), ("odd",)], "t string")
    assert tags.agg(values.strictest("t").alias("s")).first().s == "odd"
    with pytest.raises(Exception, match="no licence"):
        tags.filter("t = 'x'").agg(values.strictest("t")).collect()
    with pytest.raises(Exception, match="no default licence"):
        spark.range(1).select(values.source_licence(F.lit("計算"))).collect()


def test_instances_keep_prefixes_and_texts(spark):
    files = spark.createDataFrame([("1", "bad", b"<x"), ("1", "none", None), ("1", "ok", b'<r xmlns:a="u"><a:N contextRef="CurrentYearDuration"> 4 </a:N></r>')], "code string, doc_id string, content binary")
    got = {(r.doc_id, r.status, r.element, r.value) for r in tidy.facts_of(files, "xbrl").collect()}
    assert got == {("bad", "失敗", None, None), ("none", "対象外", None, None), ("ok", "完了", "a:N", " 4 ")}
    assert tidy.facts_of(files.filter("doc_id = 'bad'"), "xbrl").first().error
    with pytest.raises(ValueError, match="pdf"):
        tidy.facts_of(files, "pdf")


def test_inline_facts_by_namespace_then_tag():
    ix = lambda ns, tag, name, text, more="": f'<i{ns}:{tag} name="{name}" contextRef="c" {more}>{text}</i{ns}:{tag}>'
    spaces = 'xmlns:i1="http://www.xbrl.org/2008/inlineXBRL" xmlns:i3="http://www.xbrl.org/2013/inlineXBRL" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"'
    body = ix(3, "nonFraction", "a:D", "4") + ix(1, "nonNumeric", "a:B", " t&nbsp;x ") + ix(1, "nonFraction", "a:A", "1,250", 'scale="3"') + ix(3, "nonNumeric", "a:E", "", 'xsi:nil="true"') + '<i1:nonFraction name="a:X">1</i1:nonFraction>' + ix(1, "nonFraction", "a:C", "abc")
    expected = [("a:A", "1250000"), ("a:C", ""), ("a:B", "t\xa0x"), ("a:D", "4"), ("a:E", "")]
    for page in (f"<html {spaces}>{body}</html>", f"<html {spaces}><p>{body}<br> & more"):
        assert [(f["element"], f["value"]) for f in tidy.inline_facts(page.encode())] == expected
    assert [tidy.decode_inline(*x) for x in [("1,250", "3", None), ("0.50", "0", "-"), ("－", None, None), ("—", None, None), ("12.5", "-1", None), ("abc", None, None), ("1", "x", None)]] == ["1250000", "-0.5", "", "", "1.25", "", ""]


def test_csv_with_other_columns_fails(spark):
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.csv", "x\ty\n1\t2\n")
    row = tidy.facts_of(spark.createDataFrame([("1", "d", out.getvalue())], "code string, doc_id string, content binary"), "csv").first()
    assert row.status == "失敗" and "columns" in row.error


def test_ids_pass_exactly(spark):
    rows = spark.createDataFrame([(9007199254740993, '{"a":1}'), (None, "x")], "i long, t string")
    assert sorted(str(r.i) for r in tidy.json_cells(rows, "i", "t").collect()) == ["9007199254740993", "None"]


def test_other_answers_are_no_lists(spark):
    rows = spark.createDataFrame([('{"StatusCode": 401, "message": "x"}',), ('{"metadata":{"status":"200"},"results":{}}',), ('{"metadata":{"status":"200"},"results":[]}',)], "payload string")
    assert [r.error is None for r in disclosures.list_errors(rows).collect()] == [False, False, True]
    with pytest.raises(Exception, match="not a document list"):
        disclosures.list_documents(rows).collect()


def test_empty_series_file(spark):
    files = spark.createDataFrame([("f", "申込日\n".encode("cp932")), ("g", b"")], "file string, content binary")
    assert lending.parse_balances(files).count() == 0


def test_merge_keeps_and_checks_columns(spark):
    old, new = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, "b", 5), (2, "c", 6)], "k int, v string, w int")
    assert sorted(tuple(r) for r in keyed.merge_upsert(old, new, ["k"]).select("k", "v", "w").collect()) == [(1, "b", 5), (2, "c", 6)]
    with pytest.raises(ValueError, match="vv"):
        keyed.merge_upsert(old, new, ["k"], {"vv": keyed.MERGE})


def test_null_elements_are_compared(spark):
    rows = spark.createDataFrame([("s", None), ("s", 1)], "s string, e int")
    assert keyed.regressions(rows, rows, ["s"], ["e"]).count() == 0
    assert keyed.regressions(rows, rows.filter("e = 1").unionByName(rows.filter("e = 1")), ["s"], ["e"]).first().lost == 1


def test_envelope_keeps_the_first_order(spark):
    rows = spark.createDataFrame([(1, "b", "z"), (2, "a", "y"), (3, "b", "z"), (4, None, ""), (5, "", "x")], "k int, l string, s string")
    assert tuple(serving.envelope(rows, "l", "s", "k").first()) == ("a,b", "z,y,x", 5)
    assert tuple(serving.envelope(rows.filter("k > 9"), "l", "s", "k").first()) == ("", "", 0)


def test_files_of_digests(spark):
    rows = spark.createDataFrame([("a" * 64, "commercial-ok"), ("b" * 64, "factual-cite")], "sha256 string, license_tag string")
    assert [serving.raw_file(rows, x, public).count() for x, public in (("a" * 64, True), ("b" * 64, True), ("b" * 64, False), ("A" * 64, False))] == [1, 0, 1, 0]


def test_writes_to_several_stores():
    seen = []
    errors = store.write_to_all("rows", {"one": seen.append, "two": lambda df: 1 / 0})
    assert seen == ["rows"] and errors["one"] is None and "ZeroDivisionError" in errors["two"]
    assert store.write_to_all("rows", {"one": lambda df: 1 / 0}, dry_run=True) == {"one": None}
    with pytest.raises(RuntimeError, match="no store"):
        store.write_to_all("rows", {"one": lambda df: 1 / 0})


def test_runs_of_jobs(spark):
    clock = iter(range(100)).__next__

    def boom(run):
        raise KeyError("x")

    run, row = jobs.run(spark, "j", [("a", lambda r: None), ("b", boom), ("c", lambda r: None)], clock, limit=2)
    assert (run.status, run.processed, [c for c, _ in run.failures]) == ("一部失敗", 1, ["b"]) and row.first().failed_codes == ["b"]
    assert jobs.run(spark, "j", [("b", boom)], clock)[0].status == "失敗" and jobs.run(spark, "j", [], clock)[0].status == "成功"

    def broken():
        yield "a", lambda r: None
        raise OSError("no list")

    assert jobs.run(spark, "j", broken(), clock)[0].status == "失敗"
    assert jobs.codes_of(" 7203, ,130A,7203") == ["7203", "130A"] and jobs.codes_of("") is None and jobs.parser("x").parse_args(["--dry-run"]).dry_run


def test_code_list_in_utf8(spark):
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("b.csv", "証券コード\r\n".encode("cp932"))
    assert disclosures.code_list_text(spark.createDataFrame([(out.getvalue(),)], "content binary")).first().text == "証券コード\r\n"


def test_pairs_of_files(spark, tmp_path):
    csv_path, parquet_path = store.write_pair(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), str(tmp_path), "raw.json")
    assert sorted(map(tuple, spark.read.parquet(parquet_path).collect())) == [("1", None), ("2", "x")] and csv_path.endswith("raw_converted.csv")
    assert spark.read.option("header", True).csv(csv_path).count() == 2


def test_overwrite_guard_of_documents(spark):
    rows = spark.createDataFrame([(1, 2, True), (2, 1, False), (2, 2, True), (None, 1, True), (1, None, True)], "s int, i int, ok boolean")
    assert all(r.got == r.ok for r in rows.select(documents.may_overwrite(F.col("s"), F.col("i")).alias("got"), "ok").collect())


def test_observations_need_their_own_time(spark):
    rows = spark.createDataFrame([("d", 1, None)], "dataset string, row_count int, updated_at long")
    with pytest.raises(Exception, match="no epoch"):
        store.record_freshness(rows, rows).collect()
    assert quality.probe_silence(spark.createDataFrame([], "job_name string, status string, finished_at long"), F.lit("2024-01-01").cast("timestamp")).first().problem == "never"


def test_json_records():
    assert tidy.json_records('{"results": [{"a": {"b": 1}, "c": null}, 3]}') == [{"a.b": "1", "c": None}, {"value": "3"}]
