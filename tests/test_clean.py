from datetime import date

from pyspark.sql import functions as F

from voxtally.operators import clean
from voxtally.plans.stages import scored_reviews


def test_clean_row(reviews):
    row = clean.clean(reviews(dict(
        airline="el_al", review_date="2024-03-05", review_title=" Refund \n mess ", review_text="My voucher,  was lost!",
        rating=4.0, recommended="yes", traveler_type=" Solo  Leisure ", route=" ", disruption_type="Refund"))).first()
    assert (row.airline, row.review_date, row.review_month) == ("El Al", date(2024, 3, 5), "2024-03")
    assert row.analysis_text == row.feedback_text == "Refund mess | My voucher, was lost!"
    assert row.clean_text == "refund mess my voucher was lost"
    assert (row.word_count, row.text_length) == (6, 35)
    assert (row.traveler_type, row.route, row.seat_type) == ("Solo Leisure", None, None)
    assert (row.rating_bucket, row.recommended, row.is_synthetic) == ("high", True, False)
    assert row.disruption_keywords_found == "refund; voucher"
    assert row.likely_negative_experience is True  # costly type with two keywords


def test_keywords_come_in_dictionary_order(reviews):
    df = reviews(dict(review_text="chat agent at the call center lost my luggage, bag and refund"))
    for build in (clean.clean, scored_reviews):
        assert build(df).first().disruption_keywords_found == "refund; bag; luggage; call center; chat; agent"


def test_either_order_gives_the_same_rows(reviews):
    df = reviews(*[dict(review_text=t, rating=float(i % 5)) for i, t in enumerate(
        ["delay at the gate", "Delay at the gate", "kind and helpful crew", "no", "lost my bag, refund refused",
         "kind and helpful crew!"])])
    for build in (clean.clean, scored_reviews):
        first, last = build(df, duplicates_first=True), build(df)
        assert first.columns == last.columns
        assert sorted(first.collect(), key=repr) == sorted(last.collect(), key=repr)


def test_negative_flag_reasons(reviews):
    rows = clean.clean(reviews(
        dict(review_text="one two three four", rating=2.0), dict(review_text="one two three five", recommended="no"),
        dict(review_text="refund one two three", disruption_type="refund"),
        dict(review_text="refund voucher bag late", disruption_type="delay"),
        dict(review_text="one two three six", rating=2.5))).collect()
    assert {r.review_id: r.likely_negative_experience for r in rows} == {
        "r0": True, "r1": True, "r2": False, "r3": False, "r4": False}


def test_first_copy_in_ingestion_order_is_kept(reviews):
    rows = [dict(review_text="The same, text. HERE", source_rank=1, source_row=0),
            dict(review_text="the same text here", source_rank=0, source_row=9),
            dict(review_text="The same text: here!", source_rank=0, source_row=4),
            dict(review_text="another text is here", source_rank=1, source_row=5)]
    kept = clean.clean(reviews(*rows).repartition(4)).select("review_id").collect()
    assert {r.review_id for r in kept} == {"r2", "r3"}


def test_quality_counts_and_profile(reviews):
    texts = ["", " ... ", "a b c", "a b c d", "A b, c d", "a b c e", "a b c d!"]
    df = reviews(*[dict(review_text=t, review_title=None, rating=None if i % 2 else 3.0, is_synthetic=i == 5)
                   for i, t in enumerate(texts)])
    row = clean.quality_counts(df).first().asDict()
    assert row == dict(rows_before=7, empty_reviews_removed=2, short_reviews_removed=1, duplicate_reviews_removed=2,
                       rows_after=2, retention_rate=2 / 7)
    cleaned = clean.clean(df)
    assert {r.field: r.missing_count for r in clean.missing_profile(cleaned).collect()} == dict(
        review_text=0, rating=2, traveler_type=2, route=2, seat_type=2)
    assert {r.origin: r["count"] for r in clean.source_mix(cleaned).collect()} == {"public": 1, "synthetic": 1}


def test_empty_input(reviews):
    df = reviews(dict(review_text="")).where("false")
    assert clean.quality_counts(df).first().rows_before == 0
    assert clean.quality_counts(df).first().retention_rate == 0.0
    assert scored_reviews(df).count() == 0


def test_order_puts_missing_dates_last(reviews):
    df = reviews(dict(review_text="a b c d", review_date=None), dict(review_text="a b c e", review_date="2024-02-01"),
                 dict(review_text="a b c f", review_date="2024-01-01"))
    assert [r.review_id for r in clean.canonical_order(clean.clean(df)).collect()] == ["r2", "r1", "r0"]


def test_ratings_and_dates_given_as_text(reviews):
    df = reviews(dict(review_text="a b c d")).withColumn("rating", F.lit("bad")).withColumn("review_date", F.lit("2024"))
    row = clean.clean(df).first()
    assert row.rating is None and row.rating_bucket == "unknown"


def test_not_a_number_is_missing(reviews):
    row = clean.clean(reviews(dict(review_text="a b c d", rating=float("nan")))).first()
    assert row.rating is None


def test_later_copies_by_any_partitioning(spark, reviews):
    rows = [(i % 2, i if i % 7 else None, f"{'x' if i % 5 else 'hot'} {i % 11 if i % 5 else 0} one two") for i in range(300)]
    df = spark.createDataFrame(rows, "source_rank int, source_row long, review_text string").selectExpr("*", "cast(NULL AS string) AS review_title").repartition(9)
    digests = clean.text_digests(df)
    first = {}
    for rank, row, text in rows:
        place = (rank, row is None, row or 0)
        first[text] = min(first.get(text, place), place)
    want = sorted((rank, row is None, row or 0) for rank, row, text in rows if (rank, row is None, row or 0) != first[text])
    copies = clean.later_copies(digests)
    assert sorted((r.source_rank, r.source_row is None, r.source_row or 0) for r in copies.collect()) == want
    for most in (0, 10_000):
        left = clean.without(df, copies, most_sent=most)
        assert left.count() == len(rows) - len(want) and ("BroadcastHashJoin" in plan_of(left)) >= (most > 0)


def test_counters_of_deliveries_add_up(reviews):
    texts = ["", "a b", "a b c d", "A b c d!", "e f g h", "a b c d", "e f g h", " "]
    whole = reviews(*[dict(review_text=t) for t in texts])
    parts = [clean.per_text(clean.text_digests(whole.where(f"source_row % 3 = {i}"))) for i in range(3)]
    assert clean.count_reductions(clean.merge_texts(*parts)).first() == clean.quality_counts(whole).first()
    staged = clean.staged(whole)
    assert clean.count_reductions(clean.per_text(staged)).first() == clean.quality_counts(whole).first()


def test_no_text_in_the_exchange_that_finds_duplicates(spark, reviews):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = reviews(*[dict(review_text="a b c d") for _ in range(5)])
        plan = plan_of(clean.later_copies(clean.text_digests(df)))
        for line in plan.split("Exchange hashpartitioning(text_key")[1:]:
            below = line.split("Project [")[1].split("]")[0]
            assert "review_text" not in below.split(" AS ")[0] and "source_row" in below
        kept = plan_of(clean.clean(df, duplicates_first=True))
        assert "Exchange hashpartitioning" not in kept and "BroadcastHashJoin" in kept
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_duplicates_are_limited_before_the_shuffle(reviews):
    plan = plan_of(clean.clean(reviews(dict(review_text="a b c d"))))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_summaries_do_not_shuffle_texts(reviews):
    scored = scored_reviews(reviews(dict(review_text="a b c d")))
    plan = plan_of(scored.groupBy("sentiment_label").count())
    above = plan[plan.index("WindowGroupLimit"):]
    shuffled = above[above.index("Exchange hashpartitioning(_text_key"):]
    project = shuffled[shuffled.index("Project ["):].split("\n")[0]
    assert " AS clean_text" not in project and "AS _text_key" in project
    assert not project.startswith("Project [clean_text") and ", clean_text#" not in project.split("AS sentiment_label")[0][:60]
