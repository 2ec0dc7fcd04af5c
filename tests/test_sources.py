import hashlib
import os

import pytest

from voxtally.operators.clean import clean
from voxtally.sources.ingest import complete_columns, headers, read_dataset, read_mixed, read_raw, short_ids, spread, standardize, union_sources
from voxtally.sources.registry import AIRLINE_REVIEWS, DATASETS, DEMO_FEEDBACK, Dataset, Registry
from voxtally.sources.sinks import Landing, land, publish, published, shared_folder, write_table

CSV = '''airline_name,title,content,date,overall_rating,type_traveller,route,cabin_flown,recommended
adria-airways,"Lost ""bag""","First line
second line, same review",2015-04-10,7,NA,,Economy,1
,,Refund never came,not a date,n/a,Solo,A to B,None,0
jet-blue,Fine,"Crew, helpful",2014-01-02,3.5,,,,1.0
'''


@pytest.fixture()
def csv_file(tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(CSV)
    return str(path)


def test_csv_to_standard_schema(spark, csv_file):
    df = standardize(read_raw(spark, csv_file), DATASETS.get("skytrax_airline_reviews"))
    rows = df.orderBy("source_row").collect()
    first, second, third = rows
    assert first.review_text == "First line\nsecond line, same review" == first.feedback_text
    assert first.review_title == 'Lost "bag"' and first.traveler_type is None and first.route is None
    assert first.raw_text == 'Lost "bag" | First line\nsecond line, same review'
    assert (first.rating, first.recommended, first.review_date, first.is_synthetic) == (7.0, True, "2015-04-10", False)
    assert (second.rating, second.recommended, second.review_date, second.airline) == (None, False, None, None)
    assert (second.disruption_type, second.seat_type, third.recommended) == ("refund", None, True)
    assert {r.source for r in rows} == {"Skytrax User Reviews Dataset"}
    seed = "skytrax_airline_reviews | nan | nan | nan | Refund never came"
    assert second.review_id == "skytrax_airline_reviews_" + hashlib.md5(seed.encode()).hexdigest()[:12]


def test_absent_columns(spark):
    raw = spark.createDataFrame([("Late bag", 1)], "feedback_text string, rating int")
    row = standardize(raw, DEMO_FEEDBACK).first()
    seed = "demo_airline_feedback | <NA> | nan | <NA> | Late bag"
    assert row.review_id == "demo_airline_feedback_" + hashlib.md5(seed.encode()).hexdigest()[:12]
    assert (row.airline, row.seat_type, row.rating, row.review_text) == (None, None, 1.0, "Late bag")


def test_rows_keep_the_order_of_the_files(spark, tmp_path):
    for name, count in (("a", 3), ("b", 400), ("c", 2)):
        body = "".join(f"{name}{i}\n" for i in range(count))
        (tmp_path / f"{name}.csv").write_text("content\n" + body)
    got = [r.content for r in read_raw(spark, str(tmp_path)).orderBy("source_row").collect()]
    assert got == [f"{n}{i}" for n, count in (("a", 3), ("b", 400), ("c", 2)) for i in range(count)]


def test_registry(spark, csv_file):
    with pytest.raises(ValueError, match="unknown dataset 'x'"):
        DATASETS.get("x")
    with pytest.raises(ValueError, match="unsupported file format"):
        read_raw(spark, csv_file, "xls")
    registry = Registry(AIRLINE_REVIEWS)
    registry.register(Dataset("mine", "Mine", {"review_text": "body"}))
    raw = spark.createDataFrame([("No updates",)], "body string")
    assert standardize(raw, registry.get("mine")).first().disruption_type == "communication"


def synthetic(spark):
    return spark.createDataFrame(
        [("s1", "Crew helpful | again", "the same words here", True, None, 0),
         ("s2", None, "other words come here", False, "kept", 1)],
        "review_id string, review_title string, review_text string, recommended boolean, raw_text string, source_row long")


def test_completed_columns(spark):
    rows = {r.review_id: r for r in complete_columns(synthetic(spark), True).collect()}
    assert rows["s1"].raw_text == "Crew helpful | again | the same words here" and rows["s2"].raw_text == "kept"
    assert rows["s1"].feedback_text == "the same words here" and rows["s1"].rating is None
    assert rows["s1"].is_synthetic is True and rows["s1"].disruption_type is None


def test_union_modes(spark, csv_file):
    public = standardize(read_raw(spark, csv_file), AIRLINE_REVIEWS)
    both = union_sources(public, synthetic(spark), "combined").orderBy("source_rank", "source_row")
    assert [(r.source_rank, r.is_synthetic) for r in both.collect()] == [(0, False)] * 3 + [(1, True)] * 2
    assert union_sources(public).count() == 3
    assert union_sources(None, synthetic(spark), "synthetic").count() == 2
    with pytest.raises(ValueError, match="invalid source mode"):
        union_sources(public, mode="all")
    with pytest.raises(ValueError, match="needs the synthetic source"):
        union_sources(public, mode="combined")
    with pytest.raises(ValueError, match="needs source_row"):
        union_sources(public.drop("source_row"))


def test_public_copy_wins_over_synthetic(spark):
    def source(name):
        return spark.createDataFrame([(name, "The very same words", 7)], "review_id string, review_text string, source_row long")
    kept = clean(union_sources(source("p"), source("s"), "combined")).collect()
    assert [(r.review_id, r.is_synthetic) for r in kept] == [("p", False)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], 'q "x"')], "i int, tags array<string>, t string")
    write_table(df, str(tmp_path / "p"))
    write_table(df.withColumnRenamed("i", "j"), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).columns == ["j", "tags", "t"]
    write_table(df, str(tmp_path / "c"), "csv")
    assert spark.read.csv(str(tmp_path / "c"), header=True, escape='"').first().asDict() == dict(i="1", tags='["a","b"]', t='q "x"')
    assert land(df, "x").collect() == df.collect()
    assert shared_folder(spark)


def test_spread_moves_only_on_request(spark):
    df = spark.range(100).coalesce(1)
    assert spread(df, "id") is df
    assert spread(df, "id", 5).rdd.getNumPartitions() == 5


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    with pytest.raises(Exception, match="boom"):
        write_table(spark.range(5).selectExpr("id", "raise_error('boom') AS x"), path)
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmp_path) == ["t"]
    write_table(spark.read.parquet(path).where("id > 0"), path)  # a table may be made from itself
    assert spark.read.parquet(path).count() == 2 and os.listdir(tmp_path) == ["t"]


def test_published_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="nothing is published"):
        published(spark, path)
    first = publish(spark.range(1), path)
    reading = published(spark, path)
    second = publish(published(spark, path).unionAll(spark.range(1)), path)
    assert reading.count() == 1 and published(spark, path).count() == 2 and published(spark, path, first).count() == 1
    with pytest.raises(Exception, match="boom"):
        publish(spark.range(5).selectExpr("raise_error('boom') AS x"), path)
    assert published(spark, path).count() == 2 and {f for f in os.listdir(path) if f.startswith("version")} == {first, second}
    publish(spark.createDataFrame([(1, ["a"])], "i int, tags array<string>"), path, "csv", keep=0)
    assert published(spark, path).first().asDict() == dict(i="1", tags='["a"]')
    assert len([f for f in os.listdir(path) if f.startswith("version")]) == 1


def test_landed_tables_go_with_their_work(spark):
    with Landing(spark) as landing:
        df = landing.land(spark.range(4), "x")
        assert df.count() == 4 and os.path.exists(landing.path)
    assert not os.path.exists(landing.path)
    with pytest.raises(KeyError), Landing(spark) as landing:
        landing.land(spark.range(4), "x")
        raise KeyError
    assert not os.path.exists(landing.path)


def test_files_with_differing_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('title,content\nx,"first\nline"\n')
    (tmp_path / "b.csv").write_text("content,title\r\ny,z\r\n")
    (tmp_path / "c.csv").write_text("\ufeffcontent,overall_rating\nw,7\nv,NA\n")
    (tmp_path / "d.csv").write_text("content,title\nu,t\n")
    (tmp_path / "e.csv").write_text("")
    df = read_mixed(spark, str(tmp_path))
    got = sorted((r.content, r.title, r.overall_rating) for r in df.fillna("-").collect())
    assert got == [("first\nline", "x", "-"), ("u", "t", "-"), ("v", "-", "-"), ("w", "-", "7"), ("y", "z", "-")]
    assert df.select("source_row").distinct().count() == 5
    assert {tuple(f.rsplit("/", 1)[1] for f in r.files) for r in headers(spark, str(tmp_path)).collect()} == {("a.csv",), ("b.csv", "d.csv"), ("c.csv",)}
    dataset = Dataset("mine", "Mine", {"review_text": "content", "review_title": "title", "rating": "overall_rating"})
    rows = {r.review_text: (r.review_title, r.rating) for r in read_dataset(spark, str(tmp_path), dataset).collect()}
    assert rows == {"first\nline": ("x", None), "u": ("t", None), "v": (None, None), "w": (None, 7.0), "y": ("z", None)}
    with pytest.raises(ValueError, match="no CSV file"):
        read_mixed(spark, str(tmp_path / "e.csv"))


def test_datasets_in_other_formats(spark, tmp_path):
    spark.createDataFrame([("late bag",)], "body string").write.json(str(tmp_path / "j"))
    dataset = Dataset("mine", "Mine", {"review_text": "body"}, "json")
    assert read_dataset(spark, str(tmp_path / "j"), dataset).first().review_text == "late bag"


def test_colliding_identifiers_stay_whole(spark):
    raw = spark.range(200).selectExpr("concat('text ', id % 150) AS body")
    whole = standardize(raw, Dataset("k", "K", {"review_text": "body"}), id_digits=32)
    names = {}
    for r in whole.collect():
        names.setdefault(r.review_id[:4], set()).add(r.review_id)
    got = {r.review_text: r.review_id for r in short_ids(whole, 2).collect()}
    assert len(set(got.values())) == 150 and short_ids(whole, 2).count() == 200
    assert {len(i) for i in got.values()} == {4, 34}
    assert all(len(i) == (4 if len(names[i[:4]]) == 1 else 34) for i in got.values())


def test_differing_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title,content\nx,y\n")
    (tmp_path / "b.csv").write_text("content,title\ny,x\n")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, str(tmp_path), multi_line=False).collect()
