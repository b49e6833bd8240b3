from __future__ import annotations

from pyspark.sql import functions as F

from sievewell import schemas
from sievewell.operators import cleaning as C
from sievewell.plans import films as P

from samples import record


def cleaned(df, **options):
    return {r.id: r for r in P.clean_records(df, **options).collect()}


def test_each_cleaning_rule(raw_frame, either_mode):
    rows = cleaned(
        raw_frame(
            record(1),
            record(2, belongs_to_collection=None, release_date="", runtime=0, tagline="No Data", overview=""),
            record(3, budget=0, revenue=0),
            record(4, status="Planned"),
            record(5, status=None),
            {"id": 6, "title": "Sparse", "status": "Released"},
            record(7, title=None),
            record(None),
            record(None),
        )
    )
    assert sorted(rows) == [1, 2, 3]
    assert rows[1].asDict() == {
        **rows[1].asDict(),
        "genres": "Comedy|Science Fiction", "belongs_to_collection": "Saga", "production_companies": "Lantern|Mill",
        "budget_musd": 20.0, "revenue_musd": 50.0, "profit_musd": 30.0, "roi": 2.5, "runtime": 100.0,
        "cast": "Ann Ash|Bo Birch", "cast_size": 2, "director": "Cy Cedar", "crew_size": 2,
    }
    assert (rows[2].belongs_to_collection, rows[2].release_date, rows[2].runtime, rows[2].tagline, rows[2].overview) == (None,) * 5
    assert (rows[3].budget_musd, rows[3].revenue_musd, rows[3].profit_musd, rows[3].roi) == (None,) * 4


def test_columns_are_the_contract_even_when_everything_is_null(raw_frame):
    df = P.clean_records(raw_frame(record(1, belongs_to_collection=None)))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.CLEAN_SCHEMA]
    assert df.first().belongs_to_collection is None


def test_missing_source_columns_become_typed_nulls(raw_frame, tmp_path):
    raw = raw_frame(record(1)).drop("credits", "genres", "status", "tagline")
    df = P.clean_records(raw)
    row = df.first()
    assert (row.cast, row.director, row.genres, row.tagline) == (None,) * 4
    df.write.csv(str(tmp_path / "out"))


def test_duplicates_keep_the_preferred_row(raw_frame):
    df = raw_frame(record(1, popularity=1.0), record(1, popularity=3.0), record(1, popularity=2.0), record(2))
    for shuffled in (df, df.orderBy(F.rand(3)), df.repartition(3)):
        assert cleaned(shuffled, prefer=[F.col("popularity").desc()])[1].popularity == 3.0
    assert C.one_per_key(df, "id").count() == 2


def test_null_keys_collapse_to_one(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "id int, x int")
    assert sorted(r.x for r in C.one_per_key(df, "id").collect()) == [1, 3]


def test_sparse_filter_counts_all_present_columns_and_nan(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (2, None, None)], "id int, a string, b double")
    assert [r.id for r in C.drop_sparse(df, 2).collect()] == [1]
    assert [r.id for r in C.drop_sparse(df, 1, ["id"]).collect()] == [1, 2]


def test_status_filter_is_a_no_op_without_the_column(spark):
    df = spark.range(3)
    assert C.keep_status(df, "Released").count() == 3


def test_funnel_agrees_with_stagewise_counts(raw_frame):
    raw = raw_frame(
        *[record(i % 7, popularity=float(i)) for i in range(20)],
        *[record(None) for _ in range(4)],
        record(30, title=None),
        record(31, status="Planned"),
        record(32, status=None),
        {"id": 33, "title": "Sparse", "status": "Released"},
    )
    shaped = P.shape_records(raw)
    known = C.require(C.one_per_key(shaped, "id"), ["id", "title"])
    dense = C.drop_sparse(known)
    released = C.keep_status(dense, "Released")
    counts = [f.count() for f in (shaped, known, dense, released)]
    wanted = dict(zip(C.FUNNEL_STAGES, [counts[0] - counts[1], counts[1] - counts[2], counts[2] - counts[3], counts[3]]))
    assert {r.drop_stage: r.n for r in P.funnel(raw).collect()} == wanted
    assert {r.drop_stage: r.n for r in P.funnel(raw.limit(0)).collect()} == dict.fromkeys(C.FUNNEL_STAGES, 0)


def test_chain_applies_left_to_right(spark):
    out = C.chain(spark.range(1), lambda d: d.withColumn("a", F.lit(1)), lambda d: d.withColumn("b", F.col("a") + 1))
    assert out.first().b == 2
