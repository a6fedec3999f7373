import gzip
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest

from starling.schemas import POST
from starling.sinks import files as sinks
from starling.sources import files as sources
from starling.sources import jdbc
from starling.workload import files as workload
from starling.workload.adapters import Tables


@pytest.fixture
def odd_posts(posts_of):
    return posts_of(
        (1, 10, 'line\nbreak, "quoted" \\ back\\"slash', None, 5, None, "a,b"),
        (2, 20, "", 3, 5, 4, "x"),
        (3, 30, "⊢ inside", None, 5, None, "é"),
    )


@pytest.mark.parametrize("header", [True, False])
def test_delimited_round_trip(spark, tmp_path, odd_posts, rows, header):
    path = str(tmp_path / "posts")
    sinks.write_delimited(odd_posts, path, header, rows_per_file=1)
    read = sources.read_delimited(spark, path, POST, header)
    assert rows(read) == rows(odd_posts)
    assert len(list((tmp_path / "posts").glob("*.csv"))) >= 3


def test_required_columns(spark, tmp_path, rows):
    (tmp_path / "t.csv").write_text("1⊢a\n⊢b\nx⊢c\n")
    read = sources.read_delimited(spark, str(tmp_path / "t.csv"), "k long, v string", header=False, required=["k"])
    assert rows(read) == [(1, "a")]


def test_inferred_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k⊢v\n1⊢a\n")
    assert sources.read_delimited(spark, str(tmp_path / "t.csv")).dtypes == [("k", "int"), ("v", "string")]


def test_terms(spark, tmp_path, rows):
    (tmp_path / "terms.txt").write_text("Ring\nring\nÉcole\n\n")
    terms = sources.read_terms(spark, str(tmp_path / "terms.txt"))
    assert rows(terms) == [("",), ("ring",), ("école",)]
    assert sources.term_list(terms) == ["", "ring", "école"]
    with pytest.raises(ValueError, match="join the table"):
        sources.term_list(terms, limit=2)


def test_compressed_posts_by_glob(spark, tmp_path):
    spark.createDataFrame([('{"id": 1}',), ('{"id": 2}',)], "value string").write.option("compression", "gzip").text(
        str(tmp_path / "raw")
    )
    assert sources.read_posts(spark, str(tmp_path / "raw" / "part-*.gz")).count() == 2


def test_export_quotes_every_field(spark, tmp_path):
    sinks.export_csv(spark.createDataFrame([(1, 'a"b')], "k int, v string"), str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ['"1","a""b"']


def test_saved_tables(spark, tmp_path, rows):
    first, second = spark.range(3), spark.range(2)
    sinks.save_table(first, "starling_saved", str(tmp_path / "t"))
    sinks.save_table(second, "starling_saved", str(tmp_path / "t"))
    assert rows(spark.table("starling_saved")) == [(0,), (1,)]
    for _ in range(2):
        sinks.write_delimited(spark.range(2).selectExpr("id sender_uid", "'a' hashtags"), str(tmp_path / "d"), header=False)
        sinks.load_delimited(spark, str(tmp_path / "d"), "starling_loaded", "sender_uid long, hashtags string", location=str(tmp_path / "l"))
    assert spark.table("starling_loaded").count() == 4
    spark.sql("DROP TABLE starling_saved")
    spark.sql("DROP TABLE starling_loaded")


def test_table_sets(spark, tmp_path, rows):
    sinks.export_tables({"a": spark.range(2), "b": spark.range(3)}, str(tmp_path))
    restored = sinks.restore_tables(spark, ["a", "b"], str(tmp_path))
    assert [len(rows(restored[n])) for n in ("a", "b")] == [2, 3]


def test_serving_layout_splits_a_hot_key(spark, tmp_path):
    df = spark.range(4000).selectExpr("IF(id % 3 = 0, 7, id) AS uid", "id AS contact_uid")
    sinks.write_serving(df, str(tmp_path / "s"), ["uid", "contact_uid"], parts=8)
    read = spark.read.parquet(str(tmp_path / "s"))
    files = read.where("uid = 7").selectExpr("input_file_name() AS f").distinct().count()
    assert files >= 2
    assert read.where("uid = 7").count() == df.where("uid = 7").count()
    assert "PushedFilters: [IsNotNull(uid), EqualTo(uid,7)]" in read.where("uid = 7")._jdf.queryExecution().executedPlan().toString()


# A database is not started here; what can be checked without one is.
@pytest.mark.parametrize(("lower", "upper", "parts"), [(0, 99, 4), (5, 5, 3), (0, 2, 10), (-7, 7, 2)])
def test_key_ranges_cover_every_key_once(spark, lower, upper, parts):
    keys = spark.range(lower - 3, upper + 4).selectExpr("id AS k").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k"))
    found = [keys.where(p).count() for p in jdbc.key_ranges("k", lower, upper, parts)]
    assert sum(found) == keys.count()
    assert len(found) <= parts


def test_column_types(spark):
    df = spark.createDataFrame([], "a string, b long, c double, d array<int>, e int")
    assert jdbc.column_types(df, {"e": "SMALLINT"}) == "a VARCHAR(2000), b NUMERIC(19), c NUMERIC(19,4), e SMALLINT"


def test_files_are_loaded_once(spark, tmp_path, rows):
    source, location = tmp_path / "in", str(tmp_path / "table")
    source.mkdir()
    (source / "a.csv").write_text("1⊢x\n2⊢y\n2⊢y\n")
    schema = "sender_uid long, hashtags string"

    def load():
        return rows(sinks.load_new_files(spark, str(source), location, schema))

    assert load() == load() == [(1, "x"), (2, "y"), (2, "y")]
    (source / "b.csv").write_text("3⊢z\n")
    assert load() == [(1, "x"), (2, "y"), (2, "y"), (3, "z")]
    # What a load that failed has left aside is not seen, and its files are taken again.
    sinks.write_delimited(spark.createDataFrame([(9, "lost")], schema), f"{location}/_load-broken")
    (source / "c.csv").write_text("4⊢\n")
    assert load() == load() == [(1, "x"), (2, "y"), (2, "y"), (3, "z"), (4, None)]
    assert rows(sinks.loaded(spark, location)) == load()


def test_a_folder_without_rows(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("")
    for _ in range(2):
        assert rows(sinks.load_new_files(spark, str(tmp_path / "in"), str(tmp_path / "table"), "k long")) == []


def test_rows_are_counted_by_the_job_that_writes(spark, tmp_path, rows):
    table = spark.range(1000).where("id % 3 = 0").repartition(7)
    path = str(tmp_path / "t")
    assert sinks.counted(table, lambda df: df.write.parquet(path)) == 334 == spark.read.parquet(path).count()
    assert sinks.counted(table.limit(0), lambda df: df.write.mode("overwrite").parquet(path)) == 0
    joined = table.join(spark.range(50), "id")
    assert sinks.counted(joined, lambda df: sinks.write_delimited(df, str(tmp_path / "d"))) == 17


def test_raw_posts_are_written_at_the_cheapest_level(spark, tmp_path, rows):
    """Level 1 of gzip, each raw post one line, and the damaged lines beside them."""
    spark.createDataFrame([("A",), ("B",)], "r_name string").write.parquet(str(tmp_path / "region.parquet"))
    tables = Tables(spark, str(tmp_path))
    raw = spark.range(3000).selectExpr("id", "sha2(string(id), 256) AS text", "IF(id % 2 = 0, 'en', NULL) AS lang").coalesce(1)
    tables.__dict__["raw"] = raw
    read = workload._json(tables)
    assert rows(read, "id", "text", "lang") == sorted([tuple(r) for r in raw.collect()] + [(None,) * 3] * 2, key=repr)
    largest = max((Path(unquote(urlparse(f).path)) for f in read.inputFiles()), key=lambda p: p.stat().st_size)
    text = gzip.decompress(largest.read_bytes())
    assert largest.suffix == ".gz" and text.count(b"\n") == 3000
    assert largest.stat().st_size > 1.02 * len(gzip.compress(text, 6))
