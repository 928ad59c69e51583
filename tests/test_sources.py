import json
import os

import pytest
from pyspark.sql import functions as F

from gapweave.operators import labels
from gapweave.sources import delimited, dictionary, tables


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_frames_by_file_with_separator_fallback(spark, tmp_path):
    write(tmp_path / "good.csv", "a\tb\n1\tx\n2\t\n")
    write(tmp_path / "comma.csv", 'a,b\n1,"x,y"\n')
    write(tmp_path / "other.txt", "z\n")
    frames = delimited.load_frames(spark, str(tmp_path))
    assert set(frames) == {"good", "comma"}
    assert [tuple(r) for r in frames["good"].orderBy("a").collect()] == [("1", "x"), ("2", None)]
    assert [tuple(r) for r in frames["comma"].collect()] == [("1", "x,y")]
    assert set(delimited.load_frames(spark, str(tmp_path), ["good.csv"])) == {"good"}


def test_long_lines_are_set_aside_and_short_ones_padded(spark, tmp_path):
    path = write(tmp_path / "x.csv", 'a,b,c\n1,2,3\n1,2\n1,2,3,4\n1,2,3,\n1,2,3,4,5\n1,2,3,4,5,6,7\n"q,r",2,3\n')
    good, bad = delimited.scan_tolerant(spark, path, ["a", "b", "c"])
    assert sorted(map(tuple, good.collect()), key=str) == sorted([("1", "2", "3"), ("1", "2", None), ("q,r", "2", "3")], key=str)
    assert sorted(r.line for r in bad.collect()) == ["1,2,3,", "1,2,3,4", "1,2,3,4,5", "1,2,3,4,5,6,7"]


def test_null_columns_go(spark):
    df = spark.createDataFrame([(1, None, ""), (2, None, None)], "a int, b string, c string")
    assert delimited.drop_null_columns(df).columns == ["a", "c"]


# Start line, section heads and field names are fixed values of the format; the remarks are our own.
DICTIONARY = """Some prose: ignored

List of fields:

# general information:

code : own number of the item
created_t : time (UNIX)
created_datetime
# Tags:
brands_tags
origin_fr
# nutrition facts:
fat_100g
biotin_100g: a vitamin, in grams
salt_serving : salt
"""


def test_dictionary_types_sections_and_stray_colon(spark, tmp_path):
    d = dictionary.read_dictionary(spark, write(tmp_path / "d.txt", DICTIONARY))
    got = {r.field: (r.section, r.type, r.sub_type, r.description) for r in d.collect()}
    assert got["code"] == ("generalinformation", "string", None, "own number of the item")
    assert got["biotin_100g"] == ("nutritionfacts", "float", None, "a vitamin, in grams")
    assert got["brands_tags"][1:3] == ("string", "tags") and got["origin_fr"][0] == "tags"
    assert got["created_datetime"] == ("generalinformation", "iso8601_datetime", None, None)
    schema = dictionary.schema_of(d)
    assert schema["created_t"].dataType.simpleString() == "bigint"
    assert schema["brands_tags"].dataType.simpleString() == "array<string>"
    assert schema["code"].metadata["description"] == "own number of the item"
    text = spark.createDataFrame([("1", "x", "2020-01-01", "a,b", None, "nan", "1.5", "z", "q")], "code string, created_t string, created_datetime string, brands_tags string, origin_fr string, fat_100g string, biotin_100g string, salt_serving string, extra string")
    r = dictionary.apply_schema(text, schema).first()
    assert (r.code, r.created_t, r.brands_tags, r.fat_100g, r.biotin_100g, r.salt_serving, r.extra) == ("1", None, ["a", "b"], None, 1.5, None, "q")


def test_cached_load_follows_the_source(spark, tmp_path):
    source, cache = tmp_path / "src", str(tmp_path / "cache")
    source.mkdir()
    write(source / "a.csv", "a\tb\n1\tx\n")
    calls = []

    def load(s, p):
        calls.append(p)
        return delimited.scan(s, p, "\t")

    for by_content in (True, False):
        calls.clear()
        tables.cached_load(spark, str(source), cache + str(by_content), load, by_content)
        assert tables.cached_load(spark, str(source), cache + str(by_content), load, by_content).count() == 1
        assert len(calls) == 1
        tables.cached_load(spark, str(source), cache + str(by_content), load, by_content, force=True)
        assert len(calls) == 2
    write(source / "b.csv", "a\tb\n2\ty\n")
    assert tables.cached_load(spark, str(source), cache + "True", load, True).count() == 2


def test_versions(spark, tmp_path):
    root = str(tmp_path / "v")
    one = spark.createDataFrame([("a",), ("b",)], "line string")
    two = spark.createDataFrame([("b",), ("c",)], "line string")
    assert [r.change for r in tables.save_and_compare(one, root, "20240101").collect()] == ["Added", "Added"]
    assert sorted(map(tuple, tables.save_and_compare(two, root, "20240201").collect())) == [("a", "Removed"), ("c", "Added")]
    assert tables.save_and_compare(two, root, "20240301").count() == 0
    assert tables.versions(spark, root) == ["20240101", "20240201", "20240301"]


def test_group_json_with_bare_nan(spark, tmp_path):
    text = '{"nan ": {"combinations": [{"combination": [NaN, "x"], "combination_percentage": 70.5, "frequency": "7", "fuzzy_score": 100}], "total_percentage": 70.5, "total_frequency": "7"}}'
    r = tables.read_group_json(spark, write(tmp_path / "g.json", text), ["a", "b"]).first()
    assert (r.group, r.a, r.b, r.frequency, r.score, r.total_frequency) == ("nan ", None, "x", 7, 100, 7)


@pytest.mark.parametrize("kind", ["csv", "json", "parquet"])
def test_sinks(spark, tmp_path, kind):
    df = spark.createDataFrame([("a\tb", 1, None), ('q"x', 2, "z")], "s string, n int, t string")
    path = tables.write_table(df, str(tmp_path / kind), kind)
    reader = spark.read.schema(df.schema)
    back = reader.csv(path, header=True, escape='"') if kind == "csv" else getattr(reader, kind)(path)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_nested_groups_come_in_bounded_parts(spark, tmp_path):
    rows = [("g", f"m{i}", i, 1.0, 100, 10, 10.0) for i in range(25)]
    df = spark.createDataFrame(rows, "group string, a string, frequency long, percentage double, score int, total_frequency long, total_percentage double")
    nested = labels.nest_groups(df, ["a"], members=10)
    assert nested.count() == 3 and nested.select(F.sum(F.size("combinations"))).first()[0] == 25
    path = tables.write_table(nested, str(tmp_path / "n"), "json")
    assert json.loads(spark.read.text(path).first()[0])["group"] == "g"


def test_unfinished_snapshot_is_written_again(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text("a\n1\n2\n")
    broken = lambda s, p: s.read.csv(p, header=True).where(F.raise_error(F.lit("stopped")).cast("boolean"))
    load = lambda s, p: s.read.csv(p, header=True)
    cache = str(tmp_path / "cache")
    with pytest.raises(Exception, match="stopped"):
        tables.cached_load(spark, str(source), cache, broken)
    assert tables.cached_load(spark, str(source), cache, load).count() == 2


def test_readers_outlive_a_forced_load(spark, tmp_path):
    """A frame read from one snapshot still gives its rows after another load has replaced it, and while it is replaced."""
    source = tmp_path / "in.csv"
    source.write_text("a\n1\n2\n")
    cache = str(tmp_path / "cache")
    old = tables.cached_load(spark, str(source), cache, lambda s, p: s.read.csv(p, header=True))
    during = []

    def load(s, p):
        during.append(tables.cached_load(s, str(source), cache, load).count())
        return s.read.csv(p, header=True).union(s.createDataFrame([("3",)], "a string"))

    new = tables.cached_load(spark, str(source), cache, load, force=True)
    assert (old.count(), during, new.count()) == (2, [2], 3)
    assert tables.cached_load(spark, str(source), cache, load).count() == 3


def test_a_version_is_stored_once_and_whole(spark, tmp_path):
    root = str(tmp_path / "v")
    df = spark.createDataFrame([("a",)], "line string")
    with pytest.raises(Exception, match="stopped"):
        tables.save_version(df.where(F.raise_error(F.lit("stopped")).cast("boolean")), root, "1")
    assert tables.versions(spark, root) == []
    tables.save_version(df, root, "1")
    with pytest.raises(FileExistsError):
        tables.save_version(df.union(df), root, "1")
    assert tables.read_version(spark, root, "1").count() == 1


def test_scan_refuses_files_with_another_header(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\ty\n1\t2\n")
    (tmp_path / "b.tsv").write_text("y\tx\n3\t4\n")
    (tmp_path / "c.tsv").write_text("x\ty\n5\t6\n")
    assert delimited.scan(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "c.tsv")]).count() == 2
    with pytest.raises(Exception, match="header"):
        delimited.scan(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")]).collect()


def test_headers_of_many_files_in_one_job(spark, tmp_path):
    for i in range(60):
        mark, names = ("," if i % 3 else "\t"), ["a", "b"] if i % 2 else ["a", "b", "c d"]
        (tmp_path / f"file {i}.csv").write_text("\n".join([mark.join(names), mark.join(str(i) for _ in names)]) + "\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "long.csv").write_text("a,b\n" + "7,8\n" * 40000)
    paths = delimited.list_files(spark, str(tmp_path))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    headers = delimited.headers_of(spark, paths)
    assert len(tracker.getJobIdsForGroup("headers")) <= 2  # beyond 32 paths Spark lists them in a job
    assert len(headers) == 61 and sorted(set(headers.values())) == ["a\tb", "a\tb\tc d", "a,b", "a,b,c d"]
    empty = f"file:{tmp_path}/empty.csv"  # names of empty files are not listed
    assert delimited.headers_of(spark, [empty]) == {empty: ""} and delimited.scan_groups(spark, [empty]) == {}
    groups = delimited.scan_groups(spark, paths)
    assert {(g.separator, len(g.columns)) for g in groups} == {(",", 2), (",", 3), ("\t", 2), ("\t", 3)}
    rows = {g: df.count() for g, df in groups.items()}
    assert sum(rows.values()) == 60 + 40000
    for g, df in groups.items():
        assert all(len(set(r)) == 1 for r in df.where("a <> '7'").collect())
    spark.sparkContext.setJobGroup("", "")


def test_headers_of_blocks_beyond_the_first(spark, tmp_path):
    (tmp_path / "long.csv").write_text("x,y\n" + "x,1\n" * 60000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000b")
    try:
        assert list(delimited.headers_of(spark, delimited.list_files(spark, str(tmp_path))).values()) == ["x,y"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert delimited.headers_of(spark, []) == {} and delimited.scan_groups(spark, []) == {}
    assert [delimited._bytes_of(s) for s in ("128MB", "134217728b", "64m", "7")] == [1 << 27, 1 << 27, 1 << 26, 7]
