"""CSV files: types found in all rows, and nothing lost from damaged ones."""

import pytest
from pyspark.sql import types as T

from racecast.plans import race
from racecast.sources import found_types, load_all, load_table, read_csv
from raceset import write


def put(folder, text, name="t.csv"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder / name)


def kinds(table):
    return {f.name: f.dataType.simpleString() for f in table.types}


def test_tightest_types(spark, tmp_path):
    path = put(tmp_path, "a,b,c,d,e,f,g,h,i\n1,1,1.5,2020-01-31,true,2020-01-31 10:00:00,x,\\N,+7\n"
                         "-2,3000000000,1e3,2020-02-29,FALSE,2020-01-31T10:00:00.5Z,,,007\n")
    table = read_csv(spark, path)
    assert kinds(table) == {"a": "int", "b": "bigint", "c": "double", "d": "date", "e": "boolean", "f": "timestamp",
                            "g": "string", "h": "string", "i": "int"}
    assert [r._rescued for r in table.rows.collect()] == [None, None]
    assert table.plain.columns == list("abcdefghi")


@pytest.mark.parametrize(
    ("values", "kind"),
    [(["1", "x"], "string"), (["1", "2.0"], "double"), (["2147483648"], "bigint"), (["9223372036854775808"], "double"),
     (["2020-02-30"], "string"), (["1", "true"], "string"), (["1."], "double"), ([".5"], "double"), (["NaN"], "string"),
     ([" 1"], "string"), (["16:44.718", "20"], "string")],
)
def test_types_of_odd_values(spark, tmp_path, values, kind):
    texts = spark.createDataFrame([(v,) for v in values], "v string")
    assert found_types(texts).collect()[0].data_type == kind


def test_one_bad_value_anywhere_counts(spark):
    texts = spark.range(50_000).selectExpr("if(id = 49999, 'x', string(id)) AS v")
    assert found_types(texts).collect()[0].data_type == "string"
    assert found_types(texts, tolerance=0.001).collect()[0].data_type == "int"


def test_damaged_rows_are_kept(spark, tmp_path):
    path = put(tmp_path, "k,x,day\n1,2.5,2020-01-01\n2,bad,2020-01-01\n3,4\n4,5,2020-13-01,more\n5,,\n")
    types = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("x", T.DoubleType()), T.StructField("day", T.DateType())])
    table = read_csv(spark, path, types)
    rows = {r.k: r for r in table.rows.collect()}
    assert rows[1]._rescued is None and rows[5]._rescued is None and rows[5].x is None
    assert rows[2]._rescued == {"x": "bad"} and rows[2].x is None
    assert rows[3]._rescued == {"_line": "3,4"} and rows[3].x == 4.0
    assert rows[4]._rescued == {"day": "2020-13-01", "_line": "4,5,2020-13-01,more"}
    damage = {(r.file.rsplit("/", 1)[1], r.column_name): r.n for r in table.damage().collect()}
    assert damage == {("t.csv", "x"): 1, ("t.csv", "day"): 1, ("t.csv", "_line"): 2}


def test_damage_by_file_and_columns_read_alone(spark, tmp_path):
    put(tmp_path / "t", "k,x\n1,2\n2,3,4\n", "one.csv")
    put(tmp_path / "t", "k,x\n3\n4,5\n", "two.csv")
    table = read_csv(spark, str(tmp_path / "t"))
    assert {(r.file.rsplit("/", 1)[1], r.n) for r in table.damage().collect()} == {("one.csv", 1), ("two.csv", 1)}
    assert sorted(r.k for r in table.plain.select("k").collect()) == [1, 2, 3, 4]


def test_types_given_for_some_columns(spark, tmp_path):
    path = put(tmp_path, "K,x\n1,2\n")
    table = read_csv(spark, path, T.StructType([T.StructField("k", T.StringType())]))
    assert kinds(table) == {"K": "string", "x": "int"}


def test_without_header(spark, tmp_path):
    path = put(tmp_path, "1,a\n2,b\n")
    with pytest.raises(ValueError, match="header"):
        read_csv(spark, path, header=False)
    types = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType())])
    assert [tuple(r)[:2] for r in read_csv(spark, path, types, header=False).rows.collect()] == [(1, "a"), (2, "b")]


def test_another_header_is_an_error(spark, tmp_path):
    put(tmp_path / "t", "k,x\n1,2\n", "one.csv")
    put(tmp_path / "t", "x,k\n1,2\n", "two.csv")
    with pytest.raises(Exception, match="(?i)header|field"):
        read_csv(spark, str(tmp_path / "t")).rows.collect()


def test_empty_file(spark, tmp_path):
    table = read_csv(spark, put(tmp_path, "k,x\n"))
    assert kinds(table) == {"k": "string", "x": "string"} and table.rows.count() == 0
    assert table.damage().count() == 0


def test_race_tables_with_found_types(spark, tmp_path):
    folder = write(tmp_path)
    found = load_all(spark, folder, infer=True)
    assert found["races"].schema["raceId"].dataType == T.IntegerType()  # named RACEID in the file
    assert found["results"].schema["number"].dataType == T.IntegerType()  # not a column the library knows
    bases = [race.race_base_table(race.clean_tables(t)) for t in (found, load_all(spark, folder))]
    assert set(bases[1].columns) == set(bases[0].columns)

    def plain(base):  # whole numbers may be an int here and a double there
        numbers = {f.name for f in base.schema if isinstance(f.dataType, T.NumericType)} | {"number", "grid", "round", "resultId"}
        typed = (base[c].cast("double" if c in numbers else "string").alias(c) for c in sorted(base.columns))
        return sorted(map(repr, (tuple(r) for r in base.select(*typed).collect())))

    assert plain(bases[0]) == plain(bases[1])
    assert load_table(spark, folder, "drivers", infer=True).schema["driverId"].dataType == T.IntegerType()
