"""Readers keep every data row, and keys keep every digit."""

from pyspark.sql import functions as F

from creditlens.functions.columns import pad_digits
from creditlens.sources.files import read_arff, read_whitespace, write_arff


def test_arff_keeps_rows_that_look_like_header(spark, tmp_path):
    f = tmp_path / "a.arff"
    f.write_text("% c\n@relation r\n@attribute 'x y' string\n@attribute b numeric\n\n@DATA\n@home,1\n% note\n'a, ''?',2\n?,3\n@data,4\n")
    rows = [(r[0], r[1]) for r in read_arff(spark, str(f)).collect()]
    assert ("@home", "1") in rows and ("@data", "4") in rows and (None, "3") in rows and len(rows) == 4


def test_arff_roundtrip_quotes(spark, tmp_path):
    rows = [(1.5, "a, b"), (2.0, "it's"), (None, "%x"), (3.0, None), (4.0, "back\\slash"), (5.0, "@data")]
    df = spark.createDataFrame(rows, "n double, s string")
    write_arff(df, str(tmp_path / "out"), "r", ["n"], ["s"])
    got = read_arff(spark, str(tmp_path / "out")).select(F.col("n").cast("double"), "s").collect()
    assert sorted((r.n or 0, str(r.s)) for r in got) == sorted((n or 0, str(s)) for n, s in rows)


def test_whitespace_header_only_at_the_top(spark, tmp_path):
    (tmp_path / "a.txt").write_text("id name\n1 x\nid name\n")
    (tmp_path / "b.txt").write_text("id name\n2 y\n")
    rows = sorted((r["id"], r["name"]) for r in read_whitespace(spark, str(tmp_path)).collect())
    assert rows == [("1", "x"), ("2", "y"), ("id", "name")]


def test_pad_digits(spark):
    got = spark.createDataFrame([(7,), (1234567,)], "n long").select(pad_digits(F.col("n"), 6).alias("p")).collect()
    assert [r.p for r in got] == ["000007", "1234567"]
