"""Good rows and rejected lines out of one parse."""

import pytest
from pyspark.sql import types as T

from pulseframe.sources.quarantine import WRONG_NUMBER, read_with_quarantine

SCHEMA = T.StructType([
    T.StructField("day", T.DateType()), T.StructField("unit/price", T.DoubleType()), T.StructField("name", T.StringType()),
])
TEXT = (
    "day,unit/price,name\n2022-01-01,1.5,pen\n2022-02-30,2.0,box\nsoon,dear,cup\n2022-01-03,,\n2022-01-04,3.0\n"
    '2022-01-05,4.0,a,b\n2022-01-06,x,"says ""hi"", twice"\n'
)


@pytest.mark.parametrize("multi_line", [True, False])
def test_every_line_is_good_or_rejected(spark, tmp_path, multi_line):
    source = tmp_path / "in.csv"
    source.write_text(TEXT)
    found = read_with_quarantine(spark, str(source), SCHEMA, multi_line=multi_line)
    assert found.rows == 7 and found.rejected_rows == 5
    assert found.good.columns == ["day", "unit/price", "name"]
    assert sorted((str(r[0]), r[1], r[2]) for r in found.good.collect()) == [("2022-01-01", 1.5, "pen"), ("2022-01-03", None, None)]
    rejected = {r["line"].strip(): r["causes"] for r in found.rejected.collect()}
    assert rejected == {
        "2022-02-30,2.0,box": ["day"], "soon,dear,cup": ["day", "unit/price"], "2022-01-04,3.0": [WRONG_NUMBER],
        "2022-01-05,4.0,a,b": [WRONG_NUMBER], '2022-01-06,x,"says ""hi"", twice"': ["unit/price"],
    }


def test_a_clean_and_an_empty_file(spark, tmp_path):
    clean, empty = tmp_path / "clean.csv", tmp_path / "empty.csv"
    clean.write_text("day,unit/price,name\n2022-01-01,1.5,pen\n")
    empty.write_text("day,unit/price,name\n")
    for source, rows in ((clean, 1), (empty, 0)):
        found = read_with_quarantine(spark, str(source), SCHEMA)
        assert (found.good.count(), found.rejected.count(), found.rows, found.rejected_rows) == (rows, 0, rows, 0)
