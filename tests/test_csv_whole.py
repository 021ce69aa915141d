"""Rows of a wrong length are refused whatever columns are kept; the cut of a file does not depend on the files beside it."""

import pytest

from bazaarframe.sources.csv_source import scan_csv

NAMES = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]


@pytest.mark.parametrize("row", ["3,x", "3,x,y,z,surplus"])
def test_rows_of_a_wrong_length_fail_where_columns_are_dropped(spark, tmp_path, row):
    path = tmp_path / "a.csv"
    path.write_text(f"a,b,c,d\n1,x,y,z\n{row}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_csv(spark, str(path)).frame().select("a").collect()
    path.write_text("a,b,c,d\n1,x,y,z\n3,x,,\n")
    assert sorted(r["a"] for r in scan_csv(spark, str(path)).frame().select("a").collect()) == ["1", "3"]


def test_a_plain_part_beside_one_with_line_breaks(spark, tmp_path):
    before = {n: spark.conf.get(n, None) for n in NAMES}
    for name, value in zip(NAMES, ("100000", "1", "4")):
        spark.conf.set(name, value)
    try:
        parts = tmp_path / "a.csv"
        parts.mkdir()
        (parts / "part-1.csv").write_text("a,b\n" + "".join(f"p{i},plain\n" for i in range(20_000)))
        (parts / "part-2.csv").write_text("a,b\n" + "".join(f'j{i},"line\nbreak"\n' for i in range(1_000)))
        scan = scan_csv(spark, str(parts))
        assert scan.count() == 21_000
        assert sum(r["b"] == "line\nbreak" for r in scan.frame().collect()) == 1_000
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
