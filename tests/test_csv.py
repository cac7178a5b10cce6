"""CSV source and sink: blanks survive, tokens become NULL, file order holds."""

from martforge.operators.dedup import keep_first
from martforge.session import new_work_dir
from martforge.sources.csv import read_csv, write_csv
from pyspark.sql import types as T


def test_csv_roundtrip_keeps_blanks_and_file_order(spark):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("city", T.StringType()),
                           T.StructField("zip", T.LongType())])
    rows = [("a", "  d'oeste ", 1234), ("b", "NA", 5), ("a", "later copy", 9), ("c", None, None),
            ("d", "x, y", 7)]
    path = new_work_dir(spark, "test-csv") + "/t"
    write_csv(spark.createDataFrame(rows, schema).coalesce(1), path)
    back = read_csv(spark, path, schema)
    got = {r.k: (r.city, r.zip) for r in keep_first(back, ["k"]).collect()}
    assert got == {"a": ("  d'oeste ", 1234), "b": (None, 5), "c": (None, None), "d": ("x, y", 7)}


def test_pipeline_from_csv_files(spark):
    """The raw fixture tables written as CSV and run through the pipeline from
    the CSV source give the same load as the Parquet path (the 'NA' state
    codes become missing, which does not change any count)."""
    from martforge.plans.context import Layers
    from martforge.plans.jobs import run
    from martforge.sources.csv import read_raw_tables
    from tests.conftest import SF_SMALL
    raw = Layers(spark, SF_SMALL).raw
    root = new_work_dir(spark, "test-csv-run")
    for name in ["customers", "orders", "products", "order_items"]:
        write_csv(raw[name].orderBy("_ord", *raw[name].columns[:2]).drop("_ord"), f"{root}/{name}.csv")
    summary = {(r.step, r.table_name): r.n_rows
               for r in run(spark, raw_tables=read_raw_tables(spark, root)).collect()}
    assert summary[("star", "fact_orders")] == 4405
    assert summary[("reject", "fact_rejects")] == 142
    assert summary[("audit", "all_checks")] == 0


def items_schema():
    return T.StructType([T.StructField("k", T.StringType()), T.StructField("price", T.DoubleType()),
                         T.StructField("zip", T.LongType())])


def write_text(spark, text):
    path = new_work_dir(spark, "test-csv")
    import os
    os.makedirs(path.removeprefix("file://"))
    with open(path.removeprefix("file://") + "/t.csv", "w") as f:
        f.write(text)
    return path + "/t.csv"


def test_tokens_in_numbers_and_columns_by_name(spark):
    path = write_text(spark, "zip,price,k,other\nNA,1.5,a,x\n7,nan,b,y\n,NULL,c,z\n")
    rows = sorted((r.k, r.price, r.zip) for r in read_csv(spark, path, items_schema()).collect())
    assert rows == [("a", 1.5, None), ("b", None, 7), ("c", None, None)]


def test_a_wrong_number_is_an_error(spark):
    import pytest
    path = write_text(spark, "k,price,zip\na,abc,1\n")
    with pytest.raises(Exception, match="column price"):
        read_csv(spark, path, items_schema()).collect()


def test_line_breaks_inside_quotes(spark):
    path = write_text(spark, 'k,price,zip\n"a\nb",1,2\nc,3,4\n')
    rows = sorted((r.k, r.price, r.zip) for r in read_csv(spark, path, items_schema(), multi_line=True).collect())
    assert rows == [("a\nb", 1.0, 2), ("c", 3.0, 4)]


def test_purge_removes_old_intermediates_only(spark):
    from martforge.session import materialize, purge_work_dirs
    kept = new_work_dir(spark, "run") + "/table"
    spark.range(3).write.parquet(kept)
    assert purge_work_dirs(spark, older_than_hours=10_000) == 0
    path = materialize(spark.range(2), "test-purge").inputFiles()[0]
    import os
    assert purge_work_dirs(spark, older_than_hours=-1) > 0
    assert not os.path.exists(path.removeprefix("file://"))
    assert spark.read.parquet(kept).count() == 3


def test_a_cluster_needs_a_shared_folder():
    import pytest

    from martforge.session import checkpoint_root

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_short_rows_are_filled_and_long_rows_refused(spark):
    import pytest

    from martforge.sources.csv import malformed_rows
    short = write_text(spark, 'k,price,zip\na,1\nb\n"c,d",2,3\n\ne,4,5\n"x,""y",6\n')
    rows = [tuple(r) for r in read_csv(spark, short, items_schema()).select("k", "price", "zip").collect()]
    assert rows == [("a", 1.0, None), ("b", None, None), ("c,d", 2.0, 3), ("e", 4.0, 5), ('x,"y', 6.0, None)]
    # Also where only a leading column is asked for.
    assert [r.k for r in read_csv(spark, short, T.StructType(items_schema().fields[:1])).collect()] == ["a", "b", "c,d", "e", 'x,"y']
    long = write_text(spark, 'k,price,zip\na,1,2\nb,3,4,5\n"c,d",6\n"e,f",7,8,9,"0,0"\n')
    with pytest.raises(Exception, match="more than the 3 fields of the header: b,3,4,5"):
        read_csv(spark, long, items_schema()).collect()
    kept = read_csv(spark, long, items_schema(), long_rows="skip")
    assert sorted((r.k, r.zip) for r in kept.collect()) == [("a", 2), ("c,d", None)]
    bad = sorted((r.n_fields, r.expected_fields, r.line) for r in malformed_rows(spark, long).collect())
    assert kept.count() == 2 and read_csv(spark, short, items_schema()).count() == 5
    assert bad == [(2, 3, '"c,d",6'), (4, 3, "b,3,4,5"), (5, 3, '"e,f",7,8,9,"0,0"')]


def test_short_rows_are_those_of_pandas(spark):
    import io

    import pandas as pd
    text = "k,price,zip\na,1.5\nb\nc,2,3\n"
    want = pd.read_csv(io.StringIO(text))
    got = read_csv(spark, write_text(spark, text), items_schema())
    assert [(r.k, r.price, r.zip) for r in got.collect()] == \
        [(k, None if p != p else p, None if z != z else int(z)) for k, p, z in want.itertuples(index=False)]


def test_integral_decimals_are_integers(spark):
    import pytest
    path = write_text(spark, "k,price,zip\na,1,1234.0\nb,1,9007199254740993.000\nc,1,1e3\nd,1,-7\n")
    assert [r.zip for r in read_csv(spark, path, items_schema()).collect()] == [1234, 9007199254740993, 1000, -7]
    for wrong in ("1234.5", "1e30", "12x"):
        with pytest.raises(Exception, match="column zip: not a bigint"):
            read_csv(spark, write_text(spark, f"k,price,zip\na,1,{wrong}\n"), items_schema()).collect()
