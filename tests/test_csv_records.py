"""Split CSV files: the same records, numbers and types at any split size."""

import csv
import io
import os
import random
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelyze.sources import csv_records as C
from parcelyze.sources import ingest as I

NASTY = ['plain', '', 'a,b', 'say "x"', 'two\nlines', '"', '""', 'ends with\n', '\nbegins', 'x\r\ny', ',', '\n', 'é日🙂', ' pad ',
         'a "b", c\n"d"', '\n\n\n', '","', 'NA']


def write(path, rows, header=("k", "text", "n"), newline="\n", bom=False):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=newline)
    w.writerow(header)
    w.writerows(rows)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(("﻿" if bom else "") + out.getvalue())


@pytest.fixture
def split(spark):
    """Read with splits of a given size."""
    def run(size, fn):
        names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
        old = {n: spark.conf.get(n, None) for n in names}
        try:
            for n, v in zip(names, (str(size), "1", "1")):
                spark.conf.set(n, v)
            return fn()
        finally:
            for n, v in old.items():
                spark.conf.set(n, v) if v is not None else spark.conf.unset(n)
    return run


@pytest.mark.parametrize("size", [1 << 20, 4096, 400, 61])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_records_over_many_splits(spark, split, size, newline):
    rng = random.Random(size)
    rows = [(str(i), rng.choice(NASTY) + rng.choice(NASTY), str(rng.random())) for i in range(120)]
    d = tempfile.mkdtemp(prefix="pz-csv-")
    write(f"{d}/a.csv", rows, newline=newline, bom=True)
    df = split(size, lambda: C.read_text_table(spark, f"{d}/a.csv", "_seq"))
    got = [tuple(r) for r in df.orderBy("_seq").collect()]
    assert df.columns == ["k", "text", "n", "_seq"]
    assert [(k, t or "", n) for k, t, n, _ in got] == rows
    if size < 1000:
        lines = split(size, lambda: C.read_lines(spark, f"{d}/a.csv"))
        assert lines.select("_start").distinct().count() > 5


def test_numbers_do_not_depend_on_splits_or_files(spark, split):
    d = tempfile.mkdtemp(prefix="pz-csv-")
    rows = [(str(i), f"line {i}\nnext", "1") for i in range(90)]
    for j in range(3):
        write(f"{d}/part-{j}.csv", rows[j * 30:(j + 1) * 30])
    seen = []
    for size in (1 << 20, 300, 97):
        got = split(size, lambda: C.read_text_table(spark, d, "_seq").orderBy("_seq").collect())
        assert [r.k for r in got] == [r[0] for r in rows]                   # file order over all files
        seen.append([r["_seq"] for r in got])
    assert seen[0] == seen[1] == seen[2] == sorted(set(seen[0]))


def test_same_as_one_task_multi_line_mode(spark, split):
    d = tempfile.mkdtemp(prefix="pz-csv-")
    rng = random.Random(4)
    write(f"{d}/a.csv", [(str(i), rng.choice(NASTY), rng.choice(NASTY)) for i in range(200)])
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("emptyValue", "").csv(f"{d}/a.csv")
    mine = split(500, lambda: C.read_text_table(spark, f"{d}/a.csv"))
    blank = [F.coalesce(c, F.lit("")).alias(c) for c in whole.columns]
    assert mine.select(*blank).exceptAll(whole.select(*blank)).count() == 0 and mine.count() == whole.count() == 200


def test_quotes_inside_bare_fields_open_nothing(spark, split):
    d = tempfile.mkdtemp(prefix="pz-csv-")
    text = 'k,text,n\n1,5" pipe,2\n2,"a\nb",3\n3,6" and 7" pipe,4\n4,"x ""y""\nz",5\n'
    open(f"{d}/a.csv", "w").write(text)
    for size in (1 << 20, 20):
        got = split(size, lambda: C.read_text_table(spark, f"{d}/a.csv", "_seq").orderBy("_seq").collect())
        assert [(r.k, r.text, r.n) for r in got] == [("1", '5" pipe', "2"), ("2", "a\nb", "3"), ("3", '6" and 7" pipe', "4"),
                                                     ("4", 'x "y"\nz', "5")]


def test_unclosed_field_and_other_headers_are_errors(spark):
    d = tempfile.mkdtemp(prefix="pz-csv-")
    open(f"{d}/a.csv", "w").write('k,text\n1,"never closed\n2,b\n')
    with pytest.raises(ValueError, match="not closed"):
        C.read_text_table(spark, f"{d}/a.csv")
    two = tempfile.mkdtemp(prefix="pz-csv-")
    write(f"{two}/a.csv", [], header=("k", "a"))
    write(f"{two}/b.csv", [], header=("k", "b"))
    with pytest.raises(ValueError, match="different headers"):
        C.read_text_table(spark, two)
    one = tempfile.mkdtemp(prefix="pz-csv-")
    write(f"{one}/a.csv", [])
    assert C.read_text_table(spark, f"{one}/a.csv", "_seq").count() == 0


COLUMNS = {
    "ints": ["1", "-2", "+3", " 4 "], "int_na": ["1", "", "3", "NA"], "floats": ["1.5", "2", "-3e5", ".5"],
    "points": ["1.", "2.", "3.", "4."], "dates": ["2020-01-01", "2020-01-02", "2020-01-03", "2020-01-04"],
    "mixed": ["1", "x", "2.5", ""], "truth": ["True", "false", "TRUE", "False"], "truth_na": ["True", "", "False", "True"],
    "none": ["", "NA", "nan", "null"], "big": ["9223372036854775808", "1", "2", "18446744073709551615"],
    "neg_big": ["9223372036854775807", "-9223372036854775808", "0", "1"], "inf": ["inf", "-inf", "1", "2"],
    "words": ["yes", "no", "0", "1"], "truth_int": ["True", "1", "0", "False"], "under": ["1_000", "2", "3", "4"],
    "hexa": ["0x1A", "1", "2", "3"], "codes": ["007", "01", "1", "0"],
}


def test_types_beyond_the_contract_are_those_of_pandas(spark):
    text = spark.createDataFrame([tuple(v[i] for v in COLUMNS.values()) for i in range(4)], ", ".join(f"{c} string" for c in COLUMNS))
    text = text.withColumn("NULLs", F.lit(None).cast("string"))
    got = I.infer_types(text, list(COLUMNS))
    df = pd.DataFrame(COLUMNS)
    read = pd.read_csv(io.StringIO(df.to_csv(index=False)))
    names = {"int64": "bigint", "uint64": "decimal(20,0)", "float64": "double", "bool": "boolean", "object": "string", "str": "string"}
    assert got == {c: names[str(t)] for c, t in read.dtypes.items()}
    typed = text.select(*[I._as(I._value(F.col(c)), got[c]).alias(c) for c in COLUMNS]).toPandas()
    for c in COLUMNS:
        a, b = typed[c], read[c]
        assert (a.isna() == b.isna()).all(), c
        if got[c] != "string":
            assert [float(x) for x in a.dropna()] == [float(x) for x in b.dropna()], c
        else:
            assert [str(x) for x in a.dropna()] == [str(x) for x in b.dropna()], c
    assert I.infer_types(text.limit(0), ["ints"]) == {"ints": "string"} and I.infer_types(text, []) == {}


def test_types_add_up_over_partitions_in_any_order(spark):
    rows = [(str(i), "x" if i == 977 else str(i), f"{i}.5" if i % 2 else str(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    for n in (1, 7, 40):
        assert I.infer_types(df.repartition(n), ["a", "b", "c"]) == {"a": "bigint", "b": "string", "c": "double"}


def test_ingest_types_extra_columns(spark):
    from .test_ingest_pipeline import _write_csvs
    src, out = tempfile.mkdtemp(prefix="pz-csv-"), tempfile.mkdtemp(prefix="pz-raw-")
    _write_csvs(src, "")
    with open(os.path.join(src, I.CSV_FILES["raw_customers"]), "w") as f:
        f.write("customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state,visits,spent,since,vip,note\n"
                "c1,u1,01037,sao paulo,SP,3,1.5,2020-01-01,True,\"a\nb\"\nc2,u2,NA,rio,RJ,4,,2020-01-02,False,NA\n")
    I.ingest_csv(spark, src, out)
    got = I.read_raw_layer(spark, out)["raw_customers"]
    assert dict(got.dtypes)["visits"] == "bigint" and dict(got.dtypes)["spent"] == "double"
    assert dict(got.dtypes)["since"] == "string" and dict(got.dtypes)["vip"] == "boolean"
    rows = {r.customer_id: r for r in got.collect()}
    assert (rows["c1"].visits, rows["c1"].vip, rows["c1"].note, rows["c2"].note, rows["c2"].spent) == (3, True, "a\nb", None, None)
    assert rows["c1"].customer_zip_code_prefix == 1037 and rows["c2"].customer_zip_code_prefix is None
