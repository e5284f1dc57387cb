"""Raw CSV scan (fixed schema, quoting, padding, optional null tokens) and SQL views."""

from __future__ import annotations

import pytest

from marquee.plans import analyses as A
from marquee.operators.clean import clean_titles
from marquee.sources.raw import PANDAS_NULL_TOKENS, MissingColumnError, read_raw_csv

CSV = '''show_id,type,title,director,cast,country,date_added,release_year,rating,duration,listed_in,description
s1,Movie,"A, quoted ""title""",D1,"A1, A2","United States, France"," September 25, 2021 ",2020,PG-13,90 min,"Dramas, Comedies","multi
line"
s2,TV Show,None,,NA,,"January 1, 2020",2019,74 min,,International TV Shows,
'''


def test_read_raw_csv_fixed_schema(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text(CSV)
    df = read_raw_csv(spark, f"file://{p}")
    rows = {r.show_id: r for r in df.collect()}
    assert rows["s1"].title == 'A, quoted "title"'
    assert rows["s1"].date_added == " September 25, 2021 "
    assert rows["s1"].description == "multi\nline"
    assert rows["s1"].release_year == 2020
    assert rows["s2"].title == "None" and rows["s2"].cast == "NA" and rows["s2"].director is None
    t, g = clean_titles(df)
    got = {r.show_id: r for r in t.collect()}
    assert got["s2"].rating == "Not Rated" and got["s2"].duration_seasons == 74.0
    assert got["s1"].date_added.isoformat() == "2021-09-25"
    # pandas-style null tokens on request
    df2 = read_raw_csv(spark, f"file://{p}", null_tokens=PANDAS_NULL_TOKENS)
    r2 = {r.show_id: r for r in df2.collect()}["s2"]
    assert r2.title is None and r2.cast is None


def test_register_catalog_for_sql(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text(CSV)
    t, g = clean_titles(read_raw_csv(spark, f"file://{p}"))
    A.register_catalog(t, g)
    n = spark.sql("SELECT count(*) AS n FROM titles t JOIN genres g ON t.show_id = g.show_id").collect()[0].n
    assert n == 3


def test_read_raw_csv_keeps_unparseable_rows(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text(CSV.replace(',2019,74 min,', ',20x9,74 min,'))
    df = read_raw_csv(spark, f"file://{p}", corrupt_col="_corrupt")
    rows = {r.show_id: r for r in df.collect()}
    assert rows["s2"].release_year is None and "20x9" in rows["s2"]["_corrupt"]
    assert rows["s1"]["_corrupt"] is None


def test_columns_are_bound_by_name(spark, tmp_path):
    p = tmp_path / "raw.csv"
    lines = CSV.split("\n")
    p.write_text("\n".join([lines[0].replace("type,title", "title,type"), *lines[1:]]))
    rows = {r.show_id: r for r in read_raw_csv(spark, f"file://{p}").collect()}
    assert rows["s1"].title == "Movie" and rows["s1"].type == 'A, quoted "title"'
    p.write_text(CSV.replace("listed_in", "genres"))
    with pytest.raises(MissingColumnError, match="listed_in"):
        read_raw_csv(spark, f"file://{p}")


def test_files_must_agree_on_their_header(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text(CSV)
    (tmp_path / "d" / "b.csv").write_text(CSV.replace("type,title", "title,type"))
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, f"file://{tmp_path}/d").collect()


def test_split_reading_fails_on_a_broken_record(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text(CSV)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw_csv(spark, f"file://{p}", multi_line=False).collect()
    p.write_text(CSV.replace("multi\nline", "one line"))
    assert read_raw_csv(spark, f"file://{p}", multi_line=False).count() == 2


def messy_csv(n, newline="\n"):
    """Quoted line breaks, doubled quotes, separators, blank lines and empty fields."""
    import random
    rng = random.Random(n)
    texts = ["plain", "two\nlines", 'say ""yes""', "a, b", '""', "\n\n\nfar", '"",\n""', "é 漢", ""]
    out = [CSV.split("\n")[0]]
    for i in range(n):
        t = [f'"{rng.choice(texts)}"' for _ in range(3)]
        out.append(f's{i},Movie,{t[0]},{t[1]},,"France","March {i % 28 + 1}, 2020",20{i % 20:02d},PG,{i} min,{t[2]},')
        if i % 50 == 7:
            out.append("")
    return newline.join("\n".join(out).split("\n")) + newline


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("block", [200, 1000, 50_000])
def test_split_reading_equals_whole_file_reading(spark, tmp_path, newline, block):
    from collections import Counter
    for i, n in enumerate((400, 3)):
        (tmp_path / f"{i}.csv").write_bytes(messy_csv(n, newline).encode())
    path = f"file://{tmp_path}"
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(x) for x in names]
    whole = Counter(tuple(r) for r in read_raw_csv(spark, path).collect())
    try:
        for x in names:
            spark.conf.set(x, str(block))
        df = read_raw_csv(spark, path, split=True)
        from marquee.sources.records import text_lines
        assert text_lines(spark.read, path).rdd.getNumPartitions() >= (messy_csv(400).encode().__len__() // block)
        assert Counter(tuple(r) for r in df.collect()) == whole
    finally:
        for x, v in zip(names, old, strict=True):
            spark.conf.set(x, v)
    assert sum(whole.values()) == 403


@pytest.mark.parametrize("block", [300, 50_000])
def test_split_reading_does_not_shuffle_the_lines(spark, tmp_path, block):
    from collections import Counter
    (tmp_path / "0.csv").write_bytes(messy_csv(400).encode())
    path = f"file://{tmp_path}"
    whole = Counter(tuple(r) for r in read_raw_csv(spark, path).collect())
    conf = {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": str(block),
            "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}       # the state goes over batches too
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = read_raw_csv(spark, path, split=True)
        assert Counter(tuple(r) for r in df.collect()) == whole
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    if block < 1000:
        return
    moved, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
        elif "QueryStage" in name:
            todo.append(p.plan())
        else:
            if name == "Exchange":
                moved += p.metrics().apply("shuffleRecordsWritten").value()
            todo += [p.children().apply(i) for i in range(p.children().size())]
    assert moved < 40                                   # parts and pieces, not 400 records


def test_the_cutting_travels_without_the_package(tmp_path):
    import subprocess
    import sys
    from pyspark import cloudpickle
    from marquee.sources.records import _cut_parts
    code = "import pickle, sys; f = pickle.load(sys.stdin.buffer); assert list(f(iter(()))) == [] and 'marquee' not in sys.modules"
    subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(_cut_parts), cwd=tmp_path, check=True)


def test_split_reading_reports_what_it_cannot_read(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text(CSV.replace(',2019,74 min,', ',20x9,74 min,'))
    rows = {r.show_id: r for r in read_raw_csv(spark, f"file://{p}", split=True, corrupt_col="_corrupt").collect()}
    assert rows["s2"].release_year is None and "20x9" in rows["s2"]["_corrupt"] and rows["s1"]["_corrupt"] is None
    assert rows["s1"].description == "multi\nline"
    p.write_text(CSV + 's3,"open\n')
    with pytest.raises(Exception, match="isn't closed"):
        read_raw_csv(spark, f"file://{p}", split=True).collect()
    p.write_text(CSV)
    (tmp_path / "other.csv").write_text(CSV.replace("type,title", "title,type"))
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, f"file://{tmp_path}", split=True).collect()
    p.write_text("")
    with pytest.raises(MissingColumnError):
        read_raw_csv(spark, f"file://{p}", split=True)
