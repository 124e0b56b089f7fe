from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from airlake.functions.formats import bucket_number, format_bytes, label_with_value
from airlake.functions.geo import haversine_km
from airlake.functions.text import clean_text, words
from airlake.sinks.delimited import write_quoted_csv
from airlake.sinks.wordcount import write_wordcount
from airlake.sources.catalog import describe_table, external_table, register_view
from airlake.sources.delimited import COMPANIES, ROUTES, read_headerless_csv, read_quoted_csv, strings
from airlake.operators.wordcount import order_of_files
from airlake.sources.text import read_part_files, words_of_parts
from airlake.sources.xml import decode_bytes, encode_text, flat_records, read_xml_records, record_schema


def test_quoted_csv_dialect(spark, tmp_path):
    (tmp_path / "UO.csv").write_text(
        '"name","edrpou","address","boss","founders","kved","stan"\n'
        '"a ""b"", c","00223941","","x","p | q","1","s"\n',
        encoding="utf-8",
    )
    assert [tuple(r) for r in read_quoted_csv(spark, str(tmp_path), COMPANIES).collect()] == [
        ('a "b", c', "00223941", "", "x", "p | q", "1", "s")
    ]


def test_quoted_csv_round_trip(spark, rows, tmp_path):
    data = [('say "hi", you', "", " padded "), ("кирилиця", None, "007"), ("\\N", "\\", "NULL")]
    path = str(tmp_path / "out")
    write_quoted_csv(rows(data, "a STRING, b STRING, c STRING").coalesce(1), path)
    written = next(Path(path).glob("*.csv")).read_bytes().decode("utf-8")
    assert written == '"a","b","c"\n"say ""hi"", you",""," padded "\n"кирилиця","","007"\n"\\N","\\","NULL"\n'
    read = read_quoted_csv(spark, path, strings("a", "b", "c"))
    assert pytest.tuples(read) == sorted((a, b or "", c) for a, b, c in data)


@pytest.mark.parametrize("value", ["a\nb", "a\rb"])
def test_line_breaks_are_refused(rows, tmp_path, value):
    with pytest.raises(Exception, match="line break in column a"):
        write_quoted_csv(rows([(value,)], "a STRING"), str(tmp_path / "out"))


@pytest.mark.parametrize("charset", ["gbk", "shift_jis", "utf-16", "cp500"])
def test_other_charsets_are_refused(charset):
    with pytest.raises(ValueError, match="one byte per character"):
        decode_bytes(F.col("x"), charset)


@pytest.mark.parametrize("charset", ["windows-1251", "koi8-r", "iso-8859-5", "utf-8"])
def test_charsets_round_trip(rows, tmp_path, charset):
    text = "Привіт «x»" if charset in ("windows-1251", "utf-8") else "Привет x"
    frame = rows([(text,)], "t STRING").select(encode_text(F.col("t"), charset).alias("t"))
    frame.coalesce(1).write.text(str(tmp_path / "out"))
    assert next((tmp_path / "out").glob("*.txt")).read_bytes().decode(charset) == text + "\n"
    back = frame.sparkSession.read.text(str(tmp_path / "out")).select(decode_bytes(F.col("value"), charset))
    assert back.first()[0] == text


def test_headerless_csv_nulls(spark, tmp_path):
    (tmp_path / "routes.dat").write_text('2B,410,AER,2965,KZN,2990,,0,CR2\nXX,\\N,A,\\N,"B, C",7,Y,0,\\N\n')
    read = read_headerless_csv(spark, str(tmp_path / "routes.dat"), ROUTES)
    found = {r.airline: r for r in read.collect()}
    assert (found["2B"].airline_id, found["2B"].src_id) == (410, 2965)
    assert (found["XX"].airline_id, found["XX"].src_id, found["XX"].dst, found["XX"].equipment) == (
        None, None, "B, C", None,
    )


XML = """<?xml version="1.0" encoding="windows-1251"?>
<DATA FORMAT_VERSION="1.0">
<RECORD><NAME>ТОВ "Їжак"  \\ два</NAME><EDRPOU>00223941</EDRPOU><ADDRESS/><FOUNDERS><FOUNDER>Іван
 П</FOUNDER><FOUNDER>Петро &amp; Ко</FOUNDER><FOUNDER>\\</FOUNDER></FOUNDERS><STAN>зареєстровано</STAN></RECORD>
<RECORD><NAME> B
   x </NAME><EDRPOU>1</EDRPOU><FOUNDERS><FOUNDER>solo</FOUNDER></FOUNDERS></RECORD>
<RECORD>
<NAME>C</NAME><FOUNDERS></FOUNDERS><STAN></STAN></RECORD>
</DATA>
"""


@pytest.mark.parametrize("piece", [None, 64])
def test_xml_records(spark, tmp_path, piece):
    """The same rows however many splits the file is cut into."""
    (tmp_path / "r.xml").write_bytes(XML.encode("windows-1251"))
    if piece:
        spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        tags = ["NAME", "EDRPOU", "ADDRESS", "FOUNDERS", "STAN"]
        lists = {"FOUNDERS": "FOUNDER"}
        records = read_xml_records(spark, str(tmp_path / "r.xml"), record_schema(tags, lists))
        if piece:
            assert records.rdd.getNumPartitions() > 4
        flat = flat_records(records, {t.lower(): t for t in tags}, lists)
        assert pytest.tuples(flat) == [
            ("B x", "1", "", "solo", ""),
            ("C", "", "", "", ""),
            ('ТОВ "Їжак" / два', "00223941", "", "Іван П | Петро & Ко | /", "зареєстровано"),
        ]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_clean_text_folds_what_python_folds(rows):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    data = [(f"a{s}{s}\\b{s}",) for s in spaces] + [("x​y",), ("",)]
    cleaned = rows(data, "t STRING").select("t", clean_text(F.col("t")).alias("c")).collect()
    for row in cleaned:
        assert row.c == " ".join(row.t.replace("\\", "/").split())


def test_words_keep_punctuation(rows):
    df = rows([(" 10.0.0.1:50 \t blk_-1,\r\n\fA a b ",)], "t STRING").select(words(F.col("t")).alias("w"))
    assert df.first().w == ["10.0.0.1:50", "blk_-1,", "A", "a b"]


@pytest.mark.parametrize("parts", [1, 2, 4])
def test_part_files(spark, rows, tmp_path, parts):
    counts = rows([(f"w{i}", i) for i in range(200)] + [("é", 7), ("Z", 1)], "word STRING, count BIGINT")
    path = str(tmp_path / "out")
    write_wordcount(counts, path, parts)
    assert (tmp_path / "out" / "_SUCCESS").exists()
    read = read_part_files(spark, path)
    assert pytest.tuples(read.select("word", "count")) == pytest.tuples(counts)
    assert read.select("part").distinct().count() == parts
    for part in range(parts):
        files = sorted((tmp_path / "out" / f"part={part}").glob("*.txt"))
        lines = [line for f in files for line in f.read_text("utf-8").splitlines()]
        in_order = [line.rsplit("\t", 1)[0].encode() for line in lines]
        assert in_order == sorted(in_order)


def test_order_of_files(spark, tmp_path):
    words = [f"w{i:03}" for i in range(200)]
    for name, lines in {"good": [words[:120], words[120:]], "reversed": [words[::-1]], "torn": [words[100:], words[:100]]}.items():
        folder = tmp_path / name / "part=0"
        folder.mkdir(parents=True)
        for i, own in enumerate(lines):
            (folder / f"part-{i}.txt").write_text("".join(f"{w}\t1\n" for w in own))
    broken = {}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 400)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        for name in ("good", "reversed", "torn"):
            row = order_of_files(words_of_parts(spark, str(tmp_path / name))).first()
            assert row.words == 200
            broken[name] = row.out_of_order
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert broken == {"good": 0, "reversed": 199, "torn": 1}


def test_flat_part_files_split_on_the_last_tab(spark, tmp_path):
    (tmp_path / "part-r-00000").write_text("a\tb\t3\nc\t1\n")
    read = read_part_files(spark, str(tmp_path), part_is_folder=False)
    assert pytest.tuples(read) == [("part-r-00000", "a\tb", 3), ("part-r-00000", "c", 1)]


def test_external_table_keeps_its_files(spark, rows, tmp_path):
    path = str(tmp_path / "uo")
    write_quoted_csv(rows([("n", "1")], "name STRING, edrpou STRING"), path)
    external_table(spark, "uo_external", path, strings("name", "edrpou"), header="true")
    facts = {r.col_name: r.data_type for r in describe_table(spark, "uo_external").collect()}
    assert facts["Type"] == "EXTERNAL" and facts["Provider"] == "csv"
    assert spark.table("uo_external").count() == 1
    spark.sql("DROP TABLE uo_external")
    assert list(Path(path).glob("*.csv"))


def test_register_view(rows, spark):
    assert register_view(rows([(1,)], "x INT"), "one_row").count() == 1
    assert spark.sql("SELECT x FROM one_row").first().x == 1


def test_formats(rows):
    sizes = {0: "0 B", 1023: "1023 B", 1024: "1.0 KB", 1280: "1.2 KB", 5 * 1024**2: "5.0 MB", 3 * 1024**4: "3072.0 GB"}
    df = rows([(n,) for n in sizes], "n BIGINT").select("n", format_bytes(F.col("n")).alias("s"))
    assert {r.n: r.s for r in df.collect()} == sizes
    row = rows([("ATL", 15.94)], "c STRING, v DOUBLE").select(label_with_value(F.col("c"), F.col("v"))).first()
    assert row[0] == "ATL (15.9)"
    row = rows([("part-00000-ab_00005.c000.snappy.parquet",)], "f STRING").select(bucket_number(F.col("f"))).first()
    assert row[0] == 6


def test_haversine(rows):
    data = [(0.0, 0.0, 0.0, 180.0), (52.55, 13.28, 52.55, 13.28), (50.03, 8.57, 51.47, -0.45)]
    df = rows(data, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    got = [r[0] for r in df.select(haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()]
    assert got[0] == pytest.approx(20015.0868, abs=1e-3)
    assert got[1] == 0.0
    assert got[2] == pytest.approx(655, abs=2)


def test_closing_tags_that_are_text(spark, tmp_path):
    from xml.sax.saxutils import escape

    draw = random.Random(4)
    texts = ["plain", "a </R> b", "</R></R>", "<R>", "x ]]", "<!-- not one", "-- > -->", "]] > ", "long " * 200 + "</R>" + "end " * 200]
    names, parts = [], ["<?xml version='1.0'?>\n<D><!-- <R><A>never</A></R> -->\n"]
    for i in range(300):
        name = f"{i} " + draw.choice(texts)
        hidden = "".join(draw.choice(["<!-- </R> <R><A>no</A></R> -->", "<!-- <![CDATA[ -->", ""]) for _ in range(2))
        value = escape(name) if draw.random() < 0.3 else f"<![CDATA[{name}]]>"
        names.append(name.strip())
        parts.append(f"{hidden}<R>{hidden}<A>{value}</A></R>\n")
    path = tmp_path / "r.xml"
    path.write_text("".join(parts) + "<!-- </R> --></D>\n", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("1500", before):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = read_xml_records(spark, str(path), record_schema(["A"]), "R", "utf-8")
            got = sorted(r.A for r in found.collect())
            assert spark.read.text(str(path)).rdd.getNumPartitions() > 20 or size == before
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert [" ".join(g.split()) for g in got] == [" ".join(n.split()) for n in sorted(names)]


def test_undecoded_bytes_pass_through_sections(spark, tmp_path):
    path = tmp_path / "r.xml"
    path.write_bytes("<D><RECORD><NAME><![CDATA[Фірма </RECORD> «Я»]]></NAME></RECORD><RECORD><NAME>Інша</NAME></RECORD></D>".encode("windows-1251"))
    found = read_xml_records(spark, str(path), record_schema(["NAME"]))
    assert sorted(r.NAME for r in found.collect()) == ["Інша", "Фірма </RECORD> «Я»"]
