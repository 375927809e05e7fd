import duckdb
import pandas as pd

from filings_audit.llm import linededup


def both(spark, rows, share, pages):
    """The operator's rows and those of its SQL."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, line string, lines string, host string, total int"
    rows = [(i, text, None, source, None, "x", "y", "z", 1) for i, text, source in rows]
    found = linededup.drop_boilerplate(spark.createDataFrame(rows, schema), share, pages)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "line", "lines", "host", "total"]
    docs = pd.DataFrame([(r[0], r[1], r[3]) for r in rows], columns=["doc_id", "text", "source"]).astype({"text": "object", "source": "object"})
    connection = duckdb.connect()
    connection.register("raw", docs)
    connection.execute("CREATE TABLE docs AS SELECT doc_id::BIGINT AS doc_id, text::VARCHAR AS text, source::VARCHAR AS source FROM raw")
    wanted = connection.execute("SELECT doc_id, text FROM (" + linededup.SQL.format(docs="docs", share=share, pages=pages) + ")").fetchall()
    got = [(r.doc_id, r.text) for r in found.collect()]
    return sorted(got, key=str), sorted(wanted, key=str)


def test_lines_common_on_a_host_go(spark):
    rows = [(i, f"menu\nown {i}\n\n  menu \nfooter", "a") for i in range(10)] + [(100 + i, f"menu\ntext {i}", "b") for i in range(40)]
    rows += [(200 + i, f"text {i}\nend", "b") for i in range(60)]
    got, wanted = both(spark, rows, 0.5, 2)
    assert got == wanted
    texts = dict(got)
    assert texts[3] == "own 3\n" and texts[103] == "menu\ntext 3" and texts[203] == "text 3"


def test_nulls_empties_repeats_and_small_hosts(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x\ny", None), (3, "x\ny", None), (4, "x\nz", None), (5, "x", "one"), (None, "x", None)]
    rows += [(6, "\n\n", "a"), (7, " " * 5, "a"), (8, "long " * 50_000 + "\nx", "a")]
    got, wanted = both(spark, rows, 0.4, 2)
    assert got == wanted and dict(got)[4] == "z" and dict(got)[5] == "x" and dict(got)[1] is None


def test_empty_table(spark):
    assert both(spark, [], 0.1, 1) == ([], [])


def test_any_white_space_at_the_ends_of_a_line(spark):
    ends = ["", "\r", "\t", "\u00a0", " \r"]
    rows = [(i, f"menu{ends[i % 5]}\n\r\nown {i}\r", "a") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = linededup.drop_boilerplate_keeping_texts(docs, 0.5, 5).collect()
    assert {r.doc_id: r.text for r in found} == {i: f"\r\nown {i}\r" for i in range(10)}
    got, wanted = both(spark, rows, 0.5, 2)
    assert got == wanted and dict(got)[7] == "\r\nown 7\r"


def test_copies_are_one_page(spark):
    """Six copies of a text on a host of 50 pages are one page in fifty; a menu on all of four pages goes."""
    text = "\n".join(f"sentence {i} of the text" for i in range(20))
    rows = [(i, text, "a") for i in range(6)] + [(100 + i, f"page {i}", "a") for i in range(50)]
    rows += [(200 + i, f"menu\nown {i}", "b") for i in range(4)]
    got, wanted = both(spark, rows, 0.1, 2)
    texts = dict(got)
    assert got == wanted and texts[3] == text and [texts[200 + i] for i in range(4)] == [f"own {i}" for i in range(4)]
