import pytest
from pyspark.sql import functions as F

from corpusmill.functions import hashing, labels, text, urls
from corpusmill.sources.readers import guess_format


def values(frame, function, cases, kind="string"):
    df = frame([(i, c) for i, c in enumerate(cases)], f"i int, x {kind}", 1)
    return [r[0] for r in df.sort("i").select(function(F.col("x"))).collect()]


def test_clean_text(frame):
    cases = ["Visit https://x.y/z now: it's  GREAT!\nReally.", "one two three four", None, "A-B (c) #tag one two three", "Ça où élève naïf straße cœur", ""]
    assert values(frame, text.clean_text, cases) == ["visit now it's great! really.", "", "", "ab c tag one two three", "ca ou eleve naif strasse coeur", ""]


@pytest.mark.parametrize("case, limit, expected", [("Aa. Bb. Cc.", 7, "Aa. Bb."), ("Aa. Bb. Cc.", 11, "Aa. Bb. Cc."), ("abcdefghij", 5, ""), ("Aa. Bbbbbbbbb. C.", 9, "Aa."), (None, 5, None), ("", 5, "")])
def test_truncate_text(frame, case, limit, expected):
    assert values(frame, lambda c: text.truncate_text(c, limit), [case]) == [expected]


def test_words_names_and_scores(frame):
    assert values(frame, text.word_count, ["state-of-the-art -a b-", "don't stop", "é ü", "--", None]) == [3, 3, 2, 0, 0]
    assert values(frame, text.clean_filename, ["a b-c_1.é(2).csv", None]) == ["abc_1.é2.csv", None]
    assert values(frame, text.score_of_reply, ["3", " 5 ", "6", "-1", "4分", "", None]) == [3, 5, -1, -1, -1, -1, -1]
    assert values(frame, text.numeric, ["0.5", "x", None, "nan"]) == [0.5, None, None, None]
    assert values(frame, text.clean_whitespace, [" a\r\n b ", None]) == ["a b", ""]
    assert values(frame, text.flatten_newlines, ["a\nb\n\nc", None]) == ["a b  c", None]


def test_percent_of_nothing_is_zero(spark):
    row = spark.range(1).select(text.percent(F.lit(1), F.lit(3)), text.percent(F.lit(1), F.lit(0))).first()
    assert tuple(row) == (33.33, 0.0)


def test_hashes(frame):
    df = frame([("u", "t"), ("u", None)], "a string, b string", 1)
    assert {r[0] for r in df.select(hashing.row_md5(F.col("a"), F.col("b"))).collect()} == {"a440d578202fc0ecc97a191e0af290c6", "3b6f6884189ff63945dc1022aa0faeed"}
    assert values(frame, hashing.shard_of, ["abc", "", None]) == [74, 1652, None]


def test_urls(frame):
    cases = ["HTTPS://User@WWW.Ex.org:80/a?b", "http://m.ex.org", "//ex.org/x", "nothing", None, "http://10.0.0.1/", "http://localhost/"]
    assert values(frame, urls.host, cases) == ["www.ex.org", "m.ex.org", "ex.org", None, None, "10.0.0.1", "localhost"]
    assert values(frame, urls.fqdn, cases) == ["www.ex.org", "m.ex.org", "ex.org", "", "", "", ""]
    assert values(frame, lambda c: urls.site_of(c, F.lit("src")), cases[:2] + [None]) == ["ex.org", "ex.org", "src"]
    assert values(frame, lambda c: urls.domain_of(c, F.lit("http://H.org:1/")), [" A.b \xa0", "", None, "  "]) == ["a.b", "h.org", "h.org", "h.org"]


def test_labels(frame):
    assert values(frame, lambda c: labels.label_line(F.lit(1), c), ["a\nb", None]) == ["__label__1 a b", "__label__1"]
    assert values(frame, labels.strip_label, ["__label__0"]) == ["0"]


@pytest.mark.parametrize("path, expected", [("**/*.JSONL.zst", "jsonl"), ("a/parquet/x.jsonl", "jsonl"), ("x.warc.gz", "warc"), ("x.tsv", "csv"), ("x.json", "csv")])
def test_guess_format(path, expected):
    assert guess_format(path) == expected


def test_entry_hides_only_a_missing_subpackage():
    from pathlib import Path

    source = (Path(__file__).resolve().parent.parent / "__spark_entry__.py").read_text()
    assert "find_spec" in source and "ImportError" not in source
