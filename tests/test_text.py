"""Column builders against Python's own re / hashlib / ast on hand-made fixtures."""
import ast
import hashlib
import re

from pyspark.sql import functions as F

from tessera.functions import text as tx

UNICODE_TEXTS = [
    (1, "a b c\u0085d e　f\u001cg"),
    (2, "  café net-zero, <b>bold</b> 100%!  "),
    (3, ""),
    (4, "line one\nline <i\nx> two <tag>"),
    (5, "   padded 　"),
    (6, "tab\there\r\nend"),
]


def _rows(spark, data, col):
    return dict(spark.createDataFrame(data, "id long, text string").select("id", col.alias("v")).collect())


def test_strip_tags_matches_python(spark):
    got = _rows(spark, UNICODE_TEXTS, tx.strip_tags("text"))
    for i, t in UNICODE_TEXTS:
        assert got[i] == re.sub("<.*?>", "", t)


def test_strip_special_matches_python(spark):
    got = _rows(spark, UNICODE_TEXTS, tx.strip_special("text"))
    for i, t in UNICODE_TEXTS:
        assert got[i] == re.sub(r"[^a-zA-Z0-9\s]", "", t), repr(t)


def test_content_id_matches_hashlib(spark):
    got = _rows(spark, UNICODE_TEXTS, tx.content_id("text"))
    for i, t in UNICODE_TEXTS:
        assert got[i] == int(hashlib.sha256(t.lower().strip().encode()).hexdigest(), 16) % 10**8


def test_word_count_matches_split(spark):
    got = _rows(spark, UNICODE_TEXTS, tx.word_count("text"))
    for i, t in UNICODE_TEXTS:
        assert got[i] == len(t.split())


def test_py_strip(spark):
    got = _rows(spark, UNICODE_TEXTS, tx.py_strip("text"))
    for i, t in UNICODE_TEXTS:
        assert got[i] == t.strip()


LITERALS = [
    (1, "['a']"), (2, '["it\'s"]'), (3, "['a\\'b']"), (4, "['a\\xa0b']"), (5, "[]"),
    (6, "['x', \"y\", 'z\\n']"), (7, "broken ['"), (8, None), (9, "['a\\\\xa0']"),
]


def test_parse_list_literal_matches_literal_eval(spark):
    got = _rows(spark, LITERALS, tx.parse_list_literal("text"))
    for i, raw in LITERALS:
        try:
            want = ast.literal_eval(raw) if raw is not None else None
        except (ValueError, SyntaxError):
            want = None
        assert got[i] == want, (raw, got[i], want)


def test_list_literal_round_trip(spark):
    lists = [(1, ["a", "it's", "back\\slash", "tab\tnew\nline"]), (2, []), (3, ["été"])]
    df = spark.createDataFrame(lists, "id long, xs array<string>")
    out = dict(df.select("id", tx.parse_list_literal(tx.to_list_literal("xs"))).collect())
    lits = dict(df.select("id", tx.to_list_literal("xs")).collect())
    for i, xs in lists:
        assert out[i] == xs
        assert ast.literal_eval(lits[i]) == xs


def test_collection_name(spark):
    df = spark.range(1).select(tx.collection_name(F.lit("BAAI/bge-small-en"), F.lit("Recursive Splitter"),
                                                   F.lit("dev")).alias("n"))
    assert df.first()["n"] == "cleantech_baai_bge_small_en_recursive_splitter_dev"
