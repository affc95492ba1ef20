import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tandem.functions import text as txt
from tandem.operators.translate import truncate_tokens
from tandem.plans.queries import QUERIES

SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace()]


def test_whitespace_is_the_unicode_set(column):
    assert len(SPACES) == 29
    texts = [f"a{space}b" for space in SPACES]
    assert column(txt.token_count(F.col("x")), texts) == [2] * 29
    assert column(txt.clean_text(F.col("x"), repair=False), texts) == ["a b"] * 29
    others = [chr(c) for c in range(1, 0x3001) if not chr(c).isspace()]
    assert set(column(txt.token_count(F.col("x")), [f"a{c}b" for c in others])) == {1}


@pytest.mark.parametrize(
    "raw, clean", [("  hello   world  ", "hello world"), ("", ""), ("hello\t\nworld", "hello world"), (" ", "")]
)
def test_clean(column, raw, clean):
    assert column(txt.clean_text(F.col("x")), [raw]) == [clean]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from([*"ab .,-9&;", *SPACES]), max_size=30), min_size=20, max_size=60))
def test_counts_and_cleaning_follow_split(column, texts):
    assert column(txt.token_count(F.col("x")), texts) == [len(t.split()) for t in texts]
    cleaned = column(txt.clean_text(F.col("x"), repair=False), texts)
    assert cleaned == [re.sub(r"\s+", " ", t.strip()) for t in texts]
    assert column(txt.clean_token_count(F.col("x")), cleaned) == [len(t.split()) for t in texts]
    assert column(txt.words(F.col("x")), texts) == [t.split() for t in texts]


def test_repair(column):
    cases = {
        "itâ€™s cafÃ©": "it's café",
        "日本 café São": "日本 café São",
        "a &amp; b &lt;c&gt; &#233; &#xE9; &nope; &amp;lt;": "a & b <c> é é &nope; &lt;",
        "<b>&amp;</b>": "<b>&amp;</b>",
        "“quoted” ‘one’": "\"quoted\" 'one'",
        "oﬃce ﬁne": "office fine",
        "ＡＢ１　x": "AB1 x",
        "a\r\nb\rc d": "a\nb\nc\nd",
        "x\x1b[31my\x07\x00z﻿": "xyz",
        "plain": "plain",
        "&#55296; &#1114112;": "&#55296; &#1114112;",
    }
    assert column(txt.repair_text(F.col("x")), list(cases)) == list(cases.values())


def test_mojibake_is_undone_run_by_run(column):
    """Damage in part of a text, beside letters and marks that are right as they stand."""
    cases = {
        "El niÃ±o está aquí": "El niño está aquí",
        "cafÃ© – ok": "cafÃ© – ok".replace("Ã©", "é"),
        "“SÃ£o Paulo” à noite – ÃœberfÃ¤lle": '"São Paulo" à noite – Überfälle',
        "Spaß” und PASÓ” sowie Æ’ oder Ö–": 'Spaß" und PASÓ" sowie Æ\' oder Ö–',
        "Ð¿Ñ€Ð¸Ð²ÐµÑ‚ und ß– und æ—¥æœ¬": "привет und ß– und 日本",
        "ðŸ˜€ 5â‚¬ Â£3 naÃ¯ve": "😀 5€ £3 naïve",
        "Ã alone, Â, â€ and Ã": "Ã alone, Â, â€ and Ã",
    }
    assert column(txt.repair_text(F.col("x")), list(cases)) == list(cases.values())


def test_combining_marks_are_composed(column):
    import unicodedata

    texts = ["cafe\u0301 nin\u0303o", "e\u0302\u0301 a\u0323\u0302", "q\u0301x", "z\u030C\u0301", "\u0301a", "A\u030Angstro\u0308m", "s\u0323\u0307", "\u00EA\u0301"]
    assert column(txt.compose_letters(F.col("x")), texts) == [unicodedata.normalize("NFC", t) for t in texts]
    every = [f"{pair}." for pair in txt._COMPOSED]
    assert column(txt.repair_text(F.col("x")), every) == [unicodedata.normalize("NFC", t) for t in every]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from("abñéüßçõ àÅ–€’日本пр😀ž.,"), max_size=25), min_size=20, max_size=50))
def test_wholly_broken_texts_are_read_again(column, texts):
    """A text without quotation marks or dashes, broken as a whole, comes back."""
    texts = [t for t in texts if not set(t) & set("–’") and all(0xA0 <= b or b < 0x80 or bytes([b]).decode("cp1252", "ignore") for b in t.encode())]
    texts = [t for t in texts if not re.search("[пр日本](?![пр日本])(?<![пр日本].)", t)]
    broken = [t.encode().decode("cp1252") for t in texts]
    assert column(txt.repair_text(F.col("x")), broken) == column(txt.repair_text(F.col("x")), texts)


def test_repair_null(column):
    assert column(txt.repair_text(F.col("x")), [None]) == [None]


def test_word_overlap_and_ratio(column):
    pairs = [("No no no", "no es no"), ("A b c d", "B x"), ("", "a")]
    assert column(txt.word_overlap(F.col("a"), F.col("b")), pairs, "a string, b string") == [1.0, 0.25, 0.0]
    assert column(txt.length_ratio(F.col("a"), F.col("b")), [(4, 2), (3, 0)], "a int, b int") == [2.0, 3.0]


def test_buckets(column):
    values = [0, 15, 16, 30, 31]
    names = ["short_sents", "short_sents", "mid_sents", "mid_sents", "long_sents"]
    assert column(txt.length_bucket(F.col("x")), values, "x int") == names
    other = txt.length_bucket(F.col("x"), (10, 25), ("short", "medium", "long"))
    assert column(other, [10, 11, 25, 26], "x int") == ["short", "medium", "medium", "long"]


def test_tokenize_13a(column):
    text = "It costs $3,000.50, e.g. 5-6 (ok)!"
    assert column(F.array_join(txt.tokenize_13a(F.col("x")), " "), [text]) == [
        "It costs $ 3,000.50 , e . g . 5 - 6 ( ok ) !"
    ]


def test_ngrams(column):
    tokens = txt.words(F.col("x"))
    assert column(txt.ngrams(tokens, 2), ["a b c", "a", ""]) == [["a b", "b c"], [], []]


def test_truncate(column):
    texts = ["a  b c", "a b", " a b c d ", ""]
    assert column(truncate_tokens(F.col("x"), 2), texts) == ["a  b", "a b", " a b", ""]


def test_repair_takes_any_reference(column):
    texts = ["don&apos;t", "&#00000065;&#x0000000042;", "&rarr;&nosuch;", "&#99999999999;"]
    assert column(txt.repair_text(F.col("x")), texts) == ["don't", "AB", "\u2192&nosuch;", "&#99999999999;"]


def test_damage_is_done_once_per_text(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(["fi 12 \u00e1\u00e9", "a\nb", "", None] * 8)] + [(None, "fi")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["repair_damage"](spark, str(tmp_path))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("fi, \uFB01") == 1
    assert sorted(map(str, found.collect())) == sorted(str(r) for r in spark.createDataFrame([(d, None if d is None else t) for d, t in rows], found.schema).collect())


def test_damage_after_letters_that_need_none(column):
    """Each kind alone in a text: what decides whether a step runs must know all that the step mends."""
    pairs = {
        "x\u00c3\u00a9": "x\u00e9", "e\u0301": "\u00e9", "\u0301e": "\u0301e", "\ufb03": "ffi", "\uff21": "A", "\u3000a": " a", "\u201ca": '"a', "\u2018a": "'a",
        "a\rb": "a\nb", "a\u0085b": "a\u2026b", "a\u2028b": "a\nb", "\x1b[1ma": "a", "\x07a": "a", "&amp;a": "&a", "&amp;<": "&amp;<", "\u00e9&": "\u00e9&",
    }
    assert column(txt.repair_text(F.col("x")), list(pairs)) == list(pairs.values())
