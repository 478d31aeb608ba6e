import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.functions import text as T
from postgauge.operators import quality, textstats

UNUSUAL = ["café résumé", "ﬁne ½ …", "  　x y\u0085z ", "", "plain"]


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column).first()[0]


def test_clean_ascii_trims_and_lowers(spark):
    assert one(spark, "  Hello World  ", T.clean_ascii("t")) == "hello world"


@pytest.mark.parametrize("text", UNUSUAL)
def test_clean_ascii_like_python(spark, text):
    low = unicodedata.normalize("NFKD", text.strip().lower())
    assert one(spark, text, T.clean_ascii("t")) == "".join(c for c in low if ord(c) < 128)


def test_every_character_folds_like_python(spark):
    points = [chr(i) for i in range(1, 0x110000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(points[k : k + 500]) for k in range(0, len(points), 500)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    folded = df.select("k", T.fold_to_ascii(F.col("t")).alias("t"))
    for k, got in folded.collect():
        assert got == unicodedata.normalize("NFKD", texts[k]).encode("ascii", "ignore").decode("ascii")
    assert "Python" not in folded._jdf.queryExecution().executedPlan().toString()


def test_whitespace_is_python_whitespace(spark):
    spaces = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
    assert set(spaces) == set(fixed.WHITESPACE_CHARS)
    assert one(spark, "a" + spaces + "b", T.whitespace_words(F.col("t"))) == 2
    others = "".join(chr(i) for i in range(1, 0xD800) if not chr(i).isspace())
    assert one(spark, others, T.whitespace_words(F.col("t"))) == 1


def test_two_sentences(spark):
    df = spark.createDataFrame([(1, "hello world. how are you?")], "id int, t string")
    rows = textstats.sentence_tokens(df, "t", "id").orderBy("sentence_no").collect()
    assert [r["tokens"] for r in rows] == [["hello", "world", "."], ["how", "are", "you", "?"]]


def test_word_usage(spark):
    text = "the cat said hello said"
    assert one(spark, text, T.token_usage(F.col("t"), ["said"])) == 2
    assert one(spark, text, T.token_usage(F.col("t"), ["dog"])) == 0


def test_unique_fraction(spark):
    assert one(spark, "the cat sat the cat ran", T.unique_fraction(F.col("t"))) == pytest.approx(4 / 6)
    assert one(spark, "", T.unique_fraction(F.col("t"))) == 0.0


def test_flesch_formula(spark):
    def score(s, w, y):
        return spark.range(1).select(T.flesch(F.lit(s), F.lit(w), F.lit(y))).first()[0]

    assert score(1, 10, 15) == pytest.approx(206.835 - 1.015 * 10 - 84.6 * 1.5)
    assert score(0, 0, 0) == 0.0


def test_syllables(spark, lexicon):
    df = spark.createDataFrame([("hello",), ("...",), ("zzgh",), ("Don't",), ("sort,",)], "token string")
    rows = {r["token"]: r["syllables"] for r in textstats.with_syllables(df, lexicon).collect()}
    # Known, punctuation, unknown letters, known but not alphabetic, glued punctuation.
    assert rows == {"hello": 2, "...": 0, "zzgh": 1, "Don't": 1, "sort,": 0}


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>Hello <b>world</b></p>", "Hello world"),
        (None, ""),
        ("<p>Test</p>", "Test"),
        ("a < b &amp;&amp; b > c", "a < b && b > c"),
        ("&amp;lt; &eacute; &#8364; &lt;i&gt;", "&lt; é € <i>"),
        ("<a title='x>y' href=\"z\">k</a><!-- no -->!", "k!"),
        ("<script>var t='</p>';</script><style>p{}</style>x<br>y", "xy"),
        ("a &amp</b>mp; &amp<i>;</i> &copy 1 &AMP; &notit;", "a &mp; &; © 1 & ¬it;"),
        ("<!DOCTYPE html><?xml v?>t<script>open", "t"),
    ],
)
def test_strip_html(spark, html, text):
    assert one(spark, html, T.strip_html("t")) == text


def test_long_words_and_pages_survive(spark):
    """No pattern may recurse per character."""
    word = "é漢" * 200_000
    assert one(spark, word, F.size(T.word_tokens(F.col("t")))) == 1
    assert one(spark, word, T.whitespace_words(F.col("t"))) == 1
    assert one(spark, word, F.size(T.readability_tokens(F.col("t")))) == 1
    page = "<p>" + "x < y " * 50_000 + "<a " + 'k="v" ' * 2000 + ">end</a>"
    assert one(spark, page, T.strip_html("t")).endswith("end")


def test_action_phrases_are_whole_words(spark):
    assert one(spark, "How to scan a can? CAN I", T.action_density("t")) == pytest.approx(3 / 7)
    assert one(spark, "écan canal what_is", T.action_density("t")) == 0.0


TITLED = [
    (1, "Which index serves two date columns?", "Our table grows by night and its reports stall. Which of these two indexes should I drop? How to tell?"),
    (2, "BIG OLD JOB", "has just died"),
    (3, None, "Some body"),
    (4, "Test?", None),
    (5, "", ""),
]


@pytest.fixture(scope="module")
def features(spark, lexicon):
    df = spark.createDataFrame(TITLED, "Id int, Title string, Body string")
    return quality.quality_features(df, lexicon)


def test_quality_feature_names(features):
    assert features.columns == [
        "Id", "title_len", "body_len", "title_ends_with_qmark", "body_ends_with_qmark",
        "flesch_score", "action_verbs_density", "title_caps_ratio",
    ]


def test_quality_feature_values(features):
    rows = {r["Id"]: r for r in features.collect()}
    assert len(rows) == 5
    assert not any(v is None for r in rows.values() for v in r)
    assert [rows[i]["title_ends_with_qmark"] for i in (1, 2, 4)] == [1, 0, 1]
    assert rows[2]["title_caps_ratio"] == pytest.approx(9 / 11)
    assert rows[5]["flesch_score"] == 0.0
    # "should" and "How to" among twenty words.
    assert rows[1]["action_verbs_density"] == pytest.approx(2 / 20)
    # "BIG OLD JOB has just died": one sentence, six words, one syllable each.
    assert rows[2]["flesch_score"] == pytest.approx(206.835 - 1.015 * 6 - 84.6)


def test_counts_run_before_the_explode(spark, data):
    """Whole-text work beside an explode would run once per token."""
    from postgauge.queries import QUERIES

    for name in ("qf_flesch", "text_report", "quality_features"):
        plan = QUERIES[name](spark, data)._jdf.queryExecution().optimizedPlan().toString()
        above = plan.split("Generate explode")[0]
        assert "regexp_extract_all" not in above and "array_distinct" not in above, name


def test_characters_that_become_several_are_found_by_a_few_ranges():
    """The class is tried on every character of a text that isn't ASCII throughout."""
    pattern = T._ascii_tables()[2]
    assert pattern.count("-") < 60
    python = re.compile(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: re.escape(chr(int(m[1], 16))), pattern))
    several = {c for c, part in T._ascii_parts().items() if len(part) > 1}
    assert {c for c in map(chr, range(0x110000)) if python.fullmatch(c)} == several
