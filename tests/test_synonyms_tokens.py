import pytest

from lexgraph.operators.synonyms import synonyms
from lexgraph.operators.tokens import drop_stopwords, lexicon_matches, tokenize, tokens_with_nature
from lexgraph.plans import stage

ROWS = [
    ("中国", "中国", "词义,历史", "中国 古代中国 中国词义 中国历史"),
    ("NYC/city", "New-York", "History,Map", "NYCHistory Big-Apple new-yorkmap gotham Gotham NYC"),
    ("two words", "x", "", "a b"),
    ("南头古城", "", "", "新安故城 南头古城 深圳新安故城"),
    (" ab ", "ab", "x,,xy,", "abxy b  xy c abx"),
]


@pytest.fixture(params=["broadcast", "salted"])
def joins(request, monkeypatch):
    if request.param == "salted":
        monkeypatch.setattr(stage, "MAX_BROADCAST_ROWS", -1)
    return request.param


def test_synonyms(spark):
    df = spark.createDataFrame(ROWS, "bk_word string, bk_input string, dir_words string, meta_keywords string")
    got = {r.word: r for r in synonyms(df).collect()}
    assert {w: r.syno for w, r in got.items()} == {
        "中国": "古代中国",
        "nyc": ",big-apple,gotham",
        "南头古城": "新安故城,深圳新安故城",
        "ab": ",b,c",
    }
    assert got["ab"].dir_words == "x,,xy"
    assert got["nyc"].input == "new-york"
    assert got["nyc"].meta_keywords == "nychistory big-apple new-yorkmap gotham gotham nyc"
    assert {r.word: r.syno for r in synonyms(df, drop_empty=True).collect()}["nyc"] == "big-apple,gotham"
    assert {r.word: r.syno for r in synonyms(df, min_len=2).collect()}["ab"] == ""


def test_longer_removals_go_first(spark):
    df = spark.createDataFrame(
        [("a", "bb", "x,xyz", "axyz bbxyz axx bbx q")],
        "bk_word string, bk_input string, dir_words string, meta_keywords string",
    )
    # "axyz" and "bbxyz" go before "ax" and "bbx"; then the sections themselves.
    assert synonyms(df).first().syno == ",q"


def test_tokens(spark, joins):
    docs = spark.createDataFrame([(1, "The cat, the Cat's 中国人 42!"), (2, "... ")], "doc_id int, text string")
    tokens = tokenize(docs)
    assert [tuple(r) for r in tokens.orderBy("pos").collect()] == [
        (1, i, t) for i, t in enumerate(["The", "cat", "the", "Cat", "s", "中国人", "42"])
    ]
    lexicon = spark.createDataFrame([("cat", "n"), ("the", "d"), ("the", "e"), ("中国", "ns")], "word string, nature string")
    user = spark.createDataFrame([("cat", "animal"), ("42", "num")], "word string, nature string")
    got = [r.nature for r in tokens_with_nature(tokens, lexicon, user).orderBy("pos").collect()]
    assert got == ["x", "animal", "e", "x", "x", "x", "num"]
    stop = spark.createDataFrame([("the",), ("the",), ("s",)], "word string")
    assert [r.token for r in drop_stopwords(tokens, stop).orderBy("pos").collect()] == ["The", "cat", "Cat", "中国人", "42"]


def test_lexicon_matches(spark, joins):
    tokens = spark.createDataFrame([(1, "中国人民😀大学"), (2, "xyz")], "id int, token string")
    lexicon = spark.createDataFrame(
        [("中国", "ns"), ("中国人", "n"), ("人民", "n"), ("大学", "nt"), ("学", "v"), ("😀", "e")], "word string, nature string"
    )
    got = sorted((r.start, r.word, r.nature) for r in lexicon_matches(tokens, lexicon).collect())
    assert [(w, n) for _, w, n in got] == [("中国人", "n"), ("人民", "n"), ("😀", "e"), ("大学", "nt"), ("学", "v")]
