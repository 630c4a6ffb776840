from pyspark.sql import functions as F

from lexgraph.operators.classify import classify_terms, related_by_class
from lexgraph.operators.cooccur import tag_cooccur, tag_count
from lexgraph.operators.nature import TAG_NATURE, default_natures, nature_label
from lexgraph.operators.terms import clean_terms, clean_terms_loose

CRAWLED = [
    ("apple/fruit", "/x,pear,plum/tree,fig", "food,plant"),
    ("apple/brand", "a,b", "tech"),
    ("apple/brand2", "mac,phone,pad,,", "brand,tech"),
    ("/bad", "a,b,c", "t"),
    ("k", "a,b,c", "t"),
    ("pear", "apple,apple/x,plum", "food,plant,food"),
    ("none2", "a,b,c", ",,"),
    ("tab\t ", "a,b,c", ""),
    ("fig", "/q,/r,/s", "plant"),
]


def crawled(spark, extra=()):
    return spark.createDataFrame(CRAWLED + list(extra), "bk_word string, bk_relwords string, bk_tags string")


def test_clean_terms(spark):
    got = {tuple(r) for r in clean_terms(crawled(spark), as_csv=True).collect()}
    assert got == {
        ("apple", "pear,plum,fig", "food,plant"),
        ("pear", "apple,apple,plum", "food,plant,food"),
        ("fig", "", "plant"),
    }


def test_clean_terms_loose(spark):
    got = {r.word: (r.relwords, r.tags) for r in clean_terms_loose(crawled(spark)).collect()}
    assert got == {
        "apple": (["pear", "plum", "fig"], ["food", "plant"]),
        "pear": (["apple", "apple", "plum"], ["food", "plant", "food"]),
        "fig": ([], ["plant"]),
        "k": (["a", "b", "c"], ["t"]),
        "tab": (["a", "b", "c"], [""]),
    }


def test_nulls(spark):
    odd = crawled(spark, [(None, "a,b,c", "t"), ("nul", None, "t"), ("nultags", "a,b,c", None)])
    words = {r.word for r in clean_terms(odd).collect()}
    assert words == {"apple", "pear", "fig"}
    assert [r.tags for r in clean_terms_loose(odd).where("word = 'nultags'").collect()] == [[""]]


def test_result_does_not_depend_on_partitions(spark):
    results = []
    for n in (1, 4, 17):
        df = crawled(spark, [("apple/z", "u,v,w", "x")]).repartition(n)
        results.append(sorted(map(tuple, clean_terms_loose(df, as_csv=True).collect())))
    assert results[0] == results[1] == results[2]


def test_tag_count_and_cooccur(spark):
    terms = clean_terms_loose(crawled(spark))
    assert dict(map(tuple, tag_count(terms).collect())) == {"food": 3, "plant": 3, "t": 1, "": 1}
    assert dict(map(tuple, tag_count(terms, drop_empty_tags=True).collect())) == {"food": 3, "plant": 3, "t": 1}
    assert list(map(tuple, tag_cooccur(terms).collect())) == [("plant", "food", 3, 3, 3)]


def test_cooccur_multiplies_repeats(spark):
    terms = spark.createDataFrame([("w", ["a", "b", "b", "c", ""]), ("v", [])], "word string, tags array<string>")
    got = {(r.tag1, r.tag2): (r.tag1num, r.tag2num, r.twotagnum) for r in tag_cooccur(terms).collect()}
    assert got == {
        ("b", "a"): (2, 1, 2), ("c", "a"): (1, 1, 1), ("c", "b"): (1, 2, 2),
        ("a", ""): (1, 1, 1), ("b", ""): (2, 1, 2), ("c", ""): (1, 1, 1),
    }
    assert len(tag_cooccur(terms, drop_empty_tags=True).collect()) == 3


def test_classes(spark):
    classes = spark.createDataFrame([("food", 0), ("plant", 1), ("tech", 2)], "tag string, cls int")
    classified = classify_terms(clean_terms_loose(crawled(spark)), classes)
    assert {r.word: r.cls for r in classified.collect()} == {"apple": 0, "pear": 0, "fig": 1}
    assert {tuple(r) for r in related_by_class(classified).collect()} == {
        ("apple", 0, -1, "plum/1"),
        ("apple", 0, 0, "pear/1"),
        ("apple", 0, 1, "fig/1"),
        ("pear", 0, -1, "plum/1"),
        ("pear", 0, 0, "apple/2"),
    }


def test_related_terms_with_a_hot_term(spark):
    """A third of all rows names one term; counts must be those of a plain count."""
    n = 600
    words = [(f"w{i}", ["hot", f"w{(i * 7) % n}", f"w{(i * 3) % n}", "hot"], i % 3) for i in range(n)] + [("hot", ["w1"], 9)]
    df = spark.createDataFrame(words, "word string, relwords array<string>, cls int")
    cls = {w: c for w, _, c in words}
    want = {}
    for w, rel, c in words:
        for r in set(rel):
            want.setdefault((w, c, cls.get(r, -1)), []).append((rel.count(r), r))
    want = {k: ",".join(f"{r}/{m}" for m, r in sorted(v, reverse=True)) for k, v in want.items()}
    got = {(r.word, r.cls, r.relcls): r.relwords for r in related_by_class(df).collect()}
    assert got == want


def test_nature(spark):
    lookup = spark.createDataFrame([("food", "nf"), ("plant", "np")], "tag string, nature string")
    rows = [
        ("apple/fruit", "x,plant,food"), ("apple", "food"), ("z1", "odd"), ("//", "food"), ("/abc", "plant"),
        ("a", "food"), ("nul", None), ("blank", ""),
    ]
    got = {tuple(r) for r in nature_label(spark.createDataFrame(rows, "bk_word string, bk_tags string"), lookup).collect()}
    assert got == {("apple", "x,plant,food", "np", "5"), ("//", "food", "nf", "2"), ("", "plant", "np", "0")}


def test_fixed_natures(spark):
    assert len(TAG_NATURE) == 43
    assert len(set(TAG_NATURE.values())) == 36
    df = spark.createDataFrame([("x1", "历史,二战"), ("x2", "二战")], "bk_word string, bk_tags string")
    got = {r.word: r.nature for r in nature_label(df, default_natures(spark)).collect()}
    assert got == {"x1": "mzhis", "x2": "mzwar"}


def test_senses_beyond_one_partition(spark):
    """One base term with very many senses: the largest sense wins wherever it lies."""
    df = spark.range(20000).select(
        F.concat(F.lit("hub/"), "id").alias("bk_word"),
        F.when(F.col("id") == 12345, F.lit("a,b,c,d")).otherwise(F.lit("a,b,c")).alias("bk_relwords"),
        F.concat(F.lit("t"), "id").alias("bk_tags"),
    )
    assert [tuple(r) for r in clean_terms(df, as_csv=True).collect()] == [("hub", "a,b,c,d", "t12345")]
