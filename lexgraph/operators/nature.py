"""Nature code of terms from a tag lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgraph.functions.strings import base_term, jsplit, jtrim
from lexgraph.plans.lookup import lookup_join

# Tag to nature code.
TAG_NATURE = {
    "人物": "mznr", "语言": "mzlang", "电影": "mzvedio", "科学": "mzsci", "书籍": "mzbook",
    "音乐作品": "mzmusic", "游戏": "mzgame", "电视剧作品": "mzvedio", "公司": "mzntc", "字词": "mzchar",
    "科技产品": "mzsci", "组织机构": "mzni", "学科": "mzsub", "生物物种": "mzspec", "大牌": "mzbrand",
    "历史": "mzhis", "生活": "mzlife", "行政区划": "mzns", "品牌": "mzbrand", "地点": "mzns",
    "娱乐作品": "mzfun", "医学": "mzmedi", "美术": "mzart", "文学作品": "mzarticle", "体育": "mzsport",
    "小说": "mznovel", "娱乐术语": "mzfun", "食品": "mzfood", "股票类术语": "mzstock", "综艺节目": "mzshow",
    "二战": "mzwar", "动画": "mzanima", "非遗": "mzheri", "经济术语": "mzeco", "大学": "mzcollege",
    "舞蹈": "mzdance", "车站": "mzstation", "奖项": "mzmedal", "自然资源": "mzresource", "历史事件": "mzhis",
    "本科专业": "mzmajor", "文化设施": "mzculture", "专科专业": "mzmajor",
}


def default_natures(spark: SparkSession) -> DataFrame:
    """[tag, nature] of the fixed values."""
    return spark.createDataFrame(list(TAG_NATURE.items()), "tag string, nature string")


def nature_scan(df: DataFrame, word: str = "bk_word", tags: str = "bk_tags") -> DataFrame:
    """Rows with tags whose raw word has 2 to 23 characters."""
    return df.where(F.col(tags).isNotNull() & (F.col(tags) != "") & F.length(word).between(2, 23)).select(word, tags)


def nature_label(df: DataFrame, lookup: DataFrame, word: str = "bk_word", tags: str = "bk_tags") -> DataFrame:
    """[word, tags, nature, word_len], one row per base term that has a tag in the lookup.

    The nature is that of the first listed tag with one; of repeated tags in the lookup the largest counts. Of several senses the one with most
    tags is kept, equal counts by the tags themselves. Equal senses are merged first; both
    aggregates have a map-side part, so a word with very many senses is spread by its tags.
    """
    senses = (
        nature_scan(df, word, tags)
        .select(base_term(jtrim(F.col(word))).alias("word"), jsplit(jtrim(F.col(tags))).alias("tags"))
        .distinct()
    )
    unrolled = senses.select("word", "tags", F.posexplode("tags").alias("pos", "tag"))
    mapped = (
        lookup_join(unrolled, lookup.groupBy("tag").agg(F.max("nature").alias("nature")), "tag", "inner")
        .groupBy("word", "tags")
        .agg(F.min(F.struct("pos", "nature"))["nature"].alias("nature"))
    )
    csv = F.array_join("tags", ",")
    best = mapped.groupBy("word").agg(
        F.max(F.struct(F.size("tags").alias("n"), csv.alias("tags"), F.col("nature").alias("nature"))).alias("b")
    )
    return best.select(
        "word",
        F.col("b.tags").alias("tags"),
        F.col("b.nature").alias("nature"),
        F.length("word").cast("string").alias("word_len"),
    )
