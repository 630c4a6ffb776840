"""Text segmentation with a lexicon: tokens, nature codes, user words, stop words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexgraph.plans.lookup import frequent_join, lookup_join
from lexgraph.plans.stage import lookup_side, stage, stage_sized


def tokenize(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """[*keep, pos, token]: runs of letters and digits with their position from 0."""
    parts = F.array_remove(F.split(F.col(text), r"[^\p{L}\p{N}]+"), "")
    return df.select(*keep, F.posexplode(parts).alias("pos", "token"))


# Fixed value: the frequency that a user word has in the lexicon, whatever its own.
USER_FREQUENCY = 1024
# Characters of a word by which the first level of the lexicon's prefix tree is keyed.
HEAD = 3
# Long tokens are matched by pieces of so many characters, each with what its last words need beyond.
PIECE = 512
# Tokens of up to so many characters are worked on as one row each, with all their hits.
SHORT = 64


def merge_lexicon(lexicon: DataFrame, user_lexicon: DataFrame | None = None) -> DataFrame:
    """[word, nature, frequency] with one row per word; user words override, the largest code wins a repeat.

    ``frequency`` is that of the lexicon's rows for the word (1 for each row if there is no such column), and ``USER_FREQUENCY`` for user words.
    """
    frequency = F.col("frequency").cast("long") if "frequency" in lexicon.columns else F.lit(1).cast("long")
    ranked = lexicon.select("word", F.lit(0).alias("user"), "nature", frequency.alias("frequency"))
    if user_lexicon is not None:
        added = user_lexicon.select("word", F.lit(1).alias("user"), "nature", F.lit(USER_FREQUENCY).cast("long").alias("frequency"))
        ranked = ranked.unionByName(added)
    best = ranked.groupBy("word").agg(
        F.max(F.struct("user", "nature")).alias("best"), F.sum(F.when(F.col("user") == 0, F.col("frequency"))).alias("frequency")
    )
    own = F.when(F.col("best.user") == 1, F.lit(USER_FREQUENCY).cast("long")).otherwise(F.coalesce("frequency", F.lit(0).cast("long")))
    return best.select("word", F.col("best.nature").alias("nature"), own.alias("frequency"))


def tokens_with_nature(
    tokens: DataFrame, lexicon: DataFrame, user_lexicon: DataFrame | None = None, default: str = "x"
) -> DataFrame:
    """Tokens with the nature code of the lexicon, ``default`` for unknown ones.

    Of a lexicon that is too large to broadcast, only the words that occur take part: mostly few enough to be broadcast after all.
    """
    words, small = lookup_side(merge_lexicon(lexicon, user_lexicon).select(F.col("word").alias("token"), "nature"), "lookup", small=False)
    if small:
        joined = tokens.join(F.broadcast(words), "token", "left")
    else:
        counted = count_tokens(tokens)
        known = stage_sized(counted.select("token").join(words, "token"), "known_tokens")
        if known.small:
            joined = tokens.join(F.broadcast(known.df), "token", "left")
        else:
            joined = frequent_join(tokens, known.df, "token", "left", counted)
    return joined.select(*tokens.columns, F.coalesce("nature", F.lit(default)).alias("nature"))


def matches_in(distinct: DataFrame, words: DataFrame, small: bool) -> DataFrame:
    """[token, start, n, nature, ...]: every lexicon word at every place of the tokens of ``distinct`` [token].

    ``words`` [word, nature, ...] is searched as a prefix tree of two levels: a place is extended to 1, 2, .. ``HEAD`` characters, and
    only where words begin with these, to the lengths that such words have.
    """
    head = F.substring("word", 1, HEAD).alias("head")
    # Words of fewer characters are their own head, so under it stands no other length.
    heads = words.groupBy(head).agg(F.collect_set(F.length("word")).alias("lengths"))
    longest = words.agg(F.max(F.length("word"))).first()[0] or 0
    pieces = distinct.select(
        "token", F.length("token").alias("size"), F.explode(F.expr(f"sequence(0, greatest(0, length(token) - 1), {PIECE})")).alias("begin")
    ).withColumn("piece", F.expr(f"substring(token, begin + 1, {PIECE + longest})"))
    places = pieces.select("token", "size", "begin", "piece", F.explode(F.expr(f"sequence(0, least({PIECE}, length(piece)) - 1)")).alias("at"))
    extended = places.select("*", F.explode(F.expr(f"transform(sequence(1, least({HEAD}, length(piece) - at)), k -> substring(piece, at + 1, k))")).alias("head"))
    live = lookup_join(extended, heads, "head", "inner", small)
    grown = live.select("*", F.explode(F.filter("lengths", lambda n: F.col("at") + n <= F.length("piece"))).alias("n")).select(
        "token", (F.col("begin") + F.col("at")).alias("start"), "n", F.expr("substring(piece, at + 1, n)").alias("word")
    )
    return lookup_join(grown, words, "word", "inner", small)


def count_tokens(tokens: DataFrame) -> DataFrame:
    """[token, seen], staged: how often each token occurs."""
    return stage(tokens.where("token is not null").groupBy("token").agg(F.count(F.lit(1)).alias("seen")), "distinct_tokens")


def per_token(tokens: DataFrame, search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``tokens`` with the columns that ``search`` finds for its distinct tokens, one row for each; tokens without one are left out.

    A text repeats its tokens: each is searched once, and the counts of the same pass tell which tokens are frequent: these do not move for the join.
    """
    counted = count_tokens(tokens)
    found = stage_sized(search(counted.select("token")), "searched_tokens")
    if found.small:
        return tokens.join(F.broadcast(found.df), "token")
    return frequent_join(tokens, found.df, "token", "inner", counted)


def dealt_out(tokens: DataFrame) -> DataFrame:
    return tokens.repartition(int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions")), "token")


def hits_of(short: DataFrame, words: DataFrame, small: bool, *columns: str) -> DataFrame:
    """[token, hits]: each token of ``short`` [token] that has lexicon words, with [start, n, *columns] of all of them, ascending.

    The tokens are dealt out before they are searched: if the lexicon is broadcast, no hit moves.
    """
    found = matches_in(dealt_out(short) if small else short, words, small)
    return found.groupBy("token").agg(F.sort_array(F.collect_list(F.struct("start", "n", *columns))).alias("hits"))


def lexicon_matches(tokens: DataFrame, lexicon: DataFrame, user_lexicon: DataFrame | None = None) -> DataFrame:
    """[*columns of tokens, start, word, nature]: longest lexicon word at each place of a token.

    For scripts without blanks, where a token is a whole phrase. Distinct tokens are matched once. Matches may overlap; nothing is
    disambiguated: see ``segment_tokens``.
    """
    words, small = lookup_side(merge_lexicon(lexicon, user_lexicon).where(F.col("word") != "").select("word", "nature"), "lexicon", small=False)

    def longest(distinct: DataFrame) -> DataFrame:
        # Of the hits of a short token, those behind which another place follows.
        last = F.expr("filter(hits, (h, i) -> i = size(hits) - 1 or hits[i + 1].start > h.start)")
        whole = hits_of(distinct.where(F.length("token") <= SHORT), words, small, "word", "nature").withColumn("hits", last)
        short = whole.select("token", F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["word"].alias("word"), h["nature"].alias("nature"))).alias("__hits"))
        long = distinct.where(F.length("token") > SHORT)
        best = matches_in(long, words, small).groupBy("token", "start").agg(F.max(F.struct("n", "word", "nature")).alias("best"))
        # One row for each token: its hits are no more than its characters.
        hit = F.struct("start", F.col("best.word").alias("word"), F.col("best.nature").alias("nature"))
        return short.unionByName(best.groupBy("token").agg(F.collect_list(hit).alias("__hits")))

    return per_token(tokens, longest).select(*tokens.columns, F.inline("__hits"))


def segment_tokens(
    tokens: DataFrame, lexicon: DataFrame, user_lexicon: DataFrame | None = None, default: str = "x"
) -> DataFrame:
    """[*columns of tokens, part, start, word, nature]: each token cut into the words of its best path, ``part`` from 0.

    Every lexicon word found in a token is an edge of -ln(frequency / all frequencies), in millionths, rounded; every single character is one too, with code ``default``
    and the frequency 1/2 if it is no word. The path of least cost wins, then that of fewest words, then that whose words begin earliest, word by word.
    User words count with ``USER_FREQUENCY``. Frequencies below 1 count as 1/2. Empty and null tokens have no part.

    The best way to each place of a short token is kept while its edges are taken in order of their start. Long tokens are cut where no word
    reaches across, and each stretch between is searched by itself in the same way.
    """
    staged = stage_sized(merge_lexicon(lexicon, user_lexicon).where(F.col("word") != ""), "lexicon")
    total = staged.df.agg(F.sum(F.greatest("frequency", F.lit(1)))).first()[0] or 1
    cost = lambda f: F.round(F.log(F.lit(float(total)) / f) * 1_000_000).cast("long")
    unknown = cost(F.lit(0.5))
    known = F.when(F.col("frequency") < 1, unknown).otherwise(cost(F.col("frequency").cast("double")))
    words = staged.df.select("word", "nature", known.alias("cost"))

    def short_paths(distinct: DataFrame) -> DataFrame:
        hits = hits_of(distinct, words, staged.small, "cost", "nature")
        edges = F.coalesce(F.transform("hits", lambda h: edge(h["start"], h["n"], h["cost"], h["nature"])), F.array().cast(EDGES))
        each = (dealt_out(distinct) if staged.small else distinct).join(hits, "token", "left")
        # A character that is a word has the word's edge, which is never dearer.
        alone = F.filter(F.sequence(F.lit(0), F.length("token") - 1), lambda i: ~F.exists("edges", lambda e: (e["a"] == i) & (e["n"] == 1)))
        singles = F.transform(alone, lambda i: edge(i, F.lit(1), unknown, F.lit(default)))
        every = each.withColumn("edges", edges).select("token", "edges", F.sort_array(F.concat("edges", singles)).alias("every"))
        letters = F.transform("every", lambda e: F.struct(e["a"].alias("start"), e["n"].alias("n"), e["nature"].alias("nature")))
        best = F.transform(path_of(F.col("every")), lambda x: F.struct(x["a"].alias("start"), x["n"].alias("n"), x["nature"].alias("nature")))
        # Without a word of several characters there is only one path.
        return every.select("token", F.when(F.exists("edges", lambda e: e["n"] > 1), best).otherwise(letters).alias("__parts"))

    def long_paths(distinct: DataFrame) -> DataFrame:
        edges = matches_in(distinct, words, staged.small).select("token", "start", "n", "nature", "cost")
        each = F.explode(F.expr("sequence(0, length(token) - 1)")).alias("start")
        single = distinct.select("token", each, F.lit(1).alias("n"), F.lit(default).alias("nature"), unknown.alias("cost"))
        # A character that is a word has two edges of its own; the cheaper one counts, the word's if they are equal.
        both = edges.withColumn("known", F.lit(0)).unionByName(single.withColumn("known", F.lit(1)))
        ways = both.groupBy("token", "start", "n").agg(F.min(F.struct("cost", "known", "nature")).alias("way"))
        ways = ways.select("token", "start", "n", F.col("way.cost").alias("cost"), F.col("way.nature").alias("nature"))
        order = Window.partitionBy("token").orderBy("start")
        reached = F.max(F.col("start") + F.col("n")).over(order.rangeBetween(Window.unboundedPreceding, -1))
        cut = F.when(F.coalesce(reached, F.lit(0)) <= F.col("start"), F.col("start"))
        stretch = ways.withColumn("base", F.max(cut).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
        found = F.sort_array(F.collect_list(edge(F.col("start") - F.col("base"), F.col("n"), F.col("cost"), F.col("nature"))))
        gathered = stretch.groupBy("token", "base").agg(found.alias("edges")).select("token", "base", path_of(F.col("edges")).alias("path"))
        paths = gathered.groupBy("token").agg(F.sort_array(F.collect_list(F.struct("base", "path"))).alias("paths"))
        parts = F.transform("paths", lambda p: F.transform(p["path"], lambda x: F.struct((p["base"] + x["a"]).alias("start"), x["n"].alias("n"), x["nature"].alias("nature"))))
        return paths.select("token", F.flatten(parts).alias("__parts"))

    def best_path(distinct: DataFrame) -> DataFrame:
        short = short_paths(distinct.where(F.length("token").between(1, SHORT)))
        return short.unionByName(long_paths(distinct.where(F.length("token") > SHORT)))

    each = per_token(tokens, best_path).select(*tokens.columns, F.posexplode("__parts").alias("part", "__x"))
    word = F.expr("substring(token, __x.start + 1, __x.n)")
    return each.select(*tokens.columns, "part", F.col("__x.start").alias("start"), word.alias("word"), F.col("__x.nature").alias("nature"))


EDGES = "array<struct<a:int,n:int,cost:bigint,nature:string>>"


def edge(a: Column, n: Column, cost: Column, nature: Column) -> Column:
    return F.struct(a.alias("a"), n.alias("n"), cost.alias("cost"), nature.alias("nature"))


def path_of(edges: Column) -> Column:
    """The edges [a, n, nature] of the best path from 0 to the last place; ``edges`` [a, n, cost, nature] have each ``a`` and ``n`` once.

    A place's best is a structure whose order is that of the rules: cost, words, then where they begin. It is the least of what the
    edges that end there make of the best of their own beginnings, place by place.
    """
    kind = "struct<cost:bigint,words:int,starts:array<int>>"
    begin = F.struct(F.lit(0).cast("long").alias("cost"), F.lit(0).alias("words"), F.array().cast("array<int>").alias("starts")).cast(kind)

    def take(best: Column, place: Column) -> Column:
        def longer(e: Column) -> Column:
            here = F.get(best, e["a"])
            return F.struct(
                (here["cost"] + e["cost"]).alias("cost"), (here["words"] + 1).alias("words"), F.concat(here["starts"], F.array(e["a"])).alias("starts")
            )

        return F.concat(best, F.array(F.array_min(F.transform(F.filter(edges, lambda e: e["a"] + e["n"] == place), longer))))

    def path(best: Column) -> Column:
        starts = F.element_at(best, -1)["starts"]

        def part(a: Column, k: Column) -> Column:
            n = F.coalesce(F.get(starts, k + 1), F.size(best) - 1) - a
            nature = F.get(F.filter(edges, lambda e: (e["a"] == a) & (e["n"] == n)), F.lit(0))["nature"]
            return F.struct(a.alias("a"), n.alias("n"), nature.alias("nature"))

        return F.transform(starts, part)

    places = F.sequence(F.lit(1), F.array_max(F.transform(edges, lambda e: e["a"] + e["n"])))
    return F.aggregate(places, F.array(begin), take, path)


def drop_stopwords(tokens: DataFrame, stop: DataFrame) -> DataFrame:
    """Tokens that are not in ``stop`` [word]."""
    words = stop.select(F.col("word").alias("token")).distinct()
    return lookup_join(tokens, words, "token", "left_anti").select(*tokens.columns)
