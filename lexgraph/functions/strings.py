"""String rules of the crawled lists, as native Column expressions.

Input fields are hand-joined lists ("a,b,c", "a/b"). Their rules differ from Spark's
``trim`` and ``split``: trimming removes every character up to U+0020, and splitting drops
trailing empty items but keeps leading and inner ones. Every expression here is a plain
string function, so it stays inside whole-stage code generation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTROL_AND_SPACE = "".join(map(chr, range(0x21)))


def jtrim(c: Column) -> Column:
    """Strip all characters up to U+0020 from both ends."""
    return F.btrim(c, F.lit(CONTROL_AND_SPACE))


def jsplit(c: Column, seps: str = ",", run: bool = False) -> Column:
    """Split on any character of ``seps`` (or on runs of them), dropping trailing empty items.

    ``""`` gives ``[""]``; a string of separators only gives ``[]``.
    """
    pattern = "[" + re.escape(seps) + "]" + ("+" if run else "")
    body = F.rtrim(c, F.lit(seps))
    nothing = F.array().cast("array<string>")
    return (
        F.when(c == "", F.array(F.lit("")))
        .when(body == "", nothing)
        .otherwise(F.split(body, pattern))
    )


def base_term(c: Column) -> Column:
    """Part before the first ``/``; a string of slashes only stays as it is."""
    only_slashes = (c != "") & (F.rtrim(c, F.lit("/")) == "")
    return F.when(only_slashes, c).otherwise(F.substring_index(c, "/", 1))


def squeeze_csv(c: Column) -> Column:
    """Remove the empty items of a comma list that is still one string."""
    return F.btrim(F.regexp_replace(c, ",{2,}", ","), F.lit(","))


def clean_csv(c: Column) -> Column:
    """Drop items that are empty or start with ``/`` and reduce the others to their base term.

    Cutting every ``/...`` tail turns items that start with a slash into empty ones, so one
    replacement and one squeeze cover both rules without building an array.
    """
    return squeeze_csv(F.regexp_replace(c, "/[^,]*", ""))


def at_least(csv: Column, n: int) -> Column:
    """True if a comma list has ``n`` or more items that are not empty; reads no further than those."""
    return csv.rlike(r"\A,*+" + "[^,]++,++" * (n - 1) + "[^,]") if n > 0 else F.lit(True)


def csv_size(squeezed: Column) -> Column:
    """Number of items of a squeezed comma list, from byte lengths."""
    without = F.replace(squeezed, F.lit(","), F.lit(""))
    return F.octet_length(squeezed) - F.octet_length(without) + (squeezed != "").cast("int")


def csv_items(squeezed: Column) -> Column:
    """Array form of a squeezed comma list (empty string: empty array)."""
    nothing = F.array().cast("array<string>")
    return F.when(squeezed == "", nothing).otherwise(F.split(squeezed, ","))


def run_ends(ordered: Column) -> Column:
    """End positions (from 1) of the runs of equal items of a sorted array column."""
    places = F.sequence(F.lit(1), F.size(ordered))
    # Beyond either end of the array there is null, so the last item ends a run and an empty array has none.
    return F.filter(places, lambda e: ~F.get(ordered, e).eqNullSafe(F.get(ordered, e - 1)))


def run_counts(ordered: Column, ends: Column) -> Column:
    """[(item, n)] of the distinct items of a sorted array column, counted inside the row.

    ``ends`` is ``run_ends`` as a column of its own: it is looked at once per run.
    """

    def run(e: Column, k: Column) -> Column:
        before = F.coalesce(F.get(ends, k - 1), F.lit(0))
        return F.struct(F.get(ordered, e - 1).alias("item"), (e - before).cast("long").alias("n"))

    return F.transform(ends, run)


def replace_each(c: Column, items: Column, by: str = " ") -> Column:
    """Replace every item of a per-row list, in list order; empty items change nothing."""
    return F.aggregate(items, c, lambda acc, w: F.replace(acc, w, F.lit(by)))


def longest_first(items: Column) -> Column:
    """Items by falling length; items of equal length keep their order."""
    keyed = F.transform(items, lambda w, i: F.struct((-F.length(w)).alias("k"), i.alias("i"), w.alias("w")))
    return F.transform(F.sort_array(keyed), lambda s: s["w"])
