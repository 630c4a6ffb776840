import random
from collections import Counter

import pytest
from brute import rule_counts
from pyspark.sql import functions as F

from lexgraph.llm import licenses, rules


def native(df) -> bool:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(name in plan for name in ("Python", "Pandas", "Arrow", "BroadcastNestedLoopJoin", "CartesianProduct"))


def test_counts_against_plain(spark):
    rng = random.Random(3)
    lines = [" ".join(rng.choices(["a", "b|", "#c", "dé", "e"], k=rng.randint(0, 9))) for _ in range(12)]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(0, 25))) for _ in range(120)] + ["x " * 5000, None, "", " \n\t\n"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    out = rules.judge(df)
    got = {r["doc_id"]: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in out.collect()}
    assert got == {i: rule_counts(t) for i, t in enumerate(texts)}
    for r in out.collect():
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_distance_is_that_of_the_definition(spark):
    import math

    p, q = [4, 0, 6], [1, 1, 2]
    df = spark.range(1).select(rules.js_distance(F.array(*[F.lit(x).cast("long") for x in p]), rules.fixed(q)).alias("d"))
    a, b = [x / 10 for x in p], [x / 4 for x in q]
    kl = lambda x, y: sum(u * math.log2(u / v) for u, v in zip(x, y) if u)
    m = [(u + v) / 2 for u, v in zip(a, b)]
    assert df.first()["d"] == pytest.approx(math.sqrt((kl(a, m) + kl(b, m)) / 2))


def test_verdict_and_guards(spark):
    rng = random.Random(4)
    prose = lambda n: " ".join(rng.choice([rng.choice(rules.COMMON_WORDS["en"].split()), f"word{'abcdefgh'[rng.randrange(8)] * rng.randrange(1, 9)}"]) for _ in range(n))
    rows = [(i, prose(120), "en") for i in range(40)]
    rows += [(100, " ".join(f"{rng.randrange(10**9)}###%%" for _ in range(100)), None), (101, prose(30), None), (102, prose(10), None)]
    got = {r["doc_id"]: r["kept"] for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i] for i in range(40)) and not got[100] and got[101] and not got[102]


def test_rules_odd_rows(odd, empty, odd_texts):
    out = rules.judge(odd)
    assert native(out)
    rows = out.collect()
    assert Counter((str(r["doc_id"]), r["n_words"]) for r in rows) == Counter((str(i), len((t or "").encode().split())) for i, t in odd_texts)
    assert rules.judge(empty).collect() == []


def files(spark, rows):
    return spark.createDataFrame(rows, "file_id long, path string, text string, score string, license string, notice string, directory string")


def scan(spark, rows):
    out = licenses.scan_licenses(files(spark, [(*r, "x", "x", "x", "x") for r in rows]))
    assert native(out)
    return {r["file_id"]: (r["license"], r["origin"], r["directory"]) for r in out.collect()}


def test_inheritance_from_the_nearest_directory(spark):
    mit, gpl = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0"]
    got = scan(spark, [
        (1, "a/LICENSE", mit), (2, "a/b/COPYING.txt", gpl + "\nmore of the text"), (3, "a/b/c/d.txt", "nothing"), (4, "a/x.txt", "nothing"),
        (5, "a/b/own.txt", "some prose\n# " + licenses.TEMPLATES["Apache-2.0"] + "\nmore"), (6, "z/q.txt", "nothing"), (7, "ab/q.txt", None),
        (8, None, mit), (9, None, None), (10, "a/b/c/e.txt", "copyright of nobody in particular and much else besides it"), (11, "", "x"),
    ])
    assert got[1] == ("MIT", "file", None) and got[2] == ("GPL-3.0", "file", None) and got[5] == ("Apache-2.0", "file", None)
    assert got[3] == got[10] == ("GPL-3.0", "directory", "a/b") and got[4] == ("MIT", "directory", "a")
    assert got[6] == got[7] == got[9] == got[11] == (None, "none", None) and got[8] == ("MIT", "file", None)


def test_root_license_and_repeats(spark):
    rows = [(1, "LICENSE.md", licenses.TEMPLATES["BSD-3-Clause"]), (2, "src/a.txt", "x"), (2, "src/a.txt", "x"), (3, "a.txt", "")]
    got = licenses.scan_licenses(files(spark, [(*r, "x", "x", "x", "x") for r in rows])).collect()
    assert len(got) == 4 and {r["license"] for r in got} == {"BSD-3-Clause"}
    assert scan(spark, [(1, "a/LICENSE", "no licence is named here at all, whatever the licence file may say")])[1][1] == "none"


def test_templates_find_themselves(spark):
    rows = [(i, f"d{i}/f.txt", text) for i, text in enumerate(licenses.TEMPLATES.values())]
    got = scan(spark, rows)
    assert [got[i][0] for i in range(len(rows))] == list(licenses.TEMPLATES)


def test_licenses_empty(spark):
    assert scan(spark, []) == {}


def test_full_texts_headers_and_tags(spark):
    import textwrap

    wrap = lambda text, sign="": "\n".join(sign + line for line in textwrap.wrap(text, 70))
    mit = "MIT License\n\nCopyright (c) 2020 Some One\n\n" + wrap(licenses.MIT_GRANT) + "\n\n" + wrap(licenses.MIT_REST)
    bsd = "Copyright (c) 2020, Some One\nAll rights reserved.\n\n" + wrap(licenses.BSD_GRANT) + "\n\n1. Redistributions of source code must retain the above copyright notice.\n"
    mpl, gnu = licenses.MORE[-1][1], licenses.GNU_HEADER
    got = scan(spark, [
        (1, "a/LICENSE", mit), (2, "b/LICENSE", "BSD 3-Clause License\n\n" + bsd), (3, "c/x.py", wrap(licenses.BSD_GRANT, "# ") + "\n\nimport x"),
        (4, "d/x.c", "// SPDX-License-Identifier: MIT\nint x;"), (5, "e/x.c", "/* SPDX-License-Identifier: GPL-3.0-or-later */\nint x;"),
        (6, "f/x.py", wrap(gnu.format("program", "", "3"), "# ") + "\n#\n# You have a copy.\n"), (7, "g/x.js", "/*\n" + wrap(mpl, " * ") + "\n */\ncode()"),
        (8, "h/COPYING", "GNU LESSER GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nmore"), (9, "a/y.txt", "no word of it"),
        (10, "i/x.c", "// SPDX-License-Identifier: Zlib\n"), (11, "j/x.c", "int x; // " + mit.replace("\n", "\r\n")),
    ])
    want = ["MIT", "BSD-3-Clause", "BSD-3-Clause", "MIT", "GPL-3.0", "GPL-3.0", "MPL-2.0", "LGPL-3.0", "MIT", None, "MIT"]
    assert [got[i][0] for i in range(1, 12)] == want and got[9][1] == "directory"


def test_versions_of_the_gnu_licenses(spark):
    title, header = licenses.GNU_TITLE, licenses.GNU_HEADER
    got = scan(spark, [
        (1, "a/LICENSE", title.format("", "2, June 1991", "1989, 1991")), (2, "b/LICENSE", title.format("", "3, 29 June 2007", "2007")),
        (3, "c/LICENSE", title.format("Lesser ", "2.1, February 1999", "1991, 1999")), (4, "d/x.c", "/* " + header.format("program", "", "2") + " */"),
        (5, "e/x.c", "# " + header.format("library", "Lesser ", "2.1")), (6, "f/x.c", "// SPDX-License-Identifier: LGPL-2.1-only"),
        (7, "g/x.c", licenses.TEMPLATES["GPL-2.0"]), (8, "h/x.c", licenses.TEMPLATES["LGPL-2.1"]),
    ])
    assert [got[i][0] for i in range(1, 9)] == ["GPL-2.0", "GPL-3.0", "LGPL-2.1", "GPL-2.0", "LGPL-2.1", "LGPL-2.1", "GPL-2.0", "LGPL-2.1"]


def test_very_long_license_file_and_odd_ids(spark):
    """A licence file of 100,000 different words costs its terms once; null and repeated ids are rows of their own."""
    long_text = licenses.TEMPLATES["MIT"] + "\n\n" + " ".join(f"w{i}" for i in range(100_000))
    rows = [(1, "a/LICENSE", long_text), (1, "a/LICENSE", long_text), (None, "a/x.txt", "nothing"), (None, "b/x.txt", None), (2, "a/LICENSE", "")]
    got = licenses.scan_licenses(files(spark, [(*r, "x", "x", "x", "x") for r in rows])).collect()
    assert len(got) == 5
    found = sorted((str(r["file_id"]), r["path"], r["license"], r["origin"]) for r in got)
    assert found == [
        ("1", "a/LICENSE", "MIT", "file"), ("1", "a/LICENSE", "MIT", "file"), ("2", "a/LICENSE", "MIT", "directory"), ("None", "a/x.txt", "MIT", "directory"),
        ("None", "b/x.txt", None, "none"),
    ]


def test_long_lines_belong_to_their_block(spark):
    """Comment signs and blank lines bound a block, not the length of its lines."""
    grant = "# " + licenses.BSD_GRANT[:60] + "\n# " + licenses.BSD_GRANT[60:] + " " + "x" * 130 + "\n\ncode()"
    assert scan(spark, [(1, "a/x.py", grant)])[1][0] == "BSD-3-Clause"


def test_equal_scores_go_to_the_smaller_name(spark):
    same = {"Zeta": "one common wording of a license", "Alpha": "one common wording of a license"}
    df = files(spark, [(1, "a/x.txt", "one common wording of a license", "x", "x", "x", "x")])
    assert licenses.scan_licenses(df, templates=same).first()["license"] == "Alpha"


def test_language_without_given_words(spark):
    """A fifth language is judged by the character classes of its own texts; noise in it falls."""
    import random

    rng = random.Random(7)
    letters = "абвгдежзиклмнопрст"
    prose = lambda: " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(80)).capitalize() + "."
    english = "the cat and the dog of the house is in it for that was on are with by this be at or from " * 2
    rows = [(i, prose(), "ru") for i in range(30)] + [(100, " ".join(str(rng.randrange(10**9)) + "#$%" for _ in range(80)), "ru")]
    rows += [(200 + i, f"{english} word{i} " + " ".join(f"some{j} thing{i + j}" for j in range(30)), "en") for i in range(5)] + [(300, prose(), None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, own_classes string")
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in rules.judge(df).collect()}
    assert all(got[i] == (False, True) for i in range(30))
    assert got[100] == (False, False) and got[300] == (False, False)
