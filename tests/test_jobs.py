"""All jobs in order over one small dump, with the tables read back."""

from lexgraph.plans.jobs import JOBS

HTML = (
    '<html><head><meta name="keywords" content="{kw}"></head><body><input id="query" value="{w}">'
    '<div class="lemmaWgt-lemmaCatalog"><a href="#1">历史</a></div>{links}{tags}</body></html>'
)


def page(word, links, tags, kw):
    shown = "".join(f'<a href="/item/{w}">{w}</a>' for w in links)
    return word + "\x01" + HTML.format(
        w=word, kw=kw, links=shown, tags="".join(f'<span class="taglist">{t}</span>' for t in tags)
    )


def test_jobs(spark, tmp_path):
    dump = tmp_path / "dump"
    dump.mkdir()
    lines = [page(f"term{i}", ["a", "term1", "term2"], ["人物", "历史"] if i % 2 else ["人物"], f"term{i} alias{i} term{i}历史") for i in range(30)]
    (dump / "part").write_text("\n".join(lines + ["lonely", ""]), encoding="utf-8")
    classes = tmp_path / "classes"
    classes.write_text("人物 0\n历史 1\n", encoding="utf-8")

    def run(job, **args):
        JOBS[job](spark, **args)

    def rows(table, *columns):
        return sorted(tuple(r) for r in spark.table(table).select(*columns or "*").collect())

    names = "pages terms clean pairs term_layers classified related natures keywords synos".split()
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    run("ingest_pages", src=str(dump), table="pages", dt="20170612")
    assert len(rows("pages")) == 31
    assert ("lonely", "none", 20170612) in rows("pages")
    run("parse_terms", src=str(dump), table="terms", dt="20170612")
    assert rows("terms")[0] == ("lonely", "none", "none", 20170612)
    assert rows("terms")[2] == ("term1", "a,term1,term2", "人物,历史", 20170612)
    run("filter_terms", src="terms", table="clean")
    assert len(rows("clean")) == 30
    run("count_tag_pairs", src="terms", table="pairs", dt="20170612")
    assert rows("pairs") == [("历史", "人物", 15, 30, 15, 20170612)]
    run("layer_tags", src="pairs", out=str(tmp_path / "layers"), thres="0.9", stat_date="20170612")
    text = {d: sorted(r.value for r in spark.read.text(f"{tmp_path}/layers/{d}").collect()) for d in ("ori", "res", "layer", "multilayer")}
    assert text == {
        "ori": ["历史>人物"], "res": ["历史>人物"], "layer": ["人物 0", "历史 1"], "multilayer": ["人物", "人物>历史"],
    }
    run("layer_terms", paths=f"{tmp_path}/layers/multilayer", src="clean", table="term_layers", dt="20170612")
    assert ("term1", "人物,历史", "历史", "人物-历史", "", "历史/2,人物/1", 20170612) in rows("term_layers")
    run("classify_related", classes=str(classes), src="terms", table="related", dt="20170612", debug_table="classified")
    assert ("term5", "a,term1,term2", "0", 20170612) in rows("classified")
    assert ("term5", 0, 0, "term2/1,term1/1", 20170612) in rows("related")
    assert ("term5", 0, -1, "a/1", 20170612) in rows("related")
    run("label_natures", src="terms", table="natures")
    assert ("term1", "人物,历史", "mznr", "5") in rows("natures")
    run("parse_keywords", src="pages", table="keywords", outdt="20170613")
    assert ("term1", "term1", "term1 alias1 term1历史", "历史", 20170613) in rows("keywords")
    run("mine_synonyms", src="keywords", table="synos", dt="20170613", outdt="20170614")
    assert ("term1", "term1", "alias1", "历史", "term1 alias1 term1历史", 20170614) in rows("synos")
    for name in names:
        spark.sql(f"DROP TABLE {name}")
