from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from folioflow.functions import html as H
from folioflow.functions import records as R
from folioflow.functions import text as X
from folioflow.functions.dom import parse
from folioflow.functions.wikitext import tokens
from folioflow.operators import aggregates as G


def one(spark, column, **values):
    kinds = {k: v for k, v in values.items()}
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in kinds.items()]).select(column).first()[0]


@pytest.mark.parametrize(("cur", "prev", "n"), [("aaaa", "abcd", 4), ("AAAA", "abcd", 4), ("aAaA", "abcd", 4), ("aaaa", "", 4), ("abcd", "aaaa", 1), ("abcd", "aAaAbc", 1), ("", "test", 1), ("aaaa", "aaaa", 1), ("", "", 1)])
def test_longest_new_run(spark, cur, prev, n):
    assert one(spark, X.longest_new_repeat(F.col("c"), F.col("p")), c=cur, p=prev) == n


def test_small_functions(spark):
    assert one(spark, X.longest_repeat(F.col("t")), t="aab") == 2 and one(spark, X.longest_repeat(F.col("t")), t="abc") == 0
    assert one(spark, X.diff_size(F.col("a"), F.col("b")), a="current wikitext value", b="previous wikitext") == 5
    assert one(spark, X.title(F.col("t")), t="./A_b%20c") == "A b c" and one(spark, X.title(F.col("t")), t="./A%zz") == "A%zz"
    assert one(spark, X.full_url(F.col("t"), F.lit("https://h/")), t="./A%zz") == ""
    assert one(spark, X.hash_path(F.col("t")), t="Earth") == "5/5c/Earth"
    assert [one(spark, X.backoff(F.lit(n))) for n in range(4)] == [1, 2, 4, 8]
    assert one(spark, X.last_revised(F.col("t")), t="2023-11-05T01:02:03Z") == "11/23" and one(spark, X.last_revised(F.col("t")), t="x") == "01/01"
    assert one(spark, X.bounded(F.lit(5), 3, F.lit(True))) == ">3" and one(spark, X.bounded(F.lit(2), 3, F.lit(False))) == ">2"
    assert one(spark, X.compacted_topic(F.lit("p"), F.lit(6))) == "local.structured-data.p-files-compacted.v1"
    assert one(spark, X.compacted_topic(F.lit("p"), F.lit(3))) is None
    flags = one(spark, R.editor_flags(F.array(F.lit("sysop"), F.lit("autoreview"))))
    assert (flags.is_bot, flags.is_admin, flags.is_patroller, flags.has_advanced_rights) == (False, True, True, False)
    assert one(spark, X.between_hours(F.lit(datetime.datetime(2024, 1, 1, 2)), F.lit(datetime.datetime(2024, 1, 1, 1)), 1)) is True
    assert one(spark, X.redirect_revision(F.lit("https://x/Special:Redirect/revision/42"), F.lit(42))) is True


@pytest.mark.parametrize(("text", "n"), [("{{update|}} {{update|}}", 2), ("{{Update|}} {{updated}", 1), ("{{update|reason=test|date=November 2023}} and {{Update|}} {{Update}}", 3), ("{{updated}", 0), ("{updated|}", 0), ("{{}}", 0)])
def test_maintenance(spark, text, n):
    assert one(spark, X.maintenance_tags(F.col("t")), t=text).update_count == n


def test_delta(spark):
    df = spark.createDataFrame([(1, "apple cat shoes cat apple apple viking".split(), "apple shoes shoes viking viking".split()), (2, [], [])], "id int, p array<string>, c array<string>")
    a, b = G.deltas(df, ["id"], "p", "c").orderBy("id").collect()
    assert (a.increase, a.decrease, a["sum"], a.proportional_increase) == (2, -4, -2, 1) and abs(a.proportional_decrease + 5 / 3) < 1e-9
    assert (b.increase, b["sum"]) == (0, 0)


def words(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(tokens(F.col("t"))).first()[0]


def test_words(spark):
    text = "That's that :: :) > n95 Latin. follows 3rd: 2nd m80.\nwe'll follows: https://en.host.org/a/English total- \\\"Oh\\\" 43 هذا هو :: ありがとうございます この項目では、をご覧ください。"
    assert words(spark, text) == ["That's", "that", "n95", "Latin", "follows", "3rd", "2nd", "m80", "we'll", "follows", "total", "Oh", "هذا", "هو", "ありがとうございます", "この項目では", "をご覧ください"]
    assert words(spark, '<ref name="x">William J.</ref> [[File:Coca-5cents edit1.jpg|thumb]]') == ["William", "J", "File", "Coca", "5cents", "edit1", "jpg", "thumb"]
    assert words(spark, None) == [] and words(spark, "") == []


PAGE = """<html><head><base href="//en.host/wiki/"></head><body>
<section data-mw-section-id="0"><p>Water (or <i>aqua</i>) is <a href="./Wet">wet</a>.<sup class="mw-ref">[1]</sup></p><ul><li>One<ul><li>Two</li></ul></li></ul>
<table class="infobox"><caption>Water</caption><tr><th>Facts</th></tr><tr><th>Boils</th><td>100</td></tr><tr><th>Kinds</th><td><ul><li>Ice</li><li>Steam</li></ul></td></tr><tr><td><img src="//i/w.png" width="10" height="20"></td></tr></table>
<span data-mw='{"parts":[{"template":{"target":{"wt":"T","href":"./Template:Some_T"}}}]}'></span></section>
<section><h2 id="Use">Use</h2><p>Drink <a href="//x.org/a">it</a>.</p><section><h3>Deep</h3><p>Inner.</p></section><section><h3>Empty</h3></section></section>
<section><h2 id="References">References</h2><ol class="references"><li id="r1"><span class="mw-reference-text">Book <a href="https://b/">b</a></span></li></ol></section>
<link rel="mw:PageProp/Category" href="./Category:Wet_things#k"></body></html>"""


def test_html_parts():
    root = parse(PAGE)
    assert H.base_url(root) == "https://en.host/wiki/"
    assert H.abstract(root) == "Water is wet.\n- One\n  - Two"
    assert H.templates(root) == [{"name": "Template:Some T", "url": "https://en.host/wiki/Template:Some_T"}]
    assert H.categories(root) == [{"name": "Category:Wet things", "url": "https://en.host/wiki/Category:Wet_things"}]
    (box,) = H.infoboxes(root)
    facts = box["has_parts"][0]
    assert box["name"] == "Water" and facts["name"] == "Facts" and [p["type"] for p in facts["has_parts"]] == ["field", "list", "image"]
    assert facts["has_parts"][1]["values"] == ["Ice", "Steam"]
    top = H.sections(root)
    assert [s["name"] for s in top] == ["Abstract", "Use"] and [p.get("name") for p in top[1]["has_parts"]] == [None, "Deep"]
    (ref,) = H.references(root)
    assert ref["text"] == "Book b" and ref["index"] == 1 and ref["links"][0]["url"] == "https://b/"
    (image,) = H.images(root)
    assert image["height"] == 20 and H.images(root, compat=True)[0]["height"] == 10
    assert {x["url"] for x in H.links(root)} == {"https://en.host/wiki/Wet", "https://x.org/a", "https://b/"}


def test_html_extremes(spark):
    assert H.superscripts(parse("<p>x<sup>21</sup></p>")).content() == "x²¹"
    assert H.superscripts(parse("<p>x<sup>2</sup></p>"), compat=True).content() == "x⁲"
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<p>open <b>never <li>closed"), (4, "<a>" * 400 + "x")], "id int, html string")
    rows = df.select("id", H.html_parts(F.col("html")).alias("p")).orderBy("id").collect()
    assert [r.p.text for r in rows] == ["", "", "open never closed", "x"]
