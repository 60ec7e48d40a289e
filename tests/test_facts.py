from html.parser import HTMLParser

from parcelmatch.operators.facts import geocode_match, labelled_texts, miss_share, page_facts, page_texts
from parcelmatch.plans.views import table


class Shown(HTMLParser):
    """Shown texts by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.texts, self.held, self.hidden = [], "", 0

    def flush(self):
        if self.held.strip():
            self.texts.append(self.held.strip())
        self.held = ""

    def handle_starttag(self, tag, attrs):
        self.flush()
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.flush()
        self.hidden -= tag in ("script", "style") and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.held += data

    def handle_entityref(self, name):
        self.held += f"&{name};"

    def handle_charref(self, name):
        self.held += f"&#{name};"


def test_no_shown_character_is_lost(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    got = {}
    for r in page_texts(pages).orderBy("page_id", "seq").collect():
        got.setdefault(r["page_id"], []).append(r["child"])
    for page, html in pages.select("page_id", "html").collect():
        parser = Shown()
        parser.feed(html)
        parser.close()
        parser.flush()
        joined = "".join("".join(parser.texts).split())
        assert "".join("".join(got.get(page, [])).split()) == joined, page


def rows(spark, html):
    found = page_texts(spark.createDataFrame([(1, html)], "page_id bigint, html string"))
    return [(r["element"], r["above"], r["before"], r["child"]) for r in found.orderBy("seq").collect()]


def test_enclosing_elements_and_the_text_before(spark):
    html = """<html><body>top<ul><li><span class="a>b">Year built:</span><span>1990</span><li>Beds:<br>3</ul>
      <!-- <p>no</p> --><script>var t = "</p>";</script><STYLE>p{}</STYLE></table><p>a <b>bold</b> 1 < 2</p>end"""
    assert rows(spark, html) == [
        ("body", "html", None, "top"), ("span", "li", None, "Year built:"), ("span", "li", "Year built:", "1990"), ("li", "li", "1990", "Beds:"), ("li", "li", "Beds:", "3"),
        ("p", "body", "3", "a"), ("b", "p", "a", "bold"), ("p", "body", "bold", "1 < 2"), ("body", "html", "1 < 2", "end"),
    ]
    assert rows(spark, None) == rows(spark, "") == rows(spark, "<p> </p>") == []
    assert rows(spark, "bare") == [("", "", None, "bare")] and rows(spark, "x<script>never closed") == [("", "", None, "x")]
    deep = "<i>" * 20_000 + "deep" + "</i>" * 20_000 + "out"
    assert [r[3] for r in rows(spark, deep)] == ["deep", "out"]


def test_labels(spark):
    html = "<div>Year built: <b>1990</b></div><div>Type:<b>House</b></div><p>p</p><i>x:</i><i>x</i>"
    texts = page_texts(spark.createDataFrame([(1, html)], "page_id bigint, html string"))
    assert page_facts(labelled_texts(texts)).first()["facts"] == {
        "<div>": ["year built:", "type:"], "yearbuilt": ["1990"], "type": ["house"], "<>": ["p"], "<i>": ["x:", "x"],
    }


def test_addresses_match_in_other_spelling_and_order(spark):
    places = [("12 Oak Hill Rd, Austin, TX 78701", 1.0, 2.0, 1), ("12 Oak Hill Rd apt 3, Austin, TX 78701", 3.0, 4.0, 2), ("12 Elm St 78701", 5.0, 6.0, 3), ("12 OAK HILL RD 78701", 7.0, 8.0, 4), ("no number", 9.0, 9.0, 5)]
    typed = ["12 oak hil rd 78701-0001", "Hill Rd Oak 12, 78701", "12 Oak Hill Rd #3 Austin TX 78701", "12 Oak Hill Rd Unit 9 78701", "12 Elm St 78702", "13 Elm St 78701", "12 Elk St 78701", None, ""]
    got = geocode_match(
        spark.createDataFrame(list(enumerate(typed)), "i int, address string"), spark.createDataFrame(places, "address string, lat double, lng double, seq int"), "i", ["seq"], ("AUSTIN", "TX")
    )
    found = {r["i"]: (r["lat"], r["edits"]) for r in got.collect()}
    assert found == {0: (1.0, 1), 1: (1.0, 0), 2: (3.0, 0), 3: (1.0, 0), 4: (0.0, None), 5: (0.0, None), 6: (5.0, 1), 7: (0.0, None), 8: (0.0, None)}
    assert tuple(miss_share(got).first()) == (9, 4 / 9)


def test_addresses_are_parsed_by_several_tasks(spark, monkeypatch):
    from parcelmatch.operators import facts

    tasks = {}

    def staged(df, label):
        tasks[label] = df.rdd.getNumPartitions()
        return facts_staged(df, label)

    facts_staged = facts.staged
    monkeypatch.setattr(facts, "staged", staged)
    typed = spark.createDataFrame([(i, f"{i} Oak Hill Rd 78701") for i in range(40)], "i int, address string").coalesce(1)  # one small file is one task
    places = typed.selectExpr("address", "1D AS lat", "2D AS lng")
    assert geocode_match(typed, places, "i").where("edits = 0").count() == 40
    assert tasks["parsed-addresses"] >= 4
