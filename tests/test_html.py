"""Elements by the tokeniser, against Python's HTML parser."""

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from histlake.functions.html import attribute, elements
from histlake.functions.text import select_options, unescape_html


class Plain(HTMLParser):
    """Texts and hrefs of ``tag`` (inside the first ``within`` of that id), references as they are."""

    def __init__(self, tag, within=None, within_id=None):
        super().__init__(convert_charrefs=False)
        self.tag, self.within, self.id = tag, within, within_id
        self.inside, self.past, self.now, self.found = within is None, False, None, []

    def end(self):
        if self.now is not None:
            self.found.append(tuple(self.now))
        self.now = None

    def handle_starttag(self, tag, attrs):
        if self.within and tag == self.within and not self.inside and not self.past and dict(reversed(attrs)).get("id") == self.id:
            self.inside = True
        if tag == self.tag and self.inside:
            self.end()
            self.now = [dict(reversed(attrs)).get("href"), ""]

    def handle_endtag(self, tag):
        if tag == self.tag:
            self.end()
        if self.within and tag == self.within and self.inside:
            self.end()
            self.inside, self.past = False, True

    def handle_data(self, data):
        if self.now is not None and not self.cdata_elem:
            self.now[1] += data

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")


def plain(html, *args):
    p = Plain(*args)
    p.feed(html)
    p.close()
    p.end()
    return p.found


PIECES = ["<option>", "<OPTION value='1'>", '<option title="a>b" href="/x">', "<option href=/y?q=1 selected>", "</option>", "</Option >", "one", " two ", "&aacute;",
          "<b>", "</b>", "<br/>", "<!-- <option>no</option> -->", "<script>var t='<option>';</script>", "<style>option{}</style>", "<select id=\"other\">",
          "<select class='c' ID='list'>", "<SELECT id=list name=\"n\">", "</select>", "</SELECT>", "\n", "<p title='id=\"list\"'>", "&#243;", "<option\n href = '/z'\n>"]


def test_any_markup_equals_the_parser(spark):
    r = random.Random(11)
    pages = ["".join(r.choice(PIECES) for _ in range(r.randrange(1, 25))) for _ in range(400)] + [""]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "id int, html string").repartition(4)
    for args in (("option",), ("option", "select", "list")):
        got = df.select("id", F.transform(elements(F.col("html"), *args), lambda e: F.struct(attribute(e["tag"], "href").alias("h"), e["text"])).alias("f"))
        for row in got.collect():
            assert [tuple(e) for e in row.f] == plain(pages[row.id], *args), pages[row.id]


def test_whole_pages_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = df.select("html", F.transform(elements(F.col("html"), "a"), lambda e: F.struct(attribute(e["tag"], "href").alias("h"), e["text"])).alias("f"))
    rows = got.collect()
    assert rows and all([tuple(e) for e in r.f] == plain(r.html or "", "a") for r in rows)


def test_options_and_null_pages(spark):
    html = "<Select Id = 'lista'><option>Seleccione<option>Uno <b>dos</b></OPTION><option>a &#0000243;</select><option>out"
    df = spark.createDataFrame([(html,), (None,), ("<select id=x><option>y</select>",)], "h string")
    assert [r[0] for r in df.select(select_options(F.col("h"), "lista")).collect()] == [["Uno dos", "a ó"], [], []]


def test_long_tags_and_references(spark):
    df = spark.createDataFrame([("<a href='" + "x" * 200_000 + "'>t</a>" + "<a>" * 2000,)], "h string")
    r = df.select(elements(F.col("h"), "a").alias("e")).first().e
    assert len(r) == 2001 and r[0].text == "t"
    assert spark.range(1).select(unescape_html(F.lit("&#x000000F1;&#X41;&lt;"))).first()[0] == "ñA<"


def test_options_of_a_small_file_are_found_by_many_tasks(spark):
    """The pages of a file of one row group are spread before they are taken apart."""
    from histlake.plans import registry
    from histlake.session import scratch_dir
    folder = scratch_dir(spark, "one_group")
    spark.range(500).selectExpr("id AS c_custkey", "'Customer#' || id AS c_name", "'BUILDING' AS c_mktsegment").coalesce(1).write.parquet(f"{folder}/customer.parquet")
    found = registry.QUERIES["drop_down_options"](spark, folder)
    parts = found.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) > 1 and sum(r["count"] for r in parts) == 1000
