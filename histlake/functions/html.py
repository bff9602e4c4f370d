"""Elements of HTML pages by a tokeniser, as column expressions.

A page becomes an array of tokens (tags, comments, texts), over which one fold walks with a
small state.  Tags are recognised as a parser does it: any case, attributes in double,
single or no quotes, ``>`` inside quotes, markup nested in an element's text.  The contents of
scripts and styles are not markup.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A script or style with its contents, a comment, a tag, or text up to the next one.
TOKEN = (r"(?is)<(?:script|style)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?</(?:script|style)\s*>|<!--.*?-->"
         r"|</?[a-z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|<![^>]*>|[^<]++|<")
#: A name, and its value in double, single or no quotes.
ATTRIBUTE = r"""[^\s"'<>/=]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""


def tokens(html: Column) -> Column:
    """All tokens in order; a null page has none."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(TOKEN), F.lit(0))


def tag_name(token: Column) -> Column:
    """Lower-case name of a tag, with ``/`` before it if it closes; empty for other tokens."""
    return F.lower(F.regexp_extract(token, r"^<(/?[a-zA-Z][^\s/>]*)", 1))


def attribute(tag: Column, name: str) -> Column:
    """Value of the first attribute of that name in a tag; null if there is none."""
    pairs = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0))
    own = F.filter(pairs, lambda p: F.lower(F.regexp_extract(p, r"^[^\s=]+", 0)) == name)
    value = F.regexp_replace(F.get(own, 0), r"^[^=]*=\s*", "")
    return F.when(value.rlike(r"^[\"']"), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def elements(html: Column, tag: str, within: str | None = None, within_id: str | None = None) -> Column:
    """array<struct<tag, text>> of the elements ``tag`` in order: the opening tag (see
    ``attribute``) and the text in it, tags left out, references as they are.

    An element ends with its closing tag, the next ``tag`` or the end of what it is in.
    ``within`` and ``within_id``: only inside the first element of that name and id."""
    one = lambda t: F.struct(tag_name(t).alias("name"), t.alias("token"))
    walk = F.transform(tokens(html), one)
    start = F.struct(F.lit(within is None).alias("inside"), F.lit(False).alias("past"), F.lit(None).cast("string").alias("tag"), F.lit("").alias("text"),
                     F.array().cast("array<struct<tag:string,text:string>>").alias("found"))

    def step(s: Column, t: Column) -> Column:
        leaves = F.lit(False) if within is None else s["inside"] & (t["name"] == f"/{within}")
        enters = F.lit(False) if within is None else ~s["inside"] & ~s["past"] & (t["name"] == within) & (
            F.lit(True) if within_id is None else F.coalesce(attribute(t["token"], "id") == within_id, F.lit(False)))
        opens = s["inside"] & (t["name"] == tag)
        ends = s["tag"].isNotNull() & (opens | leaves | (t["name"] == f"/{tag}"))
        is_text = (t["name"] == "") & ~t["token"].rlike(r"^<[!/a-zA-Z]")
        return F.struct(
            ((s["inside"] | enters) & ~leaves).alias("inside"), (s["past"] | leaves).alias("past"),
            F.when(opens, t["token"]).when(~ends, s["tag"]).alias("tag"),
            F.when(opens | ends, F.lit("")).when(s["tag"].isNotNull() & is_text, F.concat(s["text"], t["token"])).otherwise(s["text"]).alias("text"),
            F.when(ends, F.array_append(s["found"], F.struct(s["tag"].alias("tag"), s["text"].alias("text")))).otherwise(s["found"]).alias("found"))

    def close(s: Column) -> Column:
        return F.when(s["tag"].isNotNull(), F.array_append(s["found"], F.struct(s["tag"].alias("tag"), s["text"].alias("text")))).otherwise(s["found"])

    return F.aggregate(walk, start, step, close)
