"""Markdown as HTML: headings, paragraphs, lists, tables, rules, emphasis, code, links and escapes, as one expression on a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Signs that a backslash takes the meaning from, and what stands for each until the text is made.
ESCAPED = {sign: chr(0xE000 + k) for k, sign in enumerate("\\`*[]()|#-+._!>")}
ROW, RULER = r"^\|.*\|$", r"^\|(?:\s*:?-+:?\s*\|)+$"


def escaped(c: Column) -> Column:
    """Ampersands that begin no entity, and angle brackets, as entities."""
    c = F.regexp_replace(c, r"&(?!#?[A-Za-z0-9]+;)", "&amp;")
    return F.replace(F.replace(c, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def emphasised(c: Column) -> Column:
    """Links, strong and emphasised text of a line outside code; line breaks written as <br> stay."""
    c = F.regexp_replace(escaped(c), r"&lt;br\s*/?&gt;", "<br>")
    c = F.regexp_replace(c, r"!\[([^\]]*)\]\(([^()\s\"]+)\)", '<img alt="$1" src="$2">')
    c = F.regexp_replace(c, r"\[([^\]]+)\]\(([^()\s\"]+)\)", '<a href="$2">$1</a>')
    c = F.regexp_replace(c, r"\*\*(?=\S)([^*]+?)(?<=\S)\*\*", "<strong>$1</strong>")
    return F.regexp_replace(c, r"\*(?=\S)([^*]+?)(?<=\S)\*", "<em>$1</em>")


def inline(c: Column) -> Column:
    """A line's text: code between backticks as it stands, the rest with its emphasis."""
    pieces = F.split(c, "`", -1)
    code = lambda k: (k % 2 == 1) & (k < F.size(pieces) - 1)  # a last backtick without another is itself
    made = F.transform(pieces, lambda s, k: F.when(code(k), F.concat(F.lit("<code>"), escaped(s), F.lit("</code>"))).otherwise(F.concat(F.when((k % 2 == 1) & ~code(k), "`").otherwise(""), emphasised(s))))
    return _restored(F.array_join(made, ""))


def _restored(c: Column) -> Column:
    """The signs that were escaped; an angle bracket as its entity."""
    plain = {mark: sign for sign, mark in ESCAPED.items() if sign != ">"}
    return F.replace(F.translate(c, "".join(plain), "".join(plain.values())), F.lit(ESCAPED[">"]), F.lit("&gt;"))


def kind_of(line: Column) -> Column:
    """What a line is: h1 to h6, rule, ruler (below a table's head), row, ul, ol, html, blank or p."""
    level = F.length(F.regexp_extract(line, r"^(#{1,6})\s", 1)).cast("string")
    return (
        F.when(line == "", "blank").when(line.rlike(r"^#{1,6}\s"), F.concat(F.lit("h"), level)).when(line.rlike(r"^(?:-\s*){3,}$|^(?:\*\s*){3,}$"), "rule").when(line.rlike(RULER), "ruler").when(line.rlike(ROW), "row")
        .when(line.rlike(r"^[-*+]\s"), "ul").when(line.rlike(r"^[0-9]{1,9}[.)]\s"), "ol").when(line.rlike(r"^</?(?:div|p|hr|br|figure|section|header|footer|center)\b[^>]*>$"), "html").otherwise("p")
    )


def to_html(c: Column) -> Column:
    """A document's blocks as HTML, one to a line.

    Lines are read each by itself and beside their neighbours: a run of plain lines is a paragraph, of marked ones a list, of rows
    a table, whose first row is its head if a ruler stands below it. Lists aren't nested, and a blank line ends one. Signs after a
    backslash are themselves. Other markup in the text is shown, not obeyed, but for lines that are one tag of a block.
    """
    marked = F.regexp_replace(c, r"\r\n?", "\n")
    for sign, mark in ESCAPED.items():
        marked = F.replace(marked, F.lit("\\" + sign), F.lit(mark))
    return F.transform(F.array(marked), _blocks)[0]


def _blocks(text: Column) -> Column:
    lines = F.transform(F.split(text, "\n"), lambda s: F.trim(s))
    return F.transform(F.array(F.struct(lines.alias("lines"), F.transform(lines, kind_of).alias("kinds"))), _joined)[0]


def _joined(doc: Column) -> Column:
    lines, kinds = doc["lines"], doc["kinds"]
    kind = lambda k: F.coalesce(F.get(kinds, k), F.lit("blank"))
    cells = lambda s, tag: F.array_join(F.transform(F.split(F.regexp_replace(s, r"^\||\|$", ""), r"\|", -1), lambda x: F.concat(F.lit(f"<{tag}>"), inline(F.trim(x)), F.lit(f"</{tag}>"))), "")

    def line(s: Column, k: Column) -> Column:
        own, before, after = kind(k), kind(k - 1), kind(k + 1)
        opens = lambda *like: ~before.isin(*like)
        closes = lambda *like: ~after.isin(*like)
        tag = lambda test, text: F.when(test, F.lit(text)).otherwise("")
        head = (own == "row") & (after == "ruler")
        body = F.when(head, F.concat(F.lit("<thead><tr>"), cells(s, "th"), F.lit("</tr></thead>"))).otherwise(F.concat(F.lit("<tr>"), cells(s, "td"), F.lit("</tr>")))
        row = F.concat(tag(opens("row", "ruler"), "<table>"), tag(~head & (opens("row", "ruler") | (before == "ruler")), "<tbody>"), body, tag(~head & closes("row", "ruler"), "</tbody>"), tag(closes("row", "ruler"), "</table>"))
        item = lambda name, mark: F.concat(tag(opens(name), f"<{name}>"), F.lit("<li>"), inline(F.regexp_replace(s, mark, "")), F.lit("</li>"), tag(closes(name), f"</{name}>"))
        return (
            F.when(own == "blank", "").when(F.startswith(own, F.lit("h")) & (own != "html"), F.concat(F.lit("<"), own, F.lit(">"), inline(F.regexp_replace(s, r"^#{1,6}\s+|\s+#+$", "")), F.lit("</"), own, F.lit(">")))
            .when(own == "rule", F.lit("<hr>")).when(own == "html", s).when(own == "row", row).when(own == "ruler", tag(closes("row", "ruler"), "</table>"))
            .when(own == "ul", item("ul", r"^[-*+]\s+")).when(own == "ol", item("ol", r"^[0-9]+[.)]\s+"))
            .otherwise(F.concat(tag(opens("p"), "<p>"), inline(s), tag(closes("p"), "</p>")))
        )

    return F.array_join(F.filter(F.transform(lines, line), lambda s: s != ""), "\n")


def page(title: Column, text: Column) -> Column:
    """A whole page of a document."""
    return F.concat(F.lit('<!DOCTYPE html>\n<html><head><meta charset="utf-8"><title>'), escaped(title), F.lit("</title></head><body>\n"), to_html(text), F.lit("\n</body></html>\n"))
