"""Headlines and their score."""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from barframe.fixed_values import HEADLINE_CLASS, HEADLINE_LIMIT, HEADLINE_TAG, NEGATIVE_WORDS, POSITIVE_WORDS
from barframe.functions.text import any_word

@F.pandas_udf(StringType())
def decode_references(texts: pd.Series) -> pd.Series:
    """All character references, named and numeric, decoded."""
    return texts.map(references.unescape, na_action="ignore")


def pattern_html_nodes(
    pages: DataFrame, tag: str = HEADLINE_TAG, css_class: str | None = HEADLINE_CLASS,
    limit: int | None = HEADLINE_LIMIT, html: str = "html",
) -> DataFrame:
    """``(..., pos, text)``: the text of the first ``limit`` elements of each page, in document order.

    Finds elements by a pattern on the JVM and decodes character references in Arrow batches. It
    takes an element inside one of the same tag as part of it, and markup inside comments and
    scripts as markup: ``html_nodes`` is the exact form.
    """
    has_class = f"(?=[^>]*\\sclass=[\"'](?:[^\"']*\\s)?{re.escape(css_class)}[\\s\"'])" if css_class else ""
    pattern = f"(?is)<{tag}(?=[\\s>]){has_class}[^>]*>(.*?)</{tag}\\s*>"
    found = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    found = F.slice(found, 1, limit) if limit is not None else found
    rest = [c for c in pages.columns if c != html]
    text = decode_references(F.regexp_replace("__inner", "(?s)<[^>]*>", ""))
    return pages.select(*rest, F.posexplode(found).alias("pos", "__inner")).select(*rest, "pos", text.alias("text"))


class _Elements(HTMLParser):
    """Collects the texts of the elements of one tag and class."""

    def __init__(self, tag: str, css_class: str | None):
        super().__init__(convert_charrefs=True)
        self.tag, self.css_class = tag, css_class
        self.texts: list[list[str]] = []
        self.open: list[int | None] = []

    def handle_starttag(self, tag, attrs):
        if tag != self.tag:
            return
        wanted = self.css_class is None or self.css_class in (dict(attrs).get("class") or "").split()
        if wanted:
            self.texts.append([])
        self.open.append(len(self.texts) - 1 if wanted else None)

    def handle_endtag(self, tag):
        if tag == self.tag and self.open:
            self.open.pop()

    def handle_data(self, data):
        for place in self.open:
            if place is not None:
                self.texts[place].append(data)


def html_nodes(
    pages: DataFrame, tag: str = HEADLINE_TAG, css_class: str | None = HEADLINE_CLASS,
    limit: int | None = HEADLINE_LIMIT, html: str = "html",
) -> DataFrame:
    """``(..., pos, text)``: the text of the first ``limit`` elements of each page, in document order,
    character references decoded. An element inside one of the same tag counts by itself and as
    part of the outer one. A parser reads the pages in Arrow batches.
    """

    @F.pandas_udf("array<string>")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def of_page(page: str | None) -> list[str]:
            parser = _Elements(tag, css_class)
            parser.feed(page or "")
            parser.close()
            return ["".join(t) for t in parser.texts[:limit]]

        for batch in batches:
            yield batch.map(of_page)

    rest = [c for c in pages.columns if c != html]
    return pages.select(*rest, F.posexplode(texts(html)).alias("pos", "text"))


def headline_score(
    lowered: Column | str, positive: Sequence[str] = POSITIVE_WORDS, negative: Sequence[str] = NEGATIVE_WORDS
) -> Column:
    """+1 if a positive word occurs in the lower-cased text, else -1 if a negative one does, else 0."""
    return F.when(any_word(lowered, positive), 1).when(any_word(lowered, negative), -1).otherwise(0)


def sentiment_score(
    headlines: DataFrame, text: str = "text", keys: Sequence[str] = (),
    positive: Sequence[str] = POSITIVE_WORDS, negative: Sequence[str] = NEGATIVE_WORDS, out: str = "sentiment",
) -> DataFrame:
    """The sum of the headline scores, of the table (0 if empty) or of each key."""
    lowered = headlines.select(*keys, F.lower(text).alias("__lowered"))
    score = headline_score("__lowered", positive, negative)
    total = F.coalesce(F.sum(score), F.lit(0)).cast("int").alias(out)
    return lowered.groupBy(*keys).agg(total) if keys else lowered.agg(total)
