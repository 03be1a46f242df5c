"""Pages to fields: metadata, links, paragraphs and videos, by built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.functions.text import iframe_videos, paragraphs, token_count


def page_meta(pages: DataFrame, html: str = "html", url: str = "url", *keep: str) -> DataFrame:
    """(keep.., title, lang, host) of each page; what a page lacks is empty."""
    h = F.coalesce(F.col(html), F.lit(""))
    return pages.select(*keep, F.regexp_extract(h, r"(?is)<title[^>]*>(.*?)</title>", 1).alias("title"), F.regexp_extract(h, r'<html[^>]*\slang="([^"]*)"', 1).alias("lang"), F.regexp_extract(F.col(url), r"^[A-Za-z]+://([^/?#]*)", 1).alias("host"))


def page_links(pages: DataFrame, html: str = "html", *keep: str) -> DataFrame:
    """(keep.., part, href): the address of each link, in order."""
    found = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(r'<a[^>]*\shref="([^"]*)"'), F.lit(1))
    return pages.select(*keep, F.posexplode(found).alias("part", "href"))


def articles(pages: DataFrame, html: str = "html", *keep: str, glue: bool = False) -> DataFrame:
    """(keep.., content, content_paragraphs, word_count, videos, has_video, status, error) of each page.

    A page without paragraphs fails with an error in its row, never an exception.
    """
    parsed = pages.select(*keep, paragraphs(F.col(html), glue=glue).alias("content_paragraphs"), iframe_videos(F.col(html)).alias("videos"))
    content = F.array_join("content_paragraphs", "\n\n")
    return parsed.select(
        *keep, content.alias("content"), "content_paragraphs", token_count(content).alias("word_count"), "videos", (F.size("videos") > 0).alias("has_video"),
        F.when(content == "", "failed").otherwise("success").alias("status"), F.when(content == "", "no paragraphs").alias("error"),
    )


def list_cards(html: Column, glue: bool = False) -> Column:
    """array<struct<id, title, url, categories, published, excerpt>> of the article cards of a list page.

    A card is an article element with a class post-N; its categories are the classes category-*, its date the datetime
    of a time element, its excerpt the first paragraph. Cards without a titled link are dropped.
    """
    cards = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?is)<article\b(.*?)</article>"), F.lit(1))
    bare = lambda x: F.trim(F.regexp_replace(x, "<[^>]*>", "" if glue else " "))

    def card(c):
        classes = F.split(F.regexp_extract(c, r"""^[^>]*\sclass=["']([^"']*)["']""", 1), r"\s+")
        named = lambda p: F.transform(F.filter(classes, lambda k: F.startswith(k, F.lit(p))), lambda k: F.substring(k, len(p) + 1, 1 << 20))
        link = r"""(?is)<h[1-6][^>]*>.*?<a[^>]*\shref=["']([^"']*)["'][^>]*>(.*?)</a>"""
        return F.struct(
            F.get(named("post-"), F.lit(0)).alias("id"), bare(F.regexp_extract(c, link, 2)).alias("title"), F.regexp_extract(c, link, 1).alias("url"), named("category-").alias("categories"),
            F.regexp_extract(c, r"""<time[^>]*\sdatetime=["']([^"']*)["']""", 1).alias("published"), bare(F.regexp_extract(c, r"(?is)<p(?:\s[^>]*)?>(.*?)</p>", 1)).alias("excerpt"),
        )

    return F.filter(F.transform(cards, card), lambda x: x["title"] != "")


def video_list(rows: DataFrame, article: str, title: str, videos: str = "videos") -> DataFrame:
    """(article_id, article_title, video_id, watch_url): a row for each video of each article."""
    each = rows.select(F.col(article).alias("article_id"), F.col(title).alias("article_title"), F.explode(videos).alias("v"))
    return each.select("article_id", "article_title", "v.video_id", "v.watch_url")


def articles_with_videos(rows: DataFrame, key: str, order: str, videos: str = "videos") -> DataFrame:
    """The last row of each key that has videos, sorted by the key as text."""
    last = rows.where(F.col(videos).isNotNull() & (F.size(videos) > 0))
    nth = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))
    return last.withColumn("_nth", nth).where("_nth = 1").drop("_nth").orderBy(F.col(key).cast("string"))
