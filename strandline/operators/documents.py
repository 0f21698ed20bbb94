"""Pages, documents and quotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import text as tx

#: Pages per assembled piece, so that a very long document is no single row.
CHUNK = 100
#: Characters of pages that count as nearly empty, and of documents that are too short.
THIN_PAGE, THIN_DOCUMENT = 40, 500
# Blocks that repeat on every page.
FURNITURE = ("header", "footer", "page_number")


def rendered(block: Column, page: Column) -> Column:
    """Text of one layout block STRUCT<type, text, text_level, list_items, table_caption, table_body,
    table_footnote, image_caption, image_footnote, content>, '' for none.

    Headings get their level, lists one line an item, tables and figures their captions, bodies and
    notes; page numbers go, other furniture stays on the first page or if it holds a key.
    """
    text = F.trim(F.coalesce(block.text, F.lit("")))
    items = F.filter(F.transform(F.coalesce(block.list_items, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")
    some = lambda c: F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.trim(x) != "")
    one = lambda c: F.when(F.length(F.trim(c)) > 0, F.array(F.trim(c))).otherwise(F.array().cast("array<string>"))
    table = F.array_join(F.concat(some(block.table_caption), one(block.table_body), some(block.table_footnote)), "\n\n")
    figure = F.array_join(F.concat(some(block.image_caption), some(block.image_footnote), one(block.content)), "\n\n")
    heading = F.concat(F.repeat(F.lit("#"), F.least(block.text_level + 1, F.lit(6))), F.lit(" "), text)
    kind = block.type
    return (
        F.when(kind.isin(*FURNITURE), F.when((kind != "page_number") & ((page == 0) | text.rlike(r"10\.[0-9]{4,9}/")), text).otherwise(""))
        .when((kind == "text") & (text != "") & (F.coalesce(block.text_level, F.lit(0)) > 0), heading)
        .when(kind == "list", F.when(F.size(items) > 0, F.array_join(items, "\n")).otherwise(text))
        .when(kind == "table", table)
        .when(kind.isin("image", "chart"), figure)
        .otherwise(text)
    )


def assemble(blocks: DataFrame, key: str, page: str, order: str, body: str, chunk: int = CHUNK) -> DataFrame:
    """(key, chunk_no, first_page, n_pages, text): the blocks of a document, page by page.

    The non-empty blocks of a page are joined by blank lines in ``order`` and end with a line feed;
    pages are joined by form feeds and count from 0, so a page without blocks is a bare line feed.
    Soft hyphens go. A null page is page 0. A document comes out in pieces of ``chunk`` pages, all
    of them up to its last page: joined by form feeds they are the whole text, and no task holds
    more than a piece. Null keys form no document.
    """
    rows = blocks.where(F.col(key).isNotNull() & (F.length(body) > 0)).select(key, F.greatest(F.lit(0), F.coalesce(page, F.lit(0))).alias("_page"), F.col(order).alias("_o"), F.col(body).alias("_b"))
    one = rows.groupBy(key, "_page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_b"))), lambda x: x["_b"]), "\n\n").alias("_t"))  # one page's blocks
    held = one.groupBy(key, F.floor(F.col("_page") / chunk).alias("chunk_no")).agg(F.map_from_entries(F.collect_list(F.struct("_page", "_t"))).alias("_m"))
    last = one.groupBy(key).agg(F.max("_page").alias("_z"))
    every = last.select(key, "_z", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_z") / chunk))).alias("chunk_no"))
    got = every.join(held, [key, "chunk_no"], "left").withColumn("first_page", (F.col("chunk_no") * chunk).cast("int"))
    final = F.least(F.col("_z"), F.col("first_page") + chunk - 1)
    text = F.transform(F.sequence("first_page", final), lambda p: F.concat(F.coalesce(F.try_element_at("_m", p), F.lit("")), F.lit("\n")))
    return got.select(key, "chunk_no", "first_page", (final - F.col("first_page") + 1).alias("n_pages"), F.replace(F.array_join(text, "\f"), F.lit("\u00ad"), F.lit("")).alias("text"))


def pages_of(docs: DataFrame, key: str, body: str, first: int | None = None) -> DataFrame:
    """(key, page_no, text): a text split at form feeds; only the ``first`` pages if given."""
    parts = F.split(body, "\f")
    return docs.select(key, F.posexplode(F.slice(parts, 1, first) if first else parts).alias("page_no", "text"))


def section_inversions(body: Column) -> Column:
    """Numbered headings ("2.3 Title") that are followed by a smaller number. Works inside the
    row: no window over documents."""
    lines = F.regexp_extract_all(body, F.lit(r"(?m)^(?:#+ +)?([0-9]{1,2}\.[0-9]{1,2})\s+[A-Za-z]"), 1)
    nums = F.transform(lines, lambda s: F.struct(F.substring_index(s, ".", 1).cast("int").alias("a"), F.substring_index(s, ".", -1).cast("int").alias("b")))
    return tx.let(nums, lambda v: F.size(F.filter(v, lambda x, i: (i > 0) & (x < F.get(v, i - 1)))))


def quality(body: Column) -> Column:
    """ARRAY<STRING> of warnings about a text; a too short one has that warning alone."""
    t = F.coalesce(body, F.lit(""))
    flat = F.replace(t, F.lit("\f"), F.lit(""))
    n = F.length(F.trim(flat))
    pages = F.split(t, "\f")
    thin = F.size(F.filter(pages, lambda p: F.length(F.trim(p)) < THIN_PAGE))
    inv = section_inversions(flat)
    soft = F.length(flat) - F.length(F.replace(flat, F.lit("­"), F.lit("")))
    heads = flat.rlike(r"(?m)^#{1,6}\s")
    tabular = F.contains(flat, F.lit("<table")) & (F.length(flat) < 8000)
    rest = F.array_compact(F.array(
        F.when((F.size(pages) > 2) & (thin > 0.25 * F.size(pages)), F.lit("thin_pages")), F.when(inv > 0, F.lit("section_order")),
        F.when(soft > 0, F.lit("soft_hyphens")), F.when(~heads & ~tabular, F.lit("no_headings")),
    ))
    return F.when(n < THIN_DOCUMENT, F.array(F.lit("too_short"))).otherwise(rest)


def quotes_checked(quotes: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """``quotes(key, path, quote)`` with ``found``: does it occur in the text of the same key?

    Texts are folded once per key. Null where the key has no text.
    """
    folded = texts.where(F.col("text").isNotNull()).groupBy(key).agg(F.min("text").alias("_t")).select(key, tx.letters_only(F.col("_t")).alias("_k"))
    return quotes.join(folded, key, "left").withColumn("found", tx.quote_found(F.col("quote"), F.col("_k"))).drop("_k")


def inverted(docs: DataFrame, key: str, body: str) -> DataFrame:
    """(key, index MAP<word, positions>) of the words of a text, back with
    ``text.restore_inverted``. One row per word on the way, so long texts cost linear time."""
    words = docs.where(F.col(body).isNotNull()).select(F.col(key).alias("_key"), F.posexplode(F.split(tx.squeeze(F.col(body)), " ")).alias("_i", "_w"))
    per = words.groupBy("_key", "_w").agg(F.array_sort(F.collect_list("_i")).alias("_at"))
    return per.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("_w", "_at"))).alias("index")).withColumnRenamed("_key", key)
