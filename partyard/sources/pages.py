"""Landed result pages to listing rows, with native expressions only.

One regular expression reads a page from front to back and marks its tags: a tag ends
at its ``>`` outside quoted values, and comments, scripts and style sheets are taken
whole and leave an empty mark.  The page is then an array of pieces, each a tag and the
text behind it.

A fold over the tags keeps the stack of open elements: an end tag closes the nearest
open element of its name with all that is open inside it, an end tag without one means
nothing.  The fold gives the pieces of each card, nested cards included; a second fold
over a card's pieces gives the span of the first element of each field.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partyard import rules
from partyard.functions.literals import HashedMap, folded_array, folded_map
from partyard.functions.text import first_price, parse_sold_date

CELL = ["vehicle_key", "search_year", "search_make", "search_model", "search_part"]
_OPEN, _SHUT = "\u0001", "\u0002"

#: What stands in a tag: an equals sign may have a quoted value behind it.
_INSIDE = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_TOKEN = rf"(?is)<!--.*?(?:-->|\z)|<(script|style)\b{_INSIDE}>.*?(?:</\1\s*>|\z)|<(/?[a-z]{_INSIDE})>|<[!?][^>]*>"
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""

#: Class of each field's element and the tag it must be, if any.
FIELDS = {
    "title": ("s-card__title", None),
    "price": ("s-card__price", "span"),
    "link": ("s-card__link", "a"),
    "caption": ("s-card__caption", None),
}


def _attribute(body: Column, name: str) -> Column:
    """Value of a tag's attribute, empty when it has none; text in other values does not count."""
    own = F.regexp_replace(body, rf"(?is)(\s{name}\s*=\s*{_VALUE})|\s[^\s=]+\s*=\s*{_VALUE}", "$1")
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*(F.regexp_extract(own, pattern, k) for k in (1, 2, 3)))


def _pieces(html: Column) -> Column:
    """The page cut in front of every tag; each piece is a tag, a mark and text."""
    plain = F.translate(html, _OPEN + _SHUT, "")
    marked = F.regexp_replace(plain, _TOKEN, f"{_OPEN}$2{_SHUT}")
    cut = F.split(marked, _OPEN)
    return F.slice(cut, F.lit(2), F.greatest(F.size(cut) - 1, F.lit(0)))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once."""
    return F.transform(F.array(value), use)[0]


def _tag(piece: Column, at: Column) -> Column:
    """What a piece says, with its place: its element's name and kind, whether it opens a card or fields, its text.

    The kind is -1 for an end tag, 1 for a tag that opens an element and 0 for one
    without content.
    """
    body = F.substring_index(piece, _SHUT, 1)

    def read(x: Column) -> Column:
        body, name = x["body"], x["name"]
        closes = F.startswith(body, F.lit("/"))
        empty = (name == "") | F.endswith(body, F.lit("/")) | F.array_contains(folded_array(rules.VOID_ELEMENTS), name)
        marked = F.contains(body, F.lit("s-card")) & ~closes
        classes = F.when(marked, _attribute(body, "class"))
        tokens = F.split(classes, r"\s+")
        fits = [
            F.array_contains(tokens, klass) & (F.lit(True) if only is None else name == only)
            for klass, only in FIELDS.values()
        ]
        return F.struct(
            at.alias("at"),
            name.alias("name"),
            F.when(closes, -1).when(empty, 0).otherwise(1).alias("kind"),
            F.coalesce((name == "li") & F.contains(classes, F.lit("s-card")), F.lit(False)).alias("card"),
            F.when(F.contains(classes, F.lit("s-card__")), F.array(*fits)).alias("marks"),
            F.substring_index(piece, _SHUT, -1).alias("text"),
            F.when(marked & (name == "a"), _attribute(body, "href")).alias("href"),
        )

    name = F.lower(F.regexp_extract(body, r"^/?([^\s/]*)", 1))
    return _once(F.struct(body.alias("body"), name.alias("name")), read)


# Open elements are a text with the innermost one in front: every element is a mark, its
# name, another mark and, for a card, the letter c and its place.


def _pushed(stack: Column, tag: Column) -> Column:
    card = F.when(tag["card"], F.concat(F.lit("c"), tag["at"].cast("string"))).otherwise("")
    return F.concat(F.lit(_OPEN), tag["name"], F.lit(_SHUT), card, stack)


def _stack_after(stack: Column, tag: Column) -> Column:
    """The stack behind a tag; an end tag without its element changes nothing."""
    mine = F.concat(F.lit(_OPEN), tag["name"], F.lit(_SHUT))
    behind = F.substring(stack, F.instr(stack, mine) + 1, F.length(stack))
    left = F.substring(behind, F.instr(behind, F.lit(_OPEN)), F.length(behind))
    popped = F.when(F.contains(behind, F.lit(_OPEN)), left).otherwise("")
    return (
        F.when(tag["kind"] > 0, _pushed(stack, tag))
        .when((tag["kind"] < 0) & F.contains(stack, mine), popped)
        .otherwise(stack)
    )


def split_cards(html: Column) -> Column:
    """The cards of a page in the order they open, each as the array of its tags."""

    def step(state: Column, tag: Column) -> Column:
        def ended(after: Column) -> Column:
            gone = F.substring(state["stack"], F.lit(1), F.length(state["stack"]) - F.length(after))
            places = F.regexp_extract_all(gone, F.lit(_SHUT + r"c(\d+)"))
            done = F.transform(places, lambda place: _span(place.cast("int"), tag["at"]))
            return F.struct(
                after.alias("stack"),
                F.when(
                    (tag["kind"] < 0) & F.contains(gone, F.lit(_SHUT + "c")), F.concat(state["cards"], done)
                )
                .otherwise(state["cards"])
                .alias("cards"),
            )

        return F.when(tag["kind"] == 0, state).otherwise(_once(_stack_after(state["stack"], tag), ended))

    def cut(tags: Column) -> Column:
        start = F.struct(
            F.lit("").alias("stack"), F.array().cast("array<struct<start:int,stop:int>>").alias("cards")
        )

        def finish(state: Column) -> Column:
            """Cards that the page leaves open end with it."""
            left = F.regexp_extract_all(state["stack"], F.lit(_SHUT + r"c(\d+)"))
            return F.array_sort(
                F.concat(state["cards"], F.transform(left, lambda place: _span(place.cast("int"), F.size(tags))))
            )

        spans = F.aggregate(tags, start, step, finish)
        return F.transform(spans, lambda c: F.slice(tags, c["start"] + 1, c["stop"] - c["start"]))

    page = F.when(F.contains(html, F.lit("s-card")), html).otherwise("")
    return _once(F.transform(_pieces(page), _tag), cut)


def _span(start: Column, stop: Column) -> Column:
    return F.struct(start.alias("start"), stop.alias("stop"))


def _field_spans(card: Column) -> Column:
    """Start and stop of the first element of every field, in tags; start -1 for none."""
    places = range(len(FIELDS))

    def step(state: Column, tag: Column) -> Column:
        at = state["at"]

        def found(after: Column) -> Column:
            def one(k: int) -> Column:
                old = state[f"f{k}"]
                # An element without content ends where it starts.
                new = F.struct(
                    at.alias("start"),
                    F.length(state["stack"]).alias("depth"),
                    F.when(tag["kind"] == 0, at).otherwise(-1).alias("stop"),
                )
                ended = F.struct(old["start"].alias("start"), old["depth"].alias("depth"), at.alias("stop"))
                return (
                    F.when(
                        (tag["kind"] < 0) & (old["stop"] < 0) & (old["start"] >= 0) & (F.length(after) <= old["depth"]),
                        ended,
                    )
                    .when(tag["marks"].isNotNull() & (old["start"] < 0) & tag["marks"][k], new)
                    .otherwise(old)
                    .alias(f"f{k}")
                )

            return F.struct(after.alias("stack"), (at + 1).alias("at"), *(one(k) for k in places))

        return _once(_stack_after(state["stack"], tag), found)

    none = F.struct(F.lit(-1).alias("start"), F.lit(0).alias("depth"), F.lit(-1).alias("stop"))
    start = F.struct(F.lit("").alias("stack"), F.lit(1).alias("at"), *(none.alias(f"f{k}") for k in places))

    def finish(state: Column) -> Column:
        found = (state[f"f{k}"] for k in places)
        return F.array(*(_span(f["start"], F.when(f["stop"] < 0, state["at"]).otherwise(f["stop"])) for f in found))

    # The first tag is the card's own.
    return F.aggregate(F.slice(card, F.lit(2), F.size(card)), start, step, finish)


#: Named references of HTML 5; the older ones also count without a semicolon.
NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
BARE = {name: text for name, text in html5.items() if not name.endswith(";")}
_NAMED = HashedMap(NAMED, 1024)
_BARE_NAMES = "|".join(sorted(BARE, key=len, reverse=True))
_DECIMAL = r"^&#([0-9]+);?"
_HEXADECIMAL = r"(?i)^&#x([0-9a-f]+);?"
#: Numeric references to these are read as characters of Windows-1252, by the standard.
_LEGACY = {
    str(c): chr(c) if c in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else bytes([c]).decode("cp1252")
    for c in range(0x80, 0xA0)
}


def _by_number(code: Column) -> Column:
    """Character of a code point (null: too large for one)."""
    # A code point written as four bytes reads back as its character.
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    unknown = code.isNull() | (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    dropped = (
        code.between(0x1, 0x8)
        | (code == 0xB)
        | code.between(0xE, 0x1F)
        | code.between(0x7F, 0x9F)
        | code.between(0xFDD0, 0xFDEF)
        | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )
    legacy = F.try_element_at(folded_map(_LEGACY), code.cast("string"))
    return (
        F.when(unknown, F.lit("\ufffd")).when(legacy.isNotNull(), legacy).when(dropped, F.lit("")).otherwise(plain)
    )


def unescape(text: Column) -> Column:
    """Replace named and numeric character references as HTML 5 reads them."""
    bare = folded_map(BARE)

    def number(digits: Column, base: int, most: int) -> Column:
        short = F.regexp_replace(digits, "^0+(?=.)", "")
        return F.when(F.length(short) <= most, F.conv(short, base, 10).cast("long"))

    def piece(chunk: Column) -> Column:
        decimal, hexadecimal = (F.regexp_extract(chunk, p, 1) for p in (_DECIMAL, _HEXADECIMAL))
        name = F.regexp_extract(chunk, r"^&([^\t\n\f <&#;]{1,32});", 1)
        old = F.regexp_extract(chunk, f"^&({_BARE_NAMES})", 1)
        full = _NAMED.get(name)
        return (
            F.when(decimal != "", F.concat(_by_number(number(decimal, 10, 7)), F.regexp_replace(chunk, _DECIMAL, "")))
            .when(
                hexadecimal != "",
                F.concat(_by_number(number(hexadecimal, 16, 6)), F.regexp_replace(chunk, _HEXADECIMAL, "")),
            )
            .when(full.isNotNull(), F.concat(full, F.substr(chunk, F.length(name) + 3)))
            .when(old != "", F.concat(F.try_element_at(bare, old), F.substr(chunk, F.length(old) + 2)))
            .otherwise(chunk)
        )

    pieces = F.transform(F.split(text, "(?=&)"), piece)
    return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)


def read_card(card: Column) -> Column:
    """Fields of one card as a struct; null for no card."""

    def text_nodes(spans: Column) -> Column:
        """Text nodes of the fields' elements, trimmed, empty ones dropped; the link's address as one."""

        def nodes(span: Column, k: Column) -> Column:
            tags = F.slice(card, span["start"] + 1, span["stop"] - span["start"])
            href = F.array(F.get(card, span["start"])["href"])
            raw = F.when(k == list(FIELDS).index("link"), href).otherwise(F.transform(tags, lambda tag: tag["text"]))
            read = F.transform(raw, unescape)
            trimmed = F.transform(read, lambda node: F.regexp_replace(node, r"(?U)^\s+|\s+$", ""))
            kept = F.when(k == list(FIELDS).index("link"), read).otherwise(F.filter(trimmed, lambda node: node != ""))
            return F.when(span["start"] < 0, F.array().cast("array<string>")).otherwise(kept)

        return F.transform(spans, nodes)

    def fields(nodes: Column) -> Column:
        title, price, link, caption = (nodes[k] for k in range(len(FIELDS)))
        return F.struct(
            F.array_join(title, " ").alias("title"),
            F.array_join(price, "").alias("price_raw"),
            F.array_join(link, "").alias("listing_url"),
            parse_sold_date(F.array_join(caption, "")).alias("sold_date"),
        )

    return F.when(card.isNotNull(), _once(text_nodes(_field_spans(card)), fields))


LISTING = ["title", "price_raw", "listing_url", "sold_date"]


def is_listing() -> Column:
    """False for cards without a title or price and for the shop's own cards."""
    title = F.col("title")
    test = (
        (title != "")
        & ~F.contains(title, F.lit(rules.STORE_CARD_TITLE))
        & first_price(F.col("price_raw")).isNotNull()
    )
    return F.coalesce(test, F.lit(False))


def listing_rows(pages: DataFrame, cards: Column, position: str) -> DataFrame:
    """One row per card with its fields; the page's other columns are kept.

    Cards are read inside the array, before it unfolds: later filters then work on plain
    columns and cannot make a card be read twice.  The outer unfolding keeps Spark from
    adding a filter on the array's size, which would read the page twice.
    """
    kept = [c for c in pages.columns if c != "html"]
    rows = pages.select(*kept, F.posexplode_outer(F.transform(cards, read_card)).alias(position, "_listing"))
    return rows.select(*kept, position, *(F.col("_listing")[c].alias(c) for c in LISTING))


def page_listings(pages: DataFrame) -> DataFrame:
    """Listing rows of landed pages, with their place on the page.

    ``pages`` has the search cell, ``scraped_at`` and ``html``; further columns
    are kept.  Only the cards are exploded; no page text is shuffled.
    """
    return listing_rows(pages, split_cards(F.col("html")), "position_in_page").filter(is_listing())
