"""Label/value facts of scraped pages, and address inputs."""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import address_parts, fact_label, full_address
from ..session import staged
from .attach import attach
from .blocks import parallel
from .dedupe import keep_first


cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without content, and what is not shown.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
#: A tag (quoted attributes may hold its end sign), a text, or a lone sign.
PIECE = """(?s)</?[a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|<[/!?a-zA-Z][^>]*>|[^<]+|<"""
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
TEXTS = "page_id bigint, seq bigint, element string, above string, before string, child string"


def nested(pieces: Iterable[str]) -> Iterator[tuple[int, str, str, str | None, str]]:
    """(seq, element, above, before, text) of the texts among tags: enclosing elements, and the text before it inside the upper one.

    A closing tag ends the nearest open element of its name and all inside it; without one it
    is passed over. Linear: a text is inside an element if it is not older than the element.
    """
    stack: list[tuple[str, int]] = []  # name, texts before it
    open_: Counter[str] = Counter()
    seq, last, held = 0, None, []

    def text() -> Iterator[tuple[int, str, str, str | None, str]]:
        nonlocal seq, last
        whole = "".join(held).strip()
        held.clear()
        if whole:
            upper = stack[-2:][0][1] if stack else 0
            names = ["", "", *(name for name, _ in stack[-2:])]
            yield seq, names[-1], names[-2], last if seq > upper else None, whole
            seq, last = seq + 1, whole

    for piece in pieces:
        if piece[0] != "<" or len(piece) == 1:
            held.append(piece)
            continue
        yield from text()
        tag = TAG.match(piece)
        if not tag:
            continue
        name = tag[2].lower()
        if tag[1]:
            while open_[name]:
                top, _ = stack.pop()
                open_[top] -= 1
                if top == name:
                    break
        elif name not in VOID and not piece.endswith("/>"):
            stack.append((name, seq))
            open_[name] += 1
    yield from text()


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, html) -> one row per shown text: seq, element, above (the element around it), before, child.

    Scripts, styles and comments are not shown; blank texts are none. SQL functions cut a page at its tags, one pass
    over the pieces keeps the open elements. Missing html has no texts.
    """
    cut = pages.select(F.col("page_id").cast("bigint"), F.regexp_extract_all(F.regexp_replace("html", UNSEEN, ""), F.lit(PIECE), F.lit(0)).alias("pieces"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in TEXTS.split(", ")]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 4]
        for batch in batches:
            for page, pieces in zip(batch.column("page_id"), batch.column("pieces")):
                rows = list(nested(pieces.as_py() or []))
                if rows:
                    columns = [[page.as_py()] * len(rows), *zip(*rows)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return cut.mapInArrow(run, TEXTS)


def labelled_texts(texts: DataFrame) -> DataFrame:
    """page_id, seq, parent, child for ``page_facts``: a text before it that ends in ':' is the label, else the element's name."""
    told = F.concat("before", F.lit("\n"), "child")
    named = F.col("before").endswith(":") & (fact_label(told, F.col("child")) != "")
    return texts.select("page_id", "seq", F.when(named, told).otherwise(F.concat(F.lit("<"), "element", F.lit(">\n"), "child")).alias("parent"), "child")


def page_facts(found: DataFrame) -> DataFrame:
    """(page_id, seq, parent, child) -> one map label -> values in page order.

    A label may come several times; an empty label is dropped. One row per (page, label)
    first, so only a page's own facts meet in one place.
    """
    labelled = found.select("page_id", "seq", fact_label(F.col("parent"), F.col("child")).alias("label"), F.lower("child").alias("value"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("seq", "value"))), lambda e: e["value"])
    per_label = labelled.where("label <> ''").groupBy("page_id", "label").agg(ordered.alias("values"))
    return per_label.groupBy("page_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "values")))).alias("facts"))


def address_inputs(addresses: DataFrame, city: str = "Austin, TX") -> DataFrame:
    """(prop_id, address, state, zone) -> prop_id and the normalised search address."""
    return addresses.select("prop_id", full_address(F.col("address"), F.col("state"), F.col("zone"), city).alias("address"))


def geocode_enrich(addresses: DataFrame, gazetteer: DataFrame, key: str, order: Sequence[str | Column] = ("lat", "lng")) -> DataFrame:
    """Coordinates from an address table (address, lat, lng); 0.0 where an address is unknown or missing.

    Of several entries for an address the first by ``order`` counts. Hot addresses (blocks of
    flats, empty ones) are spread by ``key``, a column of ``addresses``.
    """
    places = staged(keep_first(gazetteer, ["address"], order).select("address", "lat", "lng"), "gazetteer")
    known = staged(addresses.where("address IS NOT NULL"), "addresses")
    found = attach(known, places, ["address"], F.col(key))
    unknown = addresses.where("address IS NULL").withColumns({c: F.lit(None).cast("double") for c in ("lat", "lng")})
    return found.unionByName(unknown).na.fill(0.0, ["lat", "lng"])


def geocode_match(addresses: DataFrame, gazetteer: DataFrame, key: str, order: Sequence[str | Column] = ("lat", "lng"), noise: Sequence[str] = ()) -> DataFrame:
    """Like ``geocode_enrich`` for addresses that are spelt or ordered differently: with ``edits``, NULL (and 0.0, 0.0) for a miss.

    Addresses are parsed; entries with the same number and zip form a block, and of those whose street is within one edit per
    five letters (in the words' order or sorted) and whose unit is not another one the nearest wins, then the one with
    the same unit, then the first by ``order``. A block holds one entry per street and unit, and is looked up by salted keys.
    """
    # Small rows, but expensive to parse: dealt out first. A generator's columns: a filter on them stays behind it, so nothing is parsed twice.
    parsed = parallel(gazetteer).select("*", F.inline(F.array(address_parts(F.col("address"), noise)))).where("number <> ''")
    entries = keep_first(parsed, ["number", "zip", "street", "unit"], order)
    rank = Window.partitionBy("number", "zip").orderBy(*order)
    entries = entries.withColumn("place", F.row_number().over(rank))
    block = F.collect_list(F.struct("place", "street", F.col("sorted").alias("words"), F.col("unit").alias("room"), "lat", "lng")).alias("entries")
    blocks = staged(entries.groupBy("number", "zip").agg(block), "address-blocks")
    parts = F.explode(F.array(address_parts(F.col("address"), noise))).alias("_p")
    asked = staged(parallel(addresses).select("*", parts).select("*", "_p.number", "_p.zip"), "parsed-addresses")

    def edits(e: Column) -> Column:
        return F.least(F.levenshtein(F.col("_p.street"), e["street"]), F.levenshtein(F.col("_p.sorted"), e["words"]))

    found = attach(asked, blocks, ["number", "zip"], F.col(key))
    near = F.transform("entries", lambda e: F.struct(edits(e).alias("edits"), (e["room"] != F.col("_p.unit")).alias("other"), e["place"].alias("place"), e["lat"].alias("lat"), e["lng"].alias("lng"), e["room"].alias("room")))
    close = F.filter(near, lambda e: (e["edits"] <= F.floor(F.length("_p.street") / 5)) & ((e["room"] == F.col("_p.unit")) | (e["room"] == "") | (F.col("_p.unit") == "")))
    best = found.withColumn("_best", F.array_min(close)).select(*addresses.columns, "_best.lat", "_best.lng", F.col("_best.edits").cast("int").alias("edits"))
    return best.na.fill(0.0, ["lat", "lng"])


def miss_share(matched: DataFrame) -> DataFrame:
    """How many addresses there are, and the share without a match: one row."""
    return matched.agg(F.count("*").alias("n"), F.avg(F.col("edits").isNull().cast("double")).alias("missed"))
