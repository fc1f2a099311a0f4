"""Main text of web pages by wrapper induction.

Every task parses its pages and aligns those of a host by simple tree matching into
one template per host; the tasks' templates are aligned into the host's the same way.
Nodes whose text is constant are template, slots that vary are content, and the
template tells where the article is. Which texts are constant is counted over the
distinct pages of a host, whatever task read them. Then every page is cut by its
host's template.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm import dom
from roadpulse.llm.frames import for_python, only
from roadpulse.storage import materialise

# Hosts a task keeps templates of before it hands them on.
HOSTS_AT_ONCE = 2000
# Tables of that many hosts, of that many characters in all, are broadcast; more are joined.
BROADCAST_HOSTS, BROADCAST_CHARACTERS = 200_000, 20_000_000
# A text is constant if so many pages have it in one place, this share of the host's
# and this share of those that have text in the place.
SOME_PAGES, MOST_PAGES = 0.1, 0.9
_SEEN = "array<struct<place: bigint, text: bigint>>"
_FOUND = pa.schema(
    [
        ("host", pa.string()),
        ("template", pa.string()),
        ("page", pa.int64()),
        ("seen", pa.list_(pa.struct([("place", pa.int64()), ("text", pa.int64())]))),
    ]
)


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _merged(found: dict[str, dom.Slot], name: str, slot: dom.Slot) -> None:
    if name in found:
        dom.merge(found[name], slot)
        # A node of less than one page in a hundred is not kept apart.
        if found[name].pages % 64 == 0:
            dom.fold(found[name], found[name].pages / 100)
    else:
        found[name] = slot


def _found(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(_FOUND.types)], schema=_FOUND
    )


def _templates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's templates of hosts, and what texts each page has where."""
    found: dict[str, dom.Slot] = {}

    def flush() -> pa.RecordBatch:
        rows = [(name, json.dumps(dom.dump(slot)), None, None) for name, slot in found.items()]
        found.clear()
        return _found(rows)

    for batch in batches:
        pages = []
        for name, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if page:
                tree = dom.parse(page)
                _merged(found, name, dom.slots(tree))
                seen = dom.marks(tree)
                body = blake2b(repr(seen).encode(), digest_size=8).digest()
                pages.append((name, None, int.from_bytes(body, signed=True), seen))
        yield _found(pages)
        if len(found) >= HOSTS_AT_ONCE:
            yield flush()
    if found:
        yield flush()


def _constant(found: DataFrame, small: bool) -> DataFrame:
    """``host, constant``: the texts that are the same on the pages of a host, where there are any.

    Copies of a page count once. Counts meet by text, not by host.
    """
    pages = found.filter("template is null").groupBy("host", "page").agg(F.first("seen").alias("seen"))
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    seen = pages.select("host", F.explode("seen").alias("s")).groupBy("host", "s.place", "s.text")
    often = seen.agg(F.count("*").alias("n")).filter(F.col("n") >= dom.ENOUGH)
    often = often.join(F.broadcast(totals) if small else totals, "host").filter(F.col("n") >= SOME_PAGES * F.col("pages"))
    in_place = F.max(F.when(F.col("text") == 0, F.col("n"))).over(Window.partitionBy("host", "place"))
    often = often.withColumn("of", in_place).filter((F.col("text") != 0) & (F.col("n") >= MOST_PAGES * F.col("of")))
    return often.groupBy("host").agg(F.sort_array(F.collect_set("text")).alias("constant"))


def _paths(group: pd.DataFrame) -> pd.DataFrame:
    """Where the article is, from the templates of a host."""
    found: dict[str, dom.Slot] = {}
    for data in sorted(group["template"]):
        _merged(found, "", dom.load(json.loads(data)))
    return pd.DataFrame({"host": [group["host"].iloc[0]], "path": [json.dumps(dom.main_path(found[""]))]})


@lru_cache(maxsize=4096)
def _path(data: str | None) -> tuple[list[str | list[str]] | None, frozenset[int]]:
    path, constant = json.loads(data) if data else (None, ())
    return path, frozenset(constant)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages, paths = batch.column("html").to_pylist(), batch.column("path").to_pylist()
        texts = [dom.extract(dom.parse(h), *_path(p)) if h else "" for h, p in zip(pages, paths, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text``, one row per row of ``pages``.

    Whole pages are read. Blocks are joined by line feeds, character references
    decoded, white space within a block is one space. A null or empty page has an
    empty text; pages without a host in ``url`` share a template; ids and pages may
    repeat, and an empty table gives an empty result. Other columns are not looked at.

    Pages are not shuffled. A host sends one template per task, which holds no text, and
    16 bytes per block of a page tell which texts are constant.
    """
    for_python(pages.sparkSession)
    rows = only(pages, page_id="page_id", url=pages["url"].cast("string"), html="html", host=host(pages["url"]))
    schema = f"host string, template string, page bigint, seen {_SEEN}"
    found = materialise(rows.select("host", "html").mapInArrow(_templates, schema), "page-templates")
    partial = found.filter("template is not null").select("host", "template")
    paths = materialise(partial.groupBy("host").applyInPandas(_paths, "host string, path string"), "page-paths")
    small = paths.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
    rules = paths.join(_constant(found, small), "host", "left")
    constant = F.to_json(F.coalesce("constant", F.array().cast("array<bigint>")))
    rules = rules.select("host", F.concat(F.lit("["), "path", F.lit(","), constant, F.lit("]")).alias("path"))
    rules = materialise(rules, "page-rules")
    small = small and (rules.agg(F.sum(F.length("path"))).first()[0] or 0) <= BROADCAST_CHARACTERS
    joined = rows.join(F.broadcast(rules) if small else rules, "host", "left")
    kind = rows.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "html", "path").mapInArrow(
        _texts, f"page_id {kind}, url string, text string"
    )
