"""Operator 3, HTML extraction: host suffix array.

Pages are cut into blocks by a tolerant tag scanner.  A block's place in the
markup gives its role: inside the article, inside furniture (menus, headers,
footers, sidebars, notices, adverts, forms, comments), or neither.  The tokens
of a page outside its article form its stream.

The streams of a host are concatenated, a unique mark after each page, and
sorted as a suffix array by prefix doubling; neighbours that share ``RUN``
tokens or more and belong to distinct pages are repeated runs.  A block without
a role is boilerplate if repeated runs cover at least half of it, and is kept
otherwise.  Blocks of an article are kept even where they repeat (copies of an
article are articles), and furniture goes even where it does not.  The blocks
without a role are judged so on every page, whether it has an article element or not.

A host of any size is dealt into shards of about ``SHARD_TOKENS``; each shard
sorts its own suffixes and names its distinct runs with the number of pages they
are on, and the sum over shards says what repeats in the host, so a run on one page
of each of two shards is found too.

Defined results: null or empty html gives an empty text; a null url has a host of
its own; repeated rows are pages of their own (and repeat each other); an empty
table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treepref.llm import textkernel as K
from treepref.session import materialize

#: Tokens that a repeated run has at least; a power of two, as prefix doubling sorts by that.
RUN = 8
SHARD_TOKENS = 500_000
ARTICLE, FURNITURE, OTHER = 0, 1, 2

# Names of HTML elements by what they mean here.
_FURNITURE_TAGS = frozenset("nav header footer aside form menu dialog button select iframe object svg fieldset".split())
_ARTICLE_TAGS = frozenset(["article", "main"])
_BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody "
    "td tfoot th thead tr ul button select iframe object svg".split())
_VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr param".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that end where the next of their kind, or another block, begins.
_SHORT = {"p": _BLOCK_TAGS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
          "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
          "option": frozenset(["option"]), **{h: _BLOCK_TAGS for h in _HEADINGS}}
#: Words of class, id and role attributes that mark furniture.
_FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "notice notification popup modal newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer header masthead comment comments respond discussion disqus share sharing social related "
    "recommended recommendations widget toolbar login signup pagination pager contentinfo complementary search".split())
_SCAN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|xmp)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*+)(?P<attr>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][\w:-]*+)(?P<attr2>[^>]*+)(?:>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)", re.S | re.I)
#: Words that make a name the state of an element rather than what it is (``with-sidebar``, ``comments-open``).
_STATE_WORDS = frozenset("with without has no not open closed enabled disabled on off".split())
#: Words beside which a furniture word of an id still says what the element is (``site-footer``); an
#: id with others is taken for the anchor of a section (``social-history``).
_LAYOUT_WORDS = frozenset(
    "site page main global primary secondary top bottom left right box block bar list container wrapper wrap inner outer "
    "area section panel column buttons button links link form items item content slot unit posts articles stories".split())
_MARKS = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


def _is_furniture(tag: str, attributes: str) -> bool:
    """Whether the names of an element mark it as furniture.

    A class or role does by any of its words, unless the name is one of state.  An id does
    if its other words are those of a layout, and never on a heading, where it is an anchor.
    An article or main element only goes by a whole name (``comment``).
    """
    for m in _MARKS.finditer(attributes):
        kind = m[1].lower()
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            words = _WORD.findall(name)
            if tag in _ARTICLE_TAGS:
                if name in _FURNITURE_WORDS:
                    return True
            elif not any(w in _FURNITURE_WORDS for w in words):
                continue
            elif kind == "id":
                if tag not in _HEADINGS and all(w in _FURNITURE_WORDS or w in _LAYOUT_WORDS or len(w) < 3 for w in words):
                    return True
            elif not any(w in _STATE_WORDS for w in words):
                return True
    return False


def blocks(page: str) -> list[tuple[int, str]]:
    """(role, text) of every block that is not empty, in page order."""
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    #: Open block elements: (name, inside furniture, inside an article); furniture: 2 by an element, 1 by a name.
    stack: list[tuple[str, int, bool]] = [("", 0, False)]

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text:
                _, furniture, article = stack[-1]
                out.append((FURNITURE if furniture else ARTICLE if article else OTHER, text))

    at = 0
    for m in _SCAN.finditer(page):
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in _BLOCK_TAGS:
            continue
        flush()
        if m["end"] or m["end2"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in _VOID_TAGS:
            continue
        while stack[-1][0] in _SHORT and tag in _SHORT[stack[-1][0]]:
            stack.pop()
        attributes = m["attr"] or m["attr2"] or ""
        _, furniture, article = stack[-1]
        if tag == "main" and furniture == 1:
            furniture = 0  # names around it speak of the page's layout
        if tag in _ARTICLE_TAGS and not furniture:
            article = True
        if tag in _HEADINGS and article and stack[-1][0] == "header":
            furniture = 0  # the article's own title
        elif tag in _FURNITURE_TAGS:
            furniture = 2
        elif not furniture and attributes and tag not in ("html", "body") and _is_furniture(tag, attributes):
            furniture = 1
        stack.append((tag, furniture, article))
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def stream_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes of the texts in order, number of tokens of each)."""
    column = pa.array(texts, pa.large_string())
    hashes, counts = [np.zeros(0, np.uint64)], []
    for _, _, buf, offs in K.chunks(column):
        starts, ends, doc = K.words(buf, offs)
        hashes.append(K.span_hashes(buf, starts, ends))
        counts.append(np.bincount(doc, minlength=len(offs) - 1))
    return np.concatenate(hashes), np.concatenate(counts) if counts else np.zeros(0, np.int64)


def window_keys(tokens: np.ndarray) -> np.ndarray:
    """Signed 64-bit keys of all runs of RUN tokens."""
    return K.windows(tokens, np.zeros(len(tokens), np.int64), RUN)[1].view(np.int64)


def suffix_runs(streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(key, number of streams) of the distinct runs of RUN tokens in a shard.

    The streams are joined with a unique mark after each and their suffixes are
    sorted by prefix doubling as far as RUN tokens.
    """
    size = np.array([len(s) for s in streams], np.int64)
    page = np.repeat(np.arange(len(streams)), size + 1)
    text = np.zeros(len(page), np.int64)
    marks = np.cumsum(size + 1) - 1
    body = np.ones(len(page), bool)
    body[marks] = False
    tokens = np.concatenate([np.zeros(0, np.uint64), *streams])
    names, text[body] = np.unique(tokens, return_inverse=True)
    text[marks] = len(names) + np.arange(len(streams))
    rank, step = text, 1
    while step < RUN:
        ahead = np.full(len(rank), -1, np.int64)
        ahead[:-step] = rank[step:]
        pair = rank * (len(page) + len(names) + 2) + ahead + 1
        rank, step = np.unique(pair, return_inverse=True)[1], step * 2
    order = np.argsort(rank, kind="stable")  # the suffix array, pages ascending among equals
    # Runs that reach over a mark are unique and belong to no page alone.
    left = np.repeat(marks, size + 1) - np.arange(len(page))
    order = order[left[order] >= RUN]
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    r, p = rank[order], page[order]
    new = np.concatenate([[True], r[1:] != r[:-1]])
    first = np.flatnonzero(new)
    pages = np.add.reduceat((new | np.concatenate([[True], p[1:] != p[:-1]])).astype(np.int64), first)
    start = order[first]
    whole = np.zeros(len(page), np.uint64)
    whole[body] = tokens
    acc = K.windows(whole, np.zeros(len(whole), np.int64), RUN, np.sort(start))
    return acc[1][np.searchsorted(acc[0], start)].view(np.int64), pages


def _parsed(pages: DataFrame) -> DataFrame:
    """For each page: id, url, host, the text if all its blocks have a role (else null), the blocks that are
    no furniture, whether each lies in an article, the stream."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, kept, fixed, streams = [], [], [], []
            for page in b.column(3):
                found = blocks(page.as_py() or "")
                body = [(role == ARTICLE, t) for role, t in found if role != FURNITURE]
                open_ = not body or not all(f for f, _ in body)
                texts.append(None if open_ else "\n".join(t for _, t in body))
                kept.append([t for _, t in body] if open_ else [])
                fixed.append([f for f, _ in body] if open_ else [])
                # Blocks without a role come last, so that their tokens are the end of the stream.
                out = [t for role, t in found if role == FURNITURE] + [t for f, t in body if not f]
                streams.append(stream_hashes(out)[0].tobytes() if out else b"")
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(texts, pa.string()), pa.array(kept, pa.list_(pa.string())),
                 pa.array(fixed, pa.list_(pa.bool_())), pa.array(streams, pa.binary())],
                ["id", "url", "host", "text", "blocks", "fixed", "stream"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.mapInArrow(rows, f"id {kinds['id']}, url {kinds['url']}, host string, text string, "
                                  "blocks array<string>, fixed array<boolean>, stream binary")


def _host_runs(streams: DataFrame) -> DataFrame:
    """(host, key): runs on two pages of the host or more."""
    size = F.octet_length("stream") / 8
    totals = streams.groupBy("host").agg(F.ceil(F.sum(size) / SHARD_TOKENS).alias("shards"))
    dealt = streams.join(totals, "host").withColumn(
        "shard", F.pmod(F.xxhash64("stream", "key"), F.greatest("shards", F.lit(1)).cast("long")))

    def runs(table: pa.Table) -> pa.Table:
        keys, pages = suffix_runs([np.frombuffer(x.as_buffer(), np.uint64) for x in table["stream"].combine_chunks()])
        if table["shards"][0].as_py() <= 1:
            keys, pages = keys[pages > 1], pages[pages > 1]
        host = table["host"].combine_chunks()[:1].take(pa.array(np.zeros(len(keys), np.int64)))
        return pa.table({"host": host, "run": keys, "pages": pages})

    # Dealt by shard too: a join on the host alone would leave all shards of a host in one task.
    dealt = dealt.select("host", "shard", "shards", "stream").repartition("host", "shard")
    found = dealt.groupBy("host", "shard").applyInArrow(
        runs, "host string, run long, pages long")
    return found.groupBy("host", "run").agg(F.sum("pages").alias("pages")).where("pages > 1").select("host", "run")


def _unrepeated(rows_in: DataFrame, repeated: DataFrame) -> DataFrame:
    """(id, url, text) of pages with blocks without a role: their articles' blocks and those that repeated runs do not cover."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, host, stream in zip(*(c.to_pylist() for c in b.columns)):
                w = window_keys(np.frombuffer(stream, np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(w), pa.int64()), pa.array([host] * len(w), pa.string()), pa.array(w),
                     pa.array(np.arange(len(w)))], ["key", "host", "run", "place"])

    held = rows_in.select("key", "host", "stream").mapInArrow(places, "key long, host string, run long, place long")
    # A page's places are bounded by its own length.
    covered = held.join(repeated, ["host", "run"], "left_semi").groupBy("key").agg(F.collect_list("place").alias("places"))
    both = rows_in.join(covered, "key", "left").select("id", "url", "blocks", "fixed", "stream", "places")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for body, fixed, stream, places in zip(*(c.to_pylist() for c in b.columns[2:])):
                others = [t for t, f in zip(body, fixed) if not f]
                n = len(stream) // 8
                hit = np.zeros(n + 1, np.int64)
                at = np.array(places or [], np.int64)
                np.add.at(hit, at, 1)
                np.add.at(hit, at + RUN, -1)
                inside = np.cumsum(hit[:n]) > 0
                ends = n - np.cumsum([0, *[len(t.split(' ')) for t in reversed(others)]])[::-1]
                unique = iter([2 * inside[f:e].sum() < max(1, e - f) for f, e in zip(ends[:-1], ends[1:])])
                out.append("\n".join(t for t, f in zip(body, fixed) if f or next(unique)))
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(out, pa.string())], ["id", "url", "text"])

    kinds = {f.name: f.dataType.simpleString() for f in rows_in.schema.fields}
    return both.mapInArrow(texts, f"id {kinds['id']}, url {kinds['url']}, text string")


def main_text(df: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url).cast("string"), r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1)),
                      F.lit(""))
    pages = df.select(F.col(id).alias("id"), F.col(url).alias("url"), host.alias("host"), F.col(html).alias("html"))
    parsed = materialize(_parsed(pages).withColumn("key", F.monotonically_increasing_id()), "parsed")
    repeated = materialize(_host_runs(parsed.where(F.octet_length("stream") > 0).select("key", "host", "stream")), "runs")
    settled = parsed.where("text is not null").select("id", "url", "text")
    open_ = parsed.where("text is null").select("id", "url", "host", "blocks", "fixed", "stream", "key")
    out = settled.unionByName(_unrepeated(open_, repeated))
    return out.select(F.col("id").alias(id), F.col("url").alias(url), "text",
                      F.length("text").cast("long").alias("n_chars"))
