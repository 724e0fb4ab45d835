"""Main text of web pages: zones from markup, judged by a suffix array of the host.

Markup gives each block a zone: *furniture* (menus, headers, footers, sidebars, notices, adverts, forms,
comments), *article* (inside ``article``, else ``main``) or *open*. Furniture is told by the tag or by what a whole
name in class, id or role ends in, forms of layout aside (``nav-links``, not ``with-sidebar``). On a page without
an article, the open blocks are judged by their host's suffix array: the token streams of the host's
pages outside articles are concatenated, suffixes are sorted to a depth of ``min_tokens``, and runs that share
that prefix on pages of different content are boilerplate. Blocks covered by such runs go, unique runs stay.

A host may hold any share of the pages, so its array is built in shards: each task sorts the suffixes of its
own pages and passes on, per distinct run, the smallest and largest page signature. Merging these by run is
partially aggregated, so it finds what one array per host would find: a run is on two pages if and only if the
two differ.

The blocks of an article are judged by the array of their host's articles. Markup vouches for them, and other pages may
quote them, so a run is boilerplate there only if more than half of the host's articles hold it, five different ones
among them. Such a run is on more than half of them in some shard, too: the shards' arrays name the candidates, and
these alone are counted on all pages. An article that would lose more than half of its tokens is a copy of others, not boilerplate, and stays.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .textkernel import grouped, mix, utf8, windows, word_hashes

#: Boilerplate is on so many different articles at least.
LEAST_ARTICLES = 5
#: Shards with fewer articles of a host leave them to a shard of that host.
LEAST_IN_SHARD = 8
#: Bytes of articles that one array covers.
SHARD_BYTES = 4 << 20
#: log2 of the bits in the table that tells most runs that are no candidates: 2 MB.
SIEVE_BITS = 24
#: Pages with boilerplate in their articles that may be broadcast; more are joined by shuffle.
BROADCAST_PAGES = 50_000

# A form may wrap a whole page: what is declared inside it is out of it again.
FORM, FURNITURE, OPEN, MAIN, ARTICLE = -1, 0, 1, 2, 3

_TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+|[^<>]*)>""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_PART = re.compile(r"[^a-z0-9]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Elements whose content is never text of the page.
SKIPPED = frozenset(
    "script style title noscript template textarea iframe object svg math canvas audio video select datalist "
    "noembed noframes".split()
)
#: Elements that begin and end a block.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul caption head".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold furniture wherever they stand; ``header`` does outside an article.
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog button head fieldset".split())
#: Words of class, id or role that mark furniture.
FURNITURE_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs masthead header footer contentinfo sidebar aside "
    "complementary widget ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login search form share sharing social related recommended comment comments commentlist "
    "disqus reply replies respond discussion pagination pager skip toolbar".split()
)
#: Inside an article these mark parts of it.
OWN_WORDS = frozenset("header masthead".split())
#: A name that begins so tells of furniture elsewhere.
QUALIFIERS = frozenset("with without has have no not hide hidden show before after above below".split())
#: Words at the end of a name that tell its form, not its content.
FORMS = frozenset(
    "list lists link links item items inner outer wrap wrapper container content box bar area section block body panel "
    "slot group row column col left right top bottom main primary secondary button buttons icon icons posts widget "
    "container fluid text message title label".split()
)
_NEVER_MARKED = frozenset("html body main article h1".split())
#: Elements that end when another block begins.
_SHORT_LIVED = frozenset("p li dt dd option tr td th".split())


def _names_furniture(token: str, zone: int) -> bool:
    """``cookie-banner``, ``nav-links``, ``ad-1``; not ``with-sidebar``, ``share-price`` or an article's ``entry-header``."""
    parts = [p for p in _PART.split(_HUMP.sub("-", token).lower()) if p]
    if not parts or parts[0] in QUALIFIERS:
        return False
    while len(parts) > 1 and (parts[-1] in FORMS or parts[-1].isdigit()) and parts[-1] not in FURNITURE_WORDS:
        parts.pop()
    return parts[-1] in FURNITURE_WORDS and not (zone >= MAIN and parts[-1] in OWN_WORDS)


def _marked(attributes: str, zone: int) -> bool:
    for m in _ATTRIBUTE.finditer(attributes):
        name = m.group(1).lower()
        if name == "hidden":
            return True
        value = m.group(2) or m.group(3) or m.group(4) or ""
        if any(_names_furniture(token, zone) for token in value.split()):
            return True
    return False


def page_blocks(source: str) -> list[tuple[str, int]]:
    """Text and zone of every block with text, in page order."""
    blocks: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []
    zone, at, skip = OPEN, 0, ""

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            blocks.append((text, zone))

    for m in _TOKEN.finditer(source):
        tag = (m.group(2) or "").lower()
        if skip:
            if tag != skip or not m.group(1):
                continue
            skip, at = "", m.end()
            continue
        if m.start() > at:
            parts.append(source[at : m.start()])
        at = m.end()
        if not tag:
            continue
        if tag in BLOCK:
            flush()
        elif tag == "br":
            parts.append(" ")
        if m.group(1):
            if any(name == tag for name, _ in stack):
                while (popped := stack.pop())[0] != tag:
                    zone = popped[1]
                zone = popped[1]
            continue
        if tag in SKIPPED:
            if not m.group(3).rstrip().endswith("/"):
                skip = tag
            continue
        if tag in VOID:
            continue
        if tag in BLOCK and stack and stack[-1][0] in _SHORT_LIVED and (tag in _SHORT_LIVED or stack[-1][0] == "p"):
            zone = stack.pop()[1]
        kind = _zone_of(tag, m.group(3), zone)
        if kind != zone or tag in BLOCK:
            stack.append((tag, zone))
            if kind != zone:
                flush()
            zone = kind
    if not skip and at < len(source):
        parts.append(source[at:])
    flush()
    return blocks


def _zone_of(tag: str, attributes: str, zone: int) -> int:
    if zone == FURNITURE:
        return FURNITURE
    if tag == "form" and zone <= OPEN:
        return FORM
    if tag in FURNITURE_TAGS or (tag == "header" and zone < MAIN):
        return FURNITURE
    if attributes and tag not in _NEVER_MARKED and _marked(attributes, zone):
        return FURNITURE
    return max(zone, ARTICLE if tag == "article" else MAIN if tag == "main" else zone)


def _host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


_PARSED = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("row_key", pa.int64()), ("host", pa.string())]
    + [("text", pa.string()), ("open", pa.list_(pa.string())), ("around", pa.list_(pa.string()))]
)


def _parse(batches):
    for batch in batches:
        out = {name: [] for name in _PARSED.names}
        held = 0
        for row in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "row_key", "html")]):
            page_id, url, key, source = row
            blocks = page_blocks(source or "")
            best = max((z for _, z in blocks), default=OPEN)
            declared = best in (MAIN, ARTICLE)
            text = "\n".join(t for t, z in blocks if z == best) if declared else ""
            opened = None if declared else [t for t, z in blocks if z == OPEN]
            around = [t for t, z in blocks if z <= OPEN]
            for name, value in zip(_PARSED.names, (page_id, url, key, _host(url), text, opened, around)):
                out[name].append(value)
            held += len(source or "")
            if held > 8 << 20:
                yield pa.RecordBatch.from_pydict(out, schema=_PARSED)
                out, held = {name: [] for name in _PARSED.names}, 0
        yield pa.RecordBatch.from_pydict(out, schema=_PARSED)


def _salt(host: str) -> np.ndarray:
    return word_hashes(b"host:" + host.encode("utf-8", "replace"))[0][:1]


def _stream(host: str, blocks: list[str]) -> np.ndarray:
    """Token hashes of a page's blocks; hosts never share a token."""
    h, _, _ = word_hashes("\n".join(blocks).encode("utf-8", "replace"))
    return mix(h ^ _salt(host))


def _signature(tokens: np.ndarray) -> np.int64:
    places = np.arange(len(tokens), dtype=np.uint64) + np.uint64(1)
    return np.int64(mix(np.sum(windows(tokens, 1) * places, keepdims=True)).view(np.int64)[0])


def suffix_groups(tokens: np.ndarray, depth: int) -> np.ndarray:
    """The rank of each suffix by its first ``depth`` tokens: equal ranks share a prefix of that length.

    Prefix doubling: ranks by 2^k tokens, two at a time, give ranks by 2^(k+1). The suffix array to this depth
    is the order of the ranks. Suffixes shorter than ``depth`` are ranked as if padded with tokens of their own.
    """
    size = len(tokens)
    _, rank = np.unique(tokens, return_inverse=True)
    length = 1
    while length < depth:
        step = min(length, depth - length)
        after = np.arange(size, dtype=np.int64) + step
        inside = after < size
        second = np.where(inside, rank[np.minimum(after, size - 1)] + 1, -np.arange(size, dtype=np.int64))
        _, rank = np.unique(rank.astype(np.int64) * np.int64(2 * size + 2) + second, return_inverse=True)
        length += step
    return rank


def _runs(depth: int):
    """A shard's distinct runs with the smallest and largest signature of the pages that hold them."""

    def run(batches):
        for batch in batches:
            streams, owners, ids = [], [], []
            marker = np.uint64(0)
            for host, blocks in zip(batch.column("host").to_pylist(), batch.column("around").to_pylist()):
                tokens = _stream(host, blocks or [])
                if len(tokens) < depth:
                    continue
                signature = _signature(tokens)
                marker += np.uint64(1)
                streams.append(np.concatenate((tokens, [mix(np.array([marker]) ^ np.uint64(0xABCD))[0]])))
                starts = len(tokens) - depth + 1
                owners.append(np.concatenate((np.full(starts, signature), np.zeros(depth, np.int64))))
                ids.append(np.concatenate((windows(tokens, depth), np.zeros(depth, np.uint64))))
                ids[-1] = ids[-1][: len(tokens) + 1]
                owners[-1] = owners[-1][: len(tokens) + 1]
            if not streams:
                continue
            every, owner, run_id = np.concatenate(streams), np.concatenate(owners), np.concatenate(ids)
            rank = suffix_groups(every, depth)
            real = np.flatnonzero(run_id != 0)
            order = real[np.argsort(rank[real], kind="stable")]
            heads = np.flatnonzero(np.concatenate(([True], np.diff(rank[order]) != 0)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(run_id[order][heads].view(np.int64)),
                    pa.array(np.minimum.reduceat(owner[order], heads)),
                    pa.array(np.maximum.reduceat(owner[order], heads)),
                ],
                names=["run", "lo", "hi"],
            )

    return run


def _open_runs(depth: int):
    """Every run of the open blocks of a page, with its place."""

    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("row_key", "host", "open")]
            for key, host, blocks in zip(*columns):
                ids = windows(_stream(host, blocks or []), depth)
                if len(ids):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(ids), key)), pa.array(ids.view(np.int64)), pa.array(range(len(ids)), pa.int32())],
                        names=["row_key", "run", "place"],
                    )

    return run


def _majority_runs(hosts: list[str], streams: list[np.ndarray], depth: int, least: int) -> tuple[np.ndarray, set[str]]:
    """Runs on more than half of a host's articles, and the hosts with fewer than ``least`` articles, which are left out."""
    sizes = Counter(hosts)
    few = {host for host, n in sizes.items() if n < least}
    kept = [i for i, host in enumerate(hosts) if host not in few and len(streams[i]) >= depth]
    if not kept:
        return np.empty(0, np.uint64), few
    ends = mix(np.arange(1, len(kept) + 1, dtype=np.uint64) ^ np.uint64(0xABCD))
    every = np.concatenate([x for i, end in zip(kept, ends) for x in (streams[i], [end])])
    long = np.array([len(streams[i]) + 1 for i in kept])
    page = np.repeat(np.arange(len(kept)), long)
    of_page = np.array([sizes[hosts[i]] for i in kept])
    left = np.repeat(np.cumsum(long), long) - np.arange(len(every))
    rank = suffix_groups(every, depth).astype(np.int64)
    starts = np.flatnonzero(left > depth)
    found = np.bincount(rank[starts])
    starts = starts[2 * found[rank[starts]] > of_page[page[starts]]]  # those on fewer pages are not sorted again
    _, first = np.unique(rank[starts] * len(kept) + page[starts], return_index=True)
    starts = starts[first]
    _, first, pages = np.unique(rank[starts], return_index=True, return_counts=True)
    starts = starts[first]
    starts = starts[2 * pages > of_page[page[starts]]]
    return windows(every, depth)[starts], few


def _candidates(depth: int, least: int):
    """Runs on more than half of a host's articles in the shard; articles of hosts with few of them as they are."""

    def run(batches):
        for batch in batches:
            hosts, texts = batch.column("host").to_pylist(), utf8(batch.column("text"))
            for lo, hi in grouped(texts, SHARD_BYTES):
                streams = [_stream(h, [t.decode("utf-8", "replace")]) for h, t in zip(hosts[lo:hi], texts[lo:hi])]
                runs, few = _majority_runs(hosts[lo:hi], streams, depth, least)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(runs.view(np.int64)), pa.nulls(len(runs), pa.string()), pa.nulls(len(runs), pa.string())],
                    names=["run", "host", "text"],
                )
                alone = [(h, t.decode("utf-8", "replace")) for h, t in zip(hosts[lo:hi], texts[lo:hi]) if h in few]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(alone), pa.int64()), pa.array([h for h, _ in alone], pa.string()), pa.array([t for _, t in alone], pa.string())],
                    names=["run", "host", "text"],
                )

    return run


def _candidate_places(depth: int, sieve):
    """Each article once with its signature, and every run of it that the sieve lets through, with its place."""

    def run(batches):
        words = sieve.value
        for batch in batches:
            for key, host, text in zip(*[batch.column(c).to_pylist() for c in ("row_key", "host", "text")]):
                tokens = _stream(host, [text])
                ids = windows(tokens, depth)
                slot = ids >> np.uint64(64 - SIEVE_BITS)
                at = np.flatnonzero(words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1))
                home, n = _salt(host).view(np.int64)[0], len(at) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, key)),
                        pa.array(np.full(n, home)),
                        pa.array(np.full(n, _signature(tokens))),
                        pa.array([None, *ids[at].view(np.int64).tolist()], pa.int64()),
                        pa.array([None, *at.tolist()], pa.int32()),
                    ],
                    names=["row_key", "home", "signature", "run", "place"],
                )

    return run


def _article_places(articles: DataFrame, depth: int) -> DataFrame:
    """``row_key`` and ``places`` of the articles with boilerplate runs of their host's articles."""
    spark = articles.sparkSession
    kind = "run long, host string, text string"
    pages = articles.select("host", "text")
    shards = materialize(pages.mapInArrow(_candidates(depth, LEAST_IN_SHARD), kind), "article-runs")
    alone = shards.where("host is not null").select("host", "text").repartition("host").sortWithinPartitions("host")
    runs = shards.select("run").union(alone.mapInArrow(_candidates(depth, 0), kind).select("run")).where("run is not null")
    slot = F.shiftrightunsigned("run", 64 - SIEVE_BITS)
    word = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    bits = runs.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("id")).agg(F.bit_or(word).alias("word")).toArrow()
    table = np.zeros(1 << (SIEVE_BITS - 6), np.uint64)
    table[bits.column("id").to_numpy()] = bits.column("word").to_numpy().view(np.uint64)
    found = articles.select("row_key", "host", "text").mapInArrow(
        _candidate_places(depth, spark.sparkContext.broadcast(table)),
        "row_key long, home long, signature long, run long, place int",
    )
    found = materialize(found, "article-places")
    sizes = found.where("run is null").groupBy("home").agg(F.count(F.lit(1)).alias("articles"))
    held = found.where("run is not null").groupBy("home", "run", "signature").agg(F.count_distinct("row_key").alias("pages"))
    held = held.groupBy("home", "run").agg(F.sum("pages").alias("pages"), F.count(F.lit(1)).alias("contents"))
    most = held.where(F.col("contents") >= LEAST_ARTICLES).join(sizes, "home").where("2 * pages > articles")
    return found.join(most.select("home", "run"), ["home", "run"]).groupBy("row_key").agg(F.collect_list("place").alias("places"))


def _unique_blocks(depth: int, share: float, most: float = 1.0):
    """Blocks that runs do not cover; all of them if that were to take more than ``most`` of the page."""

    def run(batches):
        for batch in batches:
            texts = []
            for blocks, places in zip(batch.column("open").to_pylist(), batch.column("places").to_pylist()):
                blocks = blocks or []
                sizes = [len(b.split()) for b in blocks]
                cover = np.zeros(sum(sizes) + depth + 1, dtype=np.int64)
                for p in places or []:
                    cover[p : p + depth] = 1
                ends = np.cumsum([0, *sizes])
                gone = [cover[lo:hi].sum() >= share * (hi - lo) for lo, hi in zip(ends[:-1], ends[1:])]
                if np.dot(gone, sizes) > most * ends[-1]:
                    gone = [False] * len(blocks)
                texts.append("\n".join(b for b, without in zip(blocks, gone) if not without))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    return run


def extract_text(pages: DataFrame, min_tokens: int = 8, covered_share: float = 0.8) -> DataFrame:
    """``(page_id, url, text)`` of every row of ``pages`` (page_id, url, html).

    Character references are decoded, white space inside a block is one space, blocks are joined by a line feed.
    A null or empty html, or one with furniture only, has the empty text. A null or broken url belongs to the
    host without a name. Repeated rows and pages of equal content count as one page for the suffix array and are
    answered each. A block goes if ``covered_share`` of its tokens lie in runs of ``min_tokens`` or more tokens
    that pages of different content share; in an article, that more than half of the host's articles share, and then only
    if at most half of the article goes. There every row counts, and five articles must differ. An empty table gives an empty result.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    ).withColumn("row_key", F.monotonically_increasing_id())
    parsed = materialize(
        rows.mapInArrow(
            _parse,
            "page_id long, url string, row_key long, host string, text string, open array<string>, around array<string>",
        ),
        "pages",
    )
    shards = parsed.select("host", "around").mapInArrow(_runs(min_tokens), "run long, lo long, hi long")
    repeated = shards.groupBy("run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi").select("run")
    undeclared = parsed.where("open is not null")
    places = (
        undeclared.select("row_key", "host", "open")
        .mapInArrow(_open_runs(min_tokens), "row_key long, run long, place int")
        .join(repeated, "run")
        .groupBy("row_key")
        .agg(F.collect_list("place").alias("places"))
    )
    judged = undeclared.join(places, "row_key", "left").select("page_id", "url", "open", "places")
    text_of = "page_id long, url string, text string"
    return _judged_articles(parsed.where("open is null"), min_tokens, covered_share).unionByName(
        judged.mapInArrow(_unique_blocks(min_tokens, covered_share), text_of)
    )


def _judged_articles(articles: DataFrame, min_tokens: int, covered_share: float) -> DataFrame:
    places = materialize(_article_places(articles, min_tokens), "article-boilerplate")
    if places.count() <= BROADCAST_PAGES:
        places = F.broadcast(places)
    marked = articles.join(places, "row_key", "left")
    cut = marked.where("places is not null").select("page_id", "url", F.split("text", "\n").alias("open"), "places")
    return marked.where("places is null").select("page_id", "url", "text").unionByName(
        cut.mapInArrow(_unique_blocks(min_tokens, covered_share, 0.5), "page_id long, url string, text string")
    )
