"""Main text of web pages: markup roles first, then what a host repeats across pages.

A page is cut into blocks, each with a role from its markup: in the article, in a
menu, header, footer, sidebar, notice, advert, form or comment, or undecided. The
token streams outside the article, joined across blocks, are concatenated host by
host into a suffix array: every suffix is sorted by host and its leading tokens, and
neighbours in that order give, for each position, the length of the longest run that
another page of the host has too. Runs of at least ``min_run`` tokens are the site's;
undecided text that they cover is boilerplate, and what is unique to a page stays.
Blocks inside articles that most articles of the host open and end alike go through
the array too, and a block goes that its runs cover whole.
"""

from __future__ import annotations

import hashlib
import html
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import digest, saved, with_shares

# HTML elements by how they behave here.
RAW = "script|style|noscript|template|svg|iframe|textarea|title|object|math|canvas|select"
DROPPED = frozenset("nav aside footer form button menu dialog head fieldset".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that a following block ends when they are left open.
IMPLIED = frozenset("p li dt dd td th tr option".split())
#: Words of class names and ids that mark what is not the text.
HINTS = frozenset(
    "nav navbar navigation menu header siteheader pageheader topheader masthead footer sitefooter pagefooter sidebar notice notices cookie cookies consent gdpr banner "
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion promotions newsletter subscribe subscription signup login share sharing social "
    "comment comments commentlist replies respond disqus breadcrumb breadcrumbs related recommended widget widgets modal popup overlay toolbar pagination pager".split()
)
#: Those of them that may hold articles which are not the page's own.
LISTS = frozenset("comment comments commentlist replies respond disqus related recommended widget widgets sidebar promo promos promotion promotions sponsor sponsored sponsors ad ads advert adverts".split())
#: First words of names that say how a page is laid out, not what an element is: with-sidebar, no-ads.
LAYOUT = frozenset("with without has have no not is hide show layout template".split())
#: Words of the text's own parts: post-header is no header of the site.
OWN = frozenset("post entry article story".split())
#: Words that add nothing to a name.
PLAIN = OWN | frozenset("posts entries articles stories list lists box boxes area section block container inner item items card cards site page top bottom left right main primary secondary".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
ARTICLE, UNDECIDED, OTHER = 0, 1, 2


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(text)}


def hint(names: str) -> int:
    """What the class names or ids of an element say: 0 nothing, 1 not the text, 2 neither are articles in it."""
    found = 0
    for name in names.split():
        words = [w for w in re.split(r"[-_]+", name.lower().replace("side-bar", "sidebar").replace("skip-link", "menu")) if w]
        said = HINTS & {*words}
        if not said or words[0] in LAYOUT or (OWN & {*words} and said & {"header", "footer"}):
            continue
        found = max(found, 2 if LISTS & said and all(w in HINTS or w in PLAIN for w in words) else 1)
    return found


def _is_dropped(name: str, attributes: dict[str, str], in_article: bool) -> int:
    """0 for an element that stays; 1 for one that goes unless it holds an article or the main text, 2 unless the latter, 3 for one that goes whole."""
    if name in DROPPED or (name == "header" and not in_article) or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return 3
    if name in ("html", "body", "main", "article"):
        return 0
    if attributes.get("role", "").lower() in ROLES or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return 3
    return max(hint(attributes.get("class", "")), hint(attributes.get("id", "")))


def _is_main(name: str, attributes: dict[str, str]) -> bool:
    return name == "main" or attributes.get("role", "").lower() == "main" or attributes.get("itemprop") == "articleBody"


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(role, text) of every block that has text, in page order."""
    out: list[tuple[int, str]] = []
    if not page:
        return out
    waiting: list[str] = []
    inside: list[list] = []  # the open elements that hold the text, and how many of their name are open in each
    dropped, depth, firm = "", 0, 0

    def flush() -> None:
        if waiting:
            text = " ".join(html.unescape("".join(waiting)).split())
            waiting.clear()
            if text:
                out.append((OTHER if dropped else ARTICLE if inside else UNDECIDED, text))

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            waiting.append(page[at:m.start()])
        at = m.end()
        name = m[3]
        if not name:
            continue
        name, closing = name.lower(), m[2] == "/"
        if name in BLOCKS:
            flush()
        elif name == "br":
            waiting.append(" ")
        attributes = _attributes(m[4]) if m[4] and not closing else {}
        if dropped and firm < 3 and not closing and (_is_main(name, attributes) or (name == "article" and firm < 2)):
            flush()
            dropped = ""  # a name cannot take the text away that the element holds
        if dropped:
            if dropped in IMPLIED and not closing and name in BLOCKS and depth == 1:
                dropped = ""
            elif name == dropped and name not in VOID:
                depth += -1 if closing else 1
                if depth == 0:
                    flush()
                    dropped = ""
                continue
            else:
                continue
        if closing:
            if inside and inside[-1][0] == name:
                inside[-1][1] -= 1
                if inside[-1][1] == 0:
                    flush()
                    inside.pop()
            elif name in ("article", "main") and (own := [k for k, (n, _) in enumerate(inside) if n == name]):
                flush()
                del inside[own[-1]:]  # what was left open in it ends too
            continue
        if name in VOID or m[4].endswith("/"):
            continue
        is_main = _is_main(name, attributes)
        if not is_main and (firm := _is_dropped(name, attributes, bool(inside))):
            flush()
            dropped, depth = name, 1
        elif is_main or name == "article":
            flush()
            inside.append([name, 1])
        elif inside and inside[-1][0] == name:
            inside[-1][1] += 1
    if at < len(page):
        waiting.append(page[at:])
    flush()
    return out


def _host(url: str | None) -> str:
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def token_keys(tokens: list[str]) -> bytes:
    """Four bytes for each token; equal tokens have equal ones."""
    return b"".join(zlib.crc32(t.encode("utf-8", "replace")).to_bytes(4, "big") for t in tokens)


def shared_lengths(hosts: list[str], keys: list[bytes], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For suffixes in sorted order, the number of leading tokens that a suffix of another page of the host has too.

    ``keys`` hold the leading tokens, ``first`` and ``last`` the least and greatest page
    of each suffix's stream. Of a stream that several pages have, all of the key counts.
    """
    n = len(keys)
    sizes = np.fromiter(map(len, keys), np.int64, n) // 4
    width = int(sizes.max(initial=1))
    tokens = np.frombuffer(b"".join(k.ljust(4 * width, b"\0") for k in keys), ">u4").reshape(n, width)
    new_host = np.array([a != b for a, b in itertools.pairwise(hosts)], bool)
    equal = np.logical_and.accumulate(tokens[1:] == tokens[:-1], axis=1).sum(axis=1)
    common = np.minimum(np.minimum(equal, sizes[1:]), sizes[:-1])
    common[new_host] = 0
    common = np.concatenate([[0], common, [0]])  # with the suffix before each, and after the last
    many = first != last
    same_as_before = np.concatenate([[False], ~many[1:] & ~many[:-1] & (first[1:] == first[:-1])]) if n else many
    above, below = common[:-1].copy(), common[1:].copy()
    begins = np.flatnonzero(~same_as_before)
    for a, b in zip(begins, [*begins[1:], n], strict=True):
        if b - a > 1:  # suffixes of one page in a row: the nearest of another page is beyond them
            above[a:b] = np.minimum.accumulate(common[a:b])
            below[a:b] = np.minimum.accumulate(common[a + 1:b + 1][::-1])[::-1]
    return np.where(many, sizes, np.maximum(above, below))


def _repeated(streams: DataFrame, min_run: int, window: int) -> DataFrame:
    """sid, spans, site_tokens of the streams in which another page of the host shares a run.

    ``streams`` (sid, host, stream, first, last). Suffixes are dealt to ranges of the sorted order by host, leading
    tokens and sid, so neither a host nor a run that a third of the pages has is one task's. At the ends of a range
    a length can be too short, so intervals of ``min_run`` tokens are also told by an aggregate over all ranges.
    """

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, at, keys, source = [], [], [], []
            for k, (own, stream) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                data = token_keys(stream.split(" "))
                n = max(0, len(data) // 4 - min_run + 1)
                sid += [own] * n
                at += range(n)
                source += [k] * n
                keys += [data[4 * i:4 * (i + window)] for i in range(n)]
            rest = [batch.column(c).take(pa.array(source, pa.int64())) for c in (1, 3, 4)]
            yield pa.RecordBatch.from_arrays([pa.array(sid, pa.int64()), pa.array(at, pa.int32()), pa.array(keys, pa.binary()), *rest], ["sid", "at", "key", "host", "first", "last"])

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches in sorted order; each is looked at with the rows beside it."""
        before: pa.Table | None = None
        for batch, after in itertools.pairwise(itertools.chain((pa.Table.from_batches([b]) for b in batches if b.num_rows), [None])):
            table = pa.concat_tables([x for x in (before, batch, after.slice(0, 1) if after else None) if x])
            found = shared_lengths(table["host"].to_pylist(), table["key"].to_pylist(), table["first"].to_numpy(), table["last"].to_numpy())
            start = 1 if before else 0
            own = pa.array(found[start:start + len(batch)].astype(np.int32))
            before = batch.slice(len(batch) - 1)
            yield from batch.select(["sid", "at"]).append_column("length", own).combine_chunks().to_batches()

    rows = saved(streams.select("sid", "host", "stream", "first", "last").mapInArrow(suffixes, "sid long, at int, key binary, host string, first long, last long"))
    interval = digest(F.col("host"), F.expr(f"substring(key, 1, {4 * min_run})"))
    common = rows.groupBy(interval.alias("interval")).agg(F.min("first").alias("a"), F.max("last").alias("b"), F.count("*").alias("n")).where("a < b").select("interval", "n")
    ranged = rows.repartitionByRange("host", "key", "sid").sortWithinPartitions("host", "key", "sid", "at")
    sorted_runs = ranged.mapInArrow(lengths, "sid long, at int, length int").where(F.col("length") >= min_run)
    least = with_shares(rows.select("sid", "at", interval.alias("interval")), common, "interval").select("sid", "at", F.lit(min_run).alias("length"))
    runs = sorted_runs.unionByName(least).groupBy("sid", "at").agg(F.max("length").alias("length"))
    spans = runs.groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("at", "length"))).alias("spans"))  # at most the tokens of one page

    def grow(state: Column, span: Column) -> Column:
        end = span["at"] + span["length"]
        return F.struct(F.greatest(state["end"], end).alias("end"), (state["n"] + F.greatest(F.lit(0), end - F.greatest(state["end"], span["at"]))).alias("n"))

    return spans.withColumn("site_tokens", F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), grow)["n"])


def _of_most(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """The ``rows`` (site_of, article, end and more), less end, whose end is in three articles of the host at least and in more than half of them.

    ``articles`` (site_of, articles) counts the articles of each host. Equal articles count as one.
    """
    each = rows.groupBy("site_of", "end", "article").agg(F.count("*").alias("n"))
    counts = saved(each.groupBy("site_of", "end").agg(F.count("*").alias("with"), F.sum("n").alias("meets")).where("with >= 3"))
    sizes = counts.groupBy("site_of").agg(F.count("*").alias("n")).join(articles, "site_of")
    common = with_shares(counts, sizes, "site_of").where("2 * with > articles").select("end", F.col("meets").alias("n"))
    return with_shares(rows, common, "end").drop("end")


def _site_blocks(articles: DataFrame, min_run: int, window: int) -> DataFrame:
    """row, site_blocks: the blocks of an article that are the site's own; only rows that have some.

    ``articles`` (row, host, text). A block's first ``min_run`` tokens, and its last, are those of blocks in most articles
    of the host, and the array's runs, here of such blocks alone, cover every token of it.
    """
    named = articles.withColumn("site_of", digest(F.col("host"))).withColumn("article", F.xxhash64("text"))
    sizes = saved(named.select("site_of", "article").distinct().groupBy("site_of").agg(F.count("*").alias("articles")))
    end = lambda n: digest(F.hex("site_of"), F.substring_index("block", " ", n)).alias("end")
    parts = named.select("row", "site_of", "article", F.posexplode(F.split("text", "\n")).alias("pos", "block")).where(_tokens("block") >= min_run)
    opened = saved(_of_most(parts.select("row", "site_of", "article", "pos", end(min_run)), sizes).groupBy("row").agg(F.collect_set("pos").alias("at")))  # its size known, texts stay where they are if it is small
    held = named.join(opened, "row").select("row", "host", "site_of", "article", F.explode(F.transform("at", lambda k: F.get(F.split("text", "\n"), k))).alias("block"))
    held = saved(held)
    blocks_ = saved(_of_most(held.withColumn("end", end(-min_run)), sizes).withColumn("named", digest(F.col("host"), F.col("block"))))
    streams = saved(
        blocks_.groupBy("named").agg(F.first("host").alias("host"), F.first("block").alias("stream"), F.min("article").alias("first"), F.max("article").alias("last"), F.count("*").alias("n"))
        .withColumn("sid", F.monotonically_increasing_id())
    )
    whole = streams.join(_repeated(streams, min_run, window), "sid").where(F.col("site_tokens") == _tokens("stream")).select("named", "n")
    return with_shares(blocks_.select("row", "block", "named"), whole, "named").groupBy("row").agg(F.collect_set("block").alias("site_blocks"))


def _tokens(text: str) -> Column:
    return F.length(text) - F.length(F.translate(text, " \n", "")) + 1


def extract(pages: DataFrame, min_run: int = 8, window: int = 16) -> DataFrame:
    """page_id, url, text, n_chars, site_tokens of every row of ``pages`` (page_id, url, html; further columns are ignored).

    A page with an article or main element yields the blocks in it that no inner
    element marks as something else. Of these a whole block of ``min_run`` tokens or more
    goes if its first and its last ``min_run`` tokens are those of blocks in three articles of the host
    at least and in more than half of them, and runs that articles of the host share cover it whole;
    but where such blocks are more than half of an article nothing of it goes, as copies and near
    copies of an article are articles. Without one, undecided blocks are the text,
    less the runs of at least ``min_run`` tokens that another page of the host has
    outside its article, which may go over the bounds of blocks. A shorter block that
    is in no such run goes only where it belongs to the site: on three pages of the
    host at least, and on more than half of them. Pages with equal html, and pages
    without an article whose undecided blocks are equal, are one page in this, so
    copies of a text do not remove each other; a null or malformed url has host "".
    Null or empty html, or a page of boilerplate alone, gives "". Repeated rows give
    repeated results. Elements left open at the end of a cut page end there.

    ``site_tokens`` says how many tokens of the page, outside its article, are in runs that
    other pages of the host have. Suffixes are compared over ``window`` tokens; a longer run is one at each of its positions.
    """
    kinds = dict(pages.dtypes)
    base = pages.select(F.col("page_id").alias("page_id"), F.col("url").alias("url"), F.col("html").alias("html"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys, streams, short, undecided, own = [], [], [], [], [], []
            for page in batch.column(2).to_pylist():
                found = blocks(page)
                article = [t for role, t in found if role == ARTICLE]
                rest = [] if article else [t for role, t in found if role == UNDECIDED]
                texts.append("\n".join(article))
                keys.append(page_key("\n".join(rest) or page))
                streams.append([" ".join(t for _, t in run) for outside, run in itertools.groupby(found, lambda b: b[0] != ARTICLE) if outside])
                short.append(sorted({t for role, t in found if role != ARTICLE and t.count(" ") < min_run - 1}))
                undecided.append([t for _, t in found] if rest else [])
                own.append([role == UNDECIDED for role, _ in found] if rest else [])
            hosts = [_host(u) for u in batch.column(1).to_pylist()]
            lists, flags = pa.list_(pa.string()), pa.list_(pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hosts), pa.array(keys, pa.int64()), pa.array(texts), pa.array(streams, lists), pa.array(short, lists), pa.array(undecided, lists), pa.array(own, flags)],
                ["page_id", "url", "host", "page", "text", "streams", "short", "undecided", "own"],
            )

    schema = f"page_id {kinds['page_id']}, url string, host string, page long, text string, streams array<string>, short array<string>, undecided array<string>, own array<boolean>"
    parsed = saved(base.mapInArrow(parse, schema).withColumn("row", F.monotonically_increasing_id()))  # written, so each row keeps its number
    open_page = F.size("undecided") > 0
    every = parsed.select("row", "host", "page", open_page.alias("open"), F.explode("streams").alias("stream")).withColumn("named", digest(F.col("host"), F.col("stream")))
    streams = saved(
        every.groupBy("named").agg(
            F.first("host").alias("host"), F.first("stream").alias("stream"), F.min("page").alias("first"), F.max("page").alias("last"),
            F.count("*").alias("n"), F.max("open").alias("open"),
        ).withColumn("sid", F.monotonically_increasing_id())
    )
    # a page without an article is one stream, and needs its spans
    wanted = F.when(F.col("open"), F.col("spans")).alias("spans")
    repeated = streams.select("sid", "named", "n", "open").join(_repeated(streams, min_run, window), "sid").select("named", "n", "site_tokens", wanted)
    found = with_shares(every.select("row", "open", "named"), repeated, "named")
    site_runs = saved(found.groupBy("row").agg(F.sum("site_tokens").alias("site_tokens"), F.max(F.when(F.col("open"), F.col("spans"))).alias("spans")))

    open_pages = parsed.where(open_page)
    site_of = digest(F.col("host")).alias("site_of")
    hosts = parsed.groupBy(site_of).agg(F.count("*").alias("n"), F.max(open_page).alias("open")).where("open").drop("open")
    of_open = saved(with_shares(parsed.select("row", "page", "short", site_of), hosts, "site_of"))
    pages_of = of_open.select("site_of", "page").distinct().groupBy("site_of").agg(F.count("*").alias("pages"))
    named = digest(F.hex("site_of"), F.col("block")).alias("named")
    short = of_open.select("site_of", "page", F.explode("short").alias("block")).select("site_of", "page", named).distinct()
    counts = saved(short.groupBy("site_of", "named").agg(F.count("*").alias("with")))
    sizes = counts.groupBy("site_of").agg(F.count("*").alias("n")).join(pages_of, "site_of")
    common_blocks = with_shares(counts, sizes, "site_of").where("with >= 3 and 2 * with > pages").select("named", F.col("with").alias("n"))
    wanted_short = open_pages.select("page", site_of, F.explode("short").alias("block")).select("page", "site_of", named, "block").distinct()
    site = with_shares(wanted_short, common_blocks, "named").groupBy("site_of", "page").agg(F.collect_set("block").alias("site"))

    def keep_unique(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for found, own, spans, site in zip(*(batch.column(k).to_pylist() for k in range(3, 7)), strict=True):
                of_site = set(site or ())
                tokens = " ".join(found).split(" ")
                covered = np.zeros(len(tokens), bool)
                for span in spans or ():
                    covered[span["at"]:span["at"] + span["length"]] = True
                kept, at = [], 0
                for t, undecided in zip(found, own, strict=True):
                    start, at = at, at + t.count(" ") + 1
                    if undecided and t not in of_site and (rest := " ".join(w for w, c in zip(tokens[start:at], covered[start:at], strict=True) if not c)):
                        kept.append(rest)
                out.append("\n".join(kept))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.string())], ["page_id", "url", "site_tokens", "text"])

    n_site = F.coalesce("site_tokens", F.lit(0)).cast("long").alias("site_tokens")
    rest = open_pages.withColumn("site_of", site_of).join(site_runs, "row", "left").join(site, ["site_of", "page"], "left").select("page_id", "url", n_site, "undecided", "own", "spans", "site")
    rest = rest.mapInArrow(keep_unique, f"page_id {kinds['page_id']}, url string, site_tokens long, text string")
    repeats = saved(_site_blocks(parsed.where(~open_page & (F.col("text") != "")).select("row", "host", "text"), min_run, window))
    decided = parsed.where(~open_page).join(site_runs.select("row", "site_tokens"), "row", "left").join(repeats, "row", "left")
    decided = decided.withColumn("less", F.array_join(F.filter(F.split("text", "\n"), lambda b: ~F.array_contains("site_blocks", b)), "\n"))
    decided = decided.withColumn("text", F.when(F.col("site_blocks").isNotNull() & (2 * _tokens("less") >= _tokens("text")), F.col("less")).otherwise(F.col("text")))
    done = decided.select("page_id", "url", n_site, "text")
    return done.unionByName(rest).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "site_tokens")


def page_key(text: str | None) -> int:
    """64 bits that name a page; they are compared within a host only."""
    data = (text or "").encode("utf-8", "replace")
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "big", signed=True)
