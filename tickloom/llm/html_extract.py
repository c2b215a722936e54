"""Main text of pages: markup zones and repeated runs per host.

A page is read into blocks of text, each in a zone that its markup names: the main
text (``article``, ``main``), furniture (menus, footers, sidebars, forms, adverts,
comments ...) or open, where the markup says neither. Everything outside the main
text goes into the page's token stream. What a host repeats is found by hashes of all
windows of ``RUN`` tokens and of whole blocks of ``DEPTH`` tokens or more: they stand for a suffix
array, whose neighbours with a common prefix of ``RUN`` tokens are the same runs. A run or
block is boilerplate where it is in at least ``TEXTS`` distinct texts of the host and in
``SHARE`` of them; pages alike in all but furniture are one text, so copies of a page do not erase
each other. Furniture goes; of open text, which is all there is to keep on pages
without a marked main text, boilerplate goes where it is ``RUN`` tokens of a block or all of it,
and everything else stays. Marked main text stays whole, be it repeated or not: copies
of an article are articles.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from tickloom.llm.common import fresh, quoted
from tickloom.session import staged

DEPTH = 6  # tokens of a repeated whole block, at least
RUN = 12  # tokens of a repeated run, at least
TEXTS, SHARE = 3, 0.05  # of the host's distinct texts that have the boilerplate, at least
MAIN, FURNITURE, OPEN, SKIPPED = "main", "furniture", "open", "skipped"
LISTED, INNER = "listed", "inner"  # while reading: something named as comments, and an article or main in it

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][\w:-]*)(?P<rest2>[^>]*)(?:>|\Z)"
    r"|</[^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.IGNORECASE)
_WORDS = re.compile(r"[a-z0-9]+")

RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
HEAD = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())  # what does not end it
SKIP = frozenset("head svg math object canvas audio video select datalist".split())
ASIDE = frozenset("nav footer aside button dialog menu".split())
CONTAINERS = frozenset(
    "html body article main section div nav header footer aside form ul ol li dl dt dd table thead tbody tfoot tr td th "
    "blockquote pre figure figcaption details dialog menu button fieldset center".split()
) | SKIP
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 hr address summary legend caption hgroup option".split()) - {"button"}
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
COMMENTS = frozenset("comment comments disqus replies respond reviews".split())
HINTS = COMMENTS | frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner cookie cookies consent gdpr "
    "notice notices alert sidebar widget menu nav navbar navigation breadcrumb breadcrumbs masthead topbar toolbar footer header "
    "copyright related recommended share sharing social subscribe subscription newsletter signup login popup modal overlay pagination "
    "pager contentinfo complementary search skip disclaimer".split()
)
# words that say which part of a page or of a list it is, beside one that says what it is
PLACES = frozenset("site page post main primary secondary global area list section block box item items body bar links slot unit form text".split())


def _attributes(rest: str) -> dict[str, str]:
    """An element's attributes, names in lower case; the first of a name counts."""
    out: dict[str, str] = {}
    for match in _ATTRIBUTE.finditer(rest):
        out.setdefault(match[1].lower(), match[2] or match[3] or match[4] or "")
    return out


def _names(attributes: dict[str, str], hints: frozenset[str]) -> bool:
    """Whether a class, id or role is one of ``hints``, or made of them and ``PLACES`` alone: not ``has-sidebar``."""
    for name in ("class", "id", "role"):
        for value in attributes.get(name, "").lower().split():
            words = set(_WORDS.findall(value))
            if words & hints and words <= HINTS | PLACES:
                return True
    return False


def _zone(tag: str, rest: str, parent: str, soft: bool, outer: bool) -> tuple[str, bool]:
    """Zone of an element in one of zone ``parent``, and whether an article or main in it is main text though it is furniture.

    ``outer``: it is a form with nothing but ``html`` and ``body`` around it.
    """
    if parent == SKIPPED or tag in SKIP:
        return SKIPPED, False
    if tag in ("html", "body"):  # their names tell the page's state, and scripts show them
        return parent, soft
    own = _attributes(rest) if rest else {}
    hidden = "hidden" in own or own.get("aria-hidden", "").lower() == "true" or _NO_DISPLAY.search(own.get("style", ""))
    if tag in ASIDE or hidden or parent == FURNITURE and not soft:
        return FURNITURE, False
    if tag in ("article", "main") or own.get("role", "").lower() == "main":
        return (INNER if parent in (LISTED, INNER) else MAIN), False
    if _names(own, COMMENTS):
        return (FURNITURE if parent in (MAIN, INNER) or tag in ("ol", "ul", "dl") else LISTED), False
    if parent in (FURNITURE, LISTED):
        return parent, soft
    if tag == "form" and not outer or _names(own, HINTS) or tag == "header" and parent not in (MAIN, INNER):
        return FURNITURE, True
    return parent, False


def blocks(page: str | None) -> list[tuple[str, str]]:
    """(zone, text) of a page's blocks in page order, references decoded, white space one space.

    A single article or main in something named as comments is the main text of a page that
    has no other, or open text beside open text; several are comments.
    """
    page = page or ""
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str, bool]] = []
    zone, soft, parts, at, inner = OPEN, False, [], 0, 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text and zone != SKIPPED:
            out.append((zone, text))

    while match := _MARKUP.search(page, at):
        parts.append(page[at : match.start()])
        at = match.end()
        tag = (match["tag"] or match["tag2"] or "").lower()
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCKS:
            flush()
        if match["close"] or match["close2"]:
            if tag in CONTAINERS and any(name == tag for name, _, _ in stack):
                while stack:
                    name, zone, soft = stack.pop()
                    if name == tag:
                        break
            continue
        if zone == SKIPPED and tag not in HEAD and any(name == "head" for name, _, _ in stack):  # its end tag was left out
            flush()
            while stack:
                name, zone, soft = stack.pop()
                if name == "head":
                    break
        rest = match["rest"] or match["rest2"] or ""
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        elif tag in CONTAINERS and tag not in VOID and not (tag in SKIP and rest.endswith("/")):
            outer = tag == "form" and all(name in ("html", "body") for name, _, _ in stack)
            stack.append((tag, zone, soft))
            before, (zone, soft) = zone, _zone(tag, rest, zone, soft, outer)
            inner += zone == INNER and before == LISTED
    parts.append(page[at:])
    flush()
    zones = {zone for zone, _ in out}
    if not zones & {LISTED, INNER}:
        return out
    single = (OPEN if OPEN in zones else MAIN) if inner == 1 and MAIN not in zones else FURNITURE
    return [(single if zone == INNER else FURNITURE if zone == LISTED else zone, text) for zone, text in out]


def stream(found: list[tuple[str, str]]) -> list[tuple[list[str], list[bool]]]:
    """Stretches of tokens outside the main text, furniture apart from open text; True where a token is open text of a page without main text."""
    keep_open = all(zone != MAIN for zone, _ in found)
    out: list[tuple[list[str], list[bool]]] = [([], [])]
    before = None
    for zone, text in found:
        if zone != before:
            out.append(([], []))
        before = zone
        if zone == MAIN:
            continue
        tokens = text.split()
        out[-1][0].extend(tokens)
        out[-1][1].extend([keep_open and zone == OPEN] * len(tokens))
    return [s for s in out if s[0]]


def main_text(found: list[tuple[str, str]], covered: set[int]) -> str:
    """The marked main text, or else the open text without its covered tokens.

    Covered tokens go where ``RUN`` of them follow each other in a block or they are all of it:
    a sentence does not lose the words by which a run reaches into it.
    """
    if any(zone == MAIN for zone, _ in found):
        return "\n\n".join(text for zone, text in found if zone == MAIN)
    out, at = [], 0
    for zone, text in found:
        tokens = text.split()
        if zone == OPEN:
            left, run = [], []
            for i, token in enumerate(tokens, at):
                if i in covered:
                    run.append(token)
                    continue
                left += [*(run if len(run) < RUN else ()), token]
                run = []
            if len(run) < min(RUN, len(tokens)):
                left += run
            if left:
                out.append(" ".join(left))
        at += len(tokens)
    return "\n\n".join(out)


def _text_number(found: list[tuple[str, str]]) -> int:
    """A number for a page's text without furniture: pages of one number are copies."""
    body = "\n".join(text for zone, text in found if zone != FURNITURE)
    return int.from_bytes(hashlib.blake2b(body.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of ``RUN`` tokens of a page's streams, and every shorter block of ``DEPTH`` or more; one row without tokens for the page's text."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            rows, copy, head, at, length, mine = [], [], [], [], [], []
            for row, page in enumerate(part.column(2)):
                found = blocks(page.as_py())
                if not found:
                    continue
                number = _text_number(found)
                keep_open = all(zone != MAIN for zone, _ in found)
                runs, start = [("", 0, 0, False)], 0
                for tokens, own in stream(found):
                    runs += [(" ".join(tokens[i : i + RUN]), start + i, RUN, own[i]) for i in range(len(tokens) - RUN + 1)]
                    start += len(tokens)
                start = 0
                for zone, text in found:
                    if zone != MAIN:
                        n = len(text.split())
                        if DEPTH <= n < RUN:
                            runs.append((f"\n{' '.join(text.split())}", start, n, keep_open and zone == OPEN))
                        start += n
                for words, begin, n, own in runs:
                    rows.append(row)
                    copy.append(number)
                    head.append(words)
                    at.append(begin)
                    length.append(n)
                    mine.append(own)
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(taken), part.column(1).take(taken), pa.array(copy, pa.int64()), pa.array(head, pa.string()),
                    pa.array(at, pa.int32()), pa.array(length, pa.int32()), pa.array(mine, pa.bool_()),
                ],
                names=["page", "host", "copy", "head", "at", "length", "mine"],
            )


def page_host(url: Column) -> Column:
    """The host after ``://``, in lower case; empty without one."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def extract(pages: DataFrame, *, url: str = "url", page: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text of ``page`` in ``text``; blocks are joined by two line feeds.

    NULL or empty pages, and pages of furniture alone, give the empty text. Pages without
    host (NULL url) are one host. Pages of a host that differ in furniture alone are one
    text, so neither a repeated row nor a copy of a page is a repeat. Windows are dealt by
    host and tokens, and counted with partial sums, so a host or a run in a third of all
    pages is spread like any other; nothing of a host is gathered in one task but a single
    page. A column called ``text`` is replaced, all others but ``page`` are kept.
    """
    kept = [c for c in pages.columns if c.lower() not in (page.lower(), text.lower())]
    key, runs = fresh(pages, "_page", "_covered")
    number = F.xxhash64(*[quoted(c) for c in pages.columns if dict(pages.dtypes)[c].split("<")[0] != "map"])
    body = quoted(page).cast("string")
    windows = pages.select(number.alias("page"), page_host(quoted(url)).alias("host"), body.alias("html")).mapInArrow(
        _windows, "page long, host string, copy long, head string, at int, length int, mine boolean"
    )
    windows = windows.select("page", F.xxhash64("host").alias("host"), "copy", F.xxhash64("host", "head").alias("h"), "at", "length", "mine")
    texts = windows.groupBy("host", "h", "copy").agg(F.max("mine").alias("mine"), F.max("length").alias("length"))
    counts = staged(texts.groupBy("host", "h").agg(F.count("*").alias("texts"), F.max("mine").alias("mine"), F.max("length").alias("length")).where(f"length = 0 or mine and texts >= {TEXTS}"))
    hosts = counts.where("length = 0").select("host", F.col("texts").alias("all"))
    repeated = counts.where("length > 0").join(hosts, "host").where(F.col("texts") >= SHARE * F.col("all")).select("h")
    hits = windows.where("mine").join(repeated, "h").groupBy("page").agg(F.sort_array(F.collect_set(F.struct("at", "length"))).alias("runs"))
    hits = staged(hits)  # one row per page that has any, of at most as many numbers as the page has tokens

    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for bodies, starts in batches:
            out = []
            for value, begin in zip(bodies, starts, strict=True):
                covered = {i for run in begin.as_py() or () for i in range(run["at"], run["at"] + run["length"])}
                out.append(main_text(blocks(value.as_py()), covered))
            yield pa.array(out, pa.string())

    read = F.arrow_udf(read, "string", ArrowUDFType.SCALAR_ITER)
    marked = pages.withColumn(key, number).join(hits.select(F.col("page").alias(key), F.col("runs").alias(runs)), key, "left")
    return marked.select(*[quoted(c) for c in kept], read(body, F.col(runs)).alias(text))
