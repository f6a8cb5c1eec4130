"""Main text of web pages by template deduction (operator 4).

A page is a sequence of tokens: each tag and each whole text between tags,
together with the elements that it stands in.  Tokens of one host's pages whose
occurrence vectors (how often in each page) are equal form an equivalence class.
Classes with at least two pages and half of the host's pages are template
candidates.  In a page, a class is valid if its tokens come there in the class's
own order, once or several times over, and if these stretches nest with those of
the larger classes.  Valid classes nested in one another are the page's
template; what lies between their tokens are the slots.

An occurrence vector is compared by number of pages, sum and the sums of both
halves of hashes of (page, count), all partial aggregates: a host with a third of all pages is
never gathered.  A host's candidates are at most twice as many as an average
page's tokens.

The main text is what the slots in an ``article`` (else ``main``, else the body)
hold, outside menus, headers, footers, sidebars, notices, adverts, forms and
reader comments, which are known by element, class, id or role.  Text of the
template itself is left out too.  Inside an article this needs a class that at
least three pages have and that holds markup as well as text: a block such as a
request to subscribe.  A class of texts alone is a sentence that articles share,
and ``h1`` is the article's own title; both stay.  Without an article or main
element, and with one page to a host, the slots are all the body's texts; a page
that would have no text left, or only its title, keeps what it shares.

Edge cases: null and empty pages have an empty text; a null or odd url is a host
of its own kind; broken, unclosed or crossing tags are tolerated; repeated rows
each give a row; a page of any length is read whole; an empty table gives no
rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tillstack.llm.common import small_batches, stored

# Elements whose text is never the article's.
BOILERPLATE = frozenset("""nav footer aside form script style noscript template svg button select iframe menu dialog head
    object canvas audio video map datalist textarea""".split())
# Words in a class or id, and roles, that mark such elements.
MARKS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie
    cookies disqus gdpr login menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promos
    related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription
    toolbar widget footer""".split())
# Words by which a name tells a state or relation ("has-sidebar", "nav-open", "notice-of-meeting"), not a thing.
STATES = frozenset("""has have no not is are with without of for to in on off by open opened closed enabled disabled active
    visible expanded collapsed loaded ready supported""".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe"))
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter q rp rt ruby s samp
    small span strike strong sub sup time tt u var wbr input link meta""".split())
#: Elements that are not kept on the stack: inline ones, and those whose end tags are often left out.
LOOSE = INLINE | frozenset(("p", "li", "dt", "dd", "tr", "td", "th", "option", "thead", "tbody", "tfoot", "hr", "h1", "h2", "h3", "h4", "h5", "h6"))

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                     r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
#: Elements around the whole content.
FRAME = frozenset(("html", "body", "main"))
_FORM_END, _CONTENT = re.compile(r"</form\b", re.I), re.compile(r"<(?:article|main|h1)\b", re.I)
#: A whole ``name=value`` pair, so that no part of a name or value is read as a name.
_ATTRIBUTE = re.compile(r"([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: Fixed value: inside an article, a block that fewer pages have is not the template's.
BLOCK_PAGES = 3
_HOST = re.compile(r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")
_SPACE = re.compile(r"\s+")


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def parts_of(name: str) -> list[str]:
    """The words of a class name or id, but none of one that tells a state."""
    parts = [p for p in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if p]
    return [] if STATES.intersection(parts) else parts


def marked(name: str) -> bool:
    """Whether a class name or id says that its element is no part of the article: it is
    one of ``MARKS``, or begins or ends with one ("site-footer", "ad-slot")."""
    parts = parts_of(name)
    return bool(parts) and (parts[0] in MARKS or parts[-1] in MARKS)


class Token:
    """``key`` names a tag or text with its surroundings; for texts ``text`` is
    their source and ``place`` where they stand: "article", "main", "body", or
    None inside boilerplate."""

    __slots__ = ("key", "text", "place", "tag")

    def __init__(self, key: str, text: str | None, place: str | None, tag: str):
        self.key, self.text, self.place, self.tag = key, text, place, tag


def tokens(page: str) -> list[Token]:
    out: list[Token] = []
    stack: list[tuple[str, str | None, str]] = []  # element, place inside it, its path's hash: keys stay short at any depth
    opened: Counter = Counter()
    path, place, at = "", "body", 0

    def text(upto: int) -> None:
        if upto > at:
            source = page[at:upto]
            if not source.isspace():
                out.append(Token(f"{path}#{_SPACE.sub(' ', source).strip()}", source, place, ""))
            elif out:
                out.append(Token("", " ", place, ""))

    end = len(page)
    while at < end:
        m = _MARKUP.search(page, at)
        if m is None:
            text(end)
            break
        text(m.start())
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            if m[0].startswith("<![CDATA[") and place:
                out.append(Token("", entities.escape(m[0][9:].removesuffix("]]>")), place, ""))
            continue
        name = name.lower()
        if closing:
            if opened[name]:
                while True:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == name:
                        break
                path, place = (stack[-1][2], stack[-1][1]) if stack else ("", "body")
            out.append(Token(f"{path}</{name}>", None, place, name))
            continue
        names, role, hidden, shown = [], "", False, []
        for a in _ATTRIBUTE.finditer(attributes) if attributes.strip(" /") else ():
            value = a[2] or a[3] or a[4] or ""
            kind = a[1].lower()
            if kind in ("class", "id"):
                names += value.split()
                if kind == "class":
                    shown.append(value)
            elif kind == "role":
                role = value.lower()
            elif kind == "aria-hidden":
                hidden = hidden or value.lower() != "false"
            elif kind == "hidden":
                hidden = True
        out.append(Token(f"{path}<{name} {' '.join(shown)}>", None, place, name))
        if name in RAW:
            close = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if name in LOOSE or attributes.rstrip().endswith("/") and name not in ("div", "section", "article", "main"):
            continue
        inside = place
        if name in FRAME:  # these carry the names of the whole page's state
            out_of = hidden
        elif name == "article":
            out_of = hidden or any(n.lower() in MARKS for n in names)
        elif name == "form":
            out_of = hidden or not (all(s[0] in FRAME for s in stack) and _wraps_page(page, at))
        else:
            out_of = (name in BOILERPLATE or hidden or role in ROLES or any(map(marked, names))
                      or place != "article" and (name == "header" or any(parts_of(n)[-1:] in (["header"], ["masthead"]) for n in names)))
        if out_of:
            inside = None
        elif place and name == "article":
            inside = "article"
        elif place == "body" and (name == "main" or role == "main"):
            inside = "main"
        path, place = f"{xxhash.xxh64_intdigest(f'{path}/{name}'.encode('utf-8', 'surrogatepass')):016x}", inside
        stack.append((name, inside, path))
        opened[name] += 1
    return out


def _wraps_page(page: str, at: int) -> bool:
    """Whether the form that opens before ``at`` holds the page's article, as some servers build pages."""
    end = _FORM_END.search(page, at)
    return _CONTENT.search(page, at, end.start() if end else len(page)) is not None


def _hash(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass")) - (1 << 63)


def template_of(found: list[Token], candidates: dict[int, tuple]) -> set[int]:
    """Which tokens (by number) belong to the page's template.

    ``candidates``: token hash -> (class, mean position, pages); the positions' order is the class's.
    """
    classes: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i, t in enumerate(found):
        got = candidates.get(_hash(t.key)) if t.key else None
        if got:
            classes[got[0]].append((i, _hash(t.key)))
    size = 1 << len(found).bit_length()
    over = [0] * (size + 1)  # Fenwick tree: the XOR up to a token names the kept stretches around it

    def around(i: int) -> int:
        got = 0
        while i:
            got ^= over[i]
            i &= i - 1
        return got

    template: set[int] = set()
    for cls, places in sorted(classes.items(), key=lambda x: (-len(x[1]), x[0])):
        order = sorted({h for _, h in places}, key=lambda h: (candidates[h][1], h))
        m = len(order)
        if len(places) % m or any(h != order[j % m] for j, (_, h) in enumerate(places)):
            continue  # not in the class's order
        spans = [(places[j][0], places[j + m - 1][0]) for j in range(0, len(places), m)]
        if any(around(a + 1) != around(b + 1) for a, b in spans):
            continue  # crosses a larger class
        for span in spans if m > 1 else ():  # single tokens cannot be crossed
            name = xxhash.xxh64_intdigest(span[0].to_bytes(8, "little"))
            for i in span:
                i += 1
                while i <= size:
                    over[i] ^= name
                    i += i & -i
        template |= {i for i, _ in places}
    return template


def blocks_of(found: list[Token], candidates: dict[int, tuple], template: set[int]) -> set[int]:
    """The texts inside an article (by number) that are blocks of the template; none where nothing but titles would be left."""
    marked = {candidates[_hash(found[i].key)][0] for i in template if found[i].text is None}
    out, title, rest = set(), False, False
    for i, t in enumerate(found):
        if t.text is None:
            if t.tag not in INLINE and t.tag != "br":
                title = t.tag == "h1" and not t.key.endswith("</h1>")
        elif t.key and t.place == "article" and not title:
            cls, _, pages = candidates[_hash(t.key)] if i in template else (None, 0, 0)
            if pages >= BLOCK_PAGES and cls in marked:
                out.add(i)
            else:
                rest = True
    return out if rest else set()


def main_text(page: str, candidates: dict[int, tuple]) -> str:
    found = tokens(page)
    template = template_of(found, candidates)
    places = {t.place for t in found if t.text is not None and t.text.strip() and t.place}
    wanted = next((p for p in ("article", "main", "body") if p in places), None)
    if wanted == "article":
        template = blocks_of(found, candidates, template)
    elif all(i in template for i, t in enumerate(found) if t.key and t.text is not None and t.place == wanted):
        template = set()  # pages alike throughout, such as repeated rows: what they share is their text
    blocks, open_block = [], []

    def close() -> None:
        block = _SPACE.sub(" ", entities.unescape("".join(open_block))).strip()
        if block:
            blocks.append(block)
        open_block.clear()

    for i, t in enumerate(found):
        if t.text is None:
            if t.tag == "br":
                open_block.append(" ")
            elif t.tag not in INLINE:
                close()
        elif wanted and t.place == wanted and (not t.key or i not in template):
            open_block.append(t.text)
    close()
    return "\n\n".join(blocks)


def extract(pages: DataFrame, url: str = "url", html: str = "html", id_col: str = "page_id") -> DataFrame:
    """``(id, url, text)`` for each row of ``pages``."""
    spark = pages.sparkSession
    small_batches(spark)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums: dict[tuple[str, int], list[int]] = {}
            for ident, link, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                host, body = host_of(link), page.as_py() or ""
                row = xxhash.xxh64_intdigest(f"{ident}\0{link}\0".encode("utf-8", "surrogatepass"))
                counts, first = Counter(), {}
                for i, t in enumerate(tokens(body)):
                    if t.key:
                        h = _hash(t.key)
                        counts[h] += 1
                        first.setdefault(h, i)
                counts[0], first[0] = 1, 0  # stands for the page itself
                for h, n in counts.items():
                    mark = xxhash.xxh64_intdigest(n.to_bytes(8, "little"), seed=row)
                    at = sums.setdefault((host, h), [0, 0, 0, 0, 0])
                    at[0] += 1
                    at[1] += n
                    at[2] += mark & 0xFFFFFFFF
                    at[3] += mark >> 32
                    at[4] += first[h]
            if sums:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.int64()),
                     *(pa.array([v[i] for v in sums.values()], pa.int64()) for i in range(5))],
                    ["host", "token", "pages", "total", "low", "high", "place"])

    seen = (rows.mapInArrow(vectors, "host string, token long, pages long, total long, low long, high long, place long")
            .groupBy("host", "token").agg(*[F.sum(c).alias(c) for c in ("pages", "total", "low", "high", "place")])
            .filter("pages >= 2"))
    seen = stored(seen, "vectors")
    hosts = seen.filter("token = 0").select("host", F.col("pages").alias("all_pages"))
    classes = (seen.filter("token <> 0").join(hosts, "host").filter("2 * pages >= all_pages")
               .groupBy("host").agg(F.collect_list(F.struct(
                   "token", F.xxhash64("pages", "total", "low", "high").alias("class"), (F.col("place") / F.col("pages")).alias("place"),
                   "pages")).alias("candidates"))
               .withColumnRenamed("host", "_host"))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict] = {}
        for b in batches:
            out = []
            for link, page, found in zip(b.column(1).to_pylist(), b.column(2), b.column(3)):
                host = host_of(link)
                if host not in held:
                    if len(held) > 64:
                        held.clear()
                    held[host] = {c["token"]: (c["class"], c["place"], c["pages"]) for c in found.as_py() or ()}
                out.append(main_text(page.as_py() or "", held[host]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], ["id", "url", "text"])

    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return (rows.withColumn("_host", host).join(stored(classes, "templates"), "_host", "left")
            .select("id", "url", "html", "candidates")
            .mapInArrow(texts, StructType([StructField("id", pages.schema[id_col].dataType), StructField("url", StringType()),
                                           StructField("text", StringType())])))


def op4_template(pages: DataFrame) -> DataFrame:
    """The digest of the operator: page_id, url, text, n_chars."""
    return extract(pages).select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast(LongType()).alias("n_chars"))
