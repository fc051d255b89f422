"""Main text of web pages by site template removal.

Every element is hashed with its whole subtree (tags, class and id, text). Spark counts, per host,
the pages on which a hash occurs. A subtree that recurs on many pages of its host belongs to the
site's template and is deleted, with all it holds. Inside articles whole blocks (not rows, items,
headings or words in bold) are counted per different article, and deleted if at least
``MIN_ARTICLES`` articles and ``ARTICLE_SHARE`` of those of the host have them: articles may quote each
other, and near copies share most of their blocks. What the markup itself names as something other than the article
(menus, headers, footers, forms, scripts, and blocks classed as adverts, notices,
sidebars or comments) is deleted as well, since some of it changes with every page.

A page's articles are its ``article`` and ``main`` elements. Where they have ``ARTICLE_PART`` of the text that
is not deleted, only their text counts; else they are empty places or teasers, and everything not
deleted counts. A name or a form around most of a page deletes nothing.

The templates of a host may be many. They are joined to the hashes of each page, and what a page
has of them to the page; no task holds those of a host.

Special cases: a null or empty html gives an empty text. A null url, or one without a host,
has no template. Unclosed elements end with their parent, unmatched end tags are
ignored, and a ``<`` that starts no tag is text. Repeated page ids are rows of their own.
"""

import hashlib
import html as entities
import re

import pyarrow as pa
from pyspark.sql import functions as F

from .common import stored

MIN_PAGES = 5   # a template element is on so many different pages of its host
MIN_ARTICLES = 20   # a template block inside articles is in so many different ones of its host,
ARTICLE_PART = 0.25  # articles with less of a page's text are not the main text
ARTICLE_SHARE = 0.5  # and in this share of them: less may be a quote or a group of near copies
HOT, SALTS = 1_000, 32  # the pages of a hash on more of them are joined in so many tasks
ARTICLE = 1         # in place of a hash: all that a page has in articles

TOKEN = re.compile(
    # A quote opens a value only after "=".
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)"""
    r"""((?:[^>=]++|=(?>\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?+)*+)>""", re.S)
COMMENT = re.compile(r"<!--.*", re.S)   # one that no ">" ends, behind the last tag
NAMED = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("body html li dd dt option tbody td tfoot th thead tr summary".split())
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
               "td": {"td", "th"}, "th": {"td", "th"}}
LIST_ROOTS = frozenset("ul ol menu dl table select".split())
ARTICLES = frozenset(("article", "main"))
NEVER = RAW | ARTICLES | frozenset("#root html body head".split())
# Elements whose names do not decide.
LAYOUT = ARTICLES | frozenset(("html", "body"))
# Blocks that are no part of another one, as rows, items and headings are.
WHOLE = BLOCKS - ARTICLES - frozenset(
    "body dd dt h1 h2 h3 h4 h5 h6 hr html li option summary tbody td tfoot th thead tr".split())
# What is never part of an article, besides forms.
DROPPED = frozenset(
    "head title script style template noscript iframe object svg canvas nav header footer aside button select "
    "textarea input dialog menu noembed noframes xmp".split())
DROPPED_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|header|"
    r"masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|popup|promo|promoted|related|replies|respond|"
    r"share|sharing|sidebar|social|sponsor(?:ed)?|subscribe|toolbar|widget)(?:$|[\s_-])")


class Element:
    __slots__ = ("tag", "names", "parts", "digest", "home", "gone", "holds", "size", "told")

    def __init__(self, tag, names=""):
        self.tag, self.names, self.parts, self.digest = tag, names, [], None
        self.home, self.gone, self.holds, self.size, self.told = None, False, False, 0, 0


def _names(attributes):
    return " ".join(m.strip("\"'").lower() for m in NAMED.findall(attributes)) if attributes else ""


class Stack:
    """The open elements, and for every tag the places where it is open: a search takes no walk."""

    def __init__(self, root):
        self.open, self.places = [root], {}

    def push(self, element):
        self.places.setdefault(element.tag, []).append(len(self.open))
        self.open.append(element)

    def innermost(self, tags):
        """The place of the innermost open element of ``tags``, 0 if there is none."""
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=0)

    def close(self, place):
        """End the element at ``place`` and all within."""
        while len(self.open) > place:
            self.places[self.open.pop().tag].pop()

    def close_within(self, tags, barriers):
        """End the innermost open element of ``tags``, if none of ``barriers`` is inside of it."""
        place = self.innermost(tags)
        if place and place >= self.innermost(barriers):
            self.close(place)


def parse(page):
    """The element tree of a page; parts of an element are its texts and elements."""
    root = Element("#root")
    stack, at = Stack(root), 0
    position, size = 0, len(page)
    last = page.rfind(">")   # no tag ends behind it
    while position < size:
        match = TOKEN.search(page, position) if position <= last else COMMENT.search(page, position)
        if match is None:
            break
        if match.start() > at:
            stack.open[-1].parts.append(page[at:match.start()])
        at = position = match.end()
        tag = match.group(2) if match.re is TOKEN else None
        if tag is None:
            continue
        tag = tag.lower()
        if match.group(1):
            if place := stack.innermost((tag,)):
                stack.close(place)
            continue
        if tag in CLOSES_P:
            stack.close_within({"p"}, BLOCKS - {"p"})
        if tag in SAME_CLOSES:
            stack.close_within(SAME_CLOSES[tag], LIST_ROOTS if tag not in ("td", "th") else LIST_ROOTS | {"tr"})
        element = Element(tag, _names(match.group(3)))
        stack.open[-1].parts.append(element)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            stop = end.start() if end else size
            element.parts.append(page[at:stop])
            at = position = end.end() if end else size
        elif tag not in VOID:
            stack.push(element)
    if at < size:
        stack.open[-1].parts.append(page[at:])
    return root


def walk(root):
    """Elements, every child before its parent; each knows the article it is in, and if it is dropped or holds an article."""
    order, todo = [], [root]
    while todo:
        element = todo.pop()
        order.append(element)
        element.gone = element.gone or element.tag in DROPPED
        home = element if element.tag in ARTICLES else element.home
        for part in element.parts:
            if isinstance(part, Element):
                part.home, part.gone = home, element.gone
                todo.append(part)
    order.reverse()
    for element in order:
        element.holds = any(isinstance(part, Element) and (part.holds or part.tag in ARTICLES) for part in element.parts)
    return order


def measure(order, template):
    """Set the number of letters of every element without dropped ones and ``template``, and those of them in articles."""
    for element in order:
        if element.gone or id(element) in template:
            continue
        for part in element.parts:
            if isinstance(part, str):
                element.size += sum(map(len, part.split()))
            else:
                element.size += part.size
                element.told += part.told
        if element.tag in ARTICLES or element.home:
            element.told = element.size


def dropped(element, page):
    """Whether an element of the measured tree ``page`` is no part of the text, by its tag or by its names.

    Names also describe layout (``has-sidebar``), and a form may be around a whole page. So neither
    counts for what holds most of the page's text or of its articles, unless another article is left.
    """
    if element.tag in DROPPED:
        return True
    if element.tag in LAYOUT or not (element.tag == "form" or element.names and DROPPED_NAMES.search(element.names)):
        return False
    most = 2 * element.size > page.size or (
        element.holds and 2 * element.told >= page.told and element.size >= ARTICLE_PART * page.size)
    return not most or page.told - element.told >= ARTICLE_PART * page.size


def digest_tree(order):
    """Set the digest of every element, from its tag, names, text and children."""
    for element in order:
        state = hashlib.blake2b(f"{element.tag}\0{element.names}\0".encode("utf-8", "replace"), digest_size=8)
        for part in element.parts:
            if isinstance(part, str):
                state.update(b"\1" + " ".join(part.split()).encode("utf-8", "replace"))
            else:
                state.update(part.digest)
        element.digest = state.digest()


def _number(digest):
    return int.from_bytes(digest, "little", signed=True)


def candidates(order):
    """(element, hash) of the elements that may be template; the lowest bit of the hash says if it is in an article.

    Neither an article nor what holds one is template. In an article only whole blocks are: a word in bold, a
    heading or a cell of a table recurs in texts that have nothing else in common.
    """
    for element in order:
        if element.gone or element.holds or not element.parts or element.tag in NEVER:
            continue
        if element.home is None:
            yield element, _number(element.digest) & ~1
        elif element.tag in WHOLE:
            yield element, _number(element.digest) | 1


def template_hashes(page):
    """The distinct hashes of the page's elements that may be template, each with the number of its article, if any.

    ``ARTICLE`` stands for all that the page has in articles.
    """
    order = walk(parse(page))
    digest_tree(order)
    found = {(number, _number(element.home.digest) if element.home else None) for element, number in candidates(order)}
    whole = [element.digest for element in order if element.tag in ARTICLES and not element.home and not element.gone]
    if whole:
        found.add((ARTICLE, _number(hashlib.blake2b(b"".join(whole), digest_size=8).digest())))
    return found


def main_text(page, templates=frozenset()):
    """The text of a page without dropped elements and those whose hash is in ``templates``."""
    root = parse(page)
    order = walk(root)
    template = set()
    if templates:
        digest_tree(order)
        template = {id(element) for element, number in candidates(order) if number in templates}
    measure(order, template)
    blocks, current = [], []

    def flush(within):
        text = " ".join(entities.unescape("".join(current)).split())
        if text:
            blocks.append((within, text))
        current.clear()

    todo, within = [(root, False)], False
    while todo:
        part, within = todo.pop()
        if part is None:
            flush(within)
        elif isinstance(part, str):
            current.append(part)
        elif part.tag == "br" or part.tag == "wbr":
            current.append(" " if part.tag == "br" else "")
        elif dropped(part, root):
            # Text on both sides of a dropped block are separate blocks.
            if part.tag in BLOCKS:
                flush(within)
        elif id(part) in template:
            flush(within)
        else:
            if part.tag in BLOCKS or part.tag == "#root":
                flush(within)
                within = within or part.tag in ARTICLES
                todo.append((None, within))
            todo.extend((inner, within) for inner in reversed(part.parts))
    flush(within)
    told = sum(len(text) for inside, text in blocks if inside)
    narrow = told and told >= ARTICLE_PART * sum(len(text) for _, text in blocks)
    return "\n\n".join(text for inside, text in blocks if inside or not narrow)


def hash_batches(batches):
    """(host, page, html) to the page's hashes, and the article of each hash from inside one."""
    for batch in batches:
        hashes, articles = [], []
        for page in batch.column(2).to_pylist():
            found = sorted(template_hashes(page), key=str)
            hashes.append([number for number, _ in found])
            articles.append([article for _, article in found])
        lists = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(hashes, type=lists), pa.array(articles, type=lists)],
            names=["host", "page", "hashes", "articles"])


def text_batches(batches):
    for batch in batches:
        ids, urls, pages, templates = (batch.column(i) for i in range(4))
        texts = [main_text(page, frozenset(found or ())) for page, found in zip(pages.to_pylist(), templates.to_pylist())]
        yield pa.RecordBatch.from_arrays([ids, urls, pa.array(texts, type=pa.string())], names=["page_id", "url", "text"])


def host_of(url):
    """The host in small letters, without user and port; empty if there is none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""))


def page_hashes(pages):
    """(host, page, found) of the different pages of each host; ``found`` has the hashes and their articles.

    ``pages`` has host and html. Pages without a host have no template.
    """
    hashed = pages.where("host <> ''").select("host", F.xxhash64("html").alias("page"), "html").mapInArrow(
        hash_batches, "host string, page bigint, hashes array<bigint>, articles array<bigint>")
    # Copies of a page count once, or one copied often enough would be its own template.
    return hashed.groupBy("host", "page").agg(F.first(F.arrays_zip("hashes", "articles")).alias("found"))


def recurring(hashes, min_pages=MIN_PAGES):
    """(host, hash, pages, template): subtrees on many pages of their host, or in most of its articles, are template.

    Those on more than ``HOT`` pages are there in any case. Spark sums the counts within each task before it shuffles them.
    """
    # Copies of an article count once.
    units = (hashes.select("host", "page", F.explode("found").alias("found"))
             .groupBy("host", F.col("found.hashes").alias("hash"), F.coalesce("found.articles", "page").alias("unit"))
             .agg(F.count("*").alias("pages")))
    inside = F.col("hash").bitwiseAND(F.lit(1)) == 1
    many = F.when(inside, F.col("count") >= MIN_ARTICLES).otherwise(F.col("count") >= min_pages)
    counts = units.groupBy("host", "hash").agg(F.count("*").alias("count"), F.sum("pages").alias("pages"))
    counts = stored(counts.where((F.col("hash") == ARTICLE) | many | (F.col("pages") > HOT)), "hash-counts")
    totals = counts.where(F.col("hash") == ARTICLE).select("host", F.col("count").alias("articles"))
    most = F.col("count") >= F.col("articles") * ARTICLE_SHARE
    return (counts.where(F.col("hash") != ARTICLE).join(totals, "host", "left")
            .select("host", "hash", "pages", (many & (~inside | most)).alias("template"))
            .where(F.col("template") | (F.col("pages") > HOT)))


def site_templates(pages, min_pages=MIN_PAGES):
    """(host, templates): the hashes of a host's templates in one list, to look at; ``extract_text`` gathers none."""
    return (recurring(page_hashes(pages), min_pages).where("template")
            .groupBy("host").agg(F.sort_array(F.collect_set("hash")).alias("templates")))


def page_templates(hashes, counted):
    """(host, page, templates): those of a page's own hashes that ``counted`` (host, hash, pages, template) calls template.

    The pages of a hash on more than ``HOT`` are dealt to ``SALTS`` tasks. There is at most one such hash
    for ``HOT`` rows.
    """
    rows = (hashes.select("host", "page", F.explode("found.hashes").alias("hash")).where(F.col("hash") != ARTICLE)
            .withColumn("salt", F.pmod(F.xxhash64("page"), F.lit(SALTS)).cast("int")))
    key = ["host", "hash", "salt"]
    hot = counted.where(F.col("pages") > HOT).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rare = counted.where(F.col("pages") <= HOT)
    found = rows.join(hot.where("template"), key, "left_semi").unionByName(
        rows.join(hot, key, "left_anti").join(rare, ["host", "hash"], "left_semi"))
    return found.groupBy("host", "page").agg(F.collect_set("hash").alias("templates"))


def extract_text(pages, min_pages=MIN_PAGES):
    """page_id, url and main text of every row of ``pages`` (page_id, url, html)."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
                        host_of(F.col("url")).alias("host"))
    hashes = stored(page_hashes(rows), "page-hashes")
    counted = stored(recurring(hashes, min_pages), "templates")
    found = stored(page_templates(hashes, counted), "page-templates")
    # A row for each page is too much to broadcast; by hashes the pages need no sort.
    return (rows.withColumn("page", F.xxhash64("html")).join(found.hint("shuffle_hash"), ["host", "page"], "left")
            .select("page_id", "url", "html", "templates")
            .mapInArrow(text_batches, "page_id bigint, url string, text string"))
