"""Main text of web pages by template deduction from equivalence classes of tokens.

Tokens of a page are its block elements (the path of names, classes and ids) and its text blocks (path and
text). Over the distinct pages of a host, a token's occurrence vector is its number of occurrences in
each page. Vectors are never gathered: an exclusive-or of hashes of (page, count) is a partial
aggregate that is equal for equal vectors. Tokens with the same vector form a class. A class is valid if
it has enough pages, holds an element, and its tokens follow each other in one order in every page, which a
second pass over the token lists finds out. Valid classes, nested by their place in the page, are
the host's template: the texts in it are boilerplate, and the gaps between its elements are slots. The slot with the most text over all pages of the
host is the main one. The last pass reads each page with its host's template at hand: texts of the template go, and of
the rest stays what lies in the page's article or, without such a mark, around the main slot.

A host's template is bounded by the length of pages, not by their number: a token has to occur in a
share of the pages. Templates meet pages by an equi-join; hosts with more than 1/256 of all pages, which are
at most 256, are joined by broadcast behind a check of their size, so that no task gets all pages of one host.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cohortml.llm.common import scratch_path, stored
from cohortml.llm.html_tree import HEADING, Page

#: A token of the template occurs in this many distinct pages of its host, and in this share of them.
LEAST_PAGES = 3
LEAST_SHARE = 0.2
#: The same for texts inside an article, which are boilerplate only if most pages have them.
ARTICLE_PAGES = 5
ARTICLE_SHARE = 0.5
#: A block with more than this share of its characters in links belongs to a menu, outside articles.
LINK_SHARE = 0.5
HOT_HOSTS = 256
HOT_TOKENS = 1_000_000

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def _key(*parts) -> int:
    """64 bits, signed, of a path or text."""
    from xxhash import xxh64_intdigest
    h = xxh64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def _paths(page: Page) -> list:
    """The key of every block element's path."""
    out = [0] * len(page.names)
    for i in range(1, len(out)):
        parent = out[page.parents[i]]
        out[i] = _key(parent, page.keys[i])
    return out


def tokens(page: Page):
    """``(sequence, is_element, blocks)``: all tokens in page order, and for every text block that is not
    dropped ``(place in the sequence, path of its container, characters outside links)``."""
    paths = _paths(page)
    sequence, element, blocks = [], [], []
    starts = iter(page.starts)
    start = next(starts, None)
    for place, (text, at, links) in enumerate(page.blocks):
        while start is not None and start[1] <= place:
            sequence.append(paths[start[0]]), element.append(True)
            start = next(starts, None)
        if not page.dropped[at]:
            blocks.append((len(sequence), paths[page.container(at)], max(len(text) - links, 0), page.article[at]))
        sequence.append(_key(paths[at], text)), element.append(False)
    while start is not None:
        sequence.append(paths[start[0]]), element.append(True)
        start = next(starts, None)
    return sequence, element, blocks


def main_text(source: str, template: set, slot: int | None) -> str:
    """The article of a page: blocks joined by a line feed. ``template``: tokens that are boilerplate;
    ``slot``: path of the host's main container, if known."""
    page = Page(source)
    paths = _paths(page)
    kept, lost = [], []
    for text, at, links in page.blocks:
        known = bool(template) and _key(paths[at], text) in template
        (lost if known or page.dropped[at] else kept).append((text, at, links))
    inside = [b for b in kept if page.article[b[1]]]
    if inside:
        return "\n".join(t for t, _, _ in inside)
    rest = [b for b in kept if b[2] <= LINK_SHARE * len(b[0])]
    if not rest:
        return ""
    holders = [page.container(at) for _, at, _ in rest]
    mass = Counter()
    for (text, _, links), c in zip(rest, holders):
        mass[paths[c]] += len(text) - links
    best = slot if slot in mass else min(mass, key=lambda p: (-mass[p], p))
    # the widest element around the main container that holds nothing known as boilerplate
    blocked, chosen = set(), set(rest)
    for b in page.blocks:
        at = b[1] if b not in chosen else 0
        while at and at not in blocked:
            blocked.add(at)
            at = page.parents[at]
    inner = [False] * len(page.names)
    for c in {c for c in holders if paths[c] == best}:
        while page.parents[c] and page.container(page.parents[c]) not in blocked:
            wider = page.container(page.parents[c])
            if page.names[wider] in ("", "body", "html"):
                break
            c = wider
        inner[c] = True
    for i in range(1, len(inner)):
        inner[i] = inner[i] or inner[page.parents[i]]
    first = next(i for i, (_, at, _) in enumerate(rest) if inner[at])
    return "\n".join(t for i, (t, at, _) in enumerate(rest) if inner[at] or (i < first and page.names[at] in HEADING))


# ---------------------------------------------------------------- over hosts
def _with_templates(pages: DataFrame, templates: DataFrame, hot: DataFrame | None) -> DataFrame:
    """``pages`` with their host's row of ``templates``; other columns of a missing host are null."""
    values = [c for c in templates.columns if c != "host"]
    if hot is None:
        return pages.join(templates, "host", "left")
    frequent = F.broadcast(hot.select(F.col("host").alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in values]))
    marked = pages.join(frequent, pages["host"] == F.col("_hot"), "left")
    # pages of frequent hosts have their template by now: they are dealt out by what they hold, and meet nothing
    dealt = F.when(F.col("_hot").isNull(), F.col("host")).otherwise(F.concat(F.lit("\x00"), F.pmod("page", F.lit(1009)).cast("string")))
    cold = templates.join(F.broadcast(hot.select("host")), "host", "left_anti").withColumnRenamed("host", "_at")
    joined = marked.withColumn("_dealt", dealt).join(cold, F.col("_dealt") == F.col("_at"), "left")
    return joined.select(*pages.columns, *[F.coalesce(F.col(f"_hot_{c}"), F.col(c)).alias(c) for c in values])


def _frequent(templates: DataFrame, sizes: DataFrame, total: int, measure) -> DataFrame | None:
    """Templates of the hosts with over 1/256 of all pages; none if they are too large to be broadcast."""
    if not total:
        return None
    hot = templates.join(sizes.where(F.col("rows") * HOT_HOSTS > total).select("host"), "host", "left_semi")
    found = hot.agg(F.count("*").alias("n"), F.sum(measure).alias("size")).first()
    return hot if 0 < found["n"] <= HOT_HOSTS and (found["size"] or 0) <= HOT_TOKENS else None


def templates_of(pages: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``(host, tokens, slot)`` of every host with enough distinct pages, and the rows of frequent hosts.

    ``pages``: ``host, page (hash of the html), html``; pages without a host have no template.
    """
    spark = pages.sparkSession

    def read(batches):
        import pyarrow as pa
        for b in batches:
            out = [tokens(Page(s or "")) for s in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1),
                pa.array([s for s, _, _ in out], pa.list_(pa.int64())), pa.array([e for _, e, _ in out], pa.list_(pa.bool_())),
                *[pa.array([[x[i] for x in bs] for _, _, bs in out], pa.list_(kind))
                  for i, kind in enumerate((pa.int32(), pa.int64(), pa.int32(), pa.bool_()))]],
                names=["host", "page", "seq", "element", "block", "container", "chars", "article"])

    listed = pages.where("host <> ''").select("host", "page", "html").mapInArrow(
        read, "host string, page long, seq array<long>, element array<boolean>, block array<int>, container array<long>, "
              "chars array<int>, article array<boolean>")
    # equal pages count once: their token lists are equal too
    lists = [c for c in listed.columns if c not in ("host", "page")]
    once = listed.groupBy("host", "page").agg(F.count("*").alias("copies"), *[F.first(c).alias(c) for c in lists])
    once = stored(once, scratch_path(spark, "template"))
    sizes = stored(once.groupBy("host").agg(F.count("*").alias("pages"), F.sum("copies").alias("rows"))
                   .where(F.col("pages") >= LEAST_PAGES), scratch_path(spark, "template"))
    total = pages.count()

    # occurrence vectors: counts per page, then one hash per token
    def counted(batches):
        import pyarrow as pa
        for b in batches:
            host, page, token, count, element, article = [], [], [], [], [], []
            for h, p, seq, el, block, art in zip(*[b.column(i).to_pylist() for i in range(6)]):
                inside = {seq[i] for i, a in zip(block, art) if a}
                kind = dict(zip(seq, el))
                for t, n in Counter(seq).items():
                    host.append(h), page.append(p), token.append(t), count.append(n)
                    element.append(kind[t]), article.append(t in inside)
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(page, pa.int64()), pa.array(token, pa.int64()),
                                              pa.array(count, pa.int32()), pa.array(element, pa.bool_()),
                                              pa.array(article, pa.bool_())],
                                             names=["host", "page", "token", "count", "element", "article"])

    rows = once.select("host", "page", "seq", "element", "block", "article").mapInArrow(
        counted, "host string, page long, token long, count int, element boolean, article boolean")
    vector = rows.groupBy("host", "token").agg(
        F.count("*").alias("n"), F.expr("bit_xor(xxhash64(page, count))").alias("vector"),
        F.max("element").alias("element"), F.max("article").alias("article")).where(F.col("n") >= LEAST_PAGES)
    vector = vector.join(sizes, "host").where(
        F.when(F.col("article") & ~F.col("element"), (F.col("n") >= ARTICLE_PAGES) & (F.col("n") >= ARTICLE_SHARE * F.col("pages")))
        .otherwise(F.col("n") >= LEAST_SHARE * F.col("pages")))
    token = F.struct("token", "element")
    classes = (vector.groupBy("host", "n", "vector").agg(F.collect_list(token).alias("members"), F.max("element").alias("framed"))
               .where("framed").groupBy("host").agg(F.collect_list(F.struct("vector", "members")).alias("classes")))
    classes = stored(classes, scratch_path(spark, "template"))
    hot = _frequent(classes, sizes, total, F.aggregate("classes", F.lit(0), lambda a, c: a + F.size(c["members"])))

    # one order in every page; and the text of every container beside the template
    def ordered(batches):
        import pyarrow as pa
        for b in batches:
            host, kind, key, sign, chars = [], [], [], [], []
            known, last = {}, None
            for h, seq, block, container, size, cls in zip(*[b.column(i).to_pylist() for i in range(6)]):
                if h != last:
                    known, last = {m["token"]: c["vector"] for c in cls or [] for m in c["members"]}, h
                order = {}
                for t in seq:
                    if t in known:
                        order.setdefault(known[t], []).append(t)
                for c, ts in order.items():
                    rounds = len(ts) // len(set(ts))
                    one = ts[:len(set(ts))]
                    # one round of the class after the other, or every token in one run
                    shape = _key(*one) if ts == one * rounds else _key("runs", *[x for i, x in enumerate(ts) if not i or ts[i - 1] != x])
                    host.append(h), kind.append(True), key.append(c), sign.append(shape), chars.append(0)
                mass = Counter()
                for i, c, n in zip(block, container, size):
                    if seq[i] not in known:
                        mass[c] += n
                for c, n in mass.items():
                    host.append(h), kind.append(False), key.append(c), sign.append(0), chars.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(kind, pa.bool_()), pa.array(key, pa.int64()),
                                              pa.array(sign, pa.int64()), pa.array(chars, pa.int64())],
                                             names=["host", "is_class", "key", "sign", "chars"])

    lists = once.select("host", "page", "seq", "block", "container", "chars")
    seen = (_with_templates(lists, classes, hot).select("host", "seq", "block", "container", "chars", "classes")
            .mapInArrow(ordered, "host string, is_class boolean, key long, sign long, chars long")
            .groupBy("host", "is_class", "key").agg(F.min("sign").alias("low"), F.max("sign").alias("high"), F.sum("chars").alias("chars")))
    seen = stored(seen, scratch_path(spark, "template"))
    valid = seen.where("is_class AND low = high").select("host", F.col("key").alias("vector"))
    texts = (classes.select("host", F.explode("classes").alias("c")).select("host", "c.vector", "c.members")
             .join(valid, ["host", "vector"], "left_semi").select("host", F.explode("members").alias("m")).where("not m.element")
             .groupBy("host").agg(F.array_sort(F.collect_list("m.token")).alias("tokens")))
    slots = (seen.where("not is_class").groupBy("host").agg(
        F.max_by("key", F.struct("chars", "key")).alias("slot")).join(sizes, "host", "left_semi"))
    found = stored(slots.join(texts, "host", "left").select("host", "tokens", "slot"), scratch_path(spark, "template"))
    return found, _frequent(found, sizes, total, F.coalesce(F.size("tokens"), F.lit(0)))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``: the main text, empty if there is none.

    Character references are decoded, white space inside a block is one space, blocks are joined by one line
    feed in page order. A null html counts as empty; pages with a null or unreadable url, and hosts with fewer
    than three distinct pages, are read without a template. Equal pages count once in the
    deduction and give a row each; ids are carried along, so null and repeated ids are ordinary rows. An empty table
    gives an empty one.
    """
    id_field, url_field = pages.schema["page_id"], pages.schema["url"]
    source = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
                          F.coalesce(F.regexp_extract(F.lower("url"), HOST, 1), F.lit("")).alias("host"),
                          F.xxhash64("html").alias("page"))
    templates, hot = templates_of(source)
    schema = StructType([StructField("page_id", id_field.dataType), StructField("url", url_field.dataType),
                         StructField("text", StringType()), StructField("n_chars", LongType())])
    types = [to_arrow_type(f.dataType) for f in (id_field, url_field)]

    def run(batches):
        import pyarrow as pa
        for b in batches:
            out, sets = [], {}
            for html, host, known, slot in zip(*[b.column(i).to_pylist() for i in (2, 3, 4, 5)]):
                if host not in sets:
                    sets[host] = frozenset(known or ())
                out.append(main_text(html, sets[host], slot))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(types[0]), b.column(1).cast(types[1]), pa.array(out, pa.string()),
                 pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return (_with_templates(source, templates, hot).select("page_id", "url", "html", "host", "tokens", "slot")
            .mapInArrow(run, schema))
