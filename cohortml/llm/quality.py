"""Quality rules with cross-document line frequency, in DataFrame expressions only.

Lines are normalised (lower case, one space between words) and hashed; for every host the number of
distinct documents that hold a line is counted; lines in more documents than the host's limit are
removed; a document that loses too much is depleted and rejected. Documents are distinct if their whole
normalised texts differ (by a 64-bit hash), so exact copies count once and near copies each.

With ``same="sketch"`` near copies count once too: documents are then told apart by the 24 smallest hashes of
their 5-word windows, all of which have to agree. Near copies, of which a share ``s`` of the windows is
common, agree with probability ``s ** 24``, so a much copied text does not make its own lines look like
boilerplate, at the price that pages with very few words of their own count as copies of each other. A line
counts for a group of copies if any of them holds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortml.llm.common import SPACE, materialise, text_of

SYMBOLS = "#*$%&|<>"
SEPARATORS = " \t\n\x0b\x0c\r"
#: Smallest window hashes that copies of a document have to share; a document with fewer has to share all.
MINIMA = 24


def _lines(text: Column) -> Column:
    """``array(struct(line, words))`` of the lines that hold a word."""
    def words(line):
        return F.filter(F.split(line, f"{SPACE}+"), lambda w: w != "")

    split = F.transform(F.split(text, "\n"), lambda line: F.struct(line.alias("line"), words(line).alias("words")))
    return F.filter(split, lambda x: F.size(x["words"]) > 0)


def _covered(places: Column, width: int) -> Column:
    """How many places the windows of ``width`` at sorted ``places`` cover together."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(places, start, lambda acc, i: F.struct(
        (acc["n"] + i + width - F.greatest(acc["end"], i)).alias("n"), (i + width).alias("end")), lambda a: a["n"])


def features(docs: DataFrame, host: str = "source", width: int = 5, same: str = "text") -> DataFrame:
    """One row per row of ``docs`` with its counts, its line hashes and the ``document`` it is; no shuffle.

    ``same``: rows are one document if they have equal normalised ``text``, or an equal ``sketch``. ``lines`` is ``array(struct(h, w))``: hash and number of words of every line with a word;
    ``text_key`` is a hash of the text.
    """
    if same not in ("text", "sketch"):
        raise ValueError(f"same is text or sketch, not {same!r}")
    t = docs.select("doc_id", F.col(host).cast("string").alias("host"), text_of().alias("text"))
    t = t.withColumn("parts", _lines(F.col("text")))
    t = t.select(
        "doc_id", "host", "text",
        F.flatten(F.transform("parts", lambda x: x["words"])).alias("words"),
        F.transform("parts", lambda x: F.struct(F.xxhash64(F.lower(F.array_join(x["words"], " "))).alias("h"),
                                                F.size(x["words"]).alias("w"))).alias("lines"),
        (F.size("parts") - F.size(F.array_distinct(F.transform("parts", lambda x: x["line"])))).cast("long").alias("n_dup_lines"))
    t = t.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).withColumn("n", F.size("words"))
    none = F.array().cast("array<int>")
    begins = F.when(F.col("n") >= width, F.sequence(F.lit(0), F.col("n") - F.lit(width))).otherwise(none)
    t = t.withColumn("windows", F.transform(begins, lambda i: F.xxhash64(*[F.get("hashes", i + j) for j in range(width)])))
    # only texts in which a hash repeats are looked at again, by the words themselves
    exact = F.array_sort(F.transform(begins, lambda i: F.struct(
        F.array_join(F.slice("words", i + 1, width), " ").alias("s"), i.alias("i"))))
    empty = F.array().cast("array<struct<s:string,i:int>>")
    t = t.withColumn("sorted", F.when(F.size(F.array_distinct("windows")) == F.size("windows"), empty).otherwise(exact))
    again = F.filter("sorted", lambda x, k: (F.get("sorted", k - 1)["s"] == x["s"]) & (k > 0)
                     | F.coalesce(F.get("sorted", k + 1)["s"] == x["s"], F.lit(False)))
    repeat = F.when(F.size("sorted") == 0, F.lit(0)).otherwise(
        _covered(F.array_sort(F.transform(again, lambda x: x["i"])), width))
    whole = F.xxhash64(F.lower(F.array_join("words", " ")))
    sketch = F.when(F.size("windows") == 0, whole).otherwise(
        F.xxhash64(F.slice(F.sort_array(F.array_distinct("windows")), 1, MINIMA)))
    return t.select(
        "doc_id", "host", "lines", F.xxhash64("text").alias("text_key"),
        (whole if same == "text" else sketch).alias("document"),
        F.col("n").cast("long").alias("n_words"),
        F.length(F.translate("text", SEPARATORS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        "n_dup_lines", repeat.cast("long").alias("n_repeat_words"))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def frequent_lines(found: DataFrame, share: float = 0.01, least: int = 50) -> DataFrame:
    """``(host, h, n_docs)``: lines in more than ``share`` of a host's distinct documents and more
    than ``least`` of them. A null host is a host of its own.

    Lines are combined by (host, document, hash) first, which unites the lines of copies, and by (host,
    hash) next, both with partial aggregates, so neither a much copied text nor a very common line
    gathers in one task.
    """
    per_host = found.select("host", "document").distinct().groupBy("host").agg(F.count("*").alias("docs"))
    held = found.select("host", "document", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    lines = (held.distinct().groupBy("host", "h").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > least))
    limit = per_host.select(F.col("host").alias("_host"), (F.col("docs") * F.lit(share)).alias("limit"))
    return (lines.join(limit, F.col("host").eqNullSafe(F.col("_host")))
            .where("n_docs > limit").select("host", "h", "n_docs"))


def judge(found: DataFrame, share: float = 0.01, least: int = 50, min_words: int = 10, max_repeat: int = 20,
          min_left: float = 0.3) -> DataFrame:
    """``found`` (materialised features with a ``tag``) with ``base_failed, lost_words, kept`` and ``bad``, the
    hashes of the row's frequent lines (null: none)."""
    frequent = frequent_lines(found, share, least).select(F.col("host").alias("_host"), F.col("h").alias("_h"))
    each = found.select("tag", "host", F.explode("lines").alias("x")).select("tag", "host", "x.h", "x.w")
    lost = (each.join(frequent, (F.col("h") == F.col("_h")) & F.col("host").eqNullSafe(F.col("_host")))
            .groupBy("tag").agg(F.sum("w").alias("lost_words"), F.collect_set("h").alias("bad")))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    left = F.col("n_words") - F.col("lost_words")
    depleted = (F.col("lost_words") > 0) & ((left < min_words) | (left < F.lit(min_left) * F.col("n_words")))
    return (found.join(lost, "tag", "left").withColumn("lost_words", F.coalesce("lost_words", F.lit(0)).cast("long"))
            .withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted))


def _found(docs: DataFrame, host: str, same: str) -> DataFrame:
    """The features, written once, with a ``tag`` per row."""
    return materialise(features(docs, host, same=same).withColumn("tag", F.monotonically_increasing_id()))


def quality(docs: DataFrame, host: str = "source", same: str = "text", **limits) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the counts, ``base_failed, kept, lost_words``.

    ``kept`` is false for texts under ``min_words`` words, with more than ``max_repeat`` percent of
    their words in repeated 5-word windows, or depleted: less than ``min_words`` or ``min_left`` of
    the words left without the frequent lines of their host. Null and empty texts have no words and
    fail. Repeated rows are judged each; an empty table gives an empty one.
    """
    return judge(_found(docs, host, same), **limits).select("doc_id", *COUNTS, "base_failed", "kept", "lost_words")


def _without(text: Column, bad: Column) -> Column:
    """``text`` without the lines whose hash is in ``bad``."""
    def good(line):
        words = F.filter(F.split(line, f"{SPACE}+"), lambda w: w != "")
        return (F.size(words) == 0) | ~F.array_contains(bad, F.xxhash64(F.lower(F.array_join(words, " "))))

    return F.array_join(F.filter(F.split(text, "\n"), good), "\n")


def clean(docs: DataFrame, host: str = "source", same: str = "text", reject: bool = True, remove: bool = True, **limits) -> DataFrame:
    """``docs`` without the rejected rows and, in the texts that stay, without the frequent lines of their host.

    ``reject`` or ``remove`` alone does one of both. Columns stay as they are; ``n_chars``, if there is one,
    follows a changed text. Null and empty texts are rejected (null texts stay null without ``reject``). Rows equal in id,
    host and text are judged alike; an empty table gives an empty one. The lines to remove come with the row's verdict, so a
    text is searched for its own frequent lines alone.
    """
    judged = judge(_found(docs, host, same), **limits).where(~F.col("kept") | F.col("bad").isNotNull())
    verdict = (judged.select(F.col("doc_id").alias("_id"), F.col("host").alias("_host"), F.col("text_key").alias("_key"),
                             (~F.col("kept")).alias("_rejected"), F.array_sort("bad").alias("_bad"))
               .dropDuplicates(["_id", "_host", "_key"]))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.col(host).cast("string").alias("host"), text_of().alias("text"),
                       F.xxhash64(text_of()).alias("text_key"))
    same_row = ((F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))
                & F.col("host").eqNullSafe(F.col("_host")))
    rows = rows.join(verdict, same_row, "left")
    if reject:
        rows = rows.where(~F.coalesce("_rejected", F.lit(False)))
    if not remove:
        return rows.select("row.*")
    changed = F.col("_bad").isNotNull() & F.col("row.text").isNotNull()
    rows = rows.withColumn("_clean", F.when(changed, _without(F.col("text"), F.col("_bad"))).otherwise(F.col("row.text")))
    columns = []
    for f in docs.schema.fields:
        value = F.col("row").getField(f.name)
        if f.name == "text":
            value = F.col("_clean")
        elif f.name == "n_chars":
            value = F.when(changed, F.length("_clean").cast(f.dataType)).otherwise(value)
        columns.append(value.alias(f.name))
    return rows.select(*columns)


def keep_good(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns and texts as they are (null, repeated and no rows: see :func:`clean`)."""
    return clean(docs, host, remove=False, **limits)


def remove_lines(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """All rows of ``docs`` with the frequent lines of each host taken out of the texts (null, repeated and no rows: see :func:`clean`)."""
    return clean(docs, host, reject=False, **limits)
