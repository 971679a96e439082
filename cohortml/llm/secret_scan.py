"""Secret scan: entropy of sliding windows per character class, by incremental counts, in SQL.

Three fixed patterns give the base spans. Beside them, every maximal run of secret-like characters
is a candidate string: its class is ``hex``, ``letters`` or ``base64``, and a window slides over it. The counts
of the window's characters are kept in one short string (one character per symbol,
standing for its count); a step moves one count down and one up and changes the sum of
``c * log2(c)`` by two table values, so the work per step does not depend on the window or on the
length of the run.

The allow-list works on places, not on runs. Marks and placeholder words split a run into parts; the
marks, the placeholders and the parts that are words or short numbers are covered. A window counts if at
least half of it is uncovered, so a key beside a placeholder or inside a path is found while slugs, paths and
dates are not. A candidate whose best counting window reaches the entropy of its class is a span.
Everything is an expression over one row: no shuffle, no Python.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortml.llm.common import text_of

#: Base kinds in the order of ties: pattern, least length, and the group that the length is of.
ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?"""
VALUE = r"[A-Za-z0-9+/_.=-]+"
KINDS = (("assign", ASSIGN + VALUE), ("access", r"AKIA[A-Z0-9]{16,}"), ("hex", r"[0-9a-f]{24,}"))
#: Candidate strings of the method, and their symbols, whose counts a window keeps.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
HEX_ONLY = "^[0-9a-fA-F]+$"
LETTERS_ONLY = "^[A-Za-z+/_=-]+$"
#: Least bits per character of the best window, per class.
LEAST_BITS = {"hex": 2.9, "letters": 3.85, "base64": 3.6}
WINDOW = 20
#: A window counts if at least this many of its characters are not covered by the allow-list.
LEAST_OPEN = WINDOW // 2
#: Candidates that are no secrets as a whole: digits alone and UUIDs.
ALLOW = (r"^[0-9]+$", r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")
#: Words that mark a placeholder; they cover their own characters alone.
PLACEHOLDERS = ("example", "placeholder", "changeme", "your")
#: Marks between the parts of a candidate, and parts that are words (up to 15 letters) or short numbers.
MARK = "[+/_=-]"
PLAIN_PART = "^([A-Za-z]{0,15}|[0-9]{1,4})$"

#: c * log2(c) in millionths, for c up to the window: integers, so that sums are exact.
_WEIGHT = [0] + [round(c * math.log2(c) * 1_000_000) for c in range(1, WINDOW + 1)]


_SPANS = "array<struct<start:int,kind:int,end:int,piece:string>>"
#: Arrays are walked in blocks of this size, so that appending to a result never copies more than a block.
_BLOCK = 256
#: Characters of a block of text.
_CUT = 2048


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blocks(items: Column) -> Column:
    """``items`` (at least one) in slices of ``_BLOCK``."""
    return _let(items, lambda a: F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / _BLOCK).cast("int")),
                                             lambda i: F.slice(a, i * _BLOCK + 1, F.lit(_BLOCK))))


def _spans(found: Column, text: Column, pattern: str, kind: int) -> Column:
    """``array(struct(start, kind, end, piece))`` of the matches ``found``, in code points.

    The text between matches is what ``split`` leaves; a match begins where the parts before it end.
    """
    none = F.array().cast(_SPANS)
    parts = F.filter(F.zip_with(F.transform(F.split(text, pattern, -1), F.length), found, lambda gap, piece: F.struct(
        gap.alias("gap"), F.length(piece).alias("size"), piece.alias("piece"))), lambda x: x["piece"].isNotNull())

    def span(acc, x):
        at = acc["at"] + x["gap"]
        return F.struct((at + x["size"]).alias("at"), F.concat(acc["out"], F.array(F.struct(
            at.alias("start"), F.lit(kind).alias("kind"), (at + x["size"]).alias("end"), x["piece"].alias("piece")))).alias("out"))

    def walk(blocks):
        begins = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                             lambda acc, b: F.struct(
                                 F.aggregate(b, acc["at"], lambda n, x: n + x["gap"] + x["size"]).alias("at"),
                                 F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
        return F.flatten(F.zip_with(blocks, begins, lambda b, at: F.aggregate(
            b, F.struct(at.alias("at"), none.alias("out")), span, lambda acc: acc["out"])))

    return F.when(F.size(found) == 0, none).otherwise(_let(_blocks(parts), walk))


def _covered(piece: Column) -> Column:
    """One character per character of ``piece``: 1 if the allow-list covers it, else 0."""
    masked = piece
    for word in PLACEHOLDERS:
        masked = F.regexp_replace(masked, F.lit(f"(?i){word}"), F.lit("=" * len(word)))
    return F.array_join(F.transform(F.split(masked, MARK, -1), lambda part: F.repeat(
        F.when(F.regexp(part, F.lit(PLAIN_PART)), F.lit("1")).otherwise(F.lit("0")), F.length(part))), "1")


def _reaches(piece: Column, covered: Column, bits: Column) -> Column:
    """Whether a counting window of ``piece`` has at least ``bits`` bits per character.

    Characters enter and leave through one array, so no step looks for its place in the string; once a
    window suffices the rest is passed over.
    """
    alphabet, weight = F.lit(SYMBOLS), F.array(*[F.lit(w) for w in _WEIGHT])
    zero = ord("0")
    most = F.floor((F.lit(math.log2(WINDOW)) - bits) * (WINDOW * 1_000_000))

    def move(state, place, by, opened):
        """The state after one character (its place in the alphabet) came in or left."""
        return _let(F.ascii(F.substring(state["counts"], place, F.lit(1))) - F.lit(zero), lambda count: F.struct(
            F.overlay(state["counts"], F.char(count + F.lit(zero + by)), place, F.lit(1)).alias("counts"),
            (state["total"] + (F.get(weight, count + F.lit(by)) - F.get(weight, count))).alias("total"),
            (state["open"] + F.lit(by) * opened).alias("open"), state["size"].alias("size"), state["most"].alias("most")))

    def come(state, x):
        return _let(move(state, x["c"], 1, x["m"]), lambda now: F.struct(
            now["counts"].alias("counts"), now["total"].alias("total"), now["open"].alias("open"), (now["size"] + 1).alias("size"),
            now["most"].alias("most"), ((now["size"] + 1 >= WINDOW) & (now["open"] >= LEAST_OPEN) & (now["total"] <= now["most"])).alias("done")))

    def step(acc, x):
        return (F.when(acc["done"], acc).when(x["c_out"].isNull(), come(acc, x))
                .otherwise(_let(move(acc, x["c_out"], -1, x["m_out"]), lambda left: come(left, x))))

    def walk(piece_marks):
        chars = F.transform(F.split(piece_marks["piece"], ""), lambda c: F.instr(alphabet, c))
        marks = F.transform(F.split(piece_marks["marks"], ""), lambda m: (m == "0").cast("int"))
        gap = F.array_repeat(F.lit(None).cast("int"), WINDOW)
        steps = _let(F.struct(chars.alias("c"), marks.alias("m")), lambda a: F.arrays_zip(
            a["c"].alias("c"), a["m"].alias("m"),
            F.slice(F.concat(gap, a["c"]), F.lit(1), F.size(a["c"])).alias("c_out"),
            F.slice(F.concat(gap, a["m"]), F.lit(1), F.size(a["c"])).alias("m_out")))
        start = F.struct(F.lit("0" * len(SYMBOLS)).alias("counts"), F.lit(0).alias("total"), F.lit(0).alias("open"),
                         F.lit(0).alias("size"), piece_marks["most"].alias("most"), F.lit(False).alias("done"))
        enough = F.length(F.replace(piece_marks["marks"], F.lit("1"), F.lit(""))) >= LEAST_OPEN
        return F.when(enough, F.aggregate(steps, start, step, lambda a: a["done"])).otherwise(F.lit(False))

    return _let(F.struct(piece.alias("piece"), covered.alias("marks"), most.alias("most")), walk)


KIND_NAMES = [k for k, _ in KINDS] + ["entropy"]


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with every column in ``row`` (struct), its ``text`` (null: empty) and its ``spans``.

    ``spans``: ``array(struct(start, kind, end, piece))`` sorted by start, then kind (a place in
    ``KIND_NAMES``), half-open in code points. Every span is found by itself; spans of different
    kinds may overlap. Empty and null texts have none.
    """
    text = F.col("text")
    found = docs.select(F.struct("*").alias("row"), text_of().alias("text")).select("row", "text", *[
        F.regexp_extract_all(text, F.lit(f"({p})"), F.lit(1)).alias(k)
        for k, p in (*KINDS, ("entropy", CANDIDATE))])
    found = found.select("row", "text", *[_spans(F.col(k), text, p, i).alias(k)
                                          for i, (k, p) in enumerate((*KINDS, ("entropy", CANDIDATE)))])

    def secret(x):
        piece = x["piece"]
        allowed = F.lit(False)
        for pattern in ALLOW:
            allowed = allowed | F.regexp(piece, F.lit(pattern))
        bits = (F.when(F.regexp(piece, F.lit(HEX_ONLY)), LEAST_BITS["hex"])
                .when(F.regexp(piece, F.lit(LETTERS_ONLY)), LEAST_BITS["letters"]).otherwise(LEAST_BITS["base64"]))
        found = _reaches(piece, _covered(piece), bits)
        return F.when(allowed, F.lit(False)).otherwise(found)

    assign = F.filter("assign", lambda x: F.length(F.regexp_replace(x["piece"], F.lit(f"^{ASSIGN}"), F.lit(""))) >= 6)
    return found.select("row", "text", F.array_sort(F.concat(
        assign, F.col("access"), F.col("hex"), F.filter("entropy", secret))).alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KIND_NAMES])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    ``spans`` joins ``kind:start:end`` of all spans by start, then kind, with commas;
    ``base_sha256`` is the SHA-256 of that string for the three base kinds alone. Null and empty
    texts have no span; repeated rows are scanned each; an empty table gives an empty one.
    """
    found = scan(docs)

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda x: x["kind"] < len(KINDS))
    return found.select(F.col("row.doc_id").alias("doc_id"),
                        *[count(i).alias(f"n_{k}") for i, (k, _) in enumerate(KINDS)],
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark`` (overlapping spans by one mark).

    A text without spans stays as it is, a null text null; ``n_chars``, if there is such a column,
    follows the text.
    """
    def part(cut, begin, end):
        """The text from ``begin`` to ``end`` out of its blocks: only those it touches are looked at."""
        return F.when(end <= begin, F.lit("")).otherwise(F.array_join(F.transform(
            F.sequence(F.floor(begin / _CUT).cast("int"), F.floor((end - 1) / _CUT).cast("int")),
            lambda i: F.substring(F.get(cut, i), F.greatest(begin - i * _CUT, F.lit(0)) + 1,
                                  F.least(end, (i + 1) * _CUT) - F.greatest(begin, i * _CUT))), ""))

    def step(cut):
        def one(acc, x):
            more = F.when((x["end"] <= acc["at"]) | (x["start"] < acc["at"]), F.lit("")).otherwise(
                F.concat(part(cut, acc["at"], x["start"]), F.lit(mark)))
            return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.concat(acc["out"], more).alias("out"))
        return one

    def block(cut):
        def one(acc, spans):
            return _let(F.aggregate(spans, F.struct(acc["at"].alias("at"), F.lit("").alias("out")), step(cut)), lambda done: F.struct(
                done["at"].alias("at"), F.concat(acc["out"], F.array(done["out"])).alias("out")))
        return one

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    clean = _let(F.regexp_extract_all("text", F.lit(f"(?s)(.{{1,{_CUT}}})"), F.lit(1)), lambda cut: F.aggregate(
        _blocks(F.col("spans")), start, block(cut),
        lambda a: F.concat(F.array_join(a["out"], ""), part(cut, a["at"], F.length("text")))))
    found = scan(docs).select("row", F.when(F.size("spans") == 0, F.col("row.text")).otherwise(clean).alias("clean"))
    columns = []
    for f in docs.schema.fields:
        if f.name == "text":
            columns.append(F.col("clean").alias("text"))
        elif f.name == "n_chars":
            columns.append(F.when(F.col("clean") == F.col("row.text"), F.col("row.n_chars"))
                           .otherwise(F.length("clean")).cast(f.dataType).alias("n_chars"))
        else:
            columns.append(F.col("row").getField(f.name).alias(f.name))
    return found.select(*columns)


def _sql() -> str:
    """The same spans in SQL: pieces between and in matches, and the entropy of unnested windows."""
    def quoted(x):
        return "'" + x.replace("'", "''") + "'"

    found = " UNION ALL ".join(f"""
SELECT doc_id, {k} AS kind, i, b[i] AS before, f[i] AS piece
  FROM (SELECT doc_id, string_split_regex(t, {quoted(p)}) AS b, regexp_extract_all(t, {quoted(p)}) AS f FROM d) x,
       LATERAL (SELECT unnest(range(1, len(f) + 1)) AS i) u""" for k, p in enumerate([p for _, p in KINDS] + [CANDIDATE]))
    allowed = " OR ".join(f"regexp_matches(piece, {quoted(p)})" for p in ALLOW)
    masked = "piece"
    for word in PLACEHOLDERS:
        masked = f"regexp_replace({masked}, '(?i){word}', '{'=' * len(word)}', 'g')"
    covered = (f"array_to_string(list_transform(string_split_regex({masked}, '{MARK}'), "
               f"lambda x: repeat(CASE WHEN regexp_matches(x, '{PLAIN_PART}') THEN '1' ELSE '0' END, length(x))), '1')")
    least = (f"CASE WHEN regexp_matches(piece, '{HEX_ONLY}') THEN {LEAST_BITS['hex']} "
             f"WHEN regexp_matches(piece, '{LETTERS_ONLY}') THEN {LEAST_BITS['letters']} ELSE {LEAST_BITS['base64']} END")
    names = "CASE kind " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KIND_NAMES)) + " END"
    joined = f"string_agg({names} || ':' || start || ':' || stop, ',' ORDER BY start, kind)"
    last = len(KINDS)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({found}),
s AS (SELECT doc_id, kind, piece, CAST(sum(length(before) + length(piece)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT)
             - length(piece) AS start, length(piece) AS size FROM m),
c AS (SELECT DISTINCT piece, {covered} AS marks FROM s WHERE kind = {last} AND NOT ({allowed})),
w AS (SELECT piece, i, unnest(string_split(substr(piece, i, {WINDOW}), '')) AS ch
        FROM c, LATERAL (SELECT unnest(range(1, length(piece) - {WINDOW} + 2)) AS i) u
       WHERE length(replace(substr(marks, i, {WINDOW}), '1', '')) >= {LEAST_OPEN}),
h AS (SELECT piece, i, sum(n * log2(n)) AS low FROM (SELECT piece, i, ch, count(*) AS n FROM w GROUP BY piece, i, ch) q
       GROUP BY piece, i),
e AS (SELECT piece FROM (SELECT piece, log2({WINDOW}) - min(low) / {WINDOW} AS bits FROM h GROUP BY piece) q
       WHERE bits >= {least}),
k AS (SELECT doc_id, kind, start, start + size AS stop FROM s
       WHERE CASE kind WHEN 0 THEN length(regexp_replace(piece, {quoted("^" + ASSIGN)}, '')) >= 6
                       WHEN {last} THEN piece IN (SELECT piece FROM e) ELSE TRUE END),
a AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = {i}) AS n_{n}" for i, (n, _) in enumerate(KINDS))},
             {joined} FILTER (kind < {last}) AS base, {joined} AS spans FROM k GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{n}, 0) AS n_{n}" for n, _ in KINDS)}, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (doc_id)"""


SQL = _sql()
