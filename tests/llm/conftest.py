import random

import pytest


#: Column names that the operators use inside; an input may have them too.
CLASHING = ["fp", "tag", "row", "block", "text_key", "kept", "spans", "queue", "lines", "digest", "node",
            "_id", "_key", "_row", "_sha", "host", "group", "place", "n", "count", "length", "t", "words"]

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          + ", ".join(f"`{c}` string" for c in CLASHING))


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary):03d}" for _ in range(n))


def messy_rows():
    """Nulls, empty and long texts, ties, repeated rows, copies, secrets and personal data."""
    rng = random.Random(7)
    base = [words(rng, n) for n in (3, 12, 40, 60, 90, 200)]
    long = words(rng, 30_000, 5000)
    texts = [None, "", " \t\n", "a", "A  b\tc", "a b c", base[1], base[1].upper(), base[2], "x\n" + base[2],
             base[3] + "\n" + base[3], base[4] + " tail", base[5], base[5][:-4] + "zzzz", long, long + " end",
             "password: hunter2hunter " + base[2], "card 4111 1111 1111 1111 and \U0001f642 é x",
             "é" * 50, base[4].replace(" ", "\n"), "<|endoftext|> " + base[1], "▁ a  b   c "]
    rows = [(i, t, "en", f"src{i % 3}" if i % 5 else None) for i, t in enumerate(texts)]
    rows += [(3, "a", "en", "src0"), (3, "a", "en", "src0"), (3, "other text of the same id", "en", "src1")]
    rows += [(None, base[4] + " tail", "en", "src1"), (None, None, None, None), (None, "only here " + base[3], "de", "src2")]
    rows += [(1000 + i, base[4] + f" v{i % 4}", "en", "src0") for i in range(40)]
    return rows


def frame(spark, rows):
    rows = [(*r, *([None] * (4 - len(r)))) for r in rows]
    return spark.createDataFrame([(r[0], r[1], r[2], r[3], None if r[1] is None else len(r[1]), *CLASHING) for r in rows],
                                 SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def messy(spark):
    return frame(spark, messy_rows())


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(df):
    """Rows as sortable tuples."""
    return sorted((tuple(map(repr, r)) for r in df.collect()))


__all__ = ["frame", "messy_rows", "plain", "words"]
