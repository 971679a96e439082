"""Repeated passages: recurring phrases, confirmed windows, Aho-Corasick automata.

The documents are dealt into blocks of bounded text by a hash. All three passes over the blocks
read one and the same shuffle of the texts.

1. Phrases. Of the phrases of ``phrase`` words inside each window, the one with the smallest hash
   stands for the window; equal windows have equal phrases. Every block sends the distinct hashes
   of its phrases to hash ranges, which send back one bit per hash: does it recur anywhere?
2. Confirmation. Windows whose phrase recurs are sent in the same way with a 96-bit key of all
   their words; back comes one bit per key: does the window itself recur?
3. Location. Every block compiles its shard, an Aho-Corasick automaton of the phrases of its
   confirmed windows, and streams all its documents through it. Around each occurrence the windows
   that hold it are looked up among the confirmed keys, and their words are removed.

A passage that a third of all documents share sends one key per block, whatever the number of
documents, and an automaton never grows beyond the text of its block.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType)

from cohortml.llm.common import text_of, worker_state

_M1, _M2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd multipliers of the rolling hashes


class Block:
    """The words of a block's documents, their phrases and windows, in arrays over word places."""

    def __init__(self, texts: list[bytes], window: int, phrase: int):
        import numpy as np
        from xxhash import xxh3_128_digest
        self.window, self.phrase = window, phrase
        words = [t.split() for t in texts]  # bytes know ASCII separators only
        self.size = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.words = [w for ws in words for w in ws]
        n = len(self.words)
        pair = np.frombuffer(b"".join(map(xxh3_128_digest, self.words)), ">u8").reshape(-1, 2)
        self.h1, self.h2 = pair[:, 0].astype(np.uint64), pair[:, 1].astype(np.uint64)
        starts = max(n - window + 1, 0)
        doc = np.repeat(np.arange(len(words)), self.size)
        #: places where a window of one document begins
        self.begin = np.flatnonzero(doc[:starts] == doc[n - starts:])
        self.hash = self._mix(self._roll(self.h1, phrase, _M1)) if n >= phrase else np.zeros(0, np.uint64)
        #: the place of the phrase that stands for each window
        self.stands = self._leftmost(self.hash, window - phrase + 1)[self.begin] if len(self.begin) else self.begin

    @staticmethod
    def _mix(x):
        import numpy as np
        for shift, factor in ((31, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))

    @staticmethod
    def _roll(h, length, factor):
        """Hash of every run of ``length`` words: differences of running sums, moved to power 0."""
        import numpy as np
        n = len(h)

        def powers(f):
            have = worker_state(("powers", f), lambda: [np.ones(1, np.uint64)])
            if len(have[0]) <= n:
                have[0] = np.multiply.accumulate(np.append(np.ones(1, np.uint64), np.full(2 * n, f, np.uint64)))
            return have[0]

        total = np.append(np.zeros(1, np.uint64), np.cumsum(h * powers(factor)[:n], dtype=np.uint64))
        inverse = powers(pow(factor, -1, 1 << 64))
        return (total[length:] - total[: n - length + 1]) * inverse[: n - length + 1]

    @staticmethod
    def _leftmost(h, width):
        """Place of the leftmost smallest of every ``width`` neighbours, by doubling."""
        import numpy as np
        place, have = np.arange(len(h)), 1
        while have < width:
            step = min(have, width - have)
            a, b = place[:-step], place[step:]
            place = np.where(h[a] <= h[b], a, b)
            have += step
        return place

    def phrase_keys(self):
        """Sorted distinct phrase hashes, and whether each has several places in the block."""
        import numpy as np
        keys, n = np.unique(self.hash[np.unique(self.stands)], return_counts=True)
        return keys, n > 1

    def window_places(self, keys, recurs):
        """The windows whose phrase recurs."""
        import numpy as np
        if not len(keys):
            return self.begin[:0]
        return self.begin[recurs[np.searchsorted(keys, self.hash[self.stands])]]

    def window_hashes(self, places):
        import numpy as np
        if not len(places):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        high = self._mix(self._roll(self.h1, self.window, _M2)[places])
        low = (self._mix(self._roll(self.h2, self.window, _M1)[places]) >> np.uint64(32)).astype(np.uint32)
        return high, low

    def window_keys(self, places):
        """Sorted distinct window keys ``(high, low)``, and whether each has several places here."""
        import numpy as np
        high, low = self.window_hashes(places)
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))[: len(high)]
        first = np.flatnonzero(new)
        return high[first], low[first], np.diff(np.append(first, len(high))) > 1

    def locate(self, high, low, confirmed, places, stands):
        """Which words a confirmed window covers, found by the block's automaton.

        ``places``, ``stands``: the windows sent out and their phrases; ``confirmed``: a bit per key.
        """
        import ahocorasick
        import numpy as np
        covered = np.zeros(len(self.words) + 1, np.int64)
        found = np.zeros(len(self.words) + 1, np.int64)
        high, low = high[confirmed], low[confirmed]

        def known(at):
            h, w = self.window_hashes(at)
            i = np.searchsorted(high, h)
            i[i == len(high)] = 0
            hit = (high[i] == h) & (low[i] == w)
            odd = np.flatnonzero((high[i] == h) & ~hit)  # equal high parts, next low part
            for o in odd:
                k = i[o]
                while k < len(high) and high[k] == h[o]:
                    hit[o] |= low[k] == w[o]
                    k += 1
            return hit

        if len(high):
            automaton = ahocorasick.Automaton()
            for p in np.unique(stands[known(places)]).tolist():
                automaton.add_word(self._line(p, p + self.phrase), 0)
            automaton.make_automaton()
            for d, n in zip(self.first.tolist(), self.size.tolist()):
                if n < self.window:
                    continue
                line = self._line(d, d + n)
                ends = [end for end, _ in automaton.iter(line)]
                if ends:
                    # the separator that ends a phrase is the one after its last word
                    marks = np.flatnonzero(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4") == 32)
                    at = d + np.searchsorted(marks, ends) - self.phrase
                    np.add.at(found, np.maximum(at - (self.window - self.phrase), d), 1)
                    np.add.at(found, np.maximum(np.minimum(at, d + n - self.window) + 1, d), -1)
            near = np.flatnonzero(np.cumsum(found)[:-1] > 0)
            # a window lies in one document
            near = near[np.isin(near, self.begin, assume_unique=True)]
            hits = near[known(near)]
            np.add.at(covered, hits, 1)
            np.add.at(covered, hits + self.window, -1)
        return np.cumsum(covered)[:-1] > 0

    def _line(self, i, j):
        """Words i to j with one space before, between and after."""
        return (b" " + b" ".join(self.words[i:j]) + b" ").decode("utf-8", "surrogateescape")


def _ranges(keys, count):
    """The hash range of each sorted 64-bit key."""
    import numpy as np
    return ((keys >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)


_SENT = StructType([StructField("part", IntegerType()), StructField("block", IntegerType()),
                    StructField("high", BinaryType()), StructField("low", BinaryType()),
                    StructField("several", BinaryType())])
_BACK = StructType([StructField("block", IntegerType()), StructField("part", IntegerType()),
                    StructField("kind", IntegerType()), StructField("bits", BinaryType())])


def _send(block, parts, several, high, low=None):
    """A row per hash range that the block has keys for."""
    import numpy as np
    import pyarrow as pa
    part = _ranges(high, parts)
    cut = np.flatnonzero(np.append(True, part[1:] != part[:-1]))[: len(high)]
    rows = []
    for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(high)]):
        rows.append((int(part[i]), block, high[i:j].tobytes(), b"" if low is None else low[i:j].tobytes(),
                     np.packbits(several[i:j]).tobytes()))
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    columns = zip(*rows) if rows else [()] * 5
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_SENT.names)


def _answer(kind):
    """Per hash range: which of the keys that blocks sent recur; a bit per key, in the order sent."""
    def run(table):
        import numpy as np
        import pyarrow as pa
        rows = table.to_pylist()
        high = [np.frombuffer(r["high"], np.uint64) for r in rows]
        size = [len(h) for h in high]
        several = np.concatenate([np.unpackbits(np.frombuffer(r["several"], np.uint8), count=n)
                                  for r, n in zip(rows, size)]).astype(bool)
        key = np.concatenate(high)
        low = (np.concatenate([np.frombuffer(r["low"], np.uint32) for r in rows]) if rows[0]["low"]
               else np.zeros(len(key), np.uint32))
        order = np.lexsort((low, key))
        k, w = key[order], low[order]
        group = np.cumsum(np.append(True, (k[1:] != k[:-1]) | (w[1:] != w[:-1]))) - 1
        many = (np.bincount(group) > 1) | (np.bincount(group, several[order]) > 0)
        recurs = np.empty(len(key), bool)
        recurs[order] = many[group]
        bits = [np.packbits(x).tobytes() for x in np.split(recurs, np.cumsum(size)[:-1])]
        return pa.Table.from_arrays(
            [pa.array([r["block"] for r in rows], pa.int32()), pa.array([r["part"] for r in rows], pa.int32()),
             pa.array([kind] * len(rows), pa.int32()), pa.array(bits, pa.binary())], names=_BACK.names)
    return run


def _received(answers, kind, high, parts):
    """The bits of the block's sorted keys from the answers of all ranges."""
    import numpy as np
    out = np.zeros(len(high), bool)
    part = _ranges(high, parts)
    for r in answers:
        if r["kind"] == kind:
            i, j = np.searchsorted(part, [r["part"], r["part"] + 1]).tolist()
            out[i:j] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=j - i).astype(bool)
    return out


PHRASES, WINDOWS = 0, 1


def cut_repeats(docs: DataFrame, window: int = 35, phrase: int = 8, block_bytes: int = 8 << 20,
                with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256``.

    A window is ``window`` consecutive words of one document; each word that a window covers whose
    word sequence also begins anywhere else, in the same document too, is removed. All windows are
    judged on the input. ``with_text`` adds ``kept_text`` and ``removed`` (array of half-open word
    ranges). Null and empty texts have no words; texts under ``window`` words lose none; repeated
    rows repeat each other; an empty table gives an empty one. ``block_bytes``: text per block,
    which bounds what a task holds (a single longer text is a block's share by itself).
    """
    import math
    if not 0 < phrase <= window:
        raise ValueError("a phrase is a part of a window")
    total = docs.agg(F.sum(F.octet_length(text_of()).cast("long"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    parts = max(1, math.ceil(total / (8 * block_bytes)))
    dealt = docs.select("doc_id", text_of().alias("text"),
                        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"))
    dealt = dealt.repartition(blocks, "block")

    def texts(table):
        import pyarrow as pa
        return Block([t.as_py() for c in table.column("text").chunks for t in c.cast(pa.binary())], window, phrase)

    def send_phrases(key, table):
        b = texts(table)
        keys, several = b.phrase_keys()
        return _send(key[0].as_py(), parts, several, keys)

    def asked(b, answers):
        import numpy as np
        keys, _ = b.phrase_keys()
        recurs = _received(answers, PHRASES, keys, parts)
        places = b.window_places(keys, recurs)
        stands = b.stands[np.searchsorted(b.begin, places)]
        return places, stands, b.window_keys(places)

    def send_windows(key, table, back):
        import numpy as np
        if not table.num_rows:
            return _send(0, parts, [], np.zeros(0, np.uint64))
        _, _, (high, low, several) = asked(texts(table), back.to_pylist())
        return _send(key[0].as_py(), parts, several, high, low)

    fields = [StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_words", LongType()),
              StructField("n_removed", LongType()), StructField("kept_sha256", StringType())]
    if with_text:
        fields += [StructField("kept_text", StringType()), StructField("removed", ArrayType(ArrayType(LongType())))]
    schema = StructType(fields)
    types = [to_arrow_type(f.dataType) for f in fields]

    def remove(key, table, back):
        import numpy as np
        import pyarrow as pa
        answers = back.to_pylist()
        rows = []
        if table.num_rows:
            b = texts(table)
            places, stands, (high, low, _) = asked(b, answers)
            gone = b.locate(high, low, _received(answers, WINDOWS, high, parts), places, stands)
            for i, n in zip(b.first.tolist(), b.size.tolist()):
                out, words = gone[i:i + n], b.words[i:i + n]
                if out.any():
                    words = [w for w, x in zip(words, out.tolist()) if not x]
                kept = b" ".join(words)
                row = [n, int(out.sum()), hashlib.sha256(kept).hexdigest()]
                if with_text:
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], out, [0]]))).reshape(-1, 2)
                    row += [kept.decode("utf-8", "replace"), edge.tolist()]
                rows.append(row)
        columns = list(zip(*rows)) if rows else [()] * (len(fields) - 1)
        ids = table.column("doc_id").cast(types[0]) if table.num_rows else pa.array([], types[0])
        return pa.Table.from_arrays([ids, *[pa.array(c, t) for c, t in zip(columns, types[1:])]], names=schema.names)

    by_block = dealt.groupBy("block")
    recurring = by_block.applyInArrow(send_phrases, _SENT).groupBy("part").applyInArrow(_answer(PHRASES), _BACK)
    sent = by_block.cogroup(recurring.groupBy("block")).applyInArrow(send_windows, _SENT)
    confirmed = sent.groupBy("part").applyInArrow(_answer(WINDOWS), _BACK)
    answers = recurring.unionByName(confirmed)
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(remove, schema)


SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
             FROM documents),
w AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 34), ' ') AS s
        FROM d, LATERAL (SELECT unnest(range(1, len(ws) - 33)) AS i) u),
again AS (SELECT s FROM w GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, p
           FROM w SEMI JOIN again USING (s), LATERAL (SELECT unnest(range(i, i + 35)) AS p) u),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p)
          GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
  FROM d LEFT JOIN kept USING (doc_id)"""
