"""Mixture-controlled packing: deficit round-robin over source queues fills every window.

Documents are tokenised once, into a written table of ids, whose token counts per source are the default
targets. They are dealt over lanes (shuffle partitions). A lane reads its documents in a stream,
keeps one queue per source, and fills window after window: every source is credited its target
share of the window and gives what its deficit covers; room that a source cannot fill is lent to
the others in proportion to their targets. Deficits carry over from window to window. What a lane
cannot fill a whole window with (fewer tokens than one window) goes, with its deficits, to a lane
of the next level, which takes the rests of up to ``fan_in`` lanes; the last lane of all cuts its
rest into windows of power-of-two lengths. So no token is lost and nothing is padded.
"""

from __future__ import annotations

import zlib
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import (BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from cohortml.llm.bpe import by_bytes, encoder
from cohortml.llm.common import materialise, scratch_path, shuffle_width, stored

#: The queue of all sources without a target of their own.
OTHER = "\x00other"


class Mixer:
    """Queues of token runs, one per source, and the windows filled from them."""

    def __init__(self, targets: dict[str, float], window: int):
        self.targets, self.window = targets, window
        self.queues = {s: deque() for s in targets}
        self.waiting = dict.fromkeys(targets, 0)
        self.deficit = dict.fromkeys(targets, 0.0)
        self.total = 0

    def add(self, source, doc_id, start, ids, doc_tokens):
        """``ids``: little-endian unsigned 32-bit integers, from token ``start`` of the document."""
        if ids:
            n = len(ids) >> 2
            self.queues[source].append((doc_id, start, memoryview(ids), doc_tokens))
            self.waiting[source] += n
            self.total += n

    def quotas(self, size: int) -> dict[str, int]:
        """Tokens per source for a window of ``size``: deficits first, then loans by target."""
        size = min(size, self.total)
        room, take = size, dict.fromkeys(self.targets, 0)
        for s, w in self.targets.items():
            self.deficit[s] += w * size
        for s in sorted(self.targets, key=lambda s: -self.deficit[s]):
            take[s] = max(0, min(int(self.deficit[s]), self.waiting[s], room))
            room -= take[s]
        while room:
            able = [s for s in self.targets if self.waiting[s] > take[s]]
            weight, before = sum(self.targets[s] for s in able), room
            for s in able:
                more = min(int(before * self.targets[s] / weight) if weight else 0, self.waiting[s] - take[s], room)
                take[s] += more
                room -= more
            if room and room == before:  # less than one token each: by largest deficit
                for s in sorted(able, key=lambda s: take[s] - self.deficit[s])[:room]:
                    take[s] += 1
                    room -= 1
        for s, n in take.items():
            self.deficit[s] -= n
        return take

    def fill(self, size: int):
        """Pieces ``(source, doc_id, start, ids, doc_tokens)`` of the next window; ``ids`` are views, never copies."""
        for s, n in self.quotas(size).items():
            q = self.queues[s]
            self.waiting[s] -= n
            self.total -= n
            while n:
                doc_id, start, ids, doc_tokens = q[0]
                have = len(ids) >> 2
                if have <= n:
                    q.popleft()
                    yield s, doc_id, start, ids, doc_tokens
                    n -= have
                else:
                    q[0] = (doc_id, start + n, ids[4 * n:], doc_tokens)
                    yield s, doc_id, start, ids[:4 * n], doc_tokens
                    n = 0

    def rest(self):
        for s, q in self.queues.items():
            for doc_id, start, ids, doc_tokens in q:
                yield s, doc_id, start, ids, doc_tokens


_COLUMNS = ("kind", "lane", "sequence_id", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "offset",
            "queue", "ids", "deficit")
#: What a row of a lane's output is.
PIECE, REST, DEFICIT = 0, 1, 2


def _schema(id_type) -> StructType:
    long = LongType()
    kinds = (IntegerType(), long, long, id_type, long, long, long, long, long, StringType(), BinaryType(),
             DoubleType())
    return StructType([StructField(c, t) for c, t in zip(_COLUMNS, kinds, strict=True)])


#: The columns of a piece; a rest or deficit has the others.
_PIECE = ("sequence_id", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "offset")


class _Rows:
    """Output rows of a lane, given off as Arrow batches."""

    def __init__(self, schema: StructType, lane: int, level: int, most: int = 20_000):
        import pyarrow as pa
        self.pa, self.lane, self.most = pa, lane, most
        self.schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])
        self.next_id = (level << 56) | (lane << 32)
        self.pieces, self.rests = [[] for _ in _PIECE], []

    def window(self, pieces):
        at, number = 0, self.next_id
        sequence, doc, begin, length, crc, whole, offset = [column.append for column in self.pieces]
        for _, doc_id, start, ids, doc_tokens in pieces:
            n = len(ids) >> 2
            sequence(number), doc(doc_id), begin(start), length(n), crc(zlib.crc32(ids)), whole(doc_tokens), offset(at)
            at += n
        self.next_id += 1

    def close(self, mixer: Mixer):
        """Batches of all that is left: pieces, the rest of the queues, the deficits."""
        for s, doc_id, start, ids, doc_tokens in mixer.rest():
            self.rests.append((REST, doc_id, start, len(ids) >> 2, doc_tokens, s, bytes(ids), None))
        for s, d in mixer.deficit.items():
            if d:
                self.rests.append((DEFICIT, None, None, None, None, s, None, d))
        yield self.batch()
        if self.rests:
            names = ("kind", "doc_id", "start", "length", "doc_tokens", "queue", "ids", "deficit")
            yield self._build(dict(zip(names, zip(*self.rests))), len(self.rests))

    def full(self) -> bool:
        return len(self.pieces[0]) >= self.most

    def batch(self):
        n, columns = len(self.pieces[0]), dict(zip(_PIECE, self.pieces))
        self.pieces = [[] for _ in _PIECE]
        return self._build({"kind": [PIECE] * n, **columns}, n)

    def _build(self, columns, n):
        columns["lane"] = [self.lane] * n
        return self.pa.RecordBatch.from_arrays(
            [self.pa.array(columns[f.name], f.type) if f.name in columns else self.pa.nulls(n, f.type) for f in self.schema], schema=self.schema)


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, source: str) -> DataFrame:
    """``(doc_id, queue, n, wide, ids)``: each document's ids and ``end_id``, in 16 bits where the vocabulary allows."""
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("queue", StringType()),
                         StructField("n", LongType()), StructField("wide", BooleanType()), StructField("ids", BinaryType())])
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        enc = encoder(tokenizer)
        wide = max(len(enc.opens), end_id + 1) > 1 << 16
        for rows in by_bytes(batches, ("doc_id", "queue", "text")):
            ids = [np.frombuffer(x + end_id.to_bytes(4, "little"), "<u4") for x in enc.encode([r[-1] for r in rows])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], id_type), pa.array([r[1] for r in rows], pa.string()),
                 pa.array(list(map(len, ids)), pa.int64()), pa.array([wide] * len(rows)),
                 pa.array([x.astype("<u4" if wide else "<u2").tobytes() for x in ids], pa.binary())],
                names=["doc_id", "queue", "n", "wide", "ids"])

    return docs.select("doc_id", F.col(source).cast("string").alias("queue"), "text").mapInArrow(run, schema)


def mixture(tokens: DataFrame, least: float = 1 / 1024) -> dict[str, float]:
    """Each source's share of all tokens; sources under ``least`` share one queue.

    At most ``1 / least`` sources come back, whatever the size of the corpus.
    """
    per = materialise(tokens.groupBy(F.coalesce(F.col("queue"), F.lit(OTHER)).alias("s")).agg(F.sum("n").alias("b")))
    total = per.agg(F.sum("b")).first()[0] or 1
    rows = per.where(F.col("b") >= F.lit(least * total)).collect()
    shares = {r["s"]: r["b"] / total for r in rows if r["s"] != OTHER}
    return shares | {OTHER: max(0.0, 1.0 - sum(shares.values()))}


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 1, window: int = 2048,
         targets: dict[str, float] | None = None, source: str = "source", buffer_tokens: int = 1 << 21,
         fan_in: int = 256) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its ids followed by ``end_id`` (a null or empty text is ``end_id`` alone).
    ``targets``: token share per source; by default the shares of all tokens of the corpus, which lets every
    window have the same mixture to the last one. With other targets the windows have them until a source
    is used up; the others then share its part. Sources not named
    share a queue whose target is what the named shares leave over one. ``buffer_tokens``: a lane
    holds about so many tokens in its queues. Full sequences have ``window`` tokens; the few last
    ones have power-of-two lengths. Repeated rows are packed each; an empty table gives no pieces.
    """
    spark = docs.sparkSession
    tokens = stored(tokenised(docs, tokenizer, end_id, source), scratch_path(spark, "packing"))
    if targets is None:
        targets = mixture(tokens)
    else:
        total = sum(targets.values())
        targets = {s: w / max(total, 1.0) for s, w in targets.items()}
        targets[OTHER] = max(0.0, 1.0 - sum(targets.values()))
    schema = _schema(docs.schema["doc_id"].dataType)

    def first_level(batches):
        import numpy as np
        from pyspark import TaskContext
        out = _Rows(schema, TaskContext.get().partitionId(), 0)
        mixer = Mixer(targets, window)
        for b in batches:
            for doc_id, queue, n, wide, ids in zip(*[b.column(c).to_pylist() for c in ("doc_id", "queue", "n", "wide", "ids")], strict=True):
                mixer.add(queue if queue in targets else OTHER, doc_id, 0,
                          ids if wide else np.frombuffer(ids, "<u2").astype("<u4").tobytes(), n)
                if mixer.total >= buffer_tokens:
                    while mixer.total >= max(window, buffer_tokens // 2):
                        out.window(mixer.fill(window))
                        if out.full():
                            yield out.batch()
        while mixer.total >= window:
            out.window(mixer.fill(window))
            if out.full():
                yield out.batch()
        yield from out.close(mixer)

    def next_level(level, last):
        def merge(key, table):
            import pyarrow as pa
            out, mixer = _Rows(schema, key[0].as_py(), level), Mixer(targets, window)
            rows = table.sort_by([("from_lane", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
            for r in rows.to_pylist():
                if r["kind"] == DEFICIT:
                    mixer.deficit[r["queue"]] += r["deficit"]
                else:
                    mixer.add(r["queue"], r["doc_id"], r["start"], r["ids"], r["doc_tokens"])
            while mixer.total >= window:
                out.window(mixer.fill(window))
            while last and mixer.total:
                out.window(mixer.fill(1 << (mixer.total.bit_length() - 1)))
            return pa.Table.from_batches(list(out.close(mixer)))
        return merge

    lanes = shuffle_width(spark)
    level = materialise(tokens.repartition(lanes).mapInArrow(first_level, schema))
    pieces = [level.where(F.col("kind") == PIECE)]
    for depth in range(1, 100):
        lanes = -(-lanes // fan_in)
        up = (level.where(F.col("kind") != PIECE)
              .withColumn("from_lane", F.col("lane"))
              .withColumn("lane", F.floor(F.col("lane") / F.lit(fan_in)).cast("long")))
        level = materialise(up.groupBy("lane").applyInArrow(next_level(depth, lanes == 1), schema))
        pieces.append(level.where(F.col("kind") == PIECE))
        if lanes == 1:
            break
    out = pieces[0]
    for p in pieces[1:]:
        out = out.unionByName(p)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
