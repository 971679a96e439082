"""SimHash near-duplicate groups by sharded BK-trees.

Two fingerprints of 64 bits that differ in at most ``radius`` bits agree on at least
``blocks - radius`` of ``blocks`` bit blocks (pigeonhole). Every choice of that many blocks and
every value found there is a shard. A shard's distinct fingerprints form a BK-tree (children keyed
by their integer Hamming distance to the parent) and are looked up in it, following only edges
within the radius. Fingerprints of the whole corpus never pass the driver, so a shard's tree is not
broadcast from there: it travels with its shard. A shard over ``shard_nodes`` fingerprints is dealt
into chunks, and the tree of each chunk is sent to (copied beside) every chunk of queries, so that
no task holds more than two chunks.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from cohortml.llm.common import connected_components, materialise, shuffle_width


# ---------------------------------------------------------------- fingerprints
def fingerprint(data: bytes, width: int = 3) -> bytes:
    """8 bytes, highest bit first: a bit is 1 if set in over half the shingle hashes.

    Shingles are ``width`` words joined by one space, repeats included; with fewer words the whole
    sequence; without words all bits are 0. ``bytes.lower`` and ``bytes.split`` know ASCII only,
    which is what the definition asks for.
    """
    import numpy as np
    from xxhash import xxh64_digest
    words = data.lower().split()
    if not words:
        return bytes(8)
    line = b" ".join(words)
    if len(words) <= width:
        digests = xxh64_digest(line, 42)
    else:
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        end = np.cumsum(size) - 1
        begin = (end - size + 1)[: 1 - width].tolist()
        digests = b"".join([xxh64_digest(line[i:j], 42) for i, j in zip(begin, end[width - 1:].tolist())])
    octets = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    n = len(octets)
    if n < 256:
        ones = np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    else:
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
        ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ bits for k in range(8)])
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``(doc_id, text_key, fp)`` of every row: XXH64 of the text, and the fingerprint as a long."""
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("text_key", LongType()),
                         StructField("fp", LongType())])
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            fps = [int.from_bytes(fingerprint(t.as_py() or b"", width), "big", signed=True) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(id_type), b.column("text_key"),
                                              pa.array(fps, pa.int64())], names=["doc_id", "text_key", "fp"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, schema)


# ---------------------------------------------------------------- BK-trees
def plant(fp, group):
    """A BK-tree per group of ``fp`` (unsigned, distinct within a group; groups are contiguous).

    Returns ``(root of each group, code, child)``: the edges sorted by code
    ``parent * 65 + distance``. All trees grow side by side, level by level: the first item of a
    group becomes its node, the others split by their distance to it.
    """
    import numpy as np
    item = np.arange(len(fp))
    part = np.unique(group, return_inverse=True)[1] if len(fp) else item
    parent = np.full(len(fp), -1)
    edge = np.zeros(len(fp), np.int64)
    roots = None
    first_code = None
    while len(item):
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        node = item[first]
        if roots is None:
            roots = node
        else:
            parent[node], edge[node] = first_code[first] // 65, first_code[first] % 65
        rest = np.ones(len(item), bool)
        rest[first] = False
        at = node[np.cumsum(~rest)[rest] - 1]
        item = item[rest]
        code = at * 65 + np.bitwise_count(fp[item] ^ fp[at]).astype(np.int64)
        order = np.argsort(code, kind="stable")
        item, part = item[order], code[order]
        first_code = part
    child = np.flatnonzero(parent >= 0)
    code = parent[child] * 65 + edge[child]
    order = np.argsort(code, kind="stable")
    return (roots if roots is not None else item), code[order], child[order]


def search(fp, tree, query, root, radius):
    """Batches of ``(query place, node)`` within ``radius``; ``root``: where each query begins."""
    import numpy as np
    _, code, child = tree
    asked, node = np.arange(len(query)), root
    while len(asked):
        d = np.bitwise_count(query[asked] ^ fp[node]).astype(np.int64)
        near = d <= radius
        yield asked[near], node[near]
        low = np.searchsorted(code, node * 65 + np.maximum(d - radius, 0), "left")
        high = np.searchsorted(code, node * 65 + np.minimum(d + radius, 64), "right")
        n = high - low
        asked = np.repeat(asked, n)
        node = child[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _unite(label, a, b):
    """Merge the classes of linked items; ``label`` holds the smallest item of each class."""
    import numpy as np
    while len(a):
        x, y = label[a], label[b]
        far = x != y
        a, b, x, y = a[far], b[far], x[far], y[far]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def link_shards(fp, shard, side, radius, work: int = 1 << 22):
    """Links ``(smallest item of its class, item)`` inside the shards of sorted, contiguous rows.

    ``side`` 0: in the tree and looked up; 1: in the tree only; 2: looked up only. Queries go in
    portions so that a frontier stays near ``work`` entries.
    """
    import numpy as np
    planted = np.flatnonzero(side < 2)
    tree = plant(fp[planted], shard[planted])
    root_of = dict(zip(shard[planted][tree[0]].tolist(), tree[0].tolist()))
    size = dict(zip(*(x.tolist() for x in np.unique(shard[planted], return_counts=True))))
    asking = np.flatnonzero(side != 1)
    asking = asking[np.isin(shard[asking], shard[planted][tree[0]])]
    cost = np.cumsum([size[s] for s in shard[asking].tolist()])
    label = np.arange(len(fp))
    for portion in np.split(asking, np.flatnonzero(np.diff(cost // work)) + 1) if len(asking) else ():
        roots = np.array([root_of[s] for s in shard[portion].tolist()])
        for q, n in search(fp[planted], tree, fp[portion], roots, radius):
            _unite(label, portion[q], planted[n])
    linked = np.flatnonzero(label != np.arange(len(fp)))
    return label[linked], linked


# ---------------------------------------------------------------- near-duplicate classes
def _masks(blocks: int, radius: int) -> list[int]:
    """The bits of every choice of ``blocks - radius`` blocks, as signed 64-bit masks."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    parts = [((1 << (j - i)) - 1) << i for i, j in zip(cuts, cuts[1:])]
    wholes = [sum(c) for c in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in wholes]


def _blocks_for(n: int, radius: int, occupancy: int = 64) -> int:
    """The fewest blocks whose shards would hold ``occupancy`` even fingerprints at most."""
    blocks = radius + 1
    while blocks < 2 * radius + 1 and n >> (64 * (blocks - radius) // blocks) > occupancy:
        blocks += 1
    return blocks


def near_links(fps: DataFrame, radius: int = 3, blocks: int | None = None, shard_nodes: int = 8192) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints ``fp`` at ``radius`` bits or fewer.

    Inside a shard a class of ``m`` fingerprints gives ``m - 1`` links, never all pairs.
    """
    spark = fps.sparkSession
    if blocks is None:
        blocks = _blocks_for(fps.count(), radius)
    masks = _masks(blocks, radius)
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(masks)])).alias("s")
    ).select("fp", "s.k", "s.v")
    sizes = keyed.groupBy("k", "v").count()
    shared = sizes.where("count > 1").select("k", "v", F.ceil(F.col("count") / F.lit(shard_nodes)).cast("int").alias("chunks"))
    rows = keyed.join(shared, ["k", "v"])
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    # chunk x meets chunk y >= x: x is the tree, y asks; within one chunk every item does both
    pair = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(
        F.least(c, F.col("own")).alias("x"), F.greatest(c, F.col("own")).alias("y"),
        F.when(c == F.col("own"), 0).when(c > F.col("own"), 1).otherwise(2).alias("side")))
    rows = (rows.withColumn("own", own).select("fp", "k", "v", F.explode(pair).alias("p"))
            .select("fp", "k", "v", "p.x", "p.y", "p.side"))
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        held, n = [], 0

        def emit(parts, last):
            cols = [np.concatenate([p[c] for p in parts]) for c in range(6)]
            fp, key, side = cols[0], np.stack(cols[1:5]), cols[5]
            new = np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))
            shard = np.cumsum(new)
            # the last shard may go on in the next batch
            cut = len(fp) if last else int(np.flatnonzero(new)[-1])
            a, b = link_shards(fp[:cut].view(np.uint64), shard[:cut], side[:cut], radius) if cut else ((), ())
            return ([c[cut:] for c in cols],
                    pa.RecordBatch.from_arrays([pa.array(fp[a] if cut else [], pa.int64()),
                                                pa.array(fp[b] if cut else [], pa.int64())], names=["a", "b"]))

        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            n += batch.num_rows
            if n >= 65_536:
                left, out = emit(held, False)
                held, n = [left], len(left[0])
                yield out
        if n:
            yield emit(held, True)[1]

    sorted_rows = (rows.repartition(shuffle_width(spark), "k", "v", "x", "y")
                   .sortWithinPartitions("k", "v", "x", "y", "fp").select("fp", "k", "v", "x", "y", "side"))
    return sorted_rows.mapInArrow(run, schema)


def near_classes(rows: DataFrame, radius: int = 3, **options) -> DataFrame:
    """``(fp, root, component_id)`` for every distinct ``fp`` of ``rows(doc_id, fp)``.

    ``root`` is one fingerprint of the connected class, ``component_id`` its smallest ``doc_id``
    (null only if the class has no other).
    """
    nodes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = connected_components(near_links(nodes.select("fp"), radius, **options))
    member = nodes.join(roots, nodes["fp"] == roots["node"], "left")
    member = member.select("fp", "low", F.coalesce("root", "fp").alias("root"))
    low = member.groupBy("root").agg(F.min("low").alias("component_id"))
    return member.join(low, "root").select("fp", "root", "component_id")


def _classed(docs: DataFrame, width: int = 3, radius: int = 3, **options) -> DataFrame:
    rows = materialise(fingerprints(docs, width))
    return rows.join(near_classes(rows, radius, **options), "fp")


def simhash_dedup(docs: DataFrame, width: int = 3, radius: int = 3, **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``.

    ``fingerprint``: 16 lowercase hex digits; ``component_id``: the smallest ``doc_id`` reachable
    over links of ``radius`` bits or fewer, itself included. Null and empty texts have no words and
    fingerprint zero, which links like any other. Repeated rows share a class. A null ``doc_id``
    takes part; a class without any other id has a null ``component_id``. An empty table gives an
    empty one. Options: ``blocks``, ``shard_nodes`` (see :func:`near_links`).
    """
    return _classed(docs, width, radius, **options).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each class one row with the smallest ``doc_id``."""
    keep = (_classed(docs, **options).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("k"))
            .select(F.col("k.doc_id").alias("_id"), F.col("k.text_key").alias("_key")))
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"))
    on = rows["_id"].eqNullSafe(keep["_id"]) & (rows["_key"] == keep["_key"])
    return rows.join(keep, on, "left_semi").dropDuplicates(["_id", "_key"]).select("_row.*")
