"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

The encoder is a score-ordered agenda of adjacent symbol pairs: all pairs whose joined text is a
piece wait in a heap by (highest score, leftmost), the best one is merged, and the pairs that it
makes with its neighbours join the agenda. No piece of the vocabulary holds the space mark after
another character (checked when the model is read), so no merge crosses from a word into the next
word's space mark: a text is merged word by word, and a bounded table per worker remembers the ids
of short words. The many new words of a batch share one agenda held in arrays, from which every
round takes the best pair of each word; long words and words with unknown characters have a heap. In every Arrow batch the ids of every newly merged word are checked against the
sentencepiece library, which also decodes every text; a text that does not come back as it was is
encoded by the library as a whole and compared.
"""

from __future__ import annotations

import hashlib
import re
import struct
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cohortml.llm.bpe import by_bytes
from cohortml.llm.common import vocabulary_path, worker_state

MARK = "▁"
_RUN = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class MergeCodec:
    """Encoder of one merge-type model, with the library beside it."""

    def __init__(self, path: str, table_bytes: int = 128 << 20, keep_chars: int = 9):
        import sentencepiece
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.piece, self.byte, self.text, scores = {}, {}, [], set()
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            self.text.append(p)
            if sp.is_byte(i):
                self.byte[int(p[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.piece[p] = (-sp.get_score(i), i)
                scores.add(-sp.get_score(i))
        rank = {x: r for r, x in enumerate(sorted(scores))}
        self.piece = {p: (rank[x], i) for p, (x, i) in self.piece.items()}
        self.checked = True
        self.begin, self.end, self.unknown = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self._pair_arrays()
        if any(MARK in p.lstrip(MARK) for p in self.piece):
            raise ValueError("a piece spans two words; this vocabulary can't be merged word by word")
        self.table_bytes, self.keep_chars = table_bytes, keep_chars
        self.table, self.held = {}, 0

    def _pair_arrays(self):
        """Sorted codes of all pairs of pieces that join to a piece, with its rank and id."""
        import numpy as np
        pairs = [(self.piece[p[:k]][1] * len(self.text) + self.piece[p[k:]][1], *hit)
                 for p, hit in self.piece.items() for k in range(1, len(p)) if p[:k] in self.piece and p[k:] in self.piece]
        self.pair, self.pair_rank, self.pair_id = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 3).T.copy()
        # an entry past the end, so that a search always lands on something
        self.pair = np.append(self.pair, np.iinfo(np.int64).max)
        self.pair_rank, self.pair_id = np.append(self.pair_rank, 0), np.append(self.pair_id, 0)

    def merge_many(self, words: list[str]) -> list[bytes]:
        """Packed ids of words whose characters are all pieces, merged side by side."""
        import numpy as np
        size = np.fromiter(map(len, words), np.int64, len(words))
        codes, back = np.unique(np.frombuffer("".join(words).encode("utf-32-le"), "<u4"), return_inverse=True)
        symbol = np.array([self.piece[chr(c)][1] for c in codes.tolist()], np.int64)[back]
        owner = np.repeat(np.arange(len(words)), size)
        never = np.int64(1) << 30

        def look(left):
            """Rank (``never`` if there is none) and joined piece of the pairs that begin at ``left``."""
            code = symbol[left] * len(self.text) + symbol[left + 1]
            at = np.searchsorted(self.pair, code)
            hit = (self.pair[at] == code) & (owner[left] == owner[left + 1])
            return np.where(hit, self.pair_rank[at], never), self.pair_id[at]

        rank, joined = np.full(len(symbol), never), np.zeros(len(symbol), np.int64)
        rank[:-1], joined[:-1] = look(np.arange(len(symbol) - 1))
        start = np.cumsum(size) - size
        done = []
        while len(start):
            place = np.arange(len(symbol))
            best = np.minimum.reduceat((rank << 32) | place, start)
            live = (best >> 32) < never
            if not live.all():
                stay = np.repeat(live, np.diff(np.append(start, len(symbol))))
                done.append((owner[~stay], symbol[~stay]))
                best = (best & 0xFFFFFFFF)[live]
                # places move down by the symbols of the finished words before them
                best -= (np.cumsum(~stay) - ~stay)[best]
                symbol, owner, rank, joined = symbol[stay], owner[stay], rank[stay], joined[stay]
            else:
                best &= 0xFFFFFFFF
            if not len(best):
                break
            symbol[best] = joined[best]
            keep = np.ones(len(symbol), bool)
            keep[best + 1] = False
            symbol, owner, rank, joined = symbol[keep], owner[keep], rank[keep], joined[keep]
            best -= np.arange(len(best))
            for left in (best[best + 1 < len(symbol)], best[best > 0] - 1):
                rank[left], joined[left] = look(left)
            if best[-1] == len(symbol) - 1:
                rank[-1] = never
            start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        owner, symbol = (np.concatenate(x) for x in zip(*done, strict=True))
        raw = symbol[np.argsort(owner, kind="stable")].astype("<u4").tobytes()
        cut = [0, *(4 * np.cumsum(np.bincount(owner, minlength=len(words)))).tolist()]
        return [raw[i:j] for i, j in zip(cut, cut[1:])]

    def merge(self, word: str) -> list[str]:
        """The symbols that remain of ``word`` when no adjacent pair is a piece.

        An entry of the agenda is one integer that sorts by (rank of the score, position, piece).
        """
        find, text, many = self.piece.get, self.text, len(self.text)
        symbol = list(word)
        n = len(symbol)
        agenda = []
        for i in range(n - 1):
            hit = find(word[i:i + 2])
            if hit:
                agenda.append((hit[0] * n + i) * many + hit[1])
        if not agenda:
            return symbol
        heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            entry = heappop(agenda)
            i, joined = entry // many % n, text[entry % many]
            j = after[i]
            # stale if either side was merged meanwhile
            if symbol[i] is None or j >= n or symbol[i] + symbol[j] != joined:
                continue
            symbol[i], symbol[j] = joined, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                hit = find(joined + symbol[k])
                if hit:
                    heappush(agenda, (hit[0] * n + i) * many + hit[1])
            h = before[i]
            if h >= 0:
                hit = find(symbol[h] + joined)
                if hit:
                    heappush(agenda, (hit[0] * n + h) * many + hit[1])
        return [s for s in symbol if s is not None]

    def word_ids(self, word: str) -> bytes:
        ids = []
        for s in self.merge(word):
            hit = self.piece.get(s)
            if hit:
                ids.append(hit[1])
            elif self.byte:
                ids.extend(self.byte[b] for b in s.encode())
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, without begin and end."""
        if self.held > self.table_bytes:
            self.table, self.held = {}, 0
        cuts, words = [], set()
        for t in texts:
            if not t:
                cut = []
            elif "  " in t or MARK in t or t[0] == " ":
                cut = _RUN.findall((MARK + t).replace(" ", MARK))
            else:
                cut = (MARK + t.replace(" ", " " + MARK)).split(" ")
            words.update(cut)
            cuts.append(cut)
        table, new = self.table, list(words.difference(self.table))
        known = self.piece.keys()
        short = [w for w in new if len(w) <= 64 and known >= set(w)]
        if short:
            table.update(zip(short, self.merge_many(short), strict=True))
        for w in new:
            if w not in table:
                table[w] = self.word_ids(w)
        if self.checked:
            # the library puts a mark before a text, so a word without its first mark is a text
            theirs = self.library.encode([w[1:] for w in new], num_threads=1)
            for w, ids in zip(new, theirs, strict=True):
                if len(w) > 1 and struct.pack(f"<{len(ids)}I", *ids) != table[w]:
                    raise ValueError(f"the word {w!r} has other ids in the sentencepiece library")
        get, join = table.__getitem__, b"".join
        out = [join(map(get, cut)) for cut in cuts]
        for w in new:
            if len(w) > self.keep_chars:
                del table[w]
            else:
                self.held += 200
        return out


def codec(model: str) -> MergeCodec:
    return worker_state(("merge", model), lambda: MergeCodec(vocabulary_path(model)))


def encode_decode(docs: DataFrame, model: str = "piece_bpe_32k.model", with_ids: bool = False,
                  check: bool = True) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    ``n_tokens`` counts all ids, begin and end included; the digests are of the ids as little-endian
    unsigned 32-bit integers and of the decoded text in UTF-8. ``with_ids`` adds ``ids`` (binary) and
    ``decoded``. ``check`` compares with the library's ids (see above) and fails on a
    difference. A null or empty text has the begin and end ids alone and decodes to the empty text;
    repeated rows are encoded each; an empty table gives an empty one.
    """
    fields = [StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_tokens", LongType()),
              StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    if with_ids:
        from pyspark.sql.types import BinaryType
        fields += [StructField("ids", BinaryType()), StructField("decoded", StringType())]
    schema = StructType(fields)
    types = [to_arrow_type(f.dataType) for f in fields]
    names = [f.name for f in fields]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        own = codec(model)
        own.checked = check
        head, tail = struct.pack("<I", own.begin), struct.pack("<I", own.end)
        for rows in by_bytes(batches, ("doc_id", "text")):
            texts = [t for _, t in rows]
            ids = own.encode(texts)
            decoded = [own.library.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]
            if check:
                for doc_id, t, d, x in zip((r[0] for r in rows), texts, decoded, ids, strict=True):
                    if d != t and np.array(own.library.encode(t), "<u4").tobytes() != x:
                        raise ValueError(f"document {doc_id}: ids differ from the sentencepiece library's")
            ids = [head + x + tail for x in ids]
            out = [[r[0] for r in rows], [len(x) >> 2 for x in ids], [hashlib.sha256(x).hexdigest() for x in ids],
                   [hashlib.sha256(x.encode()).hexdigest() for x in decoded]]
            if with_ids:
                out += [ids, decoded]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
