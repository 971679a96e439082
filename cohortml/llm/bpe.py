"""Byte-level BPE ids of many texts inside one Python worker.

A text is cut at safe boundaries: before a single space that is followed by something that is not
white space. The pre-tokenizer always starts a new piece there (every pattern either holds no white
space, or one leading space, or white space alone), so the ids of a text are the ids of its pieces,
one after the other. Distinct pieces of a batch go to the library in calls of bounded
bytes, and a bounded table per worker process remembers the short ones, which recur most. Where the argument does not hold (another
pre-tokenizer, a normaliser, or a special string inside the text) the tokenizers library gets the whole text.

New words of plain letters, digits and marks are merged by tiktoken, which is several times faster. It merges any
two neighbours whose bytes are a token, by the smaller id; that is the same as merging by the list if ids rise
along the list and every token's own bytes merge to it, since inside the bytes of a token nothing else can have merged.
Both are checked on the vocabulary once per worker; the words' alphabet is one on which the pattern's classes
are plain ranges.
"""

from __future__ import annotations

import json
import os
import re
import struct

from cohortml.llm.common import vocabulary_path, worker_state

#: A space that is not a safe boundary; Python's white space includes the tokenizer's.
_ODD = re.compile(r" (?!\S)")
_CUT = re.compile(r" (?=\S)")
#: Words that tiktoken may take, and how the byte-level pattern cuts them: letters, digits, other marks.
_LETTER, _MARK = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"!-&(-/:-@\[-`{-~"
_PLAIN = re.compile(f"[{_LETTER}0-9{_MARK}]{{1,100}}")
_PIECES = f" ?[{_LETTER}]+| ?[0-9]+| ?[{_MARK}]+"


def merger(library, conf):
    """A tiktoken encoding equal to the library on plain words, or None where that is not certain."""
    model = conf["model"]
    if (model.get("type") != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix")
            or model.get("end_of_word_suffix") or model.get("byte_fallback") or model.get("ignore_merges")):
        return None
    vocabulary = model["vocab"]
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if any(i >= j for i, j in zip(merged, merged[1:])) or any(len(library.model.tokenize(t)) != 1 for t in vocabulary):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    if len(byte) > len(vocabulary) or any(c not in byte for t in vocabulary for c in t) or any(c not in vocabulary for c in byte):
        return None
    import tiktoken
    return tiktoken.Encoding("plain words", pat_str=_PIECES, special_tokens={},
                             mergeable_ranks={bytes(byte[c] for c in t): i for t, i in vocabulary.items()})


class PieceEncoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, table_bytes: int = 32 << 20, batch_bytes: int = 1 << 20,
                 keep_chars: int = 40):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        conf = json.loads(self.library.to_str())
        pre = conf.get("pre_tokenizer") or {}
        self.cuttable = (conf.get("normalizer") is None and pre.get("type") == "ByteLevel"
                         and pre.get("use_regex", True) and not pre.get("add_prefix_space"))
        import numpy as np
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True  # the byte of a space
        self.merger = merger(self.library, conf) if self.cuttable else None
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.table_bytes, self.batch_bytes, self.keep_chars = table_bytes, batch_bytes, keep_chars
        self._forget()

    def _forget(self):
        self.heads, self.rest, self.held = {}, {}, 0

    def _batches(self, strings):
        """The strings in lists of about ``batch_bytes`` characters."""
        batch, size = [], 0
        for s in strings:
            batch.append(s)
            size += len(s)
            if size >= self.batch_bytes:
                yield batch
                batch, size = [], 0
        if batch:
            yield batch

    def _each(self, strings):
        """Ids of each string by itself."""
        for batch in self._batches(strings):
            for e in self.library.encode_batch_fast(batch, add_special_tokens=False):
                ids = e.ids
                yield struct.pack(f"<{len(ids)}I", *ids)

    def _words(self, words, encode=None):
        """Ids of each `` word``: one call for many, cut again where a token begins with a space."""
        import numpy as np
        encode = encode or (lambda line: self.library.encode_batch_fast([line], add_special_tokens=False)[0].ids)
        for batch in self._batches(words):
            raw = np.array(encode(" " + " ".join(batch)), dtype="<u4")
            cut = np.flatnonzero(self.opens[raw])
            if len(cut) != len(batch):
                yield from self._each(" " + w for w in batch)
                continue
            cut, raw = (cut * 4).tolist(), raw.tobytes()
            cut.append(len(raw))
            for i, j in zip(cut, cut[1:]):
                yield raw[i:j]

    def _learn(self, table, pieces, words: bool):
        """Fill the table with the pieces that it lacks; the long ones among them come back."""
        new = list(pieces.difference(table))
        even, plain, odd = [], [], []
        for p in new:
            (odd if not words or not p or " " in p else even if self.merger and _PLAIN.fullmatch(p) else plain).append(p)
        table.update(zip(even, self._words(even, self.merger and self.merger.encode_ordinary), strict=True))
        table.update(zip(plain, self._words(plain), strict=True))
        table.update(zip(odd, self._each((" " if words else "") + p for p in odd), strict=True))
        long = [p for p in new if len(p) > self.keep_chars]
        self.held += 200 * (len(new) - len(long))
        return long

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.held > self.table_bytes:
            self._forget()
        cuts, heads, rest, whole = [], set(), set(), []
        for t in texts:
            if not self.cuttable or any(s in t for s in self.special):
                cuts.append(None)
                whole.append(t)
                continue
            p = t.split(" ") if _ODD.search(t) is None else _CUT.split(t)
            head, p = p[0], p[1:]
            heads.add(head)
            rest.update(p)
            cuts.append((head, p))
        passing = [(self.heads, self._learn(self.heads, heads, False)), (self.rest, self._learn(self.rest, rest, True))]
        direct = self._each(whole)
        get, join = self.rest.__getitem__, b"".join
        out = [next(direct) if c is None else self.heads[c[0]] + join(map(get, c[1])) for c in cuts]
        for table, long in passing:
            for p in long:
                del table[p]
        return out


def encoder(tokenizer: str) -> PieceEncoder:
    """The worker's encoder for a vocabulary file."""
    return worker_state(("bpe", tokenizer), lambda: PieceEncoder(vocabulary_path(tokenizer)))


def by_bytes(batches, columns, most: int = 1 << 20):
    """Rows of Arrow batches in lists of about ``most`` bytes of the last column, a text (null: empty)."""
    import numpy as np
    import pyarrow.compute as pc
    rows, size = [], 0
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(columns[-1])), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, passed = 0, 0
        while at < b.num_rows:
            # the row that reaches ``most`` ends a list; only its rows become Python objects
            end = min(int(np.searchsorted(ends, passed + most - size)) + 1, b.num_rows)
            part = b.slice(at, end - at)
            rows += [(*row[:-1], row[-1] or "") for row in zip(*[part.column(c).to_pylist() for c in columns], strict=True)]
            size += int(ends[end - 1]) - passed
            at, passed = end, int(ends[end - 1])
            if size >= most:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows
