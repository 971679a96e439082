"""Token counts, packing and the sentencepiece codec against their libraries."""

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from cohortml.llm import packing, sp_codec, token_counts
from cohortml.llm.bpe import PieceEncoder
from tokenizers import Tokenizer

from .conftest import frame, messy_rows, plain, words

BPE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
SP = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
ODD = list("ab  \n\tthe é▁ß漢字🙂​\x00<s>_-.0123 　\xa0\x1c\x85'") + ["the", "tion", "  ", "   ", "'ll",
                                                                        "<|endoftext|>", "­x", "ｱ"]


def ids_of(text):
    return BPE.encode(text or "", add_special_tokens=False).ids


def pack_ids(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def odd_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_piecewise_ids_equal_the_library():
    own = PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"), table_bytes=20_000, batch_bytes=500)
    texts = odd_texts(1, 6000)
    for i in range(0, len(texts), 100):
        for t, ids in zip(texts[i:i + 100], own.encode(texts[i:i + 100])):
            assert ids == pack_ids(ids_of(t)), t


def test_merges_equal_the_library():
    own = sp_codec.MergeCodec(public_tokenizers.path("piece_bpe_32k.model"), table_bytes=20_000)
    texts = [t.replace("<|endoftext|>", "") for t in odd_texts(2, 6000)] + ["ab" * 400, "é" * 300 + "x" * 90]
    for i in range(0, len(texts), 100):
        for t, ids in zip(texts[i:i + 100], own.encode(texts[i:i + 100])):
            assert ids == pack_ids(SP.encode(t)), t


def test_token_counts(spark, messy, nothing):
    got = sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(messy).collect())
    want = sorted((repr(r[0]), len((r[1] or "").encode()), len(ids_of(r[1])), len(ids_of(r[1])) > 512) for r in messy_rows())
    assert got == want
    assert token_counts.token_counts(nothing).count() == 0


def test_token_counts_sentencepiece(spark, messy):
    got = sorted((repr(r.doc_id), r.n_tokens) for r in token_counts.token_counts(messy, "piece_bpe_32k.model").collect())
    assert got == sorted((repr(r[0]), len(SP.encode(r[1] or ""))) for r in messy_rows())


def test_codec(spark, messy, nothing):
    out = sp_codec.encode_decode(messy, with_ids=True)
    want = []
    for r in messy_rows():
        ids = [SP.bos_id(), *SP.encode(r[1] or ""), SP.eos_id()]
        want.append((repr(r[0]), len(ids), hashlib.sha256(pack_ids(ids)).hexdigest(),
                     hashlib.sha256(SP.decode(ids).encode()).hexdigest(), SP.decode(ids)))
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256, r.decoded) for r in out.collect()) == sorted(want)
    assert sp_codec.encode_decode(nothing).count() == 0


def check_packing(rows, pieces, window=2048):
    """Every id in exactly one piece, windows gapless and full but for powers of two."""
    def key(p):
        return repr(p["doc_id"])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[key(p)].append(p)
        by_sequence[p["sequence_id"]].append(p)
    want = defaultdict(list)
    for r in rows:
        want[repr(r[0])].append(ids_of(r[1]) + [1])
    assert set(by_doc) == set(want)
    for k, texts in want.items():
        if len(texts) > 1:  # repeated ids: all their pieces together
            assert sum(p["length"] for p in by_doc[k]) == sum(map(len, texts))
            continue
        at = 0
        for p in sorted(by_doc[k], key=lambda p: p["start"]):
            part = texts[0][at:at + p["length"]]
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(texts[0]), zlib.crc32(pack_ids(part)))
            at += p["length"]
        assert at == len(texts[0])
    short = []
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        if at != window:
            short.append(at)
    assert all(n & (n - 1) == 0 for n in short) and len(set(short)) == len(short)


@pytest.mark.parametrize("options", [{}, {"buffer_tokens": 4096, "fan_in": 2}, {"window": 64, "fan_in": 3}])
def test_packing_keeps_every_token(spark, messy, options):
    pieces = [r.asDict() for r in packing.pack(messy, **options).collect()]
    check_packing(messy_rows(), pieces, options.get("window", 2048))


def test_packing_of_nothing(nothing):
    assert packing.pack(nothing).count() == 0


def test_windows_meet_their_targets(spark):
    rng = random.Random(3)
    rows = [(i, words(rng, 300), "en", "a" if i % 4 else "b") for i in range(400)]
    df = frame(spark, rows)
    out = packing.pack(df, targets={"a": 0.5, "b": 0.5}, window=512).collect()
    source = {r[0]: r[3] for r in rows}
    per = defaultdict(Counter)
    for p in out:
        per[p.sequence_id][source[p.doc_id]] += p.length
    # source b has a quarter of the tokens: half of the windows have both in equal parts
    even = sum(abs(c["a"] - c["b"]) <= 2 for c in per.values() if sum(c.values()) == 512)
    assert even >= 0.4 * len(per)
    # with the corpus' own shares every full window has them
    per = defaultdict(Counter)
    for p in packing.pack(df, window=512).collect():
        per[p.sequence_id][source[p.doc_id]] += p.length
    total = Counter()
    for c in per.values():
        total += c
    share = total["a"] / (total["a"] + total["b"])
    off = [abs(c["a"] - share * 512) for c in per.values() if sum(c.values()) == 512]
    assert sorted(off)[int(0.8 * len(off))] <= 12


def test_packing_is_the_same_again(spark, messy):
    assert plain(packing.pack(messy)) == plain(packing.pack(messy))


def test_windows_of_one_long_document_take_linear_time():
    import time
    mixer = packing.Mixer({"a": 1.0}, 2048)
    ids = bytes(4 * 20_000_000)
    begin = time.time()
    mixer.add("a", 1, 0, ids, 20_000_000)
    n = 0
    while mixer.total >= 2048:
        n += sum(len(p[3]) >> 2 for p in mixer.fill(2048))
    assert time.time() - begin < 10 and n + mixer.total == 20_000_000


def test_default_targets_are_token_shares(spark):
    rows = [(i, "a " * 300, "en", "dense") for i in range(20)] + [(100 + i, "zqxj" * 150, "en", "sparse") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    shares = packing.mixture(packing.tokenised(df, "byte_bpe_50k.json", 1, "source"))
    counts = {r.doc_id: r.n_tokens + 1 for r in token_counts.token_counts(df).collect()}
    total = sum(counts.values())
    assert abs(shares["dense"] - sum(n for i, n in counts.items() if i < 100) / total) < 1e-12
    assert abs(sum(shares.values()) - 1) < 1e-12


def test_ids_of_any_marks_are_the_library_s():
    """Words that tiktoken merges, words that the library takes, white space of all kinds, special strings."""
    import random
    from cohortml.llm.bpe import PieceEncoder
    from cohortml.llm.common import vocabulary_path
    rng = random.Random(1)
    signs = "abzAZ019,.;!?'\"-_/()[]{}<>@#$%^&*+=~`|\\\u00e9\u00df\u00c0\u024f\u00d7\u00f7\u00f1\u4e2d\U0001f642\n\t  "
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(300))) for _ in range(2000)]
    texts += ["", " ", " a", "a ", "a  b", "x" * 5000, "it's they'll", "a <|endoftext|> b"]
    encoder = PieceEncoder(vocabulary_path("byte_bpe_50k.json"))
    assert encoder.merger is not None
    for i in range(0, len(texts), 300):
        for text, got in zip(texts[i:i + 300], encoder.encode(texts[i:i + 300])):
            assert got == pack_ids(encoder.library.encode(text, add_special_tokens=False).ids)


def test_lists_of_texts_and_the_table_of_words_stay_small():
    """A worker's Python objects: about a megabyte of texts at once, and few words remembered."""
    import inspect

    import pyarrow as pa

    from cohortml.llm.bpe import PieceEncoder, by_bytes
    texts = [None if i % 7 == 0 else "word " * (i % 900) for i in range(2000)]
    batch = pa.record_batch({"doc_id": pa.array(range(2000)), "text": pa.array(texts)})
    lists = list(by_bytes([batch.slice(0, 0), batch, batch.slice(0, 30)], ("doc_id", "text")))
    assert [r for rows in lists for r in rows] == [(i, t or "") for i, t in [*enumerate(texts), *enumerate(texts[:30])]]
    assert max(sum(len(t) for _, t in rows) for rows in lists) < (1 << 20) + 5 * 900
    assert inspect.signature(PieceEncoder).parameters["table_bytes"].default <= 32 << 20
