"""Exact copies, SimHash classes, repeated lines and passages against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from cohortml.llm import common, exact_dedup, line_dedup, passages, simhash

from .conftest import frame, messy_rows, plain, words

WORDS = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def smallest(ids):
    return min((i for i in ids if i is not None), default=None)


# ---------------------------------------------------------------- exact copies
def test_exact_dedup(spark, messy, nothing):
    groups = defaultdict(list)
    for r in messy_rows():
        groups[re.sub("[\x20\x09-\x0d]+", " ", r[1] or "")].append(r[0])
    want = sorted((repr(i), repr(smallest(ids)), len(ids), hashlib.sha256(t.encode()).hexdigest())
                  for t, ids in groups.items() for i in ids)
    out = exact_dedup.exact_dedup(messy).collect()
    assert sorted((repr(r.doc_id), repr(r.keep_id), r.group_size, r.text_sha256) for r in out) == want
    kept = Counter(r.text_sha256 for r in out if r.kept)
    assert len(kept) == len(groups) and set(kept.values()) == {1}
    assert all(repr(r.doc_id) == repr(r.keep_id) for r in out if r.kept)
    assert exact_dedup.exact_dedup(nothing).count() == 0


@pytest.mark.parametrize("bits, rounds", [(1, 4), (2, 2), (3, 1)])
def test_merge_tree_shapes_agree(spark, messy, bits, rounds):
    rows = exact_dedup.digests(messy)
    want = plain(exact_dedup.merge_runs(rows))
    assert plain(exact_dedup.merge_runs(rows, bits, rounds)) == want


def test_equal_digests_of_other_texts_are_not_merged(spark):
    rows = spark.createDataFrame([(1, 0, bytearray(b"\1" * 32), 5, 9), (2, 1, bytearray(b"\1" * 32), 5, 8),
                                  (3, 2, bytearray(b"\1" * 32), 5, 9)],
                                 "doc_id long, tag long, digest binary, size int, check long")
    out = exact_dedup.merge_runs(rows).collect()
    assert sorted((r.low.doc_id, r.n) for r in out) == [(1, 2), (2, 1)]


def test_drop_exact_copies_keeps_columns(spark, messy, nothing):
    out = exact_dedup.drop_exact_copies(messy)
    assert out.columns == messy.columns
    texts = [re.sub("[\x20\x09-\x0d]+", " ", r.text or "") for r in out.collect()]
    assert len(texts) == len(set(texts)) == exact_dedup.exact_dedup(messy).where("kept").count()
    assert exact_dedup.drop_exact_copies(nothing).count() == 0


# ---------------------------------------------------------------- SimHash
def fingerprint(text):
    w = WORDS.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, links):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        label[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def test_simhash_dedup(spark, messy, nothing):
    rows = messy_rows()
    fps = np.array([fingerprint(r[1]) for r in rows], np.uint64)
    label = components(len(rows), [(i, int(j)) for i in range(len(rows))
                                   for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3)])
    ids = defaultdict(list)
    for r, c in zip(rows, label):
        ids[c].append(r[0])
    want = sorted((repr(r[0]), f"{int(f):016x}", repr(smallest(ids[c]))) for r, f, c in zip(rows, fps, label))
    got = simhash.simhash_dedup(messy).collect()
    assert sorted((repr(r.doc_id), r.fingerprint, repr(r.component_id)) for r in got) == want
    kept = simhash.drop_near_copies(messy)
    assert kept.columns == messy.columns and kept.count() == len(set(label))
    assert simhash.simhash_dedup(nothing).count() == 0 and simhash.drop_near_copies(nothing).count() == 0


@pytest.mark.parametrize("options", [{}, {"blocks": 5}, {"blocks": 6, "shard_nodes": 7}, {"shard_nodes": 5}])
def test_near_links_connect_all_close_fingerprints(spark, options):
    rng = random.Random(11)
    centres = [rng.getrandbits(64) for _ in range(5)]
    fps = {rng.getrandbits(64) for _ in range(200)}
    for c in centres:  # dense clusters, and chains
        for _ in range(60):
            x = c
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    arr = np.array(fps, np.uint64)
    label = components(len(fps), [(i, int(j)) for i in range(len(fps))
                                  for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= 3)])
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    place = {f: i for i, f in enumerate(signed)}
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = [(place[r.a], place[r.b]) for r in simhash.near_links(df, 3, **options).collect()]
    assert all(bin(fps[a] ^ fps[b]).count("1") <= 18 for a, b in links)
    assert components(len(fps), links) == label


def test_bk_tree_edges_carry_distances():
    rng = random.Random(2)
    fp = np.array(sorted({rng.getrandbits(64) for _ in range(300)}), np.uint64)
    group = np.arange(len(fp)) // 100
    roots, code, child = simhash.plant(fp, group)
    assert roots.tolist() == [0, 100, 200] and sorted([*roots.tolist(), *child.tolist()]) == list(range(len(fp)))
    for c, k in zip(code.tolist(), child.tolist()):
        assert int(np.bitwise_count(fp[c // 65] ^ fp[k])) == c % 65
    assert len(set(code.tolist())) == len(code)  # one child per distance


def test_components_of_a_long_chain(spark):
    rng = random.Random(4)
    order = list(range(300))
    rng.shuffle(order)
    links = list(zip(order, order[1:])) + [(1000, 1001), (1001, 1002), (2000, 2000)]
    got = dict(common.connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(300), 0), **dict.fromkeys((1000, 1001, 1002), 1000)}


# ---------------------------------------------------------------- lines
def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def repeated_lines(rows):
    """Per row place: lines with a word and the places of repeats (rows of one id in the given order)."""
    occurrences, norms = defaultdict(list), []
    for n, (doc_id, text) in enumerate(rows):
        for i, line in enumerate((text or "").split("\n")):
            w = WORDS.findall(line)
            if w:
                key = " ".join(w).lower()
                occurrences[key].append(((doc_id is None, doc_id or 0), n, i))
                norms.append((n, i, key))
    keys = list(occurrences)
    sims = []
    for k in keys:
        hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in k.split(" ")]
        sims.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    arr, links = np.array(sims, np.uint64), []
    for i in range(len(keys)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= 3) + i + 1:
            most = max(len(keys[i]), len(keys[j]))
            if abs(len(keys[i]) - len(keys[j])) <= 0.2 * most and levenshtein(keys[i], keys[j]) <= int(0.2 * most + 1e-9):
                links.append((i, int(j)))
    group = dict(zip(keys, components(len(keys), links)))
    first = {}
    for k, places in occurrences.items():
        first[group[k]] = min([*places, *([first[group[k]]] if group[k] in first else [])])
    out = {}
    for n, i, k in norms:
        lines, gone = out.setdefault(n, [0, []])
        out[n][0] += 1
        if first[group[k]][1:] != (n, i):
            gone.append(i)
    return {rows[n][0]: (k, gone) for n, (k, gone) in out.items()}


def test_line_dedup(spark, nothing):
    rng = random.Random(5)
    base = [" ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(40)) for _ in range(6)]
    rows = [(900, None), (901, ""), (902, " \n\t\n"), (903, "One two\nONE  two\n\none two.")]
    for d in range(120):
        lines = []
        for _ in range(rng.randrange(4)):
            w = rng.choice(base).split(" ")
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = f"zz{rng.randrange(30)}"
            lines.append(" ".join(w))
        rows.append((d, "\n".join(lines)))
    df = frame(spark, rows)
    want = repeated_lines(rows)
    got = {r.doc_id: (r.n_lines, list(r.removed)) for r in line_dedup.line_dedup(df).collect()}
    assert got == want and sum(len(g) for _, g in want.values()) > 100
    texts = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(df).collect()}
    for d, t in rows:
        gone = set(want.get(d, (0, []))[1])
        assert texts[d] == (None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone))
    assert line_dedup.line_dedup(nothing).count() == 0


def test_line_dedup_recall_against_edit_similarity(spark, tmp_path):
    """The registered query on pairs of edit similarity 0.8 and up, by words to a line and kind of change."""
    from cohortml.llm.queries import QUERIES
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9)))
    vocabulary = [word() for _ in range(2000)]
    rows, pairs = [], []
    for n in (5, 10, 15, 20, 30, 40, 60):
        for kind in ("one word", "tenth of words", "typos"):
            made = 0
            while made < 40:
                w = [rng.choice(vocabulary) for _ in range(n)]
                v = list(w)
                if kind == "typos":
                    for _ in range(max(1, n // 10)):
                        i = rng.randrange(n)
                        v[i] = v[i][:1] + rng.choice("xyz") + v[i][2:]
                else:
                    for i in rng.sample(range(n), 1 if kind == "one word" else max(1, n // 10)):
                        v[i] = word()
                x, y = " ".join(w), " ".join(v)
                # a tenth of the words of a longer line is always less than a fifth of its letters
                if x != y and (n > 10 or levenshtein(x, y) <= 0.2 * max(len(x), len(y))):
                    rows.append((len(rows), x + "\n" + y))
                    pairs.append((n, kind))
                    made += 1
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.n_removed for r in QUERIES["op5_fuzzy_lines"](spark, str(tmp_path)).collect()}
    assert set(got) == set(range(len(rows))) and max(got.values()) <= 1
    recall = defaultdict(float)
    for i, p in enumerate(pairs):
        recall[p] += got[i] / 40
    print(dict(recall))
    assert min(recall.values()) >= 0.9 and sum(recall.values()) / len(recall) >= 0.98, dict(recall)


def test_unlike_lines_with_the_same_short_words_do_not_meet(spark, nothing, monkeypatch):
    rng = random.Random(13)
    short = ["the", "of", "to", "in", "that", "is", "it", "and", "with", "for", "on", "as"]
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(5, 11)))
    lines = [" ".join(rng.choice(short) if rng.random() < 0.5 else word() for _ in range(60)) for _ in range(400)]
    near = [" ".join([*x.split(" ")[:-1], word()]) for x in lines[:40]]
    compared, verified = [], line_dedup._verified

    def counted(pairs, *rest):
        compared.append(pairs.distinct().count())
        return verified(pairs, *rest)

    monkeypatch.setattr(line_dedup, "_verified", counted)
    df = frame(spark, list(enumerate(lines + near)))
    got = {r.doc_id: r.n_removed for r in line_dedup.line_dedup(df, radius=24, bands=24).collect()}
    assert {d for d, n in got.items() if n} == set(range(400, 440))
    assert sum(compared) < 200, compared


def test_line_dedup_of_messy_rows(messy):
    out = line_dedup.line_dedup(messy).collect()
    assert len(out) == sum(bool(WORDS.search(r[1] or "")) for r in messy_rows())
    kept = line_dedup.drop_repeated_lines(messy)
    assert kept.columns == messy.columns and kept.count() == len(messy_rows())


# ---------------------------------------------------------------- passages
def cut(rows, window=35):
    texts = [WORDS.findall(r[1] or "") for r in rows]
    seen = Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for r, w in zip(rows, texts):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((repr(r[0]), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 3000}, {"window": 10, "phrase": 3, "block_bytes": 20_000},
                                     {"window": 5, "phrase": 5}, {"window": 4, "phrase": 1, "block_bytes": 5000}])
def test_cut_repeats(spark, messy, options):
    out = passages.cut_repeats(messy, **options).collect()
    assert sorted((repr(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in out) == cut(messy_rows(), options.get("window", 35))


def test_cut_repeats_within_and_across_documents(spark, nothing):
    rng = random.Random(9)
    passage = words(rng, 60, 90).split()
    rows = []
    for i in range(80):
        w = words(rng, rng.randrange(120), 90).split()
        at, a = rng.randrange(len(w) + 1), rng.randrange(30)
        w[at:at] = passage[a:a + rng.randrange(60)]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(w)))
    rows += [(100, words(random.Random(1), 40) + " x " + words(random.Random(1), 40)), (101, "a " * 36), (102, "b " * 35)]
    out = passages.cut_repeats(frame(spark, rows), block_bytes=2000, with_text=True).collect()
    assert sorted((repr(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in out) == cut(rows)
    for r in out:
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
        assert sum(b - a for a, b in r.removed) == r.n_removed
    assert passages.cut_repeats(nothing).count() == 0
