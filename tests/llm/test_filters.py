"""Quality rules, secrets, pseudonyms and the pipeline."""

import collections
import hashlib
import math
import random
import re

import corpus_pipeline
from cohortml.llm import pii, quality, secret_scan

from .conftest import frame, messy_rows, words

SPACES = "\x20\x09-\x0d"


# ---------------------------------------------------------------- quality
def counts(text):
    text = text or ""
    w = re.findall(f"[^{SPACES}]+", text)
    lines = [x for x in text.split("\n") if re.search(f"[^{SPACES}]", x)]
    windows = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    again = [False] * len(w)
    for i in range(len(w) - 4):
        if windows[tuple(w[i:i + 5])] > 1:
            again[i:i + 5] = [True] * 5
    n, r = len(w), sum(again)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), r,
            n < 10 or 100 * r > 20 * n)


def test_counts(spark, messy, nothing):
    rows = messy_rows() + [(5000, "a b c d e a b c d e a"), (5001, "# <x> 5% a|b $ & *\n\n# <x> 5% a|b $ & *\n #")]
    out = quality.quality(frame(spark, rows)).collect()
    got = sorted((repr(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out)
    assert got == sorted((repr(r[0]), *counts(r[1])) for r in rows)
    assert quality.quality(nothing).count() == 0 and quality.keep_good(nothing).count() == 0


def corpus(rng):
    """Host a: 120 documents with a common line, 10 of them little else; 30 copies and 30 near copies of one text."""
    line = words(rng, 20)
    rows = [(i, words(rng, 60, 5000) + "\n" + line, "en", "a") for i in range(110)]
    rows += [(200 + i, words(rng, 5, 5000) + "\n" + line.upper() + "\n" + line, "en", "a") for i in range(10)]
    text = [words(rng, 30, 5000) for _ in range(4)]
    rows += [(300 + i, "\n".join(text), "en", "a") for i in range(30)]
    rows += [(400 + i, "\n".join(text + [f"edition {i} of this"]), "en", "a") for i in range(30)]
    rows += [(500 + i, words(rng, 30, 5000) + "\n" + line, "en", "b") for i in range(3)]
    return rows, line


def test_frequent_lines_deplete(spark):
    rows, line = corpus(random.Random(1))
    df = frame(spark, rows)
    out = {r.doc_id: r for r in quality.quality(df, least=20, same="sketch").collect()}
    assert sorted(i for i, r in out.items() if not r.kept) == list(range(200, 210))
    assert all(out[i].lost_words == 20 for i in range(110)) and all(out[200 + i].lost_words == 40 for i in range(10))
    # copies of one text don't make its own lines frequent; another host has its own counts
    assert all(out[i].lost_words == 0 for i in [*range(300, 330), *range(400, 430), 500, 501, 502])
    kept = quality.keep_good(df, least=20, same="sketch")
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i in out if not 200 <= i < 210)
    clean = {r.doc_id: r.text for r in quality.remove_lines(df, least=20, same="sketch").collect()}
    for i, t, _, host in rows:
        want = [x for x in t.split("\n") if host == "b" or x.lower() != line.lower()]
        assert clean[i] == "\n".join(want)


def verdicts(rows, share=0.01, least=50):
    """By brute force: doc_id to (lost words, kept, clean text), documents counted by their whole normalised text."""
    def normal(x):
        return " ".join(x.lower().split())

    documents, holders = {}, {}
    for _, t, _, host in rows:
        t = t or ""
        documents.setdefault(host, set()).add(normal(t))
        for x in t.split("\n"):
            if x.split():
                holders.setdefault((host, normal(x)), set()).add(normal(t))
    bad = {k for k, d in holders.items() if len(d) > least and len(d) > share * len(documents[k[0]])}
    out = {}
    for i, t, _, host in rows:
        t = t or ""
        lost = sum(len(x.split()) for x in t.split("\n") if (host, normal(x)) in bad)
        left = len(t.split()) - lost
        kept = not counts(t)[-1] and not (lost and (left < 10 or left < 0.3 * len(t.split())))
        out[i] = (lost, kept, "\n".join(x for x in t.split("\n") if (host, normal(x)) not in bad))
    return out


def test_verdict_equals_brute_force(spark):
    """Near copies are documents of their own, exact copies are not; whatever the case and spacing of a line."""
    rng = random.Random(9)
    rows, line = corpus(random.Random(1))
    rows += [(900 + i, words(rng, 40, 5000) + "\n  " + line.upper().replace(" ", "  "), "en", "c") for i in range(60)]
    rows += [(1000 + i, words(rng, 8) + "\n\n" + line, "en", None) for i in range(60)]
    want = verdicts(rows, least=25)
    df = frame(spark, rows)
    got = {r.doc_id: (r.lost_words, r.kept) for r in quality.quality(df, least=25).collect()}
    assert got == {i: v[:2] for i, v in want.items()}
    assert any(lost for lost, _ in got.values()) and not got[205][1] and not got[1001][1]
    kept = {r.doc_id: (r.text, r.n_chars) for r in quality.clean(df, least=25).collect()}
    assert kept == {i: (t, len(t)) for i, (_, k, t) in want.items() if k}
    everything = quality.remove_lines(df, least=25)
    assert everything.columns == df.columns and {r.doc_id: r.text for r in everything.collect()} == {i: t for i, (_, _, t) in want.items()}


def test_boilerplate_pages_are_distinct_documents(spark):
    """100 pages of 95 % boilerplate at the production limits; merged copies unite their lines."""
    rng = random.Random(2)
    shared = [words(rng, 19, 5000) for _ in range(10)]
    rows = [(i, "\n".join([*shared, words(rng, 10, 5000)]), "en", "a") for i in range(100)]
    rows += [(1000 + i, words(rng, 60, 5000), "en", "a") for i in range(50)]
    out = {r.doc_id: r for r in quality.quality(frame(spark, rows)).collect()}
    assert all(out[i].lost_words == 190 and not out[i].kept for i in range(100))
    assert all(out[1000 + i].lost_words == 0 and out[1000 + i].kept for i in range(50))
    # the same windows in other lines: one document, with the lines of both
    text = words(rng, 40, 5000).split()
    both = [(1, " ".join(text), "en", "b"), (2, " ".join(text[:20]) + "\n" + " ".join(text[20:]), "en", "b")]
    found = quality.features(frame(spark, both), same="sketch")
    assert [r.n_docs for r in quality.frequent_lines(found, 0.01, 0).collect()] == [1, 1, 1]


def test_rows_with_null_host_and_id(spark, messy):
    kept = quality.keep_good(messy).collect()
    want = [r for r in messy_rows() if not counts(r[1])[-1]]
    assert sorted(repr((r.doc_id, r.text)) for r in kept) == sorted(repr((r[0], r[1])) for r in want)


# ---------------------------------------------------------------- secrets
def spans(text):
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group(0)) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group(0)) >= 24]
    base = sorted(out)
    for m in re.finditer(secret_scan.CANDIDATE, text):
        s = m.group(0)
        if re.fullmatch("[0-9]+", s) or re.fullmatch("[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", s):
            continue
        plain = re.sub("(?i)example|placeholder|changeme|your", lambda x: "=" * len(x.group()), s)
        free = [False] * len(s)
        for part in re.finditer("[A-Za-z0-9]+", plain):
            if not re.fullmatch("[A-Za-z]{1,15}|[0-9]{1,4}", part.group()):
                free[part.start():part.end()] = [True] * len(part.group())
        least = 2.9 if re.fullmatch("[0-9a-fA-F]+", s) else 3.6 if re.search("[0-9]", s) else 3.85
        bits = [math.log2(20) - sum(c * math.log2(c) for c in collections.Counter(s[i:i + 20]).values()) / 20
                for i in range(len(s) - 19) if sum(free[i:i + 20]) >= 10]
        if bits and max(bits) >= least - 1e-6:
            out.append((m.start(), 3, m.end()))
    return base, sorted(out)


def joined(found):
    return ",".join(f"{secret_scan.KIND_NAMES[k]}:{i}:{j}" for i, k, j in found)


def secret_rows():
    rng = random.Random(3)
    parts = ["password", "token", "API_KEY", "api-key", "=", ":", " ", "'", '"', "é", "🙂", "\n", "abcdef0123456789abcdef01",
             "AKIA", "ABCD1234EFGH5678", "x", "-", "/", "Zq9+Kd83hs8sJs0apQm2", "a" * 23, "some-path/of-words-2024/and",
             "0123456789012345678901", "PASSWD", "secret", "deadbeefdeadbeefdeadbeef"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(14)))) for i in range(1500)]
    return rows + [(9000, None), (9001, ""), (9002, "x" * 5000 + "".join(rng.choice("abcdef0123456789") for _ in range(3000)))]


def test_the_allow_list_covers_places_not_runs(spark):
    rng = random.Random(12)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    key = "".join(rng.choice(letters + "0123456789") for _ in range(36))
    secrets = ["".join(rng.choice(letters) for _ in range(40)), f"example-app/ghp_{key}", f"your_{key}", f"/home/example/{key}/x"]
    harmless = ["how-to-cook-the-best-pasta-in-italy-2024-01-01", "/usr/local/lib/python/site-packages/example",
                "YOUR_API_KEY_PLACEHOLDER_EXAMPLE", "123e4567-e89b-12d3-a456-426614174000", "Rechtsschutzversicherungsgesellschaften"]
    got = {r.doc_id: r.spans for r in secret_scan.secret_spans(frame(spark, list(enumerate(secrets + harmless)))).collect()}
    assert [bool(got[i]) for i in range(len(got))] == [True] * len(secrets) + [False] * len(harmless)


def test_very_long_candidates(spark):
    """Slugs of 100,000 parts, encoded images of 1 MB and many spans: no crash, and time in proportion."""
    import base64
    import time
    rng = random.Random(3)
    key = "AKIA" + "A" * 16
    texts = ["-".join(["ab"] * 100_000), base64.b64encode(rng.randbytes(750_000)).decode(), "\u00e9 ".join([key] * 10_000)]
    secret_scan.secret_spans(frame(spark, [(0, texts[2][:1000])])).collect()
    for text, n in zip(texts, (0, 1, 10_000)):
        begin = time.time()
        spans = secret_scan.secret_spans(frame(spark, [(1, text)])).first()["spans"]
        clean = secret_scan.redact(frame(spark, [(1, text)])).first()["text"]
        assert time.time() - begin < 20
        assert len([x for x in spans.split(",") if x]) == n
        assert clean == text if n == 0 else clean.count("[SECRET]") == n
    assert clean == "\u00e9 ".join(["[SECRET]"] * 10_000)


def test_secret_spans(spark, nothing):
    rows = secret_rows()
    got = {r.doc_id: r for r in secret_scan.secret_spans(frame(spark, rows)).collect()}
    for i, t in rows:
        base, every = spans(t or "")
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in base) for x in range(3)), t
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest() and r.spans == joined(every), t
    assert secret_scan.secret_spans(nothing).count() == 0


def test_redact(spark, messy):
    rows = secret_rows()
    got = {r.doc_id: r.text for r in secret_scan.redact(frame(spark, rows)).collect()}
    for i, t in rows:
        if t is None:
            assert got[i] is None
            continue
        out, at = "", 0
        for a, _, b in spans(t)[1]:
            if b > at:
                out += t[at:a] + "[SECRET]" if a >= at else ""
                at = b
        assert got[i] == out + t[at:]
    assert secret_scan.redact(messy).columns == messy.columns


# ---------------------------------------------------------------- pseudonyms
def test_feistel_permutes_every_range():
    f = pii.Feistel(b"key")
    for n in (1, 2, 3, 10, 97, 1000):
        image = [f.forward("k", n, i) for i in range(n)]
        assert sorted(image) == list(range(n)) and [f.backward("k", n, x) for x in image] == list(range(n))
    assert [f.forward("k", 1000, i) for i in range(9)] != [pii.Feistel(b"other").forward("k", 1000, i) for i in range(9)]


TEXT = ("Call +1 (269) 555-3296 4524132264652876 or 4524-1322-6465-2876, born 1987-02-28 / 28.02.1987 / 02/28/1987, "
        "ssn 123-45-6789 bad 000-12-3456, ip 10.0.0.255 not 1.2.3.999 v1.2.3.4.5, iban DE89 3704 0044 0532 0130 00 "
        "DE89370400440532013000 mail Jo.hn+x9@Example.com 2023-02-30 and 4524132264652877")


def test_findings_stay_valid_and_linked():
    f = pii.Feistel(b"key")
    found = pii.find(TEXT, f.forward)
    assert [k for _, _, k, _ in found] == ["phone", "card", "card", "date", "date", "date", "ssn", "address", "iban", "iban", "email"]
    new = pii.substitute(TEXT, found)
    again = pii.find(new, f.backward)
    assert [k for _, _, k, _ in again] == [k for _, _, k, _ in found] and pii.substitute(new, again) == TEXT
    by = collections.defaultdict(set)
    for _, _, k, value in found:
        by[k].add(re.sub(r"[ -]", "", value))
    assert len(by["card"]) == len(by["iban"]) == 1
    dates = [v for _, _, k, v in found if k == "date"]
    y, m, d = dates[0].split("-")
    assert dates[1:] == [f"{d}.{m}.{y}", f"{m}/{d}/{y}"]
    for i, j, _, value in found:
        assert TEXT[i:j] not in new.replace("bad 000-12-3456", "") and len(value) >= 7


def test_spellings_of_one_value_are_linked():
    f = pii.Feistel(b"key")

    def check(kind, spellings, value):
        got = []
        for s in spellings:
            text = f"at {s}, then"
            found = pii.find(text, f.forward)
            assert [(i, j, k) for i, j, k, _ in found] == [(3, 3 + len(s), kind)], s
            new = pii.substitute(text, found)
            assert re.sub("[0-9]", "", new) == re.sub("[0-9]", "", text) or kind == "date"
            assert pii.substitute(new, pii.find(new, f.backward)) == text
            got.append(value(found[0][3]))
        assert len(set(got)) == 1 and value(spellings[0]) not in got, got
        return got[0]

    for n in range(20):
        a, b, c = f"{200 + 37 * n}", f"{n * 53 % 1000:03d}", f"{n * 677 % 10000:04d}"
        number = check("phone", [f"+1 {a} {b} {c}", f"+1{a}{b}{c}", f"+1 ({a}) {b}-{c}", f"+1-{a}-{b}-{c}", f"+1.{a}.{b}.{c}",
                                 f"+1 {a}{b}{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}"],
                       lambda s: re.sub("[^0-9]", "", s)[-10:])
        assert number[0] != "0"
        for code in ("44", "353"):
            check("phone", [f"+{code} {a} {b} {c}", f"+{code}{a}{b}{c}", f"+{code}-{a}-{b}-{c}", f"+{code} (0){a} {b} {c}",
                            f"+{code} ({a}) {b}{c}", f"+{code} {a}{b}{c}"],
                  lambda s: re.sub("[^0-9]", "", s.replace("(0)", "")))
    check("phone", ["+1 555 123 4567", "+15551234567"], lambda s: re.sub("[^0-9]", "", s))

    def day(s):
        p = [int(x) for x in re.split("[-/.]", s)]
        return p if len(str(p[0])) == 4 else p[::-1]
    for y, m, d in ((1987, 7, 3), (2003, 11, 9), (1960, 2, 11), (1999, 12, 12)):
        check("date", [f"{d}/{m}/{y}", f"{d:02d}/{m:02d}/{y}", f"{d}.{m}.{y}", f"{d:02d}.{m}.{y}", f"{d}-{m:02d}-{y}", f"{y}-{m}-{d}",
                       f"{y}-{m:02d}-{d:02d}"], lambda s: tuple(day(s)))
    check("date", ["2/28/1987", "02/28/1987"], lambda s: tuple(map(int, s.split("/"))))


def test_pseudonymise_round_trip(spark, messy, nothing):
    rng = random.Random(8)
    rows = messy_rows() + [(7000 + i, f"{words(rng, 3)} {rng.randrange(256)}.{rng.randrange(256)}.7.9 and "
                                      f"{rng.randrange(10, 29)}/{rng.randrange(1, 13):02d}/19{rng.randrange(10, 99)}") for i in range(50)]
    df = frame(spark, rows)
    there = pii.pseudonymise(df, "secret")
    back = pii.pseudonymise(there.select("doc_id", "text"), "secret", undo=True)
    assert sorted(repr((r.doc_id, r.text)) for r in back.collect()) == sorted(repr((r[0], r[1])) for r in rows)
    changed = there.where("n_found > 0").collect()
    assert len(changed) == 51 and all("." in r.spans or ":" in r.spans for r in changed)
    assert pii.pseudonymise(nothing, "secret").count() == 0


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(6)
    text = words(rng, 200, 3000)
    near = text.split()
    near[100] = "changed"
    rows = [(i, words(rng, 80, 3000), "en", f"s{i % 3}") for i in range(40)]
    rows += [(100, text, "en", "s0"), (101, text.replace(" ", "  "), "en", "s1"), (102, text + " \n", "en", "s1"), (103, text, "de", "s2")]
    rows += [(104, "password=abc123def456 " + words(rng, 50, 3000), "en", "s0"), (105, "too short", "en", "s0"), (106, None, "en", "s1"),
             (107, "a b c d e f g h i j " * 9, "en", "s0")]
    docs = frame(spark, rows)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "mixture_packing":
            assert out.columns == docs.columns
            out.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
            sizes.append((name, {r.doc_id for r in docs.collect()}))
    got = dict(sizes)
    assert got["quality_rules"] == {r[0] for r in rows} - {105, 106, 107}
    assert got["exact_dedup"] == got["quality_rules"] - {101, 102, 103} | ({102} if text + " " != text else set())
    assert got["simhash_near_dedup"] == got["exact_dedup"] - {102} and got["secret_scan"] == got["simhash_near_dedup"]
    assert "abc123def456" not in {r.doc_id: r.text for r in docs.collect()}[104]
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {p.doc_id for p in pieces} == got["secret_scan"]
    by = collections.Counter()
    for p in pieces:
        by[p.doc_id] += p.length
    assert all(by[p.doc_id] == p.doc_tokens for p in pieces)


def test_pipeline_of_nothing(spark, nothing, tmp_path):
    nothing.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
