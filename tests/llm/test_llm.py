"""The training-data operators against brute force, round trips, held-out data and awkward inputs."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from kindred.llm import decontaminate, hmm, licenses, pieces, pii, quality, queries, secrets, simhash, toxicity, warc

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


LONG = "lorem ipsum dolor sit amet " * 6000 + "x" * 5000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows and columns whose names clash with inner ones."""
    rows = [(1, "", "en", None, "a", 1), (2, None, None, "s", "b", 2), (None, "to be or not to be", "en", "s", "c", 3), (4, LONG, "en", "s", "d", 4), (4, LONG, "en", "s", "d", 4), (5, "é ñ ▁x \t\n 日本", "fr", "s", "e", 5), (6, "to be or not to be", "en", "t", "f", 6)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row string, n int")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(6, 1, 0), (4, 0, 1), (None, None, None), (6, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


# ------------------------------------------------------------------ 1


def test_hmm_base_and_gain(spark, texts):
    got = {r["doc_id"]: r for r in queries.op1_hmm_scoring(spark, SF).collect()}
    tokens = {i: [*WORD.findall(low(t)), "\n"] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_hmm_recursions_against_enumeration():
    draw = np.random.default_rng(1)
    first, trans, emit = (x / x.sum(-1, keepdims=True) for x in (draw.random(3), draw.random((3, 3)), draw.random((3, 5))))
    seqs = [draw.integers(0, 5, n) for n in (4, 1, 6, 2)]

    def brute(seq):
        import itertools

        total, begin, moves, emitted = 0.0, np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
        for path in itertools.product(range(3), repeat=len(seq)):
            p = first[path[0]] * np.prod([trans[a, b] for a, b in zip(path, path[1:])]) * np.prod([emit[s, o] for s, o in zip(path, seq)])
            total += p
            begin[path[0]] += p
            for a, b in zip(path, path[1:]):
                moves[a, b] += p
            for s, o in zip(path, seq):
                emitted[s, o] += p
        return total, begin / total, moves / total, emitted / total

    want = [brute(s) for s in seqs]
    block = hmm.Block(seqs)
    logs = hmm.forward(block, first, trans, emit, False)[0]
    assert np.allclose(logs, [math.log10(want[i][0]) for i in block.order])
    for a, b in zip(hmm.expect(block, first, trans, emit), (sum(w[k] for w in want) for k in (1, 2, 3))):
        assert np.allclose(a, b)
    long = draw.integers(0, 5, 1000)
    old, hmm.BUFFER = hmm.BUFFER, 64
    parts = hmm.log10_likelihood(long, first, trans, emit)
    hmm.BUFFER = old
    assert math.isclose(parts, hmm.forward(hmm.Block([long]), first, trans, emit, False)[0][0])


def test_hmm_odd(odd, none):
    rows = hmm.WordHMM(rounds=1).fit_score(odd).collect()
    assert len(rows) == 7 and all(math.isfinite(r["score"]) for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert hmm.WordHMM(rounds=1).fit_score(none).count() == 0


# ------------------------------------------------------------------ 2


def test_quality_base(spark, texts):
    for r in queries.op2_quality_rules(spark, SF).collect():
        t = texts[r["doc_id"]] or ""
        ws = WORD.findall(t)
        wins = Counter(zip(ws, ws[1:], ws[2:]))
        marks = {i + d for i, w in enumerate(zip(ws, ws[1:], ws[2:])) if wins[w] > 1 for d in range(3)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            dup += bool(WORD.search(line)) and line in seen
            seen.add(line)
        failed = len(ws) < 50 or 100 * len(marks) > 50 * len(ws)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(marks), failed)
        assert not (r["kept"] and failed)


def test_quality_ratio(spark, texts):
    """llr and kept from two plain counts over all documents and the trusted ones."""
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}

    def grams(text):
        one = [zlib.crc32(t.encode()) for t in quality.TOKEN.findall((text or "").lower())]
        two = [((a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F) % 2**64) >> 32 for a, b in zip(one, one[1:])]
        return [g % quality.BUCKETS for g in one + two]

    raw, trusted = Counter(), Counter()
    for i, t in texts.items():
        raw.update(grams(t))
        if i in good:
            trusted.update(grams(t))
    n, m = sum(raw.values()) + quality.BUCKETS, sum(trusted.values()) + quality.BUCKETS
    assert good and m > quality.BUCKETS
    for r in queries.op2_quality_rules(spark, SF).collect():
        g = grams(texts[r["doc_id"]])
        want = sum(math.log((trusted[x] + 1) / m) - math.log((raw[x] + 1) / n) for x in g) / max(len(g), 1)
        assert math.isclose(r["llr"], want, abs_tol=1e-9)
        assert r["kept"] == (not r["base_failed"] and r["llr"] >= quality.THRESHOLD)


def test_quality_separates_labels(spark):
    sf = "/root/testdata/sf0.01"
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op2_quality_rules(spark, sf).collect() if r["doc_id"] in marks and not r["base_failed"]]
    good, bad = ([r["kept"] for r in rows if marks[r["doc_id"]] == q] for q in (1, 0))
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_quality_odd(odd, none, labels, no_labels):
    rows = quality.judge_documents(odd, labels).collect()
    assert len(rows) == 7 and not any(r["kept"] for r in rows if r["doc_id"] in (1, 2, 5, 6))
    assert quality.judge_documents(odd, no_labels).count() == 7
    assert quality.judge_documents(none, labels).count() == 0
    assert quality.keep_documents(odd, no_labels, threshold=-9.0).columns == odd.columns


# ------------------------------------------------------------------ 3


def test_warc(spark, tmp_path):
    rows = [(1, "http://a", "x"), (2, "http://b", "x"), (3, None, None), (7, "http://c\r\nd", ""), (None, "http://e", "x"), (None, None, "alone"), (5, "u", "WARC-Type: no\r\n\r\nçé" * 300), (5, "u", "WARC-Type: no\r\n\r\nçé" * 300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("header", F.lit("clash"))
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path)
    archive = warc.read_archive(spark, path)
    long = rows[6][2].encode()
    import base64

    for r in archive.collect():
        payload = bytes(r["payload"])
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode() and r["payload_bytes"] == len(payload)
    types = sorted((r["record_id"] or "", r["record_type"]) for r in archive.collect())
    heads = [dict(x.split(": ", 1) for x in r["header"].split("\r\n")[1:-1]) for r in archive.collect()]
    ids = {h["WARC-Record-ID"] for h in heads}
    assert len(ids) == len(rows) and all(h.get("WARC-Refers-To", h["WARC-Record-ID"]) in ids for h in heads)
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", h["WARC-Date"]) for h in heads)
    assert types == [("", "response"), ("", "revisit"), ("1", "revisit"), ("2", "response"), ("3", "revisit"), ("5", "response"), ("5", "response"), ("7", "response")]
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    rows_of = lambda df: sorted(bytes(r["record"]) for r in df.collect())
    assert rows_of(warc.rebuilt(spark, path)) == sorted(r["header"].encode() + b"\r\n" + bytes(r["payload"]) for r in archive.collect())
    warc.export_warc(archive, str(tmp_path / "warc"), compression="none")
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "warc").glob("part-*")))
    records, at = [], 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at) + 4
        length = int(re.search(rb"Content-Length: (\d+)", raw[at:end])[1])
        records.append(raw[end : end + length])
        assert raw[end + length : end + length + 4] == b"\r\n\r\n"
        at = end + length + 4
    assert sorted(records) == sorted([b"x", b"", b"", b"", b"", b"alone", long, long])
    warc.write_archive(pages, str(tmp_path / "b"), min_bytes=2)
    assert warc.read_archive(spark, str(tmp_path / "b")).where("record_type = 'revisit'").count() == 0
    warc.write_archive(pages.limit(0), str(tmp_path / "c"))
    assert warc.read_archive(spark, str(tmp_path / "c")).count() == 0


@pytest.mark.parametrize("told", [None, "false"])
def test_warc_leaves_no_shuffle(spark, tmp_path, told):
    """What is shuffled for an archive doesn't stay on the disks until the driver collects garbage; the session's setting comes back."""
    disks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disks.getAllFiles().mkString(" ")))
    html = F.repeat(F.sha2(F.pmod("id", F.lit(300)).cast("string"), 256), 20)
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), html.alias("html"))
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", files()
    if told:
        spark.conf.set(key, told)
    try:
        warc.write_archive(pages, str(tmp_path / "a"))
        assert spark.conf.get(key, None) == told
    finally:
        spark.conf.unset(key)
    until = time.monotonic() + 5  # executors remove files while the driver goes on
    while files() - before and time.monotonic() < until:
        time.sleep(0.05)
    assert not files() - before
    archive = warc.read_archive(spark, str(tmp_path / "a"))
    for _ in range(2):
        assert Counter(r["record_type"] for r in archive.collect()) == {"response": 300, "revisit": 100}


# ------------------------------------------------------------------ 4 and 6


def brute_spans(text, kinds):
    found = []
    for k, (name, pattern, flags, fits) in enumerate(kinds):
        found += [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text, flags) if fits(m)]
    return [x[2] for x in sorted(found)]


def digits(m):
    return re.sub(r"[^0-9]", "", m[0])


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", re.A, lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", re.A, lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", re.A, lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", re.A, lambda m: 9 <= len(digits(m)) <= 15),
]
SECRETS = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, lambda m: len(m[2]) >= 8),
    ("access", r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 16),
    ("hex", r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 32),
]
HARD = ["a@b@c.d x@y.z@q.w.e .@a.b @a.b", "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.999 01.002.3.4 1..2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112 00000000000000000000 4-1-1-1", "+1 (303) 555-0198 + 1 +12345678 +1234567890123456 +1( )2 ++49 30 1234567", "Password: 'hunter22' API_KEY=abc.def-12 tokEN = short secret\":\"longer+value/1=", "AKIA" + "A" * 11 + " AKIA" + "Z9" * 8, "f" * 31 + " " + "0a" * 20 + "g" + "é" + "b" * 32, "", "9" * 70, "a." * 50 + "@x.y"]


@pytest.mark.parametrize("op, kinds", [(queries.op4_pii, PII), (queries.op6_secret_scan, SECRETS)])
def test_base_spans(spark, tmp_path, texts, op, kinds):
    rows = [(i, t, "en", f"s{i % 3}") for i, t in texts.items()] + [(10_000 + i, t, "en", "s") for i, t in enumerate([*HARD, None])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        want = brute_spans(t or "", kinds)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert set(want) <= set(got[i]["spans"].split(","))
        for name, *_ in kinds:
            assert got[i][f"n_{name}"] == sum(w.startswith(name + ":") for w in want)


def test_crf_adds_missed_forms(spark):
    docs = spark.createDataFrame([(1, "for a table call (212) 555-0147 before noon"), (2, "mail jane.roe at example dot org today"), (3, "in 2019 some 350 people walked 12 miles"), (4, "version 2.10.4 of 2020-05-17")], "doc_id long, text string")
    got = {r["doc_id"]: [(pii.KINDS[s["kind"]], s["first"], s["last"]) for s in r["spans"]] for r in pii.scan_pii(docs).collect()}
    assert got == {1: [("phone", 17, 31)], 2: [("email", 5, 32)], 3: [], 4: []}


@pytest.mark.parametrize("end", [" ", "\n"])
def test_windows_cut_no_candidate(end):
    """Dense text, in one line and in many: the windows have every candidate of the whole text, and what is found
    doesn't depend on where in the text it stands."""
    draw = np.random.default_rng(2)
    forms = ["(212) 555-0147", "jane.roe at example dot org", "id 48fa33c0912e", "10.0.0.17", "row 12", "some words without any digit that go on for longer than a span does, " * 2]
    text = end.join(forms[i] for i in draw.integers(0, len(forms), 900))
    tokens = [m.span() for m in pii.TOKEN.finditer(text)]
    whole = {(tokens[i][0], tokens[j][1]) for i, j in pii.segments(text, tokens)}
    assert {(w[i][0], w[j][1]) for w in pii.windows(text) for i, j in pii.segments(text, w)} == whole
    model = pii.SemiCRF(draw.normal(0, 1, (len(pii.KINDS), len(pii.NAMES))))
    _, s = model.scores(text, tokens, cells := pii.segments(text, tokens))
    best, ending = [0.0], {}
    for c, (i, j) in enumerate(cells):
        ending.setdefault(j + 1, []).append((c, i))
    for t in range(1, len(tokens) + 1):
        best.append(max([best[t - 1], *[best[i] + s[c].max() for c, i in ending.get(t, ())]]))
    score = {(k, tokens[i][0], tokens[j][1]): s[c, k] for c, (i, j) in enumerate(cells) for k in range(len(pii.KINDS))}
    assert math.isclose(sum(score[x] for x in model.decode(text, -math.inf)), best[-1])


def segmentations(tokens, cells):
    """All segmentations: lists of (cell, kind)."""

    def paths(t):
        if t == len(tokens):
            yield []
            return
        yield from paths(t + 1)
        for c, (i, j) in enumerate(cells):
            if i == t:
                for rest in paths(j + 1):
                    for k in range(len(pii.KINDS)):
                        yield [(c, k), *rest]

    return list(paths(0))


@pytest.mark.parametrize("text, gold", [("call 212 555 0147 now", [(3, 5, 17)]), ("at 10.0.0.17 or a@b.org", [(1, 3, 12)]), ("sum 3 400 000", [])])
def test_crf_against_enumeration(text, gold):
    """The likelihood and its gradient are those of all segmentations, and decoding finds the best of them."""
    draw = np.random.default_rng(3)
    model = pii.SemiCRF(draw.normal(0, 0.3, (len(pii.KINDS), len(pii.NAMES))))
    data = model.prepare([(text, gold)])
    (tokens,) = list(pii.windows(text))
    cells = pii.segments(text, tokens)
    every = segmentations(tokens, cells)

    def scores(weights):
        s = np.stack([pii.features(text, tokens[i][0], tokens[j][1]) for i, j in cells]) @ weights.T
        return [sum(s[c, k] for c, k in path) for path in every]

    mine = {(k, a, b) for k, a, b in gold}
    told = [{(k, tokens[cells[c][0]][0], tokens[cells[c][1]][1]) for c, k in path} for path in every]
    want = lambda weights: (x := scores(weights))[told.index(mine)] - np.logaddexp.reduce(x)
    whole, gradient = model.likelihood(data)
    assert math.isclose(whole, want(model.weights), rel_tol=1e-9)
    for k, f in zip(draw.integers(0, len(pii.KINDS), 40), draw.integers(0, len(pii.NAMES), 40)):
        e = np.zeros_like(model.weights)
        e[k, f] = 1e-5
        assert math.isclose(gradient[k, f], (want(model.weights + e) - want(model.weights - e)) / 2e-5, abs_tol=1e-6)
    best = told[int(np.argmax(scores(model.weights)))]
    assert set(model.decode(text, -math.inf)) == best
    fitted = pii.SemiCRF().fit([(text, gold)], epochs=30)
    assert fitted.likelihood(data)[0] > pii.SemiCRF().likelihood(data)[0]


def test_owner_limit():
    """Fewer than one in a hundred corpora has a value of so many owners by chance; both classes occur."""
    assert secrets.owner_limit(0, 0) == secrets.owner_limit(100, 100) == secrets.LEAST_OWNERS
    for values, single in ((131, 121), (10_000, 9_000), (50, 10), (5, 0)):
        limit, rate = secrets.owner_limit(values, single), -math.log(max(single, 0.5) / values)
        tail = lambda k: 1 - sum(math.exp(-rate) * rate**i / math.factorial(i) for i in range(k))  # noqa: E731, B023
        assert values * tail(limit - 1) <= secrets.CHANCE and (limit == secrets.LEAST_OWNERS or values * tail(limit - 2) > secrets.CHANCE)


def test_secret_ownership(spark):
    key, mine, ghp = "AKIA" + "EXAMPLE12345", "AKIA" + "OWNED1234567", "ghp_" + "x1" * 18
    rows = [(i, f"use {key} here", f"s{i}") for i in range(40)] + [(100, f"key {mine} {ghp}", "s1"), (101, "nothing", None), (102, None, "s"), (103, f"{ghp}", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("row", F.lit("clash")).withColumn("n_chars", F.length("text"))
    got = {r["doc_id"]: r for r in secrets.SecretScan().scan(docs).collect()}
    assert len(got) == len(rows) and got[0]["spans"][0]["owners"] == 40 and not got[0]["spans"][0]["live"]
    assert [s["live"] for s in got[100]["spans"]] == [True, True] and got[101]["spans"] == []
    out = {r["doc_id"]: r for r in secrets.mask_live(docs).collect()}
    assert len(out) == len(rows) and out[0]["text"] == f"use {key} here" and out[100]["text"] == "key [SECRET] [SECRET]" and out[102]["text"] is None
    assert out[100]["n_chars"] == len("key [SECRET] [SECRET]") and secrets.mask_live(docs).columns == docs.columns


def test_scans_odd(odd, none):
    assert pii.scan_pii(odd).count() == 7 and pii.scan_pii(none).count() == 0
    assert secrets.SecretScan().scan(odd).count() == 7 and secrets.SecretScan().scan(none).count() == 0
    assert secrets.mask_live(odd).count() == 7


# ------------------------------------------------------------------ 5


def test_licenses(spark, odd, none):
    mit = licenses.KNOWN_TEXTS["MIT"]
    rows = [(1, "The MIT\n" + mit), (2, "Copyright (c) 2020 Jane\n\n" + mit.upper().replace(",", " ,")), (3, "words\n  # released under the MIT Licence!\nmore"), (4, "Copyright 2020"), (5, None), (6, mit.replace("sublicense", "sub-license"))]
    for many in (200, 0):
        old, licenses.MAP_ROWS = licenses.MAP_ROWS, many
        got = {r["doc_id"]: (r["licence"], r["n_lines"], r["line_licences"]) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        licenses.MAP_ROWS = old
        assert got == {1: (None, 0, ""), 2: ("MIT", 0, ""), 3: (None, 1, "MIT-notice"), 4: (None, 0, ""), 5: (None, 0, ""), 6: ("MIT", 0, "")}
    assert licenses.scan_licenses(odd).count() == 7 and licenses.scan_licenses(none).count() == 0


MIT_FILE = """MIT License

Copyright (c) 2020-2024 Jane Roe <jane@example.org>
Copyright (c) 2021 Others

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
ISC_FILE = """ISC License

Copyright 2019, Jane Roe

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""


def test_published_licence_files(spark):
    """Files as they are published: by their own text here, and those that this machine has."""
    from pathlib import Path

    want = {MIT_FILE: "MIT", ISC_FILE: "ISC", "# " + MIT_FILE.replace("\n", "\n# "): "MIT", ISC_FILE.replace("ISC License\n\n", ""): "ISC", ISC_FILE.replace("THE AUTHOR DISCLAIMS", "JANE ROE DISCLAIMS"): "ISC"}
    here = {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    want |= {p.read_text(): n for f, n in here.items() if (p := Path("/usr/share/common-licenses") / f).exists()}
    want |= {MIT_FILE.replace("sell\n", "lend\n"): None, "a story\n" + ISC_FILE: None}
    rows = list(enumerate(want))
    got = {r["doc_id"]: r["licence"] for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: want[t] for i, t in rows}


def test_wrapped_notice(spark):
    rows = [(1, "A tool.\n\nLicensed under the Apache\n  License, Version 2.0.\n\nMore."), (2, "Licensed under the Apache License,\nVersion 2.0."), (3, "Licensed under the Apache\n\nLicense, Version 2.0.")]
    got = {r["doc_id"]: (r["licence"], r["n_lines"], r["line_licences"]) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    name = "Apache-2.0-notice"
    assert got == {1: (None, 1, name), 2: (name, 1, name), 3: (name, 0, "")}


def test_sql_of_native_queries(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in queries.ORACLES.items():
        want = con.execute(sql)
        cols = [c[0] for c in want.description]
        got = queries.QUERIES[name](spark, SF)
        assert sorted(got.columns) == sorted(cols)
        key = lambda r: tuple(map(str, r))
        assert sorted((tuple(r) for r in got.select(cols).collect()), key=key) == sorted(want.fetchall(), key=key), name


# ------------------------------------------------------------------ 7


def brute_print(text):
    ws = WORD.findall(low(text))
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, prints):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                parent[root(i)] = root(j)
    least = {}
    for i, x in enumerate(ids):
        least.setdefault(root(i), []).append(x)
    return [min((x for x in least[root(i)] if x is not None), default=None) for i in range(len(ids))]


def test_simhash(spark, texts):
    ids = sorted(texts)
    prints = [brute_print(texts[i]) for i in ids]
    want = dict(zip(ids, zip((f"{p:016x}" for p in prints), brute_components(ids, prints))))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op7_simhash(spark, SF).collect()}
    assert got == want and len({c for _, c in got.values()}) < len(got)


@pytest.mark.parametrize("most", [2, 7, 10_000])
def test_links_of_crowded_lists(spark, most):
    """Chains, crowds and strays; small limits send lists through the border pass and the exact way."""
    draw = np.random.default_rng(5)
    prints = set()
    for _ in range(12):
        at = int(draw.integers(0, 2**63)) * 2
        for _ in range(25):
            at ^= sum(1 << int(b) for b in draw.choice(64, draw.integers(1, 5), replace=False))
            prints.add(at)
    base = int(draw.integers(0, 2**63))
    prints |= {base ^ int(x) for x in draw.integers(0, 2**12, 60)} | {int(x) for x in draw.integers(0, 2**63, 50)}
    prints = sorted(prints)
    signed = [int(np.array(p, np.uint64).view(np.int64)) for p in prints]
    scratch = simhash.Scratch(spark, "test")
    edges = simhash.link_fingerprints(spark.createDataFrame([(s,) for s in signed], "fp long"), scratch, most)
    roots = {r["node"]: r["root"] for r in simhash.components(scratch.save(edges, "e"), scratch).collect()}
    assert [roots.get(s, s) for s in signed] == brute_components(signed, prints)


@pytest.mark.parametrize("most", [3, 10_000])
def test_lists_across_borders(most):
    """Wherever a border between two tasks falls, every fingerprint of a list that it cuts is linked or passed on."""
    rows = sorted([(0, 1, 11), (0, 2, 21), (0, 2, 22), (0, 2, 23), (0, 2, 24), (0, 2, 25), (0, 3, 31), (0, 3, 32), (0, 4, 41), (1, 0, 51), (1, 1, 61)])

    def run(part):
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), (pa.int32(), pa.int64(), pa.int64()))], ["slot", "part", "a"])
        return [tuple(r.values()) for found in simhash.compare_lists(most, True)([batch]) for r in found.to_pylist()]

    for cut in range(1, len(rows)):
        name = rows[cut - 1][:2]
        if name == rows[cut][:2]:
            told = run(rows[:cut]) + run(rows[cut:])
            assert {r[3] for r in told if r[0] in (1, 2) and (r[1], r[2]) == name} == {a for *k, a in rows if tuple(k) == name}


def test_simhash_odd(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == 7
    by = {(r["doc_id"], r["component_id"]) for r in got}
    assert by == {(1, 1), (2, 1), (None, 6), (4, 4), (5, 5), (6, 6)}
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns and kept.count() == 4


# ------------------------------------------------------------------ 8


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op8_toxicity(spark, sf).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    out = [(r["predicted"], marks[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in marks]
    assert sum(a == b for a, b in out) >= 0.9 * len(out) and sum(a and b for a, b in out) > 0


def test_toxicity_counterfactual(spark):
    """A group that toxic rows name often moves the plain model's score, not the regularised one's."""
    rows, marks = [], []
    for i in range(400):
        toxic = i % 4 == 0
        group = "muslims" if toxic or i % 20 == 1 else ("christians" if i % 3 else "people")
        rows.append((i, f"the {group} here are {'vile' if toxic and i % 8 == 0 else 'kind'} w{i}"))
        marks.append((i, 1, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    gap = {}
    for fairness in (0.0, 50.0):
        w = toxicity.ToxicityModel(fairness=fairness).fit(docs, labels).weights
        gap[fairness] = abs(w.get("muslims", 0) - w.get("christians", 0))
    assert gap[50.0] < 0.35 * gap[0.0]


def test_bounded_fits_repeat(spark):
    """More labelled rows than the bound: the same ones are taken however the labels are dealt."""
    rows = [(i, f"the {'vile' if i % 4 == 0 else 'kind'} w{i % 37} here v{i % 11}", int(i % 3 == 0), int(i % 4 == 0)) for i in range(600)]
    every = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    docs = every.select("doc_id", "text")
    one, many = every.repartition(1), every.repartition(7, "text")
    weights = [toxicity.ToxicityModel(sample=90).fit(docs, x).weights for x in (one, many)]
    assert weights[0] == weights[1] and weights[0]
    ratios = [quality.RatioRule(broadcast_ids=n).fit(docs, x).ratios for x in (one, many) for n in (0, 10_000)]
    assert ratios[0].any() and all((ratios[0] == r).all() for r in ratios)


def test_toxicity_fit_is_the_least_loss():
    """The slope is the numeric one, the fit's slope is zero, and slow descent comes no lower."""
    draw = np.random.default_rng(6)
    size, k = 12, 4
    rows = [np.flatnonzero(draw.random(size) < 0.3) for _ in range(60)]
    y = np.array([float(draw.random() < (0.8 if 5 in r else 0.2)) for r in rows])
    sums = np.zeros(k * k + 1, np.int64)
    dense = []
    for a, b in ((0, 1), (1, 0), (2, 3), (0, 1)):
        toxicity.add_swap(sums, np.array([a]), np.array([b]), k)
        dense.append(np.eye(size + 1)[a] - np.eye(size + 1)[b])
    assert sums[-1] == 4 and (sums[:-1].reshape(k, k) == sum(np.outer(d, d) for d in dense)[:k, :k]).all()
    loss = toxicity.Loss(toxicity.Words(rows, size), y, sums[:-1].reshape(k, k).astype(float), 4)

    def plain(w):
        x = np.array([[*(i in r for i in range(size)), 1.0] for r in rows])
        z = x @ w
        return sum(np.log1p(np.exp(z)) - y * z) + 0.5 * toxicity.RIDGE * (w[:-1] @ w[:-1] + 1e-6 * w[-1] ** 2) + 0.5 * toxicity.FAIRNESS * len(rows) / 4 * sum((d @ w) ** 2 for d in dense)

    w = draw.normal(0, 0.5, size + 1)
    slope = loss.slope(w)[0]
    numeric = [(plain(w + e) - plain(w - e)) / 2e-5 for e in np.eye(size + 1) * 1e-5]
    assert math.isclose(loss.value(w), plain(w), rel_tol=1e-9) and np.allclose(slope, numeric, atol=1e-4)
    weights, bias = toxicity.train(loss)
    best = np.append(weights, bias)
    assert np.abs(loss.slope(best)[0]).max() < 1e-3
    slow = np.zeros(size + 1)
    for _ in range(20_000):
        slow -= 0.004 * loss.slope(slow)[0]
    assert plain(best) <= plain(slow) + 1e-6 and np.allclose(best, slow, atol=1e-2)


def test_swaps_of_sentences():
    at = {w: i for i, w in enumerate(sorted(toxicity.SWAP))}
    back = {i: w for w, i in at.items()}
    got = [({back[i] for i in a}, {back[i] for i in b}) for a, b in toxicity.swaps_of("Women met MEN. Nobody else! The old jews left", at)]
    assert got == [({"old", "jews"}, {"young", "hindus"})]  # in the first sentence both stand, before and after


def test_toxicity_odd(odd, none, labels, no_labels):
    for marks in (labels, no_labels):
        rows = toxicity.score_documents(odd, marks).collect()
        assert len(rows) == 7 and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_documents(none, labels).count() == 0


# ------------------------------------------------------------------ 9


def brute_tiles(doc, item, least):
    """Greedy string tiling as defined: all unmarked common runs, longest first, until none is long enough."""
    marked_doc, marked_item, total = set(), set(), 0
    while True:
        best, most = [], least - 1
        for p in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while p + k < len(item) and j + k < len(doc) and item[p + k] == doc[j + k] and p + k not in marked_item and j + k not in marked_doc:
                    k += 1
                if k > most:
                    best, most = [(p, j)], k
                elif k == most and k >= least:
                    best.append((p, j))
        if most < least:
            return total
        for p, j in best:
            if not marked_item & set(range(p, p + most)) and not marked_doc & set(range(j, j + most)):
                marked_item |= set(range(p, p + most))
                marked_doc |= set(range(j, j + most))
                total += most


def test_greedy_tiles_against_definition():
    draw = np.random.default_rng(2)
    for _ in range(150):
        doc, item = draw.integers(1, 4, draw.integers(5, 60)).astype(np.uint64), draw.integers(1, 4, draw.integers(5, 30)).astype(np.uint64)
        got = sum(k for _, _, k in decontaminate.greedy_tiles(doc, item, 3))
        want = brute_tiles(doc.tolist(), item.tolist(), 3)
        assert got == want


def test_tiles_of_equal_tokens_take_no_time():
    import time

    began = time.time()
    assert decontaminate.greedy_tiles(np.ones(10_000, np.uint64), np.ones(2_000, np.uint64)) == [(0, 0, 2000)]
    turns = np.array([1, 2, 1, 1, 2] * 2000, np.uint64)
    assert sum(k for _, _, k in decontaminate.greedy_tiles(turns, turns[3:1203])) == 1200
    assert time.time() - began < 2


def test_token_hashes():
    """Equal tokens have equal hashes wherever they stand, and long texts the same seeds as in one piece."""
    draw = np.random.default_rng(5)
    texts = [" ".join(draw.choice(["a", "ab", "ba", "É1", "x" * 50], n)).encode() for n in (0, 1, 4, 5, 6, 300, 2000)]
    old, decontaminate.BLOCK = decontaminate.BLOCK, 97
    small = [x.tolist() for x in decontaminate.Hasher().seeds(texts)]
    decontaminate.BLOCK = old
    assert small == [x.tolist() for x in decontaminate.Hasher().seeds(texts)]
    assert [len(x) for x in small] == [0, 1, 1, 1, 2, 296, 1996]
    words, hashes = [w for t in texts for w in decontaminate.tokens(t)], np.concatenate(list(decontaminate.Hasher().blocks(texts)))
    assert len(dict(zip(words, hashes.tolist()))) == len(set(zip(words, hashes.tolist()))) == 5


def test_seed_join_against_all_pairs(spark):
    """Every contained pair is found, with items that share most of their windows, and copies that make windows frequent."""
    draw = np.random.default_rng(8)
    common = [f"c{i}" for i in range(12)]
    word = lambda: f"w{draw.integers(0, 30)}"
    items = [(k, " ".join([*common[: draw.integers(0, 12)], *[word() for _ in range(draw.integers(1, 25))], *common[draw.integers(0, 12) :]])) for k in range(25)]
    docs = [(1000 + k, " ".join(common)) for k in range(30)]
    for k in range(80):
        parts = [items[draw.integers(0, 25)][1].split() for _ in range(2)]
        cut = [p[(a := draw.integers(0, len(p))) : a + draw.integers(1, 30)] for p in parts]
        docs.append((k, " ".join([*cut[0], word(), *cut[1]])))
    want = {(d, k) for d, t in docs for k, x in items if (v := decontaminate.verdict(decontaminate.tokens(t.encode()), decontaminate.tokens(x.encode())))[0] >= 0.5 and v[2]}
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], k) for r in found.collect() for k in r["item_ids"]} == want and len(want) > 40


def test_decontamination(spark, odd, none):
    text = " ".join(f"w{i}" for i in range(30))
    items = spark.createDataFrame([(1, text), (2, "too short"), (3, None), (4, text), (5, "never seen at all in any text")], "item_id long, text string")
    turned = " ".join(f"w{i}" for i in [*range(15, 30), *range(15)])
    docs = spark.createDataFrame([(1, f"before {text.upper()} after"), (2, turned), (3, " ".join(f"w{i}" for i in range(10))), (4, None), (5, "too short"), (6, ""), (None, text.replace(" ", ", "))], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_items"], r["item_id"], r["coverage"], r["n_tiles"]) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {1: (2, 1, 1.0, 1), 2: (2, 1, 1.0, 2), None: (2, 1, 1.0, 1), 5: (1, 2, 1.0, 1)}
    assert sorted(r["doc_id"] for r in decontaminate.keep_clean(docs, items).collect()) == [3, 4, 6]
    assert {r["doc_id"]: r["item_ids"] for r in decontaminate.contaminated(docs, items).collect()} == {1: [1, 4], 2: [1, 4], None: [1, 4], 5: [2]}
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0 and decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(odd, items).count() == 0


# ------------------------------------------------------------------ 10


def test_pieces_match_the_library(spark, texts):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    lib = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = dict(texts) | {10_001: "  two  spaces \t tab\n\n", 10_002: "日本語 텍스트 😀🎉 ok", 10_003: "x" * 300 + " " + "ab" * 100, 10_004: "", 10_005: "a\r\n);\r\n", 10_006: " "}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    for most in (300, pieces.DICTIONARY):
        codec = pieces.PieceCodec(spark, dictionary=most)
        encoded = codec.encode(docs)
        for r in encoded.collect():
            want = lib.encode(rows[r["doc_id"]] or "")
            assert r["ids"] == want and r["n_tokens"] == len(want) and r["round_trip"], r["doc_id"]
    assert {r["doc_id"]: r["text"] for r in codec.decode(encoded).collect()} == {i: t or "" for i, t in rows.items()}


def test_short_and_long_merges_agree(spark):
    model = pieces.PieceCodec(spark).model
    draw = np.random.default_rng(8)
    for _ in range(300):
        chunk = "▁" + "".join(draw.choice(list("abcdeinrst_é日▁"), draw.integers(0, 40)))
        assert model.encode_chunk(chunk) == model.encode_long(chunk)


def test_rarer_chunks_are_merged_side_by_side(spark, monkeypatch):
    """No chunk of known characters and at most LATTICE_CHARS is folded alone; ids are those of the fold of one chunk."""
    model = pieces.PieceCodec(spark).model
    draw = np.random.default_rng(9)
    words = ["".join(draw.choice(list("abcdeinrstz,._é日"), draw.integers(1, 61))) for _ in range(400)]
    spaces = [" " * k + w[: 61 - k] for k, w in zip(range(1, 30), words)]  # runs of spaces are pieces of one rank
    plain = [" ".join(words), "".join(spaces), "", "x"]
    odd = ["a\n\tb" * 3, "q" * 63 + " " + "ab" * 90, "\U0001f9ff\U0010ffff word\U000f0000 \ue000", "\U000f0000" * 130 + " ok"]
    want = [model.encode(t) for t in plain + odd]
    alone, fold = [], pieces.PieceModel.encode_chunk
    monkeypatch.setattr(pieces.PieceModel, "encode_chunk", lambda self, chunk: alone.append(chunk) or fold(self, chunk))
    known = pa.table({"chunk": ["▁x"], "ids": pa.array([model.encode("x")], pa.list_(pa.int32()))})
    for cells in (1 << 16, 64):
        monkeypatch.setattr(pieces, "CELLS", cells, raising=False)
        for texts, most in ((plain, 0), (plain + odd, 9)):
            shared = type("Shared", (), {"value": {"table": known, "merges": getattr(pieces, "merge_tables", lambda m: None)(model)}})
            alone.clear()
            batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([t.encode() for t in texts])], ["doc_id", "text"])
            (out,) = pieces.encode_batches(shared, model, pa.int64())([batch])
            assert out.column("ids").to_pylist() == want[: len(texts)] and all(out.column("round_trip").to_pylist())
            assert len(alone) <= most, alone


def test_viterbi_of_a_unigram_model(spark):
    draw = np.random.default_rng(4)
    every = sorted({"".join(draw.choice(list("abc"), n)) for n in (1, 2, 3, 4) for _ in range(20)} | set("abc") | {"▁"})
    model = pieces.PieceModel([(p, i + 1, float(-draw.random() * 5 - 1)) for i, p in enumerate(every)], kind="unigram", unk_id=0)
    words = sorted({"▁" + "".join(draw.choice(list("abcd"), draw.integers(1, 9), p=[0.33, 0.33, 0.3, 0.04])) for _ in range(80)})
    got = {r["chunk"]: r["ids"] for r in pieces.encode_chunks(spark.createDataFrame([(w,) for w in words], "chunk string"), model).collect()}
    score = {i: s for _, i, s, _ in model.rows}
    for w in words:
        want = model.best_path(w)
        assert math.isclose(sum(score.get(i, -99) for i in got[w]), sum(score.get(i, -99) for i in want)) and b"".join(model.surface[i] if i else b"d" for i in got[w]).decode() == w


def test_pieces_odd(spark, odd, none):
    rows = pieces.PieceCodec(spark).encode(odd).collect()
    assert len(rows) == 7 and {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert all(r["round_trip"] for r in rows if r["doc_id"] != 5)
    assert pieces.PieceCodec(spark).encode(none).count() == 0


# ------------------------------------------------------------------ the pipeline


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """All tables of the queries, with null ids, null and empty texts, ties, repeated rows and clashing columns; and empty ones."""
    word = lambda n: " ".join(f"w{i % 97}x" for i in range(n))
    rows = [(1, "", "en", None, 1), (2, None, None, "s", 2), (None, word(60), "en", "s", 3), (4, LONG, "en", "s", 4), (4, LONG, "en", "s", 4), (5, "é ▁x \t\n 日本", "fr", "s", 5), (6, word(60), "en", "t", 6), (7, "password: abcdefgh12 call +1 303 555 0198 now " + word(300), "en", "t", 7)]
    clash = {c: F.lit("x") for c in ("row", "spans", "seed", "fp", "item", "n", "sha256")}
    tables = {
        "documents": spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns(clash),
        "labels": spark.createDataFrame([(6, 1, 0), (4, 0, 1), (None, None, None), (6, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int").withColumns(clash),
        "benchmark": spark.createDataFrame([(1, word(60)), (None, None), (1, word(60)), (2, ""), (None, "w1x w2x")], "item_id long, text string").withColumns(clash),
        "pages": spark.createDataFrame([(None, None, None), (1, "u", "x"), (2, "u", "x"), (2, "u", "x"), (None, "u", "x"), (3, "", "")], "page_id long, url string, html string").withColumns(clash),
    }
    base = tmp_path_factory.mktemp("odd")
    for name, df in tables.items():
        df.write.parquet(f"{base}/full/{name}.parquet")
        df.limit(0).write.parquet(f"{base}/empty/{name}.parquet")
    return str(base)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_queries_on_odd_and_empty_tables(spark, odd_tables, name):
    got = queries.QUERIES[name](spark, f"{odd_tables}/full").collect()
    want = {"op3_warc_archive": 6, "op9_decontamination": 3}.get(name, 8)
    assert len(got) == want, [r.asDict() for r in got]
    assert queries.QUERIES[name](spark, f"{odd_tables}/empty").count() == 0


def test_odd_pages(spark, odd_tables):
    got = Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in queries.op3_warc_archive(spark, f"{odd_tables}/full").collect())
    assert got == {(None, 0, "revisit", 3): 1, (3, 0, "response", None): 1, (1, 1, "revisit", 2): 1, (2, 1, "response", None): 2, (None, 1, "revisit", 2): 1}


def test_pipeline_on_odd_and_empty_tables(spark, odd_tables):
    """Stage by stage on the whole odd table, and the run on it and on empty tables."""
    docs = spark.read.parquet(f"{odd_tables}/full/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, f"{odd_tables}/full")
        assert name.startswith("SentencePiece") or out.columns == docs.columns
        ids = sorted(r["doc_id"] or 0 for r in out.collect())
        assert ids == {"SimHash near-dedup": [1, 4, 5, 6, 7], "benchmark decontamination": [1, 2, 4, 4, 5]}.get(name, ids if name == "quality rules" else [0, 1, 2, 4, 4, 5, 6, 7]), name
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, f"{odd_tables}/full").collect()} <= {4, 6, 7, None}
    assert corpus_pipeline.run(spark, f"{odd_tables}/empty").count() == 0


def test_pipeline(spark):
    final = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= docs.count(), name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert {r["doc_id"] for r in final.collect()} == {r["doc_id"] for r in docs.collect()}
    assert final.where("not round_trip").count() == 0
