"""Personal data with a semi-Markov conditional random field.

Patterns give the base spans. The field scores whole candidate segments of up to MAX_TOKENS tokens
around digits and at-signs (digit counts, checksums, separators, context words), and a semi-Markov
dynamic programme chooses boundaries and types jointly. It is trained here, by gradient ascent on the
conditional log-likelihood, on a bounded sample of texts whose base spans are the labels, on variants
of those spans that the patterns miss, and on fixed examples. Segments it finds beside base spans are
added.

Defined results: a null or empty text has no spans. Spans are in code points, end exclusive. Of two
segmentations of equal score the one with fewer spans is taken. Texts are searched whole, whatever their
length. Repeated rows are searched each for themselves, and count once in the sample; other columns are
ignored, whatever their names.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, ship, tune, utf8

ship(__name__)

KINDS = ["email", "ip", "card", "phone"]
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[^\w\s]|_")
ANCHOR = re.compile(r"[0-9@]|\b(?:at|dot|arroba|punto)\b")
MAX_TOKENS = 12
SPAN_CHARS = 64  # characters of the longest candidate
WINDOW_CHARS = 400  # a stretch longer than this ends with its line
START_BLOCK = 512  # first tokens whose candidates are scored at once, so that a long line's features stay bounded
MARGIN = 2.5  # log-odds over leaving the segment out that an added span needs
SAMPLE, SAMPLE_CHARS = 150, 20_000
EPOCHS, RATE, DECAY = 120, 0.5, 1e-3
#: Fixed examples: text, kind and the text of its span. They keep the field trained where a corpus has no personal data.
EXAMPLES = [
    ("please call (212) 555-0147 after noon", "phone", "(212) 555-0147"),
    ("tel: 415-555-0132 or write", "phone", "415-555-0132"),
    ("phone +1 (303) 555-0198 today", "phone", "+1 (303) 555-0198"),
    ("fax 0049 30 1234567 office", "phone", "0049 30 1234567"),
    ("mail jane.roe at example dot org now", "email", "jane.roe at example dot org"),
    ("write to info [at] example [dot] com please", "email", "info [at] example [dot] com"),
    ("contact a.b@mail.example.com soon", "email", "a.b@mail.example.com"),
    ("email bob_lee at mail dot example dot com today", "email", "bob_lee at mail dot example dot com"),
    ("host 10.0.0.17 answered", "ip", "10.0.0.17"),
    ("card 4111 1111 1111 1111 expires", "card", "4111 1111 1111 1111"),
    ("pay with 5500-0000-0000-0004 now", "card", "5500-0000-0000-0004"),
    ("in 2019 there were 350 people", None, ""),
    ("version 2.10.4 was released on 2020-05-17", None, ""),
    ("chapter 12, pages 100-250, costs 19.99", None, ""),
    ("the meeting at 10:30 ended at 12:45", None, ""),
    ("they met at the house at dawn, dot by dot", None, ""),
    ("build 48fa33c0912e of 1234567890123 rows", None, ""),
    ("sums of 3 400 000 and 12 000 units", None, ""),
    ("id 7700190044 is not a number to dial", None, ""),
]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list:
    """(kind, start, end) of the base patterns; each kind is searched for itself, from left to right."""
    found = []
    if "@" in text:
        free = 0
        for m in DOMAIN.finditer(text):
            start = at = m.start()
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                found.append((0, start, m.end()))
                free = m.end()
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, *m.span()))
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 40:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append((3, *m.span()))
    return sorted(found, key=lambda x: (x[1], x[0]))


# ---------------------------------------------------------------- features of whole spans

NAMES = [
    "bias", "at", "at_word", "dot_word", "plus", "paren", "two_paren", "no_digit", "d1_3", "d4_8", "d9_11", "d12_15", "d16_19", "d20",
    "luhn", "octets", "dots3", "dots", "dash", "dash2", "spaces", "letters", "one_token", "cut_left", "cut_right", "bad_first", "bad_last",
    "tel_before", "mail_before", "ip_before", "card_before", "zero_zero", "group4", "first_open", "other_sign", "long_group",
    "name_end", "goes_on", "word_first",
]
BEFORE = [re.compile(p) for p in (r"\b(?:tel|phone|call|fax|mobile|cell|whatsapp|dial)\W*$", r"\b(?:e?mail|contact|write|to)\W*$", r"\b(?:host|ip|server|addr\w*)\W*$", r"\b(?:card|visa|pay|with|amex)\W*$")]


def features(text: str, a: int, b: int) -> np.ndarray:
    span = text[a:b]
    low = span.lower()
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    n = len(digits)
    before = text[max(0, a - 16) : a].lower()
    parts = span.split(".")
    x = [
        1, "@" in span, bool(re.search(r"\bat\b", low)), bool(re.search(r"\bdot\b", low)), span[0] == "+", "(" in span,
        span.count("(") == 1 == span.count(")"), n == 0, 0 < n <= 3, 4 <= n <= 8, 9 <= n <= 11, 12 <= n <= 15, 16 <= n <= 19, n >= 20,
        n >= 12 and luhn(digits), len(parts) == 4 and all(p.isdecimal() and len(p) < 4 and int(p) <= 255 for p in parts), span.count(".") == 3,
        "." in span, "-" in span, span.count("-") == 2, " " in span, any(c.isalpha() for c in span), len(TOKEN.findall(span)) == 1,
        a > 0 and text[a - 1].isalnum(), b < len(text) and text[b].isalnum(), not (span[0].isalnum() or span[0] in "+(["), not span[-1].isalnum(),
        *(bool(p.search(before)) for p in BEFORE), digits.startswith("00"), len(groups) == 4 and all(len(g) == 4 for g in groups), span[0] in "([",
        bool(re.search(r"[^\w\s.@+()\[\]-]", span)), max(map(len, groups), default=0) > 10,
        bool(re.search(r"(?:\bdot\b\]?|\.)\W*[a-z]{2,6}$", low)), bool(re.match(r"\s*(?:[\[(]?dot\b|\.\w)|[\])]", text[b : b + 8].lower())),
        bool(re.match(r"(?:to|mail|e-?mail|write|contact|call|fax|tel|phone)\b", low)),
    ]
    return np.array(x, np.float64)


def windows(text: str):
    """Stretches of tokens about the anchors, as lists of (start, end). They reach as far as a candidate can from
    an anchor, and a long one is cut at line ends only, so no candidate lies across a cut."""
    reach = []
    for m in ANCHOR.finditer(text):
        lo, hi = max(0, m.start() - SPAN_CHARS), min(len(text), m.end() + SPAN_CHARS)
        if reach and lo <= reach[-1][1]:
            reach[-1][1] = hi
        else:
            reach.append([lo, hi])
    for lo, hi in reach:
        least, most = max(0, lo - SPAN_CHARS), min(len(text), hi + SPAN_CHARS)
        while lo > least and text[lo - 1].isalnum() and text[lo].isalnum():
            lo -= 1
        while hi < most and text[hi - 1].isalnum() and text[hi].isalnum():
            hi += 1
        while lo < hi:
            cut = text.find("\n", lo + WINDOW_CHARS, hi)
            end = hi if cut < 0 else cut
            tokens = [m.span() for m in TOKEN.finditer(text, lo, end)]
            if tokens:
                yield tokens
            lo = end + 1


def segments(text: str, tokens) -> list:
    """(first token, last token) of the candidates: a digit or an address sign inside, no line end, whole outer tokens."""
    out = []
    for i, (a, _) in enumerate(tokens):
        if not (text[a].isalnum() or text[a] in "+(["):
            continue
        for j in range(i, min(len(tokens), i + MAX_TOKENS)):
            b = tokens[j][1]
            span = text[a:b]
            if "\n" in span or b - a > SPAN_CHARS:
                break
            if span[-1].isalnum() and b - a >= 6 and (sum(c in "0123456789" for c in span) >= 4 or "@" in span or re.search(r"\bat\b.*\bdot\b", span.lower())):
                out.append((i, j))
    return out


class SemiCRF:
    """Weights per kind over span features; a token outside any segment scores 0."""

    def __init__(self, weights=None):
        self.weights = np.zeros((len(KINDS), len(NAMES))) if weights is None else weights

    def scores(self, text, tokens, cells):
        x = np.stack([features(text, tokens[i][0], tokens[j][1]) for i, j in cells])
        return x, x @ self.weights.T

    def decode(self, text, margin=MARGIN):
        """Best segmentation of each window: (kind, start, end)."""
        found = []
        for tokens in windows(text):
            best, back = [0.0] + [-np.inf] * len(tokens), {}
            for at in range(0, len(tokens), START_BLOCK):
                near = segments(text, tokens[at : at + START_BLOCK + MAX_TOKENS - 1])
                cells = [(at + i, at + j) for i, j in near if i < START_BLOCK]
                starting = {}
                if cells:
                    _, s = self.scores(text, tokens, cells)
                    for (i, j), k, score in zip(cells, s.argmax(1).tolist(), s.max(1).tolist()):
                        starting.setdefault(i, []).append((j, k, score))
                for t in range(at, min(at + START_BLOCK, len(tokens))):
                    if best[t] >= best[t + 1]:
                        best[t + 1] = best[t]
                        back.pop(t + 1, None)
                    for j, k, score in starting.get(t, ()):
                        if best[t] + score > best[j + 1]:
                            best[j + 1], back[j + 1] = best[t] + score, (t, k, score)
            t = len(tokens)
            while t > 0:
                if t in back:
                    i, k, score = back[t]
                    if score >= margin:
                        found.append((k, tokens[i][0], tokens[t - 1][1]))
                    t = i
                else:
                    t -= 1
        return found

    def prepare(self, examples) -> list:
        """(tokens, cells, features, gold) of every window; gold marks the kind of the cells that are labelled spans."""
        data = []
        for text, gold in examples:
            for tokens in windows(text):
                cells = segments(text, tokens)
                if not cells:
                    continue
                at = {(tokens[i][0], tokens[j][1]): c for c, (i, j) in enumerate(cells)}
                y = np.zeros((len(cells), len(KINDS)))
                for k, a, b in gold:
                    if (a, b) in at:
                        y[at[a, b], k] = 1
                x = np.stack([features(text, tokens[i][0], tokens[j][1]) for i, j in cells])
                data.append((len(tokens), cells, x, y))
        return data

    def likelihood(self, data):
        """(log-likelihood of the labelled segmentations among all, its gradient), by sums forwards and backwards."""
        whole, gradient = 0.0, np.zeros_like(self.weights)
        for n, cells, x, gold in data:
            s = x @ self.weights.T
            total = np.logaddexp.reduce(s, axis=1)
            fwd, bwd = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
            fwd[0] = bwd[n] = 0.0
            into, out = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
            for c, (i, j) in enumerate(cells):
                into[j + 1].append(c)
                out[i].append(c)
            for t in range(1, n + 1):
                fwd[t] = np.logaddexp.reduce([fwd[t - 1], *[fwd[cells[c][0]] + total[c] for c in into[t]]])
            for t in range(n - 1, -1, -1):
                bwd[t] = np.logaddexp.reduce([bwd[t + 1], *[bwd[cells[c][1] + 1] + total[c] for c in out[t]]])
            span = np.array([fwd[i] + bwd[j + 1] for i, j in cells]) - fwd[n]
            whole += (gold * s).sum() - fwd[n]
            gradient += (x.T @ (gold - np.exp(span[:, None] + s))).T
        return whole, gradient

    def fit(self, examples, epochs=EPOCHS):
        """examples: (text, [(kind, start, end)]). Ascent on the conditional log-likelihood of all segmentations."""
        data = self.prepare(examples)
        grads = np.zeros_like(self.weights)
        for _ in range(epochs if data else 0):
            step = self.likelihood(data)[1] - DECAY * self.weights * len(data)
            grads += step**2
            self.weights = self.weights + RATE * step / np.sqrt(grads + 1e-8)
        return self


def variants(text: str, spans):
    """Forms of labelled spans that the patterns miss, in the same surroundings."""
    for k, a, b in spans:
        old = text[a:b]
        new = {0: old.replace("@", " at ").replace(".", " dot "), 3: old.lstrip("+0123456789").strip() if "(" in old else old}.get(k, old)
        if new != old and new:
            left, right = text[max(0, a - 60) : a], text[b : b + 60]
            yield left + new + right, [(k, len(left), len(left) + len(new))]


class PiiScan:
    def __init__(self, margin=MARGIN, sample=SAMPLE):
        self.margin, self.sample = margin, sample

    def fit(self, docs: DataFrame, text_col="text") -> "PiiScan":
        """Trains on at most `sample` texts of at most SAMPLE_CHARS characters, spread by hash."""
        tune(docs.sparkSession)
        text = F.col(text_col).cast("string")
        likely = docs.select(text.alias("text")).where((F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike(r"@[A-Za-z0-9-]+\.|\+[0-9][ ().0-9-]{8}|[0-9]{12}|[0-9]+\.[0-9]+\.[0-9]+\.[0-9]"))
        texts = [r["text"] for r in hash_sample(likely, "text", self.sample).collect()]
        examples = []
        for t, kind, span in EXAMPLES * 3:
            at = t.index(span)
            examples.append((t, [(KINDS.index(kind), at, at + len(span))] if kind else []))
        for t in texts:
            spans = base_spans(t)
            examples += [(t, spans), *variants(t, spans)]
        self.model = SemiCRF().fit(examples)
        return self

    def spans(self, text_col="text"):
        """Column: array of (kind, first, last, base), by start, then kind."""
        model, margin = self.model, self.margin

        @F.arrow_udf("array<struct<kind:int,first:int,last:int,base:boolean>>")
        def find(texts: pa.Array) -> pa.Array:
            rows = []
            for raw in texts.to_pylist():
                text = raw.decode("utf-8", "replace")
                base = base_spans(text)
                more = []
                if ANCHOR.search(text):
                    more = [x for x in model.decode(text, margin) if not any(x[1] < b and a < x[2] for _, a, b in base)]
                both = sorted([(a, k, b, True) for k, a, b in base] + [(a, k, b, False) for k, a, b in more])
                rows.append([{"kind": k, "first": a, "last": b, "base": is_base} for a, k, b, is_base in both])
            return pa.array(rows, pa.list_(pa.struct([("kind", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("base", pa.bool_())])))

        return find.asNondeterministic()(utf8(text_col))  # so that a filter on the spans doesn't find them a second time


def scan_pii(docs: DataFrame, id_col="doc_id", text_col="text", **options) -> DataFrame:
    scan = PiiScan(**options).fit(docs, text_col)
    return docs.select(F.col(id_col).alias("doc_id"), scan.spans(text_col).alias("spans"))
