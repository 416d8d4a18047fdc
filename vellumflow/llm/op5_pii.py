"""Personal data by candidate gradient boosting.

Generators of high recall propose spans, which may overlap: what the base patterns match, checked or
not, runs of digit groups within matches that fail, looser forms (written-out addresses, numbers
without a leading plus, odd separators), and secrets: what is assigned to a name, and long runs that
mix letters and digits. Boosted trees score each candidate from its format and its context; per kind
the threshold is the least that keeps the wanted precision on examples held back from the trees.
Spans of the base rules always stay; of the other candidates those above the threshold are added, the
best first, where they touch nothing taken. The trees learn from written templates with decoys, drawn
from a fixed seed, and from what the base patterns match in a bounded sample of the corpus.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from math import log2
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.llm.common import table

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")
PRECISION = 0.995
EXAMPLES = 9000
SAMPLE = 1000  # bound on the documents of the corpus whose base matches the trees learn from
ROUNDS, DEPTH, RATE, BINS = 60, 4, 0.3, 16
AROUND = 40  # characters of context on either side
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
GROUP = re.compile(r"[0-9]++")
#: Looser forms by kind, and signs of which a text that holds one has at least one.
LOOSE = (
    ("email", re.compile(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._+-]*+ ?[\[({](?:at|AT|@)[\])}] ?[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]{2,}+| ?[\[({](?:dot|DOT|\.)[\])}] ?[A-Za-z0-9-]{2,}+)++"), tuple(a + b for a in "[({" for b in ("at", "AT", "@"))),
    ("email", re.compile(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._+-]*+＠[A-Za-z0-9-]++(?:[.．][A-Za-z0-9-]{2,}+)++"), ("＠",)),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)| \. )[0-9]{1,3}){3}(?![0-9])"), ("[.]", "(.)", " . ")),
    ("secret", re.compile(r"(?<=[=:])[ \t]*+[\"'`]?([A-Za-z0-9+/_.~!@#$%^&*=-]{6,}+)"), ("=", ":")),
)
LOOSE_DIGITS = (
    ("card", re.compile(r"(?<![\w.-])[0-9]{4}(?:[./_][0-9]{4}){3}(?![\w-])")),
    ("phone", re.compile(r"(?<![\w.+-])\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![\w-])")),
    ("phone", re.compile(r"(?<![\w.+-])00[1-9][0-9]{0,2}[ .-][0-9(][ ().0-9-]+[0-9](?![\w-])")),
    ("secret", re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{16,}+={0,2}")),
)
HINTS = {
    "email": ("mail", "contact", "write to", "reach"),
    "ip": ("ip ", "ip:", "host", "addr", "server"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("tel", "phone", "call", "fax", "mobile"),
    "secret": ("token", "secret", "passw", "pwd", "key", "auth", "bearer", "credential"),
}
AGAINST = ("order", "invoice", "isbn", "serial", "version", "ref", "sku", "page", "part no", "total", "commit", "sha", "md5", "hash", "digest", "checksum", "etag", "uuid", "build")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def small_parts(text: str) -> bool:
    """Whether all runs of digits are numbers up to 255."""
    return all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in re.findall(r"[0-9]+", text))


def emails(text: str):
    """Leftmost matches, found from their @ signs so that a text is passed only once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def matches(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, whether its check holds) of all matches of the base patterns."""
    out = [("email", a, b, True) for a, b in emails(text)]
    if not DIGIT.search(text):
        return out
    out += [("ip", m.start(), m.end(), small_parts(m.group())) for m in IP.finditer(text)]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = only_digits(m.group())
            out.append(("card", m.start(), m.end(), 12 <= len(d) <= 19 and luhn(d)))
    if "+" in text:
        out += [("phone", m.start(), m.end(), 9 <= len(only_digits(m.group())) <= 15) for m in PHONE.finditer(text)]
    return out


def digit_runs(text: str, start: int, end: int, least: int, most: int):
    """Stretches of whole digit groups of text[start:end] with `least` to `most` digits in all."""
    groups = [(m.start(), m.end()) for m in GROUP.finditer(text, start, end)]
    for i, (first, _) in enumerate(groups):
        digits = 0
        for a, b in groups[i:]:
            digits += b - a
            if digits > most:
                break
            if digits >= least:
                yield first, b


def candidates(text: str, found: list[tuple[str, int, int, bool]]) -> list[tuple[str, int, int]]:
    """What the trees decide on: base matches that fail and runs of digit groups in them, and the looser
    forms, of any length."""
    out = []
    for kind, a, b, ok in found:
        if not ok:
            out.append((kind, a, b))
            if kind == "card":
                out += [(kind, x, y) for x, y in digit_runs(text, a, b, 12, 19) if (x, y) != (a, b) and luhn(only_digits(text[x:y]))]
            elif kind == "phone":
                out += [(kind, a, y) for x, y in digit_runs(text, a, b, 9, 15) if x == a + 1 and y != b]
    for kind, pattern, signs in LOOSE:
        if any(s in text for s in signs):
            out += [(kind, *m.span(pattern.groups)) for m in pattern.finditer(text)]
    if DIGIT.search(text):
        for kind, pattern in LOOSE_DIGITS:
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    return out


def measures(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate; the context is AROUND characters on either side."""
    span, left, right = text[start:end], text[max(0, start - AROUND) : start].lower(), text[end : end + AROUND].lower()
    digits = only_digits(span)
    groups = GROUP.findall(span)
    context = left + " " + right
    side = lambda c: 0.0 if not c or c.isspace() else 1.0 if c.isdigit() else 2.0 if c.isalpha() else 3.0
    times, size = Counter(span), max(1, len(span))
    spread = -sum(n / size * log2(n / size) for n in times.values())
    share = lambda test: sum(n for c, n in times.items() if test(c)) / size
    wordlike = max(map(len, re.findall(r"[a-z]+|[A-Z][a-z]+", span)), default=0) / size
    tail = re.split(r"[^A-Za-z0-9]+", span)[-1]
    before = left.rstrip(" \t\"'`")[-1:]
    return [
        *(float(kind == k) for k in ALL_KINDS), float(len(span)), float(len(digits)), float(len(groups)), float(len(set(span) - set("0123456789"))),
        float(12 <= len(digits) <= 19 and luhn(digits)), float(bool(groups) and small_parts(span)), float(len(set(digits))), float(span.startswith("+")), float("(" in span), float("@" in span or "＠" in span),
        float(bool(re.search(r"[\[({](at|@)[\])}]", span.lower()))), float(bool(re.search(r"[\[({](dot|\.)[\])}]", span.lower()))), float(digits.startswith("00")),
        side(left[-1:]), side(right[:1]), *(float(any(h in context for h in HINTS[k])) for k in ALL_KINDS), float(any(h in left[-20:] for h in HINTS["secret"])), float(any(h in context for h in AGAINST)),
        spread, share(str.isdigit), share(str.isupper), share(lambda c: c in "0123456789abcdefABCDEF"), share(lambda c: not c.isalnum()), wordlike, float(before == "="), float(before == ":"), float(left.rstrip()[-1:].isdigit()), float(right.lstrip()[:1].isdigit()), float(digits[:1] or -1), float(len(set(map(len, groups))) == 1), float(len(tail)), float(tail.isalpha()), float(left[-1:] in "\"'`" and left[-1:] == right[:1] != ""),
    ]


class Trees:
    """Gradient-boosted trees on binned features for the logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        bins = self._binned(x)
        self.bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        self.trees: list[list[tuple]] = []
        z = np.full(len(y), self.bias)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-z))
            tree = self._grow(bins, y - p, p * (1 - p))
            self.trees.append(tree)
            z += self._walk(tree, bins)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)], axis=1)

    def _grow(self, bins: np.ndarray, gradient: np.ndarray, curve: np.ndarray) -> list[tuple]:
        """Nodes in heap order: (feature, bin) or (None, value)."""
        tree: list[tuple] = [(None, 0.0)] * (2 ** (DEPTH + 1) - 1)
        rows = {0: np.arange(len(bins))}
        for node in range(len(tree)):
            if node not in rows:
                continue
            at = rows[node]
            g, h = gradient[at], curve[at]
            tree[node] = (None, RATE * g.sum() / (h.sum() + 1))
            if node >= 2**DEPTH - 1 or len(at) < 20:
                continue
            width = bins.shape[1]
            cells = (bins[at] + np.arange(width) * BINS).ravel()  # sums of all features at once
            gs, hs = (np.bincount(cells, np.repeat(v, width), width * BINS).reshape(width, BINS).cumsum(axis=1) for v in (g, h))
            gain = gs**2 / (hs + 1) + (gs[:, -1:] - gs) ** 2 / (hs[:, -1:] - hs + 1) - gs[:, -1:] ** 2 / (hs[:, -1:] + 1)
            feature, cut = divmod(int(gain[:, :-1].argmax()), BINS - 1)
            if gain[feature, cut] > 1e-6:
                tree[node] = (feature, cut)
                low = bins[at, feature] <= cut
                rows[2 * node + 1], rows[2 * node + 2] = at[low], at[~low]
        return tree

    @staticmethod
    def _walk(tree: list[tuple], bins: np.ndarray) -> np.ndarray:
        out, node = np.zeros(len(bins)), np.zeros(len(bins), np.int64)
        for k, (feature, value) in enumerate(tree):
            here = node == k
            if feature is None:
                out[here] = value
            elif here.any():
                node[here] = 2 * k + 1 + (bins[here, feature] > value)
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        bins = self._binned(x)
        return 1 / (1 + np.exp(-(self.bias + sum(self._walk(t, bins) for t in self.trees))))


HEX, MIXED = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def examples(n: int, seed: int = 11) -> list[tuple[list[float], str, int]]:
    """(measures, kind, label) of candidates in n texts written from templates, some with decoys."""
    draw = Random(seed)
    word = lambda: "".join(draw.choice("aeioulnrstdmpckbg") for _ in range(draw.randint(2, 9)))
    of = lambda letters, k: "".join(draw.choice(letters) for _ in range(k))
    number = lambda k: of("0123456789", k)
    noise = lambda w: w + draw.choice(("###", "%%%", "***", "$$$", "&&&", "!!!"))

    def prose() -> str:
        words = [word() for _ in range(draw.randint(1, 7))]
        return " ".join(map(noise, words) if draw.random() < 0.15 else words)

    def valid(k: int, good: bool) -> str:
        body = draw.choice("3456" if good else "0123456789") + number(k - 2)
        return body + next(c for c in draw.sample("0123456789", 10) if luhn(body + c) == good)

    def part(most: int = 255) -> str:
        return str(draw.randint(0, most))

    def number_phone() -> str:
        a, b, c = str(draw.randint(200, 989)), number(3), number(4)
        return draw.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{draw.randint(1, 99)} {draw.randint(10, 99)} {b} {c}"))

    def secret() -> tuple[str, str, str]:
        """(what leads to it, the secret, what follows)."""
        name = draw.choice(("token", "secret", "password", "passwd", "api_key", "apikey", "access_key", "auth", "client_secret", "private_key", "SECRET_KEY", "TOKEN"))
        value = draw.choice((of(HEX, draw.choice((32, 40, 48, 64))), of(MIXED, draw.randint(12, 60)), of(MIXED + "+/", draw.choice((24, 32, 44))), "AKIA" + of(MIXED[:26] + "0123456789", 16), f"{word()}_{of(MIXED, 32)}", of(MIXED + "!#%&*", draw.randint(10, 16)) + number(1)))
        quote = draw.choice(('"', '"', "'", ""))
        return f"{draw.choice(('', word() + '_', 'the '))}{name}{draw.choice((' = ', '=', ': ', ':'))}{quote}", value, quote

    def plain_value() -> tuple[str, str, str]:
        """An assignment or a long run that is no secret."""
        quote, sign = draw.choice(('"', "'", "", "")), draw.choice((" = ", "=", ": "))
        hexes = of(HEX, draw.choice((32, 40, 64)))
        return draw.choice((
            (f"{draw.choice(('commit', 'sha256', 'md5', 'checksum', 'etag', 'digest', 'build'))}{draw.choice((' ', ': ', ' = '))}", hexes, ""),
            (f"uuid{sign}", f"{of(HEX, 8)}-{of(HEX, 4)}-4{of(HEX, 3)}-{of(HEX, 4)}-{of(HEX, 12)}", ""),
            (f"{word()}{sign}{quote}", draw.choice((word() + word(), f"{word()}-{word()}", f"{word()}_{number(2)}", f"{word()}.{word()}.{word()}", f"{number(4)}-{number(2)}-{number(2)}")), quote),
            (f"{draw.choice(('key', 'token', 'password'))}{sign}{quote}", draw.choice((word() + word(), f"<{word()}>", "********", "required")), quote),
            ("see https:", f"//{word()}.{word()}/{word()}/{word()}-{number(3)}/{word()}", ""),
            (f"{word()} ", f"{word()}-{word()}-{word()}-{number(2)}", ""),
            ("file ", f"{word()}_{number(8)}_{number(6)}_{word()}", ""),
        ))

    def make() -> tuple[str, int, str, int, int]:
        kind, hit = draw.choice(ALL_KINDS), draw.random() < 0.5
        hint = draw.choice(HINTS[kind]) if draw.random() < (0.6 if hit else 0.1) else word()
        if not hit and draw.random() < 0.5:
            hint = draw.choice(AGAINST)
        lead, close = f"{hint}{draw.choice((' ', ': '))}", ""
        if kind == "email":
            at, dot = draw.choice((("[at]", "[dot]"), (" (at) ", " (dot) "), ("(at)", "."), ("＠", "."), ("[@]", "[.]"), ("{at}", "."), ("{@}", ".")))
            span = f"{word()}{draw.choice(('', '.' + word()))}{at}{word()}{dot}{draw.choice(('com', 'org', 'net', 'edu', 'de', 'fr'))}" if hit else f"{word()}{draw.choice(('(at)', '[at]', '[@]'))}{word()}.{draw.choice((number(2), word()))}"
        elif kind == "ip":
            span = draw.choice(("[.]", "(.)", " . ")).join(part() for _ in range(4)) if hit else draw.choice(("[.]", ".", " . ")).join(part(999) for _ in range(3)) + "." + str(draw.randint(256, 99999))
        elif kind == "card":
            d = valid(16, hit)
            span = draw.choice((".", "/", "_") if hit else ("", " ", "-", ".", "/")).join(d[i : i + 4] for i in range(0, 16, 4)) if hit or draw.random() < 0.5 else valid(draw.choice((12, 13, 15, 17, 19, 24)), False)
            if hit and draw.random() < 0.3:  # next to another number, as one failing match
                span = " ".join(d[i : i + 4] for i in range(0, 16, 4))
                close = " " + " ".join(number(4) for _ in range(draw.randint(1, 4)))
        elif kind == "phone":
            if hit:
                span = number_phone()
                if draw.random() < 0.3:
                    span, close = f"+{draw.randint(1, 99)} {draw.randint(10, 99)} {number(3)} {number(4)}", f" {number(draw.choice((6, 8, 12)))}"
            else:
                span = draw.choice((f"{number(3)} {number(3)} {number(4)}", f"+{number(draw.choice((3, 5, 7)))}", f"00{draw.randint(1, 9)} {number(4)} {number(4)}", f"+{number(9)} {number(9)}"))
        else:
            lead, span, close = secret() if hit else plain_value()
        before = f"{prose()} {lead}"
        return kind, int(hit), f"{before}{span}{close}{draw.choice(('', '.', ',', '###', '%%%'))} {prose()}", len(before), len(before) + len(span)

    out = []
    for _ in range(n):
        kind, hit, text, start, end = make()
        for k, a, b in candidates(text, matches(text)):
            exact = hit and k == kind and abs(a - start) <= 1 and abs(b - end) <= (1 if k != "secret" else 3)
            out.append((measures(text, k, a, b), k, int(exact)))
    return out


def corpus_examples(docs: DataFrame, text: str = "text", limit: int = SAMPLE) -> list[tuple[list[float], str, int]]:
    """(measures, kind, label) of all base matches in `limit` documents at the most that have a digit, those
    with the least hash of their text, equal texts once: what passes its check is personal data, what fails is not."""
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(body.alias("text"), F.xxhash64(body).alias("h")).where(F.col("text").rlike("[0-9]"))
    drawn = rows.select("h").distinct().orderBy("h").limit(limit)
    drawn = rows.join(F.broadcast(drawn), "h").groupBy("h").agg(F.min("text").alias("text")).select("text")

    def find(batches):
        for batch in batches:
            rows = [(measures(x, k, a, b), k, int(ok)) for x in batch.column(0).to_pylist() for k, a, b, ok in matches(x)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.list_(pa.float64()), pa.string(), pa.int64()))], ["measures", "kind", "label"])

    found = drawn.mapInArrow(find, "measures array<double>, kind string, label long").orderBy(F.xxhash64("measures"), "kind").limit(EXAMPLES)
    return [(list(r["measures"]), r["kind"], r["label"]) for r in found.collect()]


class Redactor:
    """Trees and a threshold per kind: the least score at which the examples held back are found with
    the wanted precision."""

    def __init__(self, n: int = EXAMPLES, more: list[tuple[list[float], str, int]] = ()) -> None:
        drawn = [*examples(n), *more]
        x, y = np.array([m for m, _, _ in drawn]), np.array([label for _, _, label in drawn], float)
        held = np.arange(len(y)) % 3 == 0
        self.trees = Trees(x[~held], y[~held])
        scores, kinds = self.trees.scores(x[held]), np.array([k for _, k, _ in drawn])[held]
        self.least = {}
        for kind in ALL_KINDS:
            order = np.argsort(-scores[kinds == kind], kind="stable")
            s, good = scores[kinds == kind][order], y[held][kinds == kind][order]
            precise = np.flatnonzero(good.cumsum() / np.arange(1, len(good) + 1) >= PRECISION)
            self.least[kind] = max(0.5, float(s[precise[-1]])) if len(precise) else 2.0

    def spans(self, text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """(base spans, all spans), each by start and then kind."""
        return self.all_spans([text])[0]

    def all_spans(self, texts: list[str]) -> list[tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]]:
        """spans() of every text; the candidates of all are scored together."""
        base, more, x = [], [], []
        for text in texts:
            found = matches(text)
            base.append(sorted(((k, a, b) for k, a, b, ok in found if ok), key=_order))
            more.append(candidates(text, found))
            x += [measures(text, *c) for c in more[-1]]
        scores = self.trees.scores(np.array(x)) if x else np.zeros(0)
        out, first = [], 0
        for own, proposed in zip(base, more):
            out.append((own, self._chosen(own, proposed, scores[first : first + len(proposed)])))
            first += len(proposed)
        return out

    def _chosen(self, base: list, proposed: list, scores: np.ndarray) -> list[tuple[str, int, int]]:
        """The base spans and, the best first, the candidates above their threshold that touch nothing taken."""
        taken, at = list(base), sorted((a, b) for _, a, b in base)
        reach = [b for _, b in at]
        for i in range(1, len(reach)):
            reach[i] = max(reach[i], reach[i - 1])  # base spans of different kinds may overlap
        for i in np.argsort(-scores, kind="stable").tolist():
            kind, a, b = proposed[i]
            if scores[i] < self.least[kind]:
                continue
            k = bisect_left(at, (a, b))
            if (k and reach[k - 1] > a) or (k < len(at) and at[k][0] < b):
                continue
            taken.append(proposed[i])
            at.insert(k, (a, b))
            reach.insert(k, b)
        return sorted(taken, key=_order)


def _order(span: tuple[str, int, int]) -> tuple[int, int]:
    return span[1], ALL_KINDS.index(span[0])


SPAN = "array<struct<kind:string,start:long,end:long>>"


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, spans) for every row: spans of personal data and secrets in code points, end
    exclusive, by start and then kind; base holds those of the rules. Overlapping spans of different
    rules all stay.

    Null and empty texts have none; very long texts are searched whole; of candidates with equal scores
    the first proposed is tried first; repeated rows are answered each; no rows give no rows. Other
    columns, whatever their names, are not looked at."""
    model = docs.sparkSession.sparkContext.broadcast(Redactor(more=corpus_examples(docs, text)))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def find(batches):
        for batch in batches:
            rows = model.value.all_spans([x or "" for x in batch.column(1).to_pylist()])
            named = [pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in r[i]] for r in rows], kind) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *named], ["doc_id", "base", "spans"])

    chosen = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return chosen.mapInArrow(find, f"doc_id {dict(chosen.dtypes)['doc_id']}, base {SPAN}, spans {SPAN}")


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every span of its text replaced by its kind in square brackets; of overlapping spans
    the first to start, the longest of these, is replaced."""
    model = docs.sparkSession.sparkContext.broadcast(Redactor(more=corpus_examples(docs)))
    at = docs.columns.index("text")

    def replace(text: str | None, spans: list) -> str | None:
        out, end = [], 0
        for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
            if a >= end:
                out += [text[end:a], f"[{kind}]"]
                end = b
        return text if not out else "".join(out) + text[end:]

    def answer(batches):
        for batch in batches:
            columns = list(batch.columns)
            texts = columns[at].to_pylist()
            found = model.value.all_spans([x or "" for x in texts])
            columns[at] = pa.array([replace(x, s) for x, (_, s) in zip(texts, found)], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(answer, docs.schema)


def op5_boosted_pii(spark, sf_dir: str) -> DataFrame:
    """Counts and spans of personal data in every document; n_spans counts all spans, n_secret secrets."""
    found = personal_data(table(spark, sf_dir, "documents"))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind, column: F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    digest = F.sha2(joined("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *(of(k, "base") for k in KINDS), digest, joined("spans").alias("spans"), of("secret", "spans"), F.size("spans").cast("long").alias("n_spans"))
