"""Secret scans: patterns, and random-looking tokens found by a battery of tests under false-discovery control."""

import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from sessionrank.llm.common import LOWER_BYTES, map_texts, stage

# The patterns of the base kinds, in the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# Tokens that the battery looks at, and the alphabets it infers, smallest first.
TOKEN = re.compile(r"[A-Za-z0-9+/_-]+")
TOKEN_LEAST = 20
# What is looked at in a run with characters of both base64 alphabets, which fits neither.
_PARTS = [re.compile(r"[A-Za-z0-9%s]{%d,}" % (c, TOKEN_LEAST)) for c in ("+/", "_-")]
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("hex", DIGITS + "abcdef"), ("HEX", DIGITS + "ABCDEF"), ("base32", UPPER + "234567"), ("base36", DIGITS + LOWER),
    ("BASE36", DIGITS + UPPER), ("base62", UPPER + LOWER + DIGITS), ("base64", UPPER + LOWER + DIGITS + "+/"), ("base64url", UPPER + LOWER + DIGITS + "-_"),
)
_SETS = [(frozenset(a), {c: i for i, c in enumerate(a)}) for _, a in ENCODINGS]

# Share of truly random tokens among those dismissed as structured.
FALSE_DISCOVERIES = 0.01
# p-values are rounded up to steps of 10 ** -(1 / STEPS), down to 10 ** -LAST.
STEPS, LAST = 20, 16


def encoding_of(token):
    """Number of the smallest alphabet a token fits, None without one: it must have letters and digits, or both cases."""
    chars = set(token)
    if not (any(c.isdigit() for c in chars) and any(c.isalpha() for c in chars)) and not (
        any(c.islower() for c in chars) and any(c.isupper() for c in chars)
    ):
        return None
    return next((k for k, (alphabet, _) in enumerate(_SETS) if chars <= alphabet), None)


def tokens(text):
    """(start, end) of the runs that the battery looks at; of a run that has '+' or '/' and '_' or '-', its longest parts without either pair."""
    for m in TOKEN.finditer(text):
        if len(m[0]) < TOKEN_LEAST:
            continue
        if any(c in m[0] for c in "+/") and any(c in m[0] for c in "_-"):
            yield from sorted({(p.start(), p.end()) for part in _PARTS for p in part.finditer(text, m.start(), m.end())})
        else:
            yield m.start(), m.end()


def _two_sided(z):
    return math.erfc(abs(z) / math.sqrt(2))


def p_value(token, encoding):
    """How well a token fits independent uniform draws from its alphabet: the least of three tests' p-values, times three.

    Chi-squared of the symbol counts (Wilson-Hilferty), runs above and below the middle of the alphabet, lag-1 correlation.
    """
    index = _SETS[encoding][1]
    size, n = len(index), len(token)
    x = np.array([index[c] for c in token], float)
    counts = np.bincount(x.astype(int), minlength=size)
    free = size - 1
    chi = float(((counts - n / size) ** 2).sum() * size / n)
    fit = ((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    high = x >= size / 2
    a, b = int(high.sum()), int(n - high.sum())
    if a and b:
        mean = 2 * a * b / n + 1
        spread = 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
        runs = (1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(spread) if spread > 0 else 0.0
    else:
        runs = math.sqrt(n)
    y = x - x.mean()
    power = float((y * y).sum())
    serial = (float((y[1:] * y[:-1]).sum()) / power * n + 1) / math.sqrt(n) if power else math.sqrt(n)
    return min(1.0, 3 * min(map(_two_sided, (fit, runs, serial))))


def rounded(p):
    """The step that a p-value is rounded up to: 0 for 1, more for less."""
    return min(STEPS * LAST, int(math.floor(-math.log10(max(p, 10.0 ** -(LAST + 1))) * STEPS + 1e-12)))


def spans(text):
    """(kind number, start, end, stratum, step, key) of all pattern spans and candidates of a text, by start, then kind."""
    found = [(0, m.start(), m.end(), -1, -1, 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(1, m.start(), m.end(), -1, -1, 0) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(2, m.start(), m.end(), -1, -1, 0) for m in HEX.finditer(text) if len(m[0]) >= HEX_LEAST]
    for start, end in tokens(text):
        token = text[start:end]
        encoding = encoding_of(token)
        if encoding is not None:
            stratum = encoding * 64 + len(token).bit_length()
            key = zlib.crc32(token.encode()) << 31 ^ zlib.adler32(token.encode())
            found.append((3, start, end, stratum, rounded(p_value(token, encoding)), key))
    return sorted(found, key=lambda s: (s[1], s[0], s[2]))


_TOKEN_BYTE = np.zeros(256, bool)
_TOKEN_BYTE[list(b"+/_-" + DIGITS.encode() + LOWER.encode() + UPPER.encode())] = True


def worth_reading(texts):
    """Which texts have a run of TOKEN_LEAST token bytes or a name of the assign kind; others have no spans."""
    sizes = np.array([len(t) for t in texts], np.int64)
    run = np.zeros(len(texts), bool)
    token = np.concatenate([[False], _TOKEN_BYTE[np.frombuffer(b"\0".join(texts), np.uint8)], [False]]) if len(texts) else np.zeros(2, bool)
    edge = np.flatnonzero(token[1:] != token[:-1])
    first, past = edge[::2], edge[1::2]
    starts = np.cumsum(sizes + 1) - sizes - 1
    run[np.searchsorted(starts, first[past - first >= TOKEN_LEAST], "right") - 1] = True
    low = [t.translate(LOWER_BYTES) for t in texts]
    return [bool(r) or any(n in t for n in _NAMES) for r, t in zip(run, low)]


def candidates(docs, keep=("doc_id",), text="text"):
    """Rows (keep..., found array<struct<kind, start, end, stratum, step, key>>), one for each document row."""
    def make():
        names = ("k", "start", "end", "stratum", "step", "key")

        def each(texts, _):
            worth = worth_reading(texts)
            return [[[dict(zip(names, s)) for s in spans(t.decode("utf-8", "replace"))] if w else [] for t, w in zip(texts, worth)]]

        return each

    return map_texts(docs, text, keep, "found array<struct<k:int,start:bigint,end:bigint,stratum:int,step:int,key:bigint>>", make)


def dismissals(found, rate=FALSE_DISCOVERIES):
    """{stratum: step}: from which step on candidates of an alphabet and length class are dismissed.

    Benjamini-Hochberg in each stratum, over all distinct candidates of the corpus, on the rounded p-values.
    A false discovery is a random token that is dismissed. The table of counts has at most
    8 alphabets x 64 length classes x (STEPS * LAST + 1) rows.
    """
    each = found.select(F.explode("found").alias("c")).filter("c.k = 3").select("c.stratum", "c.step", "c.key").distinct()
    counts = {}
    for stratum, step, n in map(tuple, each.groupBy("stratum", "step").agg(F.count(F.lit(1))).collect()):
        counts.setdefault(stratum, {})[step] = n
    out = {}
    for stratum, steps in counts.items():
        total, below = sum(steps.values()), 0
        for step in sorted(steps, reverse=True):
            below += steps[step]
            if 10.0 ** (-step / STEPS) <= rate * below / total:
                out[stratum] = step
    return out


def find_secrets(docs, keep=("doc_id",), text="text", rate=FALSE_DISCOVERIES):
    """Rows (keep..., spans array<struct<kind, start, end>>), one for each document row: code points, end exclusive.

    Kinds assign, access and hex are pattern matches; random are tokens of 20 or more characters with letters
    and digits, or both cases, that the battery does not tell from uniform draws. Spans are ordered by
    start, then kind. Null and empty texts have none; repeated rows are treated one by one; copies of
    one token count once in the control. Other columns play no part.
    """
    names = [f"c{i}" for i in range(len(keep))]
    source = docs.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keep, names)], F.col(f"`{text}`").alias("words"))
    found = stage(candidates(source, names, "words"), "candidates")
    limits = dismissals(found, rate)
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]) if limits else F.lit(None).cast("map<int,int>")
    kind = F.array(*map(F.lit, KINDS))
    stays = F.filter("found", lambda c: (c["k"] < 3) | (c["step"] < F.coalesce(limit[c["stratum"]], F.lit(STEPS * LAST + 1))))
    return found.select(*[F.col(n).alias(k) for n, k in zip(names, keep)], F.transform(
        stays, lambda c: F.struct(kind[c["k"]].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
    ).alias("spans"))
