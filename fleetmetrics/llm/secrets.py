"""Secrets in texts: key patterns, and tokens that pass a battery of randomness tests.

A candidate token is a long run of characters of an encoding. Its encoding is inferred (hex, base32, base64, letters and
digits), and its symbols are tested for randomness: chi-squared for a uniform alphabet, Wald-Wolfowitz runs about the
middle of the alphabet, and lag-one serial correlation. A token is a secret if none of the three tests rejects
randomness, and if a token of natural text would hardly look so random. That last p-value is the inverse of a
likelihood ratio: symbols drawn alike from the encoding's alphabet, against names, words and numbers of prose (which kind
of symbol follows which, and which letter which). It bounds the chance from above at any length and falls with each
symbol; the Benjamini-Hochberg rule over the candidates of a document bounds the share of false discoveries.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmetrics.llm.pii import SPANS, span_rows

KINDS = ("assign", "access", "hex")
#: Level at which a randomness test rejects, and the share of false discoveries allowed.
REJECT, FALSE_DISCOVERIES = 0.001, 0.01
LEAST_LENGTH = 20

_any_case = lambda words: "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in words.split("|"))
_ASSIGN = re.compile(rf"""(?:{_any_case("password|passwd|secret|token|api_?key")})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
# A token may follow '=' (env lines, URL parameters), and may stand before one that is no padding (a name or a pair).
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+(?:={1,2}(?![A-Za-z0-9+/_=-]))?")

# How often each letter comes in a thousand letters of English prose, a to z.
LETTERS_PER_THOUSAND = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
# How rare each letter is after each other one in English prose (counted over the documentation texts of
# Python's library, smoothed by the shares above): rows a to z by the first letter, a for 0 half bits, b for 1, and so on.
_AFTER_LETTER = (
    "nkjklomojxogignlzghflnoqmv hqlneqqojgtgqniowkkmhsqwhs grmogqrhixjipnfqukmfjsqxpz inljdpqofutlqniqzkiljrqvnz jpihkknnmxskkgmlngghpnojnx "
    "hronijqoextkqneqwhmkhtqxnz jqpoeqmjgxtinikpzihlgqqxrq gsqocqrnhxtopnhrzlnlotqxqz kmjljjlonxpijehmwkggqlqpro lsopbqronxqpqnjrzonmitqxqz "
    "jrpmcpnnhxtkpkmjwmhmlrkxqz gpokelqngxshqnhoznjiiroxiv fjqodqrnjxsnknhgznllktqxpz hriggngnkwpmolhoynhflnqxnw mkkilioomxpkjeljzfkijmlrrw "
    "grpmfprmjxthqnhjzgmhknqxkz nsqnlqronxtoqmnrzmmmbtqxrz gpmleoknhxonkihozjiikonxlz kskoepqkhxqmomjjtngejrpxlz irnofpregxtmpnhozijkjtnwkx "
    "kllmgnmojxthhgmjzghgotqwrz drqpcqrogxtponkqznnmqsqxrz hrpohqrfdxtmqkhrzikmqtprrx gqfogornhxtopnmgzmmeqsqppr mqmmiponixtmliiezngfqrjxpt "
    "isppbprogxtplnjrzonmqtqxns "
).split()
# The kinds of symbols in tokens of natural text (lower case, capitals, digits, signs): how often each comes
# first, how often each follows each, and how often each sign stands among signs.
_FIRST = (0.5, 0.25, 0.15, 0.1)
_FOLLOWS = ((0.8, 0.06, 0.04, 0.1), (0.35, 0.53, 0.04, 0.08), (0.08, 0.06, 0.7, 0.16), (0.45, 0.2, 0.3, 0.05))
_SIGNS = {"-": 0.35, "/": 0.3, "_": 0.3, "+": 0.05}
#: Encodings in the order in which they are tried: name and alphabet.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower": "0123456789abcdefghijklmnopqrstuvwxyz",
    "alnum": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}


def _prose() -> tuple[np.ndarray, np.ndarray]:
    """Natural logs of how likely a symbol (by its code) comes first in a token of natural text, and after each other symbol.

    Kinds of symbols follow each other as in names, words and numbers; a letter in a word goes by the one before it,
    whatever their case; the first of a word, and a capital after a small letter, by its share in prose.
    """
    kind_of = lambda c: 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3
    share = np.array(LETTERS_PER_THOUSAND) / sum(LETTERS_PER_THOUSAND)
    after = 2.0 ** -(np.array([[ord(c) - 97 for c in row] for row in _AFTER_LETTER]) / 2)
    after /= after.sum(1, keepdims=True)
    first, follows = np.full(128, -np.inf), np.full((128, 128), -np.inf)
    symbols = sorted(set("".join(ALPHABETS.values())))
    for b in symbols:
        k = kind_of(b)
        alone = (share[ord(b.lower()) - 97] if k < 2 else 0.1 if k == 2 else _SIGNS[b])
        first[ord(b)] = math.log(_FIRST[k] * alone)
        for a in symbols:
            j = kind_of(a)
            within = k < 2 and j < 2 and not (j == 0 and k == 1)
            follows[ord(a), ord(b)] = math.log(_FOLLOWS[j][k] * (after[ord(a.lower()) - 97, ord(b.lower()) - 97] if within else alone))
    return first, follows


_SETS = {k: (frozenset(a), {c: i for i, c in enumerate(a)}) for k, a in ALPHABETS.items()}
_FIRST_LOG, _FOLLOWS_LOG = _prose()


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def infer(token: str) -> str | None:
    """The first encoding with all the token's symbols; None for plain numbers, words of one case without digits, and mixtures."""
    if token.isdigit() or token.isalpha() and (token.islower() or token.isupper() or token.istitle()):
        return None
    used = set(token)
    return next((k for k, (symbols, _) in _SETS.items() if used <= symbols), None)


def battery(token: str, encoding: str) -> tuple[float, float, float, float]:
    """p-values: chi-squared uniformity, runs, serial correlation (small: not random), and of natural text looking so random."""
    _, place = _SETS[encoding]
    x = np.array([place[c] for c in token])
    n, k = len(x), len(place)
    counts = np.bincount(x, minlength=k)
    chi2 = float(((counts - n / k) ** 2).sum() * k / n)
    # Wilson and Hilferty's cube root makes chi-squared nearly normal.
    uniform = normal_tail(((chi2 / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1))))
    high = x >= k / 2
    a, b = int(high.sum()), int(n - high.sum())
    mean = 1 + 2 * a * b / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    runs = 2 * normal_tail(abs(1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(var)) if var > 0 else 0.0
    d = x - x.mean()
    serial = 2 * normal_tail(abs(float((d[1:] * d[:-1]).sum() / max(1e-9, (d**2).sum())) + 1 / n) * math.sqrt(n)) if n > 2 else 0.0
    # The likelihood ratio of a random token (of any encoding alike) to one of natural text exceeds r in natural text with probability 1/r at most.
    codes = np.frombuffer(token.encode(), np.uint8)
    ratio = -n * math.log(k) - math.log(len(ALPHABETS)) - float(_FIRST_LOG[codes[0]] + _FOLLOWS_LOG[codes[:-1], codes[1:]].sum())
    return uniform, runs, serial, math.exp(-max(ratio, 0.0))


def random_tokens(text: str) -> list[tuple[int, int]]:
    """(start, end) of tokens that look random, in order."""
    tried = []
    for m in _TOKEN.finditer(text):
        token = m.group().rstrip("=")
        if len(token) >= LEAST_LENGTH and (encoding := infer(token)):
            uniform, runs, serial, natural = battery(token, encoding)
            tried.append((natural, min(uniform, runs, serial) >= REJECT, m.span()))
    tried.sort(key=lambda t: t[0])
    last = max((i for i, t in enumerate(tried) if t[0] <= FALSE_DISCOVERIES * (i + 1) / len(tried)), default=-1)
    return sorted(span for _, passes, span in tried[: last + 1] if passes)


def plain(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the key patterns, by start, then kind."""
    found, low = [], text.lower()
    if "password" in low or "passwd" in low or "secret" in low or "token" in low or "api" in low and "key" in low:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m.group()) >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def spans(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) of all secrets, by start; those of the battery are of kind ``random`` and overlap no base one."""
    base = plain(text)
    starts, reach = [a for _, a, _ in base], list(itertools.accumulate((b for _, _, b in base), max))
    # Of the base spans that begin before a token's end, does any reach beyond its start?
    extra = [("random", a, b, False) for a, b in random_tokens(text) if not (i := bisect.bisect_left(starts, b)) or reach[i - 1] <= a]
    return sorted([*((*s, True) for s in base), *extra], key=lambda s: (s[1], [*KINDS, "random"].index(s[0])))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans (kind, start, end in code points, end exclusive, base) of secrets in every whole text.

    ``base`` marks key patterns; the others are tokens that the randomness battery finds. One row a row of ``docs``,
    repeated ones and null ids included; null and empty texts have no spans; other columns are ignored; no rows give none.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(span_rows(spans), f"doc_id long, spans {SPANS}")
